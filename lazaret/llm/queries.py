"""The registered queries of the operators, each over its whole table, and SQL where that can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lazaret.llm import chat, decontaminate, dialogue, html_crf, licenses, ngram_join, packing, quality, search, sharding, toxicity, url_rules, warc
from lazaret.llm.tables import cut


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.near_duplicates(_read(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_read(spark, sf_dir, "documents"), "word_bpe_49k.json")
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    model = quality.fit(docs, _read(spark, sf_dir, "labels"))
    return quality.judge(docs, model).select("doc_id", *quality.STATISTICS, "base_failed", "kept", "margin")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_read(spark, sf_dir, "pages"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "conversations")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    windows = cut(chat.format_chats(rows.unionByName(extra)), "windows")
    return chat.read_windows(windows)


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages")
    labels = _read(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad")
    )
    rules = url_rules.mine(pages.join(labels, "page_id"))
    return url_rules.judge(pages, rules)


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licences(_read(spark, sf_dir, "documents"))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages")
    return html_crf.extract(pages, html_crf.fit(pages))


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_read(spark, sf_dir, "documents"))


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "conversations")
    return dialogue.repair(dialogue.damaged(rows), rows)


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, _read(spark, sf_dir, "labels")))


QUERIES = {
    f.__name__: f
    for f in (
        op1_ngram_join,
        op2_warc,
        op3_decontaminate,
        op4_chat,
        op5_pack,
        op6_url_rules,
        op7_licenses,
        op8_html,
        op9_quality,
        op10_shards,
        op11_search,
        op12_repair,
        op13_toxicity,
    )
}

_NGRAM_JOIN = r"""
WITH RECURSIVE
words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
lists AS (
    SELECT doc_id, CASE
        WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
    END AS s FROM words
),
shingles AS (SELECT doc_id, unnest(s) AS shingle FROM lists),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
    GROUP BY ALL
),
links AS (
    SELECT a, b FROM shared JOIN lists x ON x.doc_id = a JOIN lists y ON y.doc_id = b
    WHERE 100 * n >= 80 * (len(x.s) + len(y.s) - n)
),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT r.doc_id, l.b FROM reach r JOIN both_ways l ON l.a = r.other
)
SELECT r.doc_id, CAST(any_value(len(s)) AS BIGINT) AS n_shingles, min(other) AS component_id
FROM reach r JOIN lists USING (doc_id) GROUP BY r.doc_id
"""

_WARC = """
WITH hashed AS (
    SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
),
first AS (SELECT *, min(page_id) OVER (PARTITION BY hex, payload_bytes) AS original FROM hashed)
SELECT
    page_id, payload_bytes,
    array_to_string(flatten(list_transform(range(8), lambda g: list_transform([15, 10, 5, 0], lambda s:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               CAST(((CAST('0x' || substr(hex, CAST(5 * g + 1 AS INTEGER), 5) AS BIGINT) >> s) & 31) + 1 AS INTEGER), 1)))), '') AS payload_digest,
    CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = original THEN NULL ELSE original END AS refers_to
FROM first
"""


def _licenses_sql() -> str:
    quoted = ((n, t.replace("'", "''")) for n, t in licenses.TEMPLATES.items())
    rows = ", ".join(f"('{n}', '{t}')" for n, t in quoted)
    words = r"regexp_extract_all(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9\x{{80}}-\x{{10FFFF}}]+')"
    pairs = "list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])"
    return f"""
    WITH templates(template, t) AS (VALUES {rows}),
    known AS (
        SELECT template, list_distinct(p) AS b, len(list_distinct(p)) AS size, len(p) AS length
        FROM (SELECT template, {pairs} AS p FROM (SELECT template, {words.format("t")} AS w FROM templates))
    ),
    texts AS (SELECT row_number() OVER () AS r, doc_id, {pairs} AS p FROM (SELECT doc_id, {words.format("text")} AS w FROM documents)),
    near AS (
        SELECT r, template
        FROM (SELECT r, unnest(list_distinct(p)) AS pair FROM texts) JOIN (SELECT template, unnest(b) AS pair FROM known) USING (pair)
        JOIN known USING (template) GROUP BY r, template HAVING count(*) >= 0.66 * any_value(size)
    ),
    windows AS (
        SELECT r, template, size, b, s, least(length, len(p)) AS n, p[s + 1 : s + least(length, len(p))] AS own
        FROM (SELECT *, unnest(range(0, len(p) - least(length, len(p)) + 1)) AS s FROM near JOIN texts USING (r) JOIN known USING (template))
    ),
    scored AS (
        SELECT r, template, size, s, n, 2 * len(list_intersect(list_distinct(own), b)) / (len(list_distinct(own)) + size) AS dice FROM windows
    ),
    ordered AS (
        SELECT r, list({{'template': template, 's': s, 'e': s + n, 'dice': dice}} ORDER BY dice DESC, size DESC, template, s) AS l
        FROM scored WHERE dice >= 0.8 GROUP BY r
    ),
    kept AS (
        SELECT r, unnest(list_reduce(list_transform(l, lambda x: [x]), lambda held, x:
            CASE WHEN len(list_filter(held, lambda y: y.s <= x[1].e AND x[1].s <= y.e)) = 0 THEN held || x ELSE held END)) AS m
        FROM ordered
    )
    SELECT doc_id, split_part(m.template, ' ', 1) AS license, count(*) AS n_matches, max(m.dice) AS best_dice, min(m.s) AS first_word
    FROM kept JOIN texts USING (r) GROUP BY doc_id, split_part(m.template, ' ', 1)
    """


_SEARCH = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w, row_number() OVER () AS r FROM documents),
q AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
held AS (SELECT item_id, t, count(*) AS qtf FROM (SELECT item_id, unnest(w) AS t FROM q) GROUP BY ALL),
totals AS (SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0),
m AS (SELECT r, doc_id, 75 + (25 * len(w) * n) // l AS m FROM d, totals WHERE len(w) > 0),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) SEMI JOIN held USING (t) GROUP BY ALL),
weights AS (SELECT t, CAST(floor(1000 * ln((2 * any_value(n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, totals GROUP BY t),
scores AS (SELECT item_id, r, sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS score
    FROM held JOIN tf USING (t) JOIN weights USING (t) JOIN m USING (r) GROUP BY ALL),
ranked AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
    FROM scores JOIN m USING (r) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 20
"""

ORACLES = {"op1_ngram_join": _NGRAM_JOIN, "op2_warc": _WARC, "op7_licenses": _licenses_sql(), "op11_search": _SEARCH}
