"""Main text of web pages by a linear-chain conditional random field over the leaf blocks of the DOM.

A page is read once from start to end. Text between two borders of block elements is a leaf block, whatever inline elements it
has; scripts, styles, comments and the head give no blocks. A block's features are its ancestors' tags, words of
their class, id and role, its own tag, and its text: length, share of links, punctuation, symbols. A chain of two labels, main and
other, is decoded by Viterbi over all blocks of a page, so that neighbours decide with each other.

It is trained on labelled pages: pages written from patterns here (menus, notices, adverts, forms, comments,
sidebars, with and without semantic elements), and a bounded sample of the pages at hand that mark their article up,
where the marks are the labels. Half of the training pages are shown without the semantic ancestors, so that class words and
text carry weight too.

Character references are decoded, white space inside a block becomes one blank, blocks are joined by one blank in page
order; nothing else is left out or cut. A null or empty page has an empty text. Broken markup is read as far as it goes: an end tag
closes what it can, an unclosed element ends with its parent. Repeated rows are read each on their own; extra columns are not read.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lazaret.llm.tables import sampled_ids

# Kinds of HTML elements.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template svg math iframe object canvas audio video title".split())
SEMANTIC = frozenset("article main nav header footer aside form menu".split())
# An element of the first kind ends when one of the second kind begins inside the same parent.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
_SCOPE = frozenset("ul ol menu dl table select body html article section div main".split())

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)>|<[!?/][^>]*+>""",
    re.DOTALL,
)
_COMMENT = re.compile(r"<!--.*\Z", re.DOTALL)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+")


class Place:
    """An element of a page among its ancestors; what features and marks need of them is handed down, so deep pages cost no more."""

    __slots__ = ("tag", "plain", "semantic", "named", "marks")

    def __init__(self, parent: Place | None, tag: str, named: str):
        groups = {g for w in _WORD.findall(named) for g in _GROUP.get(w, ())}
        own = {f"named={g}" for g in groups}
        self.tag = tag
        self.named = bool(named) or (parent is not None and parent.named)
        if tag:
            self.semantic = _with(parent.semantic, own | {f"in={tag}"})
            self.plain = _with(parent.plain, own if tag in SEMANTIC else own | {f"in={tag}"})
            self.marks = tuple(_marked(m, state, tag, groups) for m, state in zip(MARKS, parent.marks, strict=True))
        else:
            self.semantic = self.plain = frozenset()
            self.marks = (0,) * len(MARKS)


def _with(held: frozenset[str], more: set[str]) -> frozenset[str]:
    return held if more <= held else held | more


# The elements that mark an article, and what inside them is never main.
MARKS = ("article", "main")
_NEVER = frozenset("nav aside form menu footer button select textarea label".split())
_OTHER = frozenset("advert notice form comment side menu share".split())


def _marked(mark: str, state: int, tag: str, groups: set[str]) -> int:
    """0 outside of the mark, 1 inside, 2 in something inside that is never main."""
    if state == 0:
        return int(tag == mark)
    return 2 if state == 1 and (tag in _NEVER or groups & _OTHER) else state


@dataclass
class Block:
    place: Place
    text: str
    linked: int


class _Open:
    """The open elements, each with its place, and where those of each name stand."""

    def __init__(self):
        self.items: list[tuple[str, Place]] = []
        self.at: dict[str, list[int]] = {}
        self.root = Place(None, "", "")

    @property
    def place(self) -> Place:
        return self.items[-1][1] if self.items else self.root

    def last(self, names) -> int:
        """Where the innermost of these names stands, -1 if none is open."""
        return max((self.at[n][-1] for n in names if self.at.get(n)), default=-1)

    def push(self, name: str, place: Place) -> None:
        self.at.setdefault(name, []).append(len(self.items))
        self.items.append((name, place))

    def close(self, i: int) -> int:
        """Close the element at i and all inside it; how many of them are links."""
        names = [name for name, _ in self.items[i:]]
        for name in names:
            self.at[name].pop()
        del self.items[i:]
        return names.count("a")


def blocks_of(page: str | None) -> list[Block]:
    """The leaf blocks of a page in order, those without text left out. The work goes with the length of the page, whatever is in it."""
    out: list[Block] = []
    stack = _Open()
    pieces: list[str] = []
    linked, links, in_head = 0, 0, False

    def flush():
        nonlocal linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                out.append(Block(stack.place, text, linked))
            pieces.clear()
        linked = 0

    page = page or ""
    at, end = 0, len(page)
    # Behind the last > there are no tags, and at most the start of a comment.
    last = page.rfind(">")
    while at < end:
        if at <= last:
            m = _TAG.search(page, at)
        else:
            m = _COMMENT.search(page, at)
        data = page[at : m.start()] if m else page[at:]
        if data and not in_head:
            pieces.append(data)
            if links:
                linked += len(data)
        if not m:
            break
        at = m.end()
        if m.re is _COMMENT:
            continue
        closing, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            continue
        name = name.lower()
        if name == "head":
            in_head = not closing
            continue
        if name in ("body", "html"):
            flush()
            in_head = in_head and name == "html"
            continue
        if in_head and name not in SILENT and not closing and name not in VOID:
            in_head = False
        if name in SILENT:
            if not closing and not attributes.endswith("/"):
                close = re.compile(rf"</{name}\b[^>]*>", re.IGNORECASE).search(page, at) if at <= last else None
                at = close.end() if close else end
            continue
        if name not in INLINE:
            flush()
        if name in VOID:
            continue
        if closing:
            i = stack.last((name,))
            if i >= 0 and not (name in INLINE and stack.last(SEMANTIC) > i):
                links -= stack.close(i)
            continue
        if name not in INLINE:
            i = stack.last(("p",))
            if i >= max(len(stack.items) - 4, 0):
                links -= stack.close(i)
            ended = [own for own, by in _ENDS.items() if name in by]
            if ended:
                i = stack.last(ended)
                if i >= 0 and stack.last(_SCOPE) < i:
                    links -= stack.close(i)
        if attributes.endswith("/"):
            continue
        place = stack.place
        if name not in INLINE:
            place = Place(place, name, " ".join(a or b or c for a, b, c in _NAMED.findall(attributes)).lower())
        if name == "a":
            links += 1
        stack.push(name, place)
    flush()
    return out


# --- features ----------------------------------------------------------------------------------

# Words of class, id and role names, by what they usually name.
_NAMES = {
    "advert": "ad ads adv advert adverts advertisement adsense banner sponsor sponsored promo promotion commercial dfp teaser",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay toast warning disclaimer paywall announcement",
    "form": "form login signin signup register search subscribe newsletter subscription input",
    "comment": "comment comments reply replies respond disqus discussion feedback reader readers",
    "side": "sidebar side aside widget widgets related recommended recommendations popular trending rail more tags archive secondary complementary",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc topbar toolbar tabs skip sitemap",
    "head": "header masthead banner topbar logo branding",
    "foot": "footer copyright legal colophon contentinfo credits",
    "share": "share sharing social follow twitter facebook buttons",
    "body": "article content post entry story body main text page blog single news prose",
}
_GROUP: dict[str, list[str]] = {}
for _g, _ws in _NAMES.items():
    for _w in _ws.split():
        _GROUP.setdefault(_w, []).append(_g)

def _path_features(place: Place, semantic: bool) -> tuple[str, ...]:
    tag = place.tag
    held = place.semantic if semantic else place.plain
    return tuple(sorted(held | {f"tag={tag}" if semantic or tag not in SEMANTIC else "tag="}))


def features(block: Block, semantic: bool = True) -> list[str]:
    text = block.text
    n = text.count(" ") + 1
    size = 0 if n < 3 else 1 if n < 6 else 2 if n < 12 else 3 if n < 25 else 4 if n < 60 else 5
    share = block.linked / max(len(text), 1)
    link = 0 if share == 0 else 1 if share < 0.34 else 2 if share < 0.8 else 3
    out = [*_path_features(block.place, semantic), "any", f"words={size}", f"links={link}", f"words={size} links={link}"]
    out.append("ends" if text[-1] in ".!?:;\"'”»)" else "open")
    if "©" in text or "·" in text or "All rights" in text:
        out.append("rights")
    if "," in text:
        out.append("comma")
    return out


# --- the field ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Field:
    """Weights by feature (other, main), by step from label to label, and for the first and last label."""

    weights: dict[str, tuple[float, float]]
    steps: tuple[tuple[float, float], tuple[float, float]]
    first: tuple[float, float]
    last: tuple[float, float]

    def decode(self, sequence: list[list[str]]) -> list[int]:
        """The most likely labels (Viterbi): 1 is main."""
        if not sequence:
            return []
        get, ((t00, t01), (t10, t11)), back = self.weights.get, self.steps, []
        s0, s1 = self.first
        for k, names in enumerate(sequence):
            if k:
                from0, from1 = (s0 + t00, s1 + t10), (s0 + t01, s1 + t11)
                back.append((from0[1] > from0[0], from1[1] > from1[0]))
                s0, s1 = max(from0), max(from1)
            for name in names:
                w = get(name)
                if w:
                    s0 += w[0]
                    s1 += w[1]
        label = int(s1 + self.last[1] > s0 + self.last[0])
        out = [label]
        for step in reversed(back):
            label = int(step[label])
            out.append(label)
        return out[::-1]


def train(pages: list[tuple[list[list[str]], list[int]]], rounds: int = 120, penalty: float = 0.02, rate: float = 0.15) -> Field:
    """Weights that maximise the likelihood of the labels given the blocks, with an L2 penalty.

    Forward and backward sums run over all pages at once, padded to the longest; Adam takes the gradient.
    """
    pages = [p for p in pages if p[0]]
    names = sorted({n for blocks, _ in pages for b in blocks for n in b})
    number = {n: i for i, n in enumerate(names)}
    p, length = len(pages), np.array([len(b) for b, _ in pages])
    longest = int(length.max())
    x = np.zeros((p * longest, len(names)), np.float32)
    y = np.zeros((p, longest), np.int64)
    for i, (blocks, labels) in enumerate(pages):
        for k, b in enumerate(blocks):
            x[i * longest + k, [number[n] for n in b]] = 1
            y[i, k] = labels[k]
    real = np.arange(longest) < length[:, None]
    theta = np.zeros(2 * len(names) + 8)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    hot = np.eye(2)[y] * real[..., None]
    rows = np.arange(p)

    def step(theta):
        w = theta[: 2 * len(names)].reshape(-1, 2)
        t, first, last = theta[-8:-4].reshape(2, 2), theta[-4:-2], theta[-2:]
        score = (x @ w).reshape(p, longest, 2)
        a, b = np.zeros((p, longest, 2)), np.zeros((p, longest, 2))
        a[:, 0] = score[:, 0] + first
        for k in range(1, longest):
            a[:, k] = score[:, k] + np.logaddexp(a[:, k - 1, :1] + t[0], a[:, k - 1, 1:] + t[1])
        b[rows, length - 1] = last
        for k in range(longest - 2, -1, -1):
            after = score[:, k + 1] + b[:, k + 1]
            value = np.logaddexp(t[:, 0] + after[:, :1], t[:, 1] + after[:, 1:])
            b[:, k] = np.where((k < length - 1)[:, None], value, b[:, k])
        z = np.logaddexp(*(a[rows, length - 1] + last).T)
        node = np.exp(a + b - z[:, None, None]) * real[..., None]
        edge = np.exp(a[:, :-1, :, None] + t + (score + b)[:, 1:, None, :] - z[:, None, None, None]) * real[:, 1:, None, None]
        g = np.empty_like(theta)
        g[: 2 * len(names)] = (x.T @ (hot - node).reshape(-1, 2)).ravel()
        seen = np.einsum("pki,pkj->ij", hot[:, :-1] * real[:, 1:, None], hot[:, 1:])
        g[-8:-4] = (seen - edge.sum((0, 1))).ravel()
        g[-4:-2] = (hot[:, 0] - node[:, 0]).sum(0)
        g[-2:] = (hot[rows, length - 1] - node[rows, length - 1]).sum(0)
        return g / p - penalty * theta

    for i in range(1, rounds + 1):
        g = step(theta)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta = theta + rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-8)
    w = theta[: 2 * len(names)].reshape(-1, 2)
    pair = lambda a: (float(a[0]), float(a[1]))
    return Field({n: pair(w[i]) for n, i in number.items()}, (pair(theta[-8:-6]), pair(theta[-6:-4])), pair(theta[-4:-2]), pair(theta[-2:]))


# --- training pages ----------------------------------------------------------------------------


def marked_labels(blocks: list[Block]) -> list[int] | None:
    """Labels by a page's own marks: main is what lies in an article (else main element) and in nothing that is never main.

    None if the page marks no article.
    """
    for k in range(len(MARKS)):
        labels = [int(b.place.marks[k] == 1) for b in blocks]
        if any(labels):
            return labels
    return None


def pattern_pages(n: int = 240, seed: int = 5) -> list[tuple[str, list[int]]]:
    """Labelled pages from patterns; the labels are those of the page's blocks in order."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    syllables = "ta re mo lin ker sol ven du pra is en or al ti ca ne".split()
    word = lambda: "".join(pick(syllables) for _ in range(int(rng.integers(1, 4))))
    phrase = lambda a, b: " ".join(word() for _ in range(int(rng.integers(a, b))))

    def sentence(a=5, b=25):
        return phrase(a, b).capitalize() + pick([".", ".", ".", "!", "?"])

    def paragraph():
        style = rng.random()
        if style < 0.1:
            return sentence(2, 5)
        if style < 0.15:
            return phrase(8, 30)
        text = " ".join(sentence() for _ in range(int(rng.integers(1, 6))))
        if rng.random() < 0.2:
            text = text.replace(" ", f' <a href="/x">{word()}</a> ', 1)
        return text.replace(" ", ", ", 1) if rng.random() < 0.5 else text

    def wrap(kind, tags, names, inner):
        tag = pick(tags) if rng.random() < 0.5 else "div"
        name = f' class="{pick(names)}"' if tag == "div" or rng.random() < 0.5 else ""
        if rng.random() < 0.3:
            name = name.replace("class", "id")
        return f"<{tag}{name}>{inner}</{tag}>"

    def links(a, b):
        items = [f'<li><a href="/{word()}">{phrase(1, 3)}</a></li>' for _ in range(int(rng.integers(a, b)))]
        return "<ul>" + "".join(items) + "</ul>", len(items)

    def side_piece():
        kind = int(rng.integers(8))
        if kind == 0:
            inner, k = links(3, 8)
            return wrap("menu", ["nav", "menu"], ["nav", "main-menu", "breadcrumbs"], inner), k
        if kind == 1:
            return wrap("ad", ["div", "aside"], ["ad", "ads", "advert banner", "sponsored"], sentence()), 1
        if kind == 2:
            return wrap("notice", ["div", "section"], ["cookie-notice", "notice", "consent", "alert"], f"<p>{sentence()}</p><button>{phrase(1, 3)}</button>"), 2
        if kind == 3:
            return f'<form class="{pick(["search", "newsletter", "login"])}"><label>{phrase(1, 4)}</label><input name="q"><button>{word()}</button></form>', 2
        if kind == 4:
            inner, k = links(2, 6)
            return wrap("side", ["aside"], ["sidebar", "widget", "related"], f"<h3>{phrase(1, 4)}</h3>{inner}<p>{sentence()}</p>"), k + 2
        if kind == 5:
            comments = "".join(f'<div class="comment"><b>{word()}</b><p>{paragraph()}</p></div>' for _ in range(2))
            return wrap("comments", ["section"], ["comments", "discussion"], f"<h3>{phrase(1, 3)}</h3>{comments}"), 5
        if kind == 6:
            return wrap("share", ["div"], ["share", "social"], f"{phrase(1, 3)}: <a>{word()}</a> <a>{word()}</a>"), 1
        return wrap("ad", ["aside"], ["promo", "teaser"], f"<h4>{phrase(2, 5)}</h4><p>{sentence()}</p>"), 2

    out = []
    for _ in range(n):
        page, labels = [f"<html><head><title>{phrase(3, 8)}</title></head><body>"], []

        def add(text, k, label):
            page.append(text)
            labels.extend([label] * k)

        if rng.random() < 0.7:
            add(wrap("head", ["header"], ["header", "masthead"], f"<p>{phrase(1, 5)}</p><p>{sentence(3, 9)}</p>"), 2, 0)
        for _ in range(int(rng.integers(1, 4))):
            add(*side_piece(), 0)
        body = pick(["article", "article", "main", "div", "section"])
        name = f' class="{pick(["content", "post", "entry-content", "story", "article-body"])}"' if body in ("div", "section") else ""
        outer = pick(["main", "div", ""])
        page.append(f'<{outer} class="page">' if outer else "")
        page.append(f"<{body}{name}>")
        if rng.random() < 0.8:
            add(f"<h1>{phrase(3, 9)}</h1>", 1, 1)
        for k in range(int(rng.integers(1, 9))):
            style = rng.random()
            if style < 0.65:
                add(f"<p>{paragraph()}</p>", 1, 1)
            elif style < 0.73:
                add(f"<h2>{phrase(2, 6)}</h2>", 1, 1)
            elif style < 0.78:
                add("<ul>" + "".join(f"<li>{sentence(2, 9)}</li>" for _ in range(3)) + "</ul>", 3, 1)
            elif style < 0.82:
                add(f"<blockquote>{paragraph()}</blockquote>", 1, 1)
            elif k:
                add(*side_piece(), 0)
        page.append(f"</{body}>")
        page.append(f"</{outer}>" if outer else "")
        for _ in range(int(rng.integers(0, 4))):
            add(*side_piece(), 0)
        if rng.random() < 0.8:
            add(wrap("foot", ["footer"], ["footer", "copyright"], f"<p>&copy; {word()}.example &middot; {sentence(3, 12)}</p>"), 1, 0)
        out.append(("".join(page) + "</body></html>", labels))
    return out


def training_set(pages: list[str | None], sample_blocks: int = 200) -> list[tuple[list[list[str]], list[int]]]:
    """Sequences of features and labels: pattern pages and those of ``pages`` that mark their article, the first ``sample_blocks`` blocks of each."""
    rows = []
    for page, labels in pattern_pages():
        blocks = blocks_of(page)
        if len(blocks) != len(labels):
            raise AssertionError("a pattern's labels do not fit its blocks")
        rows.append((blocks, labels))
    for page in pages:
        blocks = blocks_of(page)
        labels = marked_labels(blocks)
        if labels:
            rows.append((blocks[:sample_blocks], labels[:sample_blocks]))
    out = []
    for i, (blocks, labels) in enumerate(rows):
        out.append(([features(b) for b in blocks], labels))
        # Shown again without semantic elements if class words tell enough.
        if i % 2 == 0 and any(b.place.named for b in blocks):
            out.append(([features(b, semantic=False) for b in blocks], labels))
    return out


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample_rows: int = 120, sample_blocks: int = 200) -> Field:
    """A field trained on the patterns and at most ``sample_rows`` pages, those with the smallest hash of their id, and of each of these the first
    ``sample_blocks`` blocks. Both bound training alone; pages are extracted whole."""
    pages = pages.select(id_col, html_col).filter(F.col(html_col).isNotNull() & F.col(id_col).isNotNull())
    # Ids first: pages come to the driver only for the sample, which the limit bounds.
    ids = [r[id_col] for r in sampled_ids(pages.select(id_col).distinct(), id_col, sample_rows).collect()]
    sample = pages.filter(F.col(id_col).isin(ids)).dropDuplicates([id_col]).collect()
    return train(training_set([r[html_col] for r in sorted(sample, key=lambda r: r[id_col])], sample_blocks))


def main_text(page: str | None, model: Field) -> str:
    blocks = blocks_of(page)
    labels = model.decode([features(b) for b in blocks])
    return " ".join(b.text for b, label in zip(blocks, labels, strict=True) if label)


def extract(pages: DataFrame, model: Field, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) for each row."""
    schema = T.StructType(
        [
            T.StructField(id_col, pages.schema[id_col].dataType),
            T.StructField(url_col, pages.schema[url_col].dataType),
            T.StructField("text", T.StringType()),
        ]
    )

    @F.pandas_udf("string")
    def text_of(page: pd.Series) -> pd.Series:
        return pd.Series([main_text(p, model) for p in page], dtype=object)

    texts = pages.select(id_col, url_col, F.coalesce(html_col, F.lit("")).alias("_html")).select(id_col, url_col, text_of("_html").alias("text"))
    return texts.select(*schema.names, F.char_length("text").cast("long").alias("n_chars"))
