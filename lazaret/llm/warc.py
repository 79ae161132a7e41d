"""Legacy archive converter: ARC files of version 1 and 2 to WARC/1.1, and a reader of WARC files.

An ARC record is a header line, a declared length of bytes and a line feed. Version 1 declares URL, IP address, date, content type
and length; version 2 also result code, checksum, location, offset and file name before the length. A file begins with a version
block that tells which. Header lines are read from the right, so that blanks in a URL do no harm.

The converter makes for each record an equivalent WARC one: an identifier (a name-based UUID of file, place and URL), the date in
ISO form, a type (warcinfo for the version block, response for records with an HTTP head, resource for others) and SHA-1
digests of block and payload. Of records with equal payloads the one with the smallest key stays a response; the others become
revisits of it, which hold the HTTP head but no payload.

Files go through Spark's own writers and readers, so any store that Spark reaches will do: a text file with line ends of two
bytes holds the bytes of the records as they are, gzip-compressed; a task writes files of a bounded number of records, and a
reader unpacks one file at a time, record by record. Payloads are never shuffled by digest; only keys and digests are.

Null payloads are empty, a null URL is written as ``-``, a null key as none. Rows with the same key are told apart by their record. Extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lazaret.llm.tables import cut
from lazaret.sources.storage import work_folder

#: Records of one archive file.
FILE_RECORDS = 4096
_KEY = b"X-Archive-Key"
_NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:legacy-archive")

# Names of the header fields, in the order of each version.
ARC_FIELDS = {
    1: ("url", "ip", "date", "type", "length"),
    2: ("url", "ip", "date", "type", "code", "checksum", "location", "offset", "filename", "length"),
}


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# --- ARC ---------------------------------------------------------------------------------------


def version_block(version: int, name: str, date: str) -> bytes:
    about = f"{version} 0 lazaret\n{' '.join(_TITLES[f] for f in ARC_FIELDS[version])}\n\n".encode()
    values = {"url": f"filedesc://{name}", "ip": "0.0.0.0", "date": date, "type": "text/plain", "code": "200", "filename": name}
    return arc_record(version, values, about)


# The names of the fields as the version block writes them.
_TITLES = {
    "url": "URL",
    "ip": "IP-address",
    "date": "Archive-date",
    "type": "Content-type",
    "code": "Result-code",
    "checksum": "Checksum",
    "location": "Location",
    "offset": "Offset",
    "filename": "Filename",
    "length": "Archive-length",
}


def arc_record(version: int, values: dict[str, str], content: bytes) -> bytes:
    line = " ".join(str(len(content)) if f == "length" else values.get(f, "-") for f in ARC_FIELDS[version])
    return line.encode() + b"\n" + content + b"\n"


def parse_header(line: bytes, version: int) -> dict[str, str] | None:
    """The fields of a header line, or None if it is not one of that version."""
    fields = ARC_FIELDS[version]
    values = line.decode("utf-8", "surrogateescape").rsplit(" ", len(fields) - 1)
    if len(values) != len(fields) or not values[-1].isdigit() or not re.fullmatch(r"[0-9]{12,14}", values[2]):
        return None
    return dict(zip(fields, values, strict=True))


class _Stream:
    """Bytes of a file that may be gzip-compressed, in one member or many, unpacked as they are read."""

    def __init__(self, data: bytes):
        self.data, self.at, self.buffer = data, 0, bytearray()
        self.packed = data[:2] == b"\x1f\x8b"
        self.unpack = zlib.decompressobj(31) if self.packed else None
        self.place = 0

    def _more(self) -> bool:
        if not self.packed:
            part = self.data[self.at : self.at + (1 << 20)]
            self.at += len(part)
            self.buffer += part
            return bool(part)
        while self.at < len(self.data) or self.unpack.unconsumed_tail:
            source = self.unpack.unconsumed_tail or self.data[self.at : self.at + (1 << 18)]
            if not self.unpack.unconsumed_tail:
                self.at += len(source)
            out = self.unpack.decompress(source, 1 << 20)
            if self.unpack.eof:
                self.at -= len(self.unpack.unused_data)
                self.unpack = zlib.decompressobj(31)
            self.buffer += out
            if out:
                return True
        return False

    def line(self) -> bytes | None:
        """The next line without its end; None at the end of the file."""
        start = 0
        while (end := self.buffer.find(b"\n", start)) < 0:
            start = len(self.buffer)
            if not self._more():
                if not self.buffer:
                    return None
                end = len(self.buffer)
                break
        out = bytes(self.buffer[:end])
        self.place += min(end + 1, len(self.buffer))
        del self.buffer[: end + 1]
        return out

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n and self._more():
            pass
        if len(self.buffer) < n:
            raise ValueError(f"the record at byte {self.place} declares {n} bytes, the file has {len(self.buffer)}")
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        self.place += n
        return out


_DEFINITION = re.compile(rb"([12]) [0-9]+ [^\n]*\nURL IP-address ")


def read_arc(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(version, place, header fields, content) of each record; version blocks set the version of what follows.

    A version block is the first record, or a later ``filedesc://`` record whose content defines the fields of records, as in files put
    together from others; its header has a field ``definition``. A page at such a URL is a record as any other.
    """
    stream, version = _Stream(data), None
    while True:
        place = stream.place
        line = stream.line()
        if line is None:
            return
        line = line.rstrip(b"\r")
        if not line:
            continue
        if version is None and line.startswith(b"filedesc://"):
            for v in ARC_FIELDS:
                # A version block tells its version in its first line.
                header = parse_header(line, v)
                if header:
                    content = stream.take(int(header["length"]))
                    version = int(content.split(b" ", 1)[0])
                    yield version, place, header | {"definition": "yes"}, content
                    break
            else:
                raise ValueError(f"no version block at byte {place}: {line[:200]!r}")
            continue
        # Behind a version block of another version the line may only be read by that one's fields.
        header = parse_header(line, version) if version in ARC_FIELDS else None
        if header is None and line.startswith(b"filedesc://"):
            header = next((h for v in ARC_FIELDS if (h := parse_header(line, v))), None)
        if header is None:
            raise ValueError(f"no record of ARC version {version} at byte {place}: {line[:200]!r}")
        content = stream.take(int(header["length"]))
        if line.startswith(b"filedesc://") and (m := _DEFINITION.match(content)):
            version, header = int(m[1]), header | {"definition": "yes"}
        yield version, place, header, content


# --- WARC --------------------------------------------------------------------------------------


def iso_date(date: str) -> str:
    """YYYYMMDDhhmm[ss] as an ISO instant."""
    d = date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def split_http(content: bytes) -> tuple[bytes, bytes] | None:
    """HTTP head (with the empty line) and payload, or None if there is no head."""
    if not content.startswith(b"HTTP/"):
        return None
    m = re.search(rb"\r?\n\r?\n", content)
    return (content[: m.end()], content[m.end() :]) if m else (content, b"")


def warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """A record up to the first of the two line ends behind its block; the writer adds the second."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode("utf-8", "surrogateescape") + b"\r\n" + block + b"\r\n"


def converted(name: str, version: int, place: int, header: dict[str, str], content: bytes) -> dict:
    """What a WARC record needs of an ARC record."""
    http = split_http(content)
    head, payload = http if http else (b"", content)
    key = re.search(rb"(?mi)^" + _KEY + rb": *(-?[0-9]+)", head)
    kind = "warcinfo" if "definition" in header else "response" if http else "resource"
    return {
        "record_id": f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{name} {place} ' + header['url'].encode('utf-8', 'surrogateescape').hex())}>",
        "key": int(key[1]) if key else None,
        "kind": kind,
        "date": iso_date(header["date"]),
        "url": header["url"],
        "ip": header["ip"],
        "type": header["type"],
        "head": head,
        "payload": payload,
        "digest": digest(payload),
        "block_digest": digest(content),
    }


def record_bytes(r: dict, original: tuple[str, str] | None) -> bytes:
    """The WARC record; ``original`` has the identifier and date of the response that a revisit stands for."""
    kind = "revisit" if original else r["kind"]
    block = r["head"] if original else r["head"] + r["payload"]
    fields = [("WARC-Type", kind), ("WARC-Record-ID", r["record_id"]), ("WARC-Date", r["date"])]
    if kind == "warcinfo":
        fields.append(("WARC-Filename", r["url"].removeprefix("filedesc://")))
    elif r["url"] != "-":
        fields.append(("WARC-Target-URI", r["url"]))
    if r["ip"] not in ("-", "0.0.0.0"):
        fields.append(("WARC-IP-Address", r["ip"]))
    if original:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", original[0]),
            ("WARC-Refers-To-Date", original[1]),
        ]
    if kind != "warcinfo":
        fields.append(("WARC-Payload-Digest", f"sha1:{r['digest']}"))
    fields.append(("WARC-Block-Digest", f"sha1:{digest(block) if original else r['block_digest']}"))
    fields.append(("Content-Type", "application/http; msgtype=response" if r["head"] else r["type"]))
    return warc_record(fields, block)


def read_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record."""
    stream = _Stream(data)
    while True:
        line = stream.line()
        if line is None:
            return
        line = line.rstrip(b"\r")
        if not line:
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record at byte {stream.place}: {line[:200]!r}")
        fields: dict[str, str] = {}
        while (line := (stream.line() or b"").rstrip(b"\r")):
            name, _, value = line.decode("utf-8", "surrogateescape").partition(":")
            fields[name.strip().lower()] = value.strip()
        yield fields, stream.take(int(fields["content-length"]))


# --- on Spark ----------------------------------------------------------------------------------


def _write(records: DataFrame, path: str, line_end: str) -> None:
    """Records (a binary column) as files of bytes. A file's record ends with ``line_end``, which the writer adds."""
    records.select(F.col(records.columns[0]).cast("string")).write.option("lineSep", line_end).option("compression", "gzip").option(
        "maxRecordsPerFile", FILE_RECORDS
    ).text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def write_arc(pages: DataFrame, path: str, key_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> None:
    """ARC files of the pages, versions 1 and 2 by turns of the tasks; a version block begins each file."""
    from pyspark import TaskContext

    slim = pages.select(F.col(key_col).cast("long").alias("key"), F.col(url_col).alias("url"), F.col(payload_col).cast("binary").alias("payload"))

    def write(batches):
        part, n = TaskContext.get().partitionId(), 0
        version = 1 + part % 2
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                block = b""
                if n % FILE_RECORDS == 0:
                    block = version_block(version, f"part-{part}-{n // FILE_RECORDS}.arc", "20070301000000")
                key = b"" if r["key"] is None else _KEY + b": %d\r\n" % r["key"]
                head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + key + b"\r\n"
                url = re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", r["url"] or "-")
                values = {"url": url, "ip": "192.0.2.1", "date": f"2007030112{part % 60:02d}{n % 60:02d}", "type": "text/html", "code": "200"}
                record = block + arc_record(version, values, head + (r["payload"] or b""))
                out.append(record[:-1])  # the writer adds the line feed
                n += 1
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    _write(slim.mapInArrow(write, "record binary"), path, "\n")


_CONVERTED = """record_id string, key long, kind string, date string, url string, ip string, type string, head binary, payload binary,
digest string, block_digest string"""


def converted_records(spark: SparkSession, arc_path: str) -> DataFrame:
    """The parts of WARC records, one for each record of the ARC files."""

    def convert(batches):
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                name = path.as_py().rpartition("/")[2]
                held, size = [], 0
                for record in read_arc(content.as_py()):
                    held.append(converted(name, *record))
                    size += len(held[-1]["payload"])
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema=_ARROW)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=_ARROW)

    return _files(spark, arc_path).mapInArrow(convert, _CONVERTED)


_ARROW = pa.schema(
    [
        ("record_id", pa.string()),
        ("key", pa.int64()),
        *((n, pa.string()) for n in ("kind", "date", "url", "ip", "type")),
        ("head", pa.binary()),
        ("payload", pa.binary()),
        ("digest", pa.string()),
        ("block_digest", pa.string()),
    ]
)


def convert(spark: SparkSession, arc_path: str, warc_path: str, least_bytes: int = 0) -> None:
    """WARC files from ARC files. Payloads under ``least_bytes`` are never made revisits."""
    records = converted_records(spark, arc_path)
    # First pass: keys and digests. A null key comes after all others.
    facts = records.filter("kind = 'response'").select("record_id", "key", "digest", "date", F.octet_length("payload").alias("n"))
    facts = cut(facts.filter(F.col("n") >= least_bytes), "digests")
    order = F.struct(F.col("key").isNull(), "key", "record_id", "date")
    first = facts.groupBy("digest", "n").agg(F.min(order).alias("o"), F.count("*").alias("m")).filter("m > 1")
    first = cut(first.select("digest", "n", F.col("o.record_id").alias("first_id"), F.col("o.date").alias("first_date")), "originals")
    again = cut(facts.join(first, ["digest", "n"]).filter("record_id != first_id").select("record_id", "first_id", "first_date"), "revisits")
    # Second pass: the records themselves, each with what it revisits.
    joined = records.join(again, "record_id", "left")

    def write(batches):
        for batch in batches:
            for a in range(0, len(batch), 256):
                rows = batch.slice(a, 256).to_pylist()
                out = [record_bytes(r, (r["first_id"], r["first_date"]) if r["first_id"] else None) for r in rows]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    _write(joined.mapInArrow(write, "record binary"), warc_path, "\r\n")


def read_records(spark: SparkSession, warc_path: str) -> DataFrame:
    """record_id, kind, url, date, refers_to, payload_digest, key, payload (null for revisits) of each record of WARC files."""
    schema = pa.schema([*((n, pa.string()) for n in ("record_id", "kind", "url", "date", "refers_to", "payload_digest")), ("key", pa.int64()), ("payload", pa.binary())])

    def read(batches):
        for batch in batches:
            for content in batch.column("content"):
                held, size = [], 0
                for fields, block in read_warc(content.as_py()):
                    http = split_http(block) if "application/http" in fields.get("content-type", "") else None
                    head, payload = http if http else (b"", block)
                    key = re.search(rb"(?mi)^" + _KEY + rb": *(-?[0-9]+)", head)
                    kind = fields.get("warc-type")
                    held.append(
                        {
                            "record_id": fields.get("warc-record-id"),
                            "kind": kind,
                            "url": fields.get("warc-target-uri"),
                            "date": fields.get("warc-date"),
                            "refers_to": fields.get("warc-refers-to"),
                            "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                            "key": int(key[1]) if key else None,
                            "payload": None if kind == "revisit" else payload,
                        }
                    )
                    size += len(payload)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)

    return _files(spark, warc_path).mapInArrow(
        read, "record_id string, kind string, url string, date string, refers_to string, payload_digest string, key long, payload binary"
    )


def round_trip(pages: DataFrame, key_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Pages through ARC and WARC files and back: key, payload_bytes, payload_digest, record_type, refers_to for each page."""
    spark = pages.sparkSession
    arc, warc = work_folder(spark, "arc"), work_folder(spark, "warc")
    write_arc(pages, arc, key_col, url_col, payload_col)
    convert(spark, arc, warc)
    records = read_records(spark, warc).filter("kind in ('response', 'revisit')")
    # Digests are taken from the payloads that were read; a revisit has its response's.
    read = records.select(
        "record_id", "kind", "key", "refers_to", F.octet_length("payload").cast("long").alias("n"), F.sha1("payload").alias("hex"), "payload_digest"
    )
    read = cut(read, "warc-index")
    used = read.filter("refers_to is not null").select(F.col("refers_to").alias("of")).distinct()
    originals = cut(
        read.join(used, read["record_id"] == used["of"]).select("of", F.col("key").alias("of_key"), F.col("n").alias("of_n"), F.col("hex").alias("of_hex")),
        "warc-originals",
    )
    out = read.join(originals, read["refers_to"] == originals["of"], "left")
    return out.select(
        F.col("key").alias(key_col),
        F.coalesce("n", "of_n").alias("payload_bytes"),
        base32(F.coalesce("hex", "of_hex")).alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.col("of_key").alias("refers_to"),
    )


def base32(sha1_hex):
    """A SHA-1 in hexadecimal as upper-case base32: 5 hexadecimal digits are 4 letters."""
    digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    letters = []
    for group in range(8):
        bits = F.conv(F.substring(sha1_hex, 5 * group + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            letters.append(F.substring(F.lit(digits), F.shiftright(bits, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*letters)
