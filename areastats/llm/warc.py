"""WARC archives with a two-level capture index.

Captures are sorted by reversed-host url key and page. Every range of the order is a shard file of
compressed blocks with a sparse directory (first key and place of each block) beside it. A look-up
finds the shard, searches the directory, reads and searches one block, and then reads
one range of an archive. Files carry a name of their own per attempt; the tables that Spark
commits name the ones that count.
"""

import base64
import bisect
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from areastats.llm.common import filesystem, shared_folder, stored

#: Captures in a compressed block of the index.
BLOCK_LINES = 256
#: Compressed bytes after which a task begins another archive.
ARCHIVE_BYTES = 1 << 28
DATE = "1970-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Stands for a missing page id in keys, below all others.
NO_PAGE = -(2**63)


def url_key(url: str | None) -> str:
    """Host labels reversed and joined by commas, `)`, then the rest: com,example,www)/a?b."""
    rest = (url or "").partition("://")[2] or (url or "")
    host = re.match(r"[^/?#]*", rest)[0]
    name, _, port = host.rpartition("@")[2].lower().partition(":")
    return ",".join(reversed(name.split("."))) + (f":{port}" if port else "") + ")" + rest[len(host) :]


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, first: int | None) -> bytes:
    """One record, gzipped by itself; a revisit of page `first` if that is another page."""
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    revisit = first is not None and first != page_id
    http = b"" if revisit else b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    body = b"" if revisit else http + payload
    fields = {
        "WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}>", "WARC-Date": DATE,
        "WARC-Target-URI": target, "WARC-Payload-Digest": f"sha1:{digest(payload)}", "X-Payload-Length": str(len(payload)),
        "Content-Type": "application/http; msgtype=response", "Content-Length": str(len(body)),
    }
    if revisit:
        fields |= {"WARC-Profile": REVISIT, "WARC-Refers-To": f"<urn:page:{first}>"}
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode("utf-8", "surrogatepass") + body + b"\r\n\r\n") + packer.flush()


def parse(data: bytes) -> tuple[dict[str, str], bytes | None]:
    """Fields and payload (None for a revisit) of one gzipped record."""
    plain = zlib.decompress(data, 31)
    head, _, rest = plain.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    body = rest[: int(fields["Content-Length"])]
    return fields, None if fields["WARC-Type"] == "revisit" else body.partition(b"\r\n\r\n")[2]


# ---- writing ----------------------------------------------------------------------------

CAPTURE = "urlkey string, page long, archive string, offset long, length long"


def write_archives(pages: DataFrame, folder: str, min_revisit_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write one record per row and return the captures, a stored table.

    Of rows with equal payloads of at least `min_revisit_bytes`, those with the smallest id are
    responses and the others revisit it; a null id counts as no id and a null payload as empty.
    Only payloads that come twice are joined, and AQE splits one that comes very often.
    """
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("html"))
    rows = rows.withColumn("hash", F.sha1(F.col("html").cast("binary")))
    again = rows.where(F.octet_length("html") >= min_revisit_bytes).groupBy("hash").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("hash", "first")
    known = rows.join(stored(again, "repeated"), "hash", "left").select("page_id", "url", "html", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = filesystem(folder)
        fs.create_dir(path)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                made = []
                for page_id, url, html, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if out is None or at > ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(f"{path}/{name}", compression=None)
                    data = record(page_id, url, html.encode("utf-8", "surrogatepass"), first)
                    out.write(data)
                    made.append((url_key(url), NO_PAGE if page_id is None else page_id, name, at, len(data)))
                    at += len(data)
                if made:
                    yield _captures(made)
        finally:
            if out is not None:
                out.close()

    return stored(known.mapInArrow(run, CAPTURE), "captures")


def _captures(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"urlkey": pa.string(), "page": pa.int64(), "archive": pa.string(), "offset": pa.int64(), "length": pa.int64()}
    columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values(), strict=True)], list(kinds))


def write_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> list[tuple[str, int, str, int, str]]:
    """Write the sorted shards and their directories.

    Returns (first key and page, last key and page, name) of each: one row per partition.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = filesystem(folder)
        fs.create_dir(path)
        name = f"{uuid.uuid4().hex}.cdx"
        directory: list[list] = []
        lines: list[tuple] = []
        last, at, out = None, 0, None

        def flush() -> None:
            nonlocal lines, last, at
            block = zlib.compress("\n".join(json.dumps(x) for x in lines).encode(), 6)
            out.write(block)
            directory.append([*lines[0][:2], at, len(block)])
            last, at, lines = list(lines[-1][:2]), at + len(block), []

        for batch in batches:
            for line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out = out or fs.open_output_stream(f"{path}/{name}", compression=None)
                lines.append(line)
                if len(lines) >= block_lines:
                    flush()
        if lines:
            flush()
        if out is None:
            return
        out.close()
        with fs.open_output_stream(f"{path}/{name}.directory", compression=None) as f:
            f.write(json.dumps(directory).encode())
        columns = [[directory[0][0]], [directory[0][1]], [last[0]], [last[1]], [name]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["low_key", "low_page", "high_key", "high_page", "shard"])

    ordered = captures.repartitionByRange("urlkey", "page").sortWithinPartitions("urlkey", "page", "archive", "offset")
    shards = ordered.mapInArrow(run, "low_key string, low_page long, high_key string, high_page long, shard string")
    return sorted(map(tuple, shards.collect()))


# ---- reading ----------------------------------------------------------------------------


class Shards:
    """Look-ups in the shards; keeps the last directory and the last block it read."""

    def __init__(self, folder: str, shards: list[tuple[str, int, str, int, str]]):
        self.fs, self.path = filesystem(folder)
        self.shards = sorted(shards)
        self.highs = [(s[2], s[3]) for s in self.shards]
        self.kept: dict[str, tuple] = {}

    def find(self, key: tuple[str, int]) -> Iterator[tuple[str, int, str, int, int]]:
        """All captures of this url key and page."""
        at = bisect.bisect_left(self.highs, key)
        while at < len(self.shards) and (self.shards[at][0], self.shards[at][1]) <= key:
            yield from self._in_shard(self.shards[at][4], key)
            at += 1

    def _in_shard(self, name: str, key: tuple[str, int]) -> Iterator[tuple]:
        directory, firsts = self._kept("directory", name, lambda: self._directory(name))
        block = max(0, bisect.bisect_left(firsts, key) - 1)
        while block < len(directory) and firsts[block] <= key:
            lines, keys = self._kept("block", (name, block), lambda b=block: self._block(name, directory[b]))
            at = bisect.bisect_left(keys, key)
            while at < len(keys) and keys[at] == key:
                yield tuple(lines[at])
                at += 1
            block += 1

    def _kept(self, kind: str, name, load):
        if self.kept.get(kind, (None,))[0] != name:
            self.kept[kind] = (name, load())
        return self.kept[kind][1]

    def _directory(self, name: str) -> tuple[list, list]:
        with self.fs.open_input_file(f"{self.path}/{name}.directory") as f:
            directory = json.loads(f.read())
        return directory, [(d[0], d[1]) for d in directory]

    def _block(self, name: str, entry: list) -> tuple[list, list]:
        with self.fs.open_input_file(f"{self.path}/{name}") as f:
            lines = [json.loads(x) for x in zlib.decompress(f.read_at(entry[3], entry[2])).split(b"\n")]
        return lines, [(x[0], x[1]) for x in lines]


def look_up(requests: DataFrame, shards: list[tuple[str, int, str, int, str]], folder: str, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Captures of the requested (url, page) pairs, from the index; each distinct request once.

    The requests are dealt in the order of the index, so a task reads each of its blocks once.
    Every task knows the shards' ranges: one row for each partition the index was written by.
    """

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [url_key(u) for u in batch.column("url").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), batch.column("page")], ["urlkey", "page"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Shards(folder, shards)
        for batch in batches:
            wanted = zip(batch.column("urlkey").to_pylist(), batch.column("page").to_pylist(), strict=True)
            yield _captures([c for key in wanted for c in index.find(key)])

    asked = requests.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_PAGE)).alias("page"), F.col(url_col).cast("string").alias("url"))
    asked = asked.mapInArrow(keys, "urlkey string, page long").distinct()
    return asked.repartitionByRange("urlkey", "page").sortWithinPartitions("urlkey", "page").mapInArrow(find, CAPTURE)


def read_records(captures: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """Read the captures' ranges, archive by archive; an archive has ARCHIVE_BYTES at most.

    (page_id, url, record_type, payload_bytes, payload_digest, refers_to[, payload]); size and digest
    are those of the payload, for revisits as their record states them. A response whose
    payload does not have its record's digest raises an error.
    """
    kinds = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "refers_to": pa.int64()}
    if with_payload:
        kinds["payload"] = pa.binary()
    number = lambda urn: int(urn[10:-1]) if len(urn) > 11 else None

    def read(data: bytes) -> tuple:
        fields, payload = parse(data)
        stated = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if payload is not None and digest(payload) != stated:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} does not have the digest {stated}")
        size = int(fields["X-Payload-Length"]) if payload is None else len(payload)
        row = (number(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], fields["WARC-Type"], size, stated, number(fields.get("WARC-Refers-To", "")))
        return (*row, payload) if with_payload else row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = filesystem(folder)
        name, archive = None, None
        for batch in batches:
            rows = []
            for own, offset, length in zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length")), strict=True):
                if own != name:
                    if archive is not None:
                        archive.close()
                    name, archive = own, fs.open_input_file(f"{path}/{own}")
                rows.append(read(archive.read_at(length, offset)))
                if len(rows) >= 256:
                    yield made(rows)
                    rows = []
            yield made(rows)

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values(), strict=True)], list(kinds))

    schema = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long" + (", payload binary" if with_payload else "")
    return captures.repartition("archive").sortWithinPartitions("archive", "offset").mapInArrow(run, schema)


def archived(pages: DataFrame, min_revisit_bytes: int = 0, with_payload: bool = False) -> DataFrame:
    """Write all pages to archives, index them, look every page up and read its records back.

    One row per input row. Control characters and blanks in urls come back percent-encoded; null
    urls come back empty. Rows that repeat a response's id and payload are responses too.
    """
    folder = shared_folder(pages.sparkSession, "warc")
    shards = write_index(write_archives(pages, folder, min_revisit_bytes), folder)
    return read_records(look_up(pages, shards, folder), folder, with_payload)


#: The result of the query: page_id, payload_bytes, payload_digest, record_type, refers_to.
WARC_SQL = r"""
WITH hashed AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hash FROM pages
), first AS (
  SELECT *, min(page_id) OVER (PARTITION BY hash) AS first_page FROM hashed
)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(hash, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INTEGER + 1, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN first_page = page_id OR first_page IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first_page <> page_id THEN first_page END AS refers_to
FROM first
"""
