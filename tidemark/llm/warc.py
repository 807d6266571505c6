"""WARC archives of pages, and one sorted index over all of them.

Records are rows of text; Spark's text writer puts them into files, and the
blank lines that end a record are its line separator. So archives lie wherever
Spark can write, and a lost task writes its files again. Every archive read
back yields one index run, sorted by URL key and time. Runs are range-
partitioned by those keys, and in each range a loser tree merges what every run
has for it. Files of the index are globally ordered capture histories.

Pages with equal payloads are stored once: the one with the smallest page id is
a response, the others revisit it.

Defined results: a NULL payload is empty, and empty payloads are equal like
others; a NULL URL is empty; repeated ids with equal payloads are all responses
if they are the smallest; a NULL id never is the smallest while the payload has
another one; an empty table gives an empty archive and index; extra columns are
ignored. Line ends in a URL are percent-encoded in its record.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_dir

END = "\r\n\r\n"
EOL = "\r\n"
RECORDS_PER_FILE = 1000
RANGE_ROWS = 200_000
INDEX = "url_key string, captured string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, at long"
_NAMES = [f.split()[0] for f in INDEX.split(", ")]

# Digits of base 32, as numbers are written and in RFC 4648.
_BASE32_FROM, _BASE32_TO = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(text: Column) -> Column:
    """SHA-1 of the UTF-8 bytes in base 32: each five hex digits are four."""
    hexed = F.sha1(text.cast("binary"))
    parts = [F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), _BASE32_FROM, _BASE32_TO)


def _record_id(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(">"))


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(EOL))


def plan_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Rows of pages with page_id, url, payload, payload_digest, payload_bytes
    and refers_to. Only ids and digests are shuffled to find the first copies."""
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.replace(F.replace(F.coalesce(F.col(url), F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")).alias("url"),
        F.coalesce(F.col(payload), F.lit("")).alias("payload"),
    )
    rows = rows.withColumns({"payload_digest": base32_sha1(F.col("payload")), "payload_bytes": F.octet_length("payload").cast("long")})
    first = rows.groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    joined = rows.join(first.select("payload_digest", "first"), "payload_digest", "left")
    copy = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.withColumn("refers_to", F.when(copy, F.col("first"))).drop("first")


def record_text(captured: Column) -> Column:
    """A whole record without the blank lines at its end."""
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK" + EOL + "Content-Type: text/html; charset=utf-8" + EOL),
        _header("Content-Length", F.col("payload_bytes")),
        F.lit(EOL),
    )
    block_size = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    head = F.concat(
        F.lit("WARC/1.1" + EOL),
        _header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _header("WARC-Record-ID", _record_id(F.col("page_id"))),
        _header("WARC-Date", F.date_format(captured, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(
            revisit,
            F.concat(
                _header("WARC-Refers-To", _record_id(F.col("refers_to"))),
                _header("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            ),
        ).otherwise(""),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", block_size),
        F.lit(EOL),
    )
    return F.concat(head, http, F.when(revisit, "").otherwise(F.col("payload")))


def write_archives(
    pages: DataFrame, path: str, captured: Column | None = None, per_file: int = RECORDS_PER_FILE, compression: str = "gzip", **columns: str
) -> None:
    """Write one record per page. Without a time column the time of a record is
    its page id in seconds since the year 2020, so that archives are repeatable.

    A compressed archive is one stream, which is read from its start; with
    ``compression="none"`` the offsets of the index lead straight to a record.
    ``per_file`` bounds the records of an archive, which is read as one value:
    lower it for pages of many megabytes."""
    planned = plan_records(pages, **columns)
    if captured is None:
        captured = F.timestamp_seconds(F.lit(1577836800) + F.coalesce("page_id", F.lit(0)))
    text = planned.select(record_text(captured).alias("value"))
    text.write.option("lineSep", END).option("compression", compression).option("maxRecordsPerFile", per_file).text(path)


_FIELD = re.compile(rb"^([^:\r\n]+):[ \t]*([^\r\n]*)\r?$", re.M)


def parse_archive(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of every record, framed by its Content-Length."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        head = {k.decode().lower(): v.decode() for k, v in _FIELD.findall(data[at:stop])}
        begin = stop + 4
        end = begin + int(head["content-length"])
        if data[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"record at {at} is not framed as its Content-Length says")
        yield at, head, data[begin:end]
        at = end + 4


def url_key(url: str) -> str:
    """Host labels in reverse order, then the rest: sorts a site together. The
    host goes from ``://`` to the first ``/``, ``?`` or ``#``; without ``://`` it
    is empty."""
    _, scheme, rest = url.partition("://")
    if not scheme:
        return ")" + url
    end = re.search("[/?#]|$", rest).start()
    return ",".join(reversed(rest[:end].lower().split("."))) + ")" + rest[end:]


def _page(record_id: str) -> int | None:
    number = record_id.removeprefix("<urn:page:").removesuffix(">")
    return None if number == "none" else int(number)


def index_runs(spark: SparkSession, path: str) -> DataFrame:
    """One sorted run of captures per archive; payloads are checked against
    their digests on the way. Archives are small, so each is one value."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = []
                data = content.as_py()
                for at, head, block in parse_archive(gzip.decompress(data) if name.endswith(".gz") else data):
                    http, _, body = block.partition(b"\r\n\r\n")
                    size = int(dict((k.lower(), v) for k, v in _FIELD.findall(http))[b"content-length"])
                    digest = head["warc-payload-digest"].removeprefix("sha1:")
                    response = head["warc-type"] == "response"
                    if response and (len(body) != size or base64.b32encode(hashlib.sha1(body).digest()).decode() != digest):
                        raise ValueError(f"payload of {head['warc-record-id']} in {name} is damaged")
                    refers = None if response else _page(head["warc-refers-to"])
                    rows.append((url_key(head["warc-target-uri"]), head["warc-date"], _page(head["warc-record-id"]), size, digest, head["warc-type"], refers, name, at))
                rows.sort(key=_order)
                if rows:
                    yield _batch(rows)

    return files.mapInArrow(run, INDEX)


_TYPES = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=_NAMES)


def _order(row: tuple) -> tuple:
    return row[0].encode(), row[1], row[2] is not None, row[2] or 0, row[7], row[8]


class LoserTree:
    """k-way merge of sorted runs: each inner node keeps the loser of its match,
    so the next row takes one comparison per level."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs = [[(_order(r), r) for r in run] for run in runs]
        self.k = max(1, len(runs))
        self.next = [0] * self.k
        self.losers = [-1] * self.k
        self.winner = self._build(1)

    def _key(self, run: int):
        """Order of a run's next row; a run at its end loses to all others."""
        if run >= len(self.runs) or self.next[run] >= len(self.runs[run]):
            return (1,)
        return (0, self.runs[run][self.next[run]][0], run)

    def _build(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        left, right = self._build(2 * node), self._build(2 * node + 1)
        if self._key(right) < self._key(left):
            left, right = right, left
        self.losers[node] = right
        return left

    def __iter__(self) -> Iterator[tuple]:
        while len(self._key(self.winner)) > 1:
            yield self.runs[self.winner][self.next[self.winner]][1]
            self.next[self.winner] += 1
            node, best = (self.winner + self.k) // 2, self.winner
            while node:
                if self._key(self.losers[node]) < self._key(best):
                    self.losers[node], best = best, self.losers[node]
                node //= 2
            self.winner = best


def merge_runs(runs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """All captures in global order, range by range. The archive and offset in
    the range key part even one URL with very many captures."""
    ranges = max(1, -(-runs.count() // range_rows))
    ranged = runs.repartitionByRange(ranges, "url_key", "captured", "page_id", "archive", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[str, list[tuple]] = {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                own.setdefault(row[7], []).append(row)
        for rows in own.values():
            # a run arrives in its order unless the shuffle has split it
            if any(_order(a) > _order(b) for a, b in zip(rows, rows[1:])):
                rows.sort(key=_order)
        held = []
        for row in LoserTree([own[name] for name in sorted(own)]) if own else ():
            held.append(row)
            if len(held) == 10_000:
                yield _batch(held)
                held = []
        if held:
            yield _batch(held)

    return ranged.mapInArrow(run, INDEX)


def record_at(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, block) of the record that ``data``, read from an uncompressed
    archive at an offset of the index, begins with."""
    _, head, block = next(parse_archive(data))
    return head, block


def archive_pages(pages: DataFrame, path: str | None = None, compression: str = "gzip", **columns: str) -> DataFrame:
    """Write the archives, read them back and return the merged index; it is
    stored under ``path`` as files in global order."""
    spark = pages.sparkSession
    path = path or scratch_dir(spark, "warc")
    write_archives(pages, f"{path}/archives", compression=compression, **columns)
    runs_path, index_path = f"{path}/runs", f"{path}/index"
    index_runs(spark, f"{path}/archives").write.parquet(runs_path)
    merge_runs(spark.read.schema(INDEX).parquet(runs_path)).write.parquet(index_path)
    return spark.read.schema(INDEX).parquet(index_path)
