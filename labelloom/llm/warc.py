"""WARC archives of pages and their external index, merged by loser trees.

Pages become response and revisit records, written by Spark's text writer as gzip-compressed archives
in the shared folder, and are read back record by record by their Content-Length. Each archive yields one
run of captures, sorted by URL key and time. Runs are cut at common range borders, and every range merges
its pieces of all runs by a k-way loser tree, so the whole index is in one global order. Pieces are not
sorted again: where the shuffle brought parts of a run out of turn, each part is merged as a run of its own.
The borders run through time and id as well, so a URL with very many captures is spread over ranges.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.llm.store import land, width
from labelloom.session import scratch_path

# Smaller payloads are never revisits.
MIN_REVISIT_BYTES = 100
RECORDS_PER_FILE = 4000
RANGE_ROWS = 500_000
# Seconds from 1970 to the year 10000: dates keep four digits of the year and sort as text.
LAST_SECOND = 253_402_300_800
CRLF = "\r\n"

CAPTURE = ("page_id long, url string, url_key string, capture_time string, payload_bytes long, payload_digest string, "
           "record_type string, refers_to long")


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels reversed, without scheme, port, user and a leading www, lower case, then the path.

    Null and text without a host keep what there is after `)`.
    """
    try:
        parts = urlsplit((url or "").strip())
        host = (parts.hostname or "").lower()
    except ValueError:
        return ")" + (url or "").strip().lower()
    labels = host.split(".") if host else []
    if labels[:1] == ["www"]:
        labels = labels[1:]
    path = (parts.path or "/").lower() + ("?" + parts.query.lower() if parts.query else "")
    return ",".join(reversed(labels)) + ")" + path


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """One WARC record per row of (page_id, url, html), null html as an empty payload.

    Of equal payloads of at least `min_bytes` bytes the row with the smallest page id is the response
    and the others revisit it; rows that repeat that id are responses too, and without any id there is
    nothing to refer to, so all are responses. A capture's time is its page id in seconds since 1970, modulo
    the seconds up to the year 10000, so every long is a page id, also a negative one; null is 1970.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"))
    rows = rows.select("*", F.octet_length("payload").alias("bytes"), F.sha2("payload", 256).alias("digest"))
    repeated = (rows.filter(F.col("bytes") >= min_bytes).groupBy("digest")
                .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1 and first_id is not null")
                .select("digest", "first_id"))
    rows = rows.join(repeated, "digest", "left")
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    http = F.concat(F.lit(CRLF.join(("HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", "Content-Length: "))),
                    F.col("bytes").cast("string"), F.lit(CRLF * 2))
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    time = F.date_format(F.timestamp_seconds(F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(LAST_SECOND))), "yyyy-MM-dd'T'HH:mm:ss'Z'")

    def field(name, value):
        return F.concat(F.lit(f"{CRLF}{name}: "), value)

    head = F.concat(
        F.lit("WARC/1.1"), field("WARC-Type", F.when(again, "revisit").otherwise("response")),
        field("WARC-Record-ID", F.concat(F.lit("<urn:page:"), page, F.lit(">"))), field("WARC-Date", time),
        F.coalesce(field("WARC-Target-URI", F.regexp_replace("url", "[\\r\\n]+", " ")), F.lit("")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(again, F.concat(
            field("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            field("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("first_id").cast("string"), F.lit(">"))))).otherwise(""),
        field("Content-Type", F.lit("application/http;msgtype=response")),
        field("Content-Length", (F.octet_length(http) + F.when(again, 0).otherwise(F.col("bytes"))).cast("string")),
        F.lit(CRLF * 2))
    record = F.concat(head, http, F.when(again, "").otherwise(F.col("payload")))
    (rows.select(record.alias("value")).write.option("lineSep", CRLF * 2).option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(folder))


def records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of every record of an archive, read one at a time by Content-Length."""
    while first := stream.readline():
        if first.decode().rstrip(CRLF) != "WARC/1.1":
            raise ValueError(f"no record where one begins: {first[:40]!r}")
        fields = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, value = line.decode().split(": ", 1)
            fields[name] = value
        size = int(fields["Content-Length"])
        block = stream.read(size)
        if len(block) < size or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {fields.get('WARC-Record-ID')} is cut short")
        yield fields, block


def _page(urn: str | None) -> int | None:
    name = urn.removeprefix("<urn:page:").removesuffix(">") if urn else "none"
    return None if name == "none" else int(name)


def capture(fields: dict[str, str], block: bytes) -> tuple:
    """The index entry of one record, size and digest taken from a response's payload itself."""
    split = block.index(b"\r\n\r\n")
    http = dict(line.split(": ", 1) for line in block[:split].decode().split(CRLF)[1:])
    payload, kind = block[split + 4:], fields["WARC-Type"]
    digest = hashlib.sha256(payload).hexdigest() if kind == "response" else fields["WARC-Payload-Digest"].partition(":")[2]
    size = len(payload) if kind == "response" else int(http["Content-Length"])
    url = fields.get("WARC-Target-URI")
    return (_page(fields["WARC-Record-ID"]), url, url_key(url), fields["WARC-Date"], size, digest, kind,
            _page(fields.get("WARC-Refers-To")))


def order_of(entry: tuple) -> tuple:
    """URL key, time, page id; entries without an id come first."""
    return entry[2], entry[3], entry[0] is not None, entry[0] or 0


_TYPES = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())


def _batch(entries: list[tuple], run: str | None = None) -> pa.RecordBatch:
    columns = [pa.array(c, t) for c, t in zip(zip(*entries, strict=True), _TYPES, strict=True)]
    names = [part.split()[0] for part in CAPTURE.split(", ")]
    if run is not None:
        columns, names = [*columns, pa.array([run] * len(entries))], [*names, "run"]
    return pa.record_batch(columns, names=names)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One sorted run of captures per archive."""
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            with gzip.open(pa.BufferReader(content.as_buffer())) as stream:
                entries = sorted((capture(*r) for r in records(io.BufferedReader(stream))), key=order_of)
            for lo in range(0, len(entries), 10_000):
                yield _batch(entries[lo:lo + 10_000], path)


class LoserTree:
    """Merges sorted runs: inner nodes keep the loser of each match, the root the overall winner.

    Replacing the winner replays one path of log2(k) matches. Ties go to the earlier run.
    """

    def __init__(self, runs: list[list], key):
        self.runs, self.key = runs, key
        self.at = [0] * len(runs)
        self.heads = [key(r[0]) if r else None for r in runs]
        self.k = len(runs)
        self.losers = [-1] * self.k
        self.winner = self._play(1) if self.k else -1

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return x < y or (x == y and a < b)

    def _play(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        if not self._beats(a, b):
            a, b = b, a
        self.losers[node] = b
        return a

    def __iter__(self):
        if self.k == 1:
            yield from self.runs[0]
            return
        while self.k and self.heads[self.winner] is not None:
            won = self.winner
            run = self.runs[won]
            yield run[self.at[won]]
            self.at[won] += 1
            self.heads[won] = self.key(run[self.at[won]]) if self.at[won] < len(run) else None
            node = (won + self.k) // 2
            while node:
                if self._beats(self.losers[node], won):
                    self.losers[node], won = won, self.losers[node]
                node //= 2
            self.winner = won


def sorted_pieces(tagged: Iterator[tuple[str, tuple]]) -> list[list[tuple]]:
    """Entries of (run, entry) as lists in order: one per run, and one more wherever a run falls back."""
    pieces, current = [], {}
    for run, entry in tagged:
        piece = current.get(run)
        if piece is None or order_of(entry) < order_of(piece[-1]):
            piece = current[run] = []
            pieces.append(piece)
        piece.append(entry)
    return pieces


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The captures of one range in order, from its pieces of all runs."""
    pieces = sorted_pieces((run, tuple(entry)) for batch in batches
                           for *entry, run in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    out = []
    for entry in LoserTree(pieces, order_of):
        out.append(entry)
        if len(out) == 10_000:
            yield _batch(out)
            out = []
    if out:
        yield _batch(out)


def read_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Captures of all archives of a folder with the archive (`run`) they stand in, each run sorted."""
    files = spark.read.format("binaryFile").load(folder).select("path", "content").filter("length(content) > 0")
    return files.mapInArrow(_runs, CAPTURE + ", run string")


def merge_runs(runs: DataFrame) -> DataFrame:
    """Captures of landed runs in global order of URL key, time and page id, over the partitions in turn."""
    ranges = max(width(runs), -(-runs.count() // RANGE_ROWS))
    return runs.repartitionByRange(ranges, "url_key", "capture_time", "page_id").mapInArrow(_merge, CAPTURE)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write (page_id, url, html) as archives, read them back, and return the merged index, one row per page.

    Every row comes back, also repeated ones and those with null columns. Other columns are ignored.
    """
    spark = pages.sparkSession
    folder = scratch_path(spark, "archives")
    write_archives(pages, folder)
    return merge_runs(land(read_runs(spark, folder), "runs"))
