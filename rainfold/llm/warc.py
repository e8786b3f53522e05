"""WARC archives of pages, and their index by an external merge.

``write_archives`` makes one record for each page. Of records with equal payloads of at least
``LEAST_REVISIT`` bytes the one with the smallest page_id is a response and the others are revisits of
it, without the payload; smaller payloads are always responses. Records are text, since payloads are
UTF-8; Spark's text writer lays them down, gzipped, so files are committed as all its output is and a
lost executor leaves no half archive. ``captures`` reads the archives back, one task for a file, and
yields each record's place, its URL key and what its headers and payload say.

``merged_index`` orders all captures by URL key, time and page. The captures of an archive, sorted,
are a run. The runs are cut at common bounds that Spark's range partitioner finds, on the whole key
with the page, so that a URL or host with a third of all captures spreads over tasks; each task merges
its part of all runs with a loser tree. ``range_id`` and ``place`` give the global order, in which a
URL's captures stand together as its history.

Nulls and oddities: null html is an empty payload, a null url an empty target. A null page_id is a
response, since it cannot be the smallest. Rows that repeat a page_id each get a record. A line break
in a URL is percent-encoded. An empty table gives no archives and an empty index.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from rainfold.llm.storage import shared_path, stored

# The smallest payload that a revisit refers to, records in a file at most, the end of
# a record, and the time of page 0.
LEAST_REVISIT = 100
RECORDS_PER_FILE = 2_000
RECORD_END = "\r\n\r\n"
_FIRST_CAPTURE = "2024-01-01 00:00:00"
_CAPTURE = (
    "page_id long, url string, url_key string, captured string, record_type string,"
    " refers_to long, payload_bytes long, payload_digest string, file string, at long, length long"
)


def _with_types(pages: DataFrame) -> DataFrame:
    """Each page with its payload, digest and the page that it refers to."""
    rows = pages.selectExpr(
        "cast(page_id as bigint) as page_id",
        "coalesce(url, '') as url",
        "coalesce(html, '') as payload",
    ).selectExpr(
        "*",
        "sha2(payload, 256) as digest",
        "cast(octet_length(payload) as bigint) as size",
    )
    # Pre-aggregated before the shuffle; only digests with several pages are kept.
    firsts = stored(
        rows.where(F.col("size") >= LEAST_REVISIT)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select(F.col("digest").alias("shared"), "first"),
        "shared-payloads",
    )
    return rows.join(firsts, F.col("digest") == F.col("shared"), "left").withColumn(
        "refers_to", F.expr("if(page_id > first, first, cast(null as bigint))")
    )


_HTTP = (
    "concat('HTTP/1.1 200 OK\\r\\nContent-Type: text/html; charset=utf-8\\r\\nContent-Length: ',"
    " size, '\\r\\n\\r\\n')"
)
_REVISIT = (
    "if(refers_to is null, '', concat('WARC-Profile: http://netpreserve.org/warc/1.0/revisit/"
    "identical-payload-digest\\r\\nWARC-Refers-To: <urn:page:', refers_to, '>\\r\\n'))"
)
_RECORD = (
    "concat('WARC/1.0\\r\\nWARC-Type: ', if(refers_to is null, 'response', 'revisit'),"
    " '\\r\\nWARC-Record-ID: <urn:page:', coalesce(cast(page_id as string), ''),"
    " '>\\r\\nWARC-Date: ', captured, '\\r\\nWARC-Target-URI: ', target,"
    f" '\\r\\n', {_REVISIT}, 'WARC-Payload-Digest: sha256:', digest,"
    " '\\r\\nContent-Type: application/http; msgtype=response\\r\\nContent-Length: ',"
    f" octet_length({_HTTP}) + if(refers_to is null, size, 0), '\\r\\n\\r\\n', {_HTTP},"
    " if(refers_to is null, payload, ''))"
)


def write_archives(pages: DataFrame, path: str) -> None:
    """One record for each row of ``pages`` (page_id, url, html), in gzipped files below ``path``."""
    records = _with_types(pages).withColumns(
        {
            "captured": F.expr(
                f"date_format(timestamp_ntz'{_FIRST_CAPTURE}' + make_dt_interval(0, 0, 0,"
                " coalesce(page_id, 0)), \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
            ),
            "target": F.expr("replace(replace(url, '\\r', '%0D'), '\\n', '%0A')"),
        }
    )
    (
        records.selectExpr(f"{_RECORD} as value")
        .write.option("lineSep", RECORD_END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .text(path)
    )


def url_key(url: str) -> str:
    """Host from the right, then path and query: pages of a site sort together."""
    try:
        parts = urlsplit(url.strip().lower())
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        return url.strip().lower()
    query = f"?{parts.query}" if parts.query else ""
    return ",".join(reversed(host.split("."))) + ")" + (parts.path or "/") + query


def _number(header: str) -> int | None:
    digits = header.removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def _headers(stream: io.BufferedIOBase) -> tuple[dict[str, str], int]:
    """The lines up to an empty one as names and values, and their bytes."""
    found, size = {}, 0
    for line in iter(stream.readline, b""):
        size += len(line)
        if not line.strip():
            break
        name, _, value = line.decode("utf-8", "replace").partition(":")
        found[name.strip().lower()] = value.strip()
    return found, size


def records_of(content: bytes) -> Iterator[tuple]:
    """The captures in one gzipped archive, in the order of their records."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content)))
    at = 0
    while True:
        headers, size = _headers(stream)
        if not headers:
            return
        block = io.BytesIO(stream.read(int(headers["content-length"])))
        http, _ = _headers(block)
        payload = block.read()
        length = size + block.tell() + len(stream.read(len(RECORD_END)))
        digest = headers["warc-payload-digest"].removeprefix("sha256:")
        if headers["warc-type"] == "response" and hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"the payload of {headers['warc-record-id']} differs from its digest")
        url = headers.get("warc-target-uri", "")
        yield (
            _number(headers["warc-record-id"]), url, url_key(url), headers["warc-date"],
            headers["warc-type"], _number(headers.get("warc-refers-to", "")),
            int(http["content-length"]), digest, at, length,
        )
        at += length


def captures(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives below ``path``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _CAPTURE.split(", ")]
        for batch in batches:
            for file, content in zip(batch.column("path"), batch.column("content")):
                rows = [(*r[:8], file.as_py(), *r[8:]) for r in records_of(content.as_py())]
                columns = list(zip(*rows)) or [[]] * len(names)
                kinds = [pa.int64() if " long" in x else pa.string() for x in _CAPTURE.split(", ")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], names=names
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("path", "content").mapInArrow(read, _CAPTURE)


class LoserTree:
    """Merges sorted runs: each inner node keeps the loser of its match, the winner moves on."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs = runs
        self.size = max(1, len(runs))
        self.position = [0] * self.size
        self.losers = [-1] * self.size
        self.winner = self._play(1)

    def _key(self, run: int) -> tuple | None:
        rows = self.runs[run] if run < len(self.runs) else ()
        return rows[self.position[run]] if self.position[run] < len(rows) else None

    def _beats(self, a: int, b: int) -> bool:
        """An empty run loses; equal rows go to the earlier run."""
        x, y = self._key(a), self._key(b)
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x, a) < (y, b)

    def _play(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        a, b = self._play(2 * node), self._play(2 * node + 1)
        winner, self.losers[node] = (a, b) if self._beats(a, b) else (b, a)
        return winner

    def __iter__(self) -> Iterator[tuple]:
        while (row := self._key(self.winner)) is not None:
            yield row
            run = self.winner
            self.position[run] += 1
            node = (run + self.size) // 2
            while node >= 1:
                if self._beats(self.losers[node], run):
                    self.losers[node], run = run, self.losers[node]
                node //= 2
            self.winner = run


def merged_index(found: DataFrame) -> DataFrame:
    """The captures with range_id and place, their global order by URL key, time and page."""
    order = ["url_key", "captured", "page_id"]
    columns = found.columns

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(parts) if (parts := list(batches)) else None
        if not rows:
            return
        keys = rows.select(["url_key", "captured", "page_id", "file"]).to_pydict()
        pages = [-1 if page is None else page for page in keys["page_id"]]
        keyed = list(zip(keys["url_key"], keys["captured"], pages, range(len(rows))))
        files = keys["file"]
        starts = [0, *(i for i in range(1, len(files)) if files[i] != files[i - 1]), len(files)]
        runs = [keyed[a:b] for a, b in zip(starts[:-1], starts[1:])]
        merged = rows.take(pa.array([key[3] for key in LoserTree(runs)]))
        placed = merged.append_column("place", pa.array(range(len(merged)), pa.int64()))
        yield from placed.to_batches(max_chunksize=10_000)

    ranged = (
        found.repartitionByRange("url_key", "captured", F.coalesce("page_id", F.lit(-1)))
        .withColumn("range_id", F.spark_partition_id())
        # Each run in one piece, in its own order.
        .sortWithinPartitions("file", *order)
    )
    return ranged.mapInArrow(merge, f"{_CAPTURE}, range_id int, place long").select(
        *columns, "range_id", "place"
    )


def archived(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write the pages' archives below ``path``, read them back and index them."""
    spark = pages.sparkSession
    path = path or shared_path(spark, "warc")
    write_archives(pages, path)
    return merged_index(stored(captures(spark, path), "captures"))
