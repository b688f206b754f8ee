"""WARC archives of captured pages, read back, and their indexes merged.

Each archive is read as a stream, record by record, and gives a run of captures,
sorted where it is read. Runs are dealt out by ranges of (URL key, time, id), as
many as their bytes ask for; in every range Spark brings each run's part in order,
spilling as it must, and a loser tree merges them, which gives capture histories
in one global order. A task holds one range in columns, and one record.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Callable, Iterator, Sequence
from typing import BinaryIO
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .native import let
from .shared import Scratch

# The base32 alphabet and the profile of revisit records.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"

#: Bytes of records an archive is to hold, and records at most; bytes of captures per range.
ARCHIVE_BYTES, ARCHIVE_RECORDS = 64 << 20, 2000
RANGE_BYTES = 32 << 20

CAPTURE = "id long, url string, url_key string, captured string, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, offset long, length long"


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of SHA-1: every 5 hex digits are 4 characters."""
    return let(
        F.sha1(data),
        lambda h: let(
            F.transform(F.sequence(F.lit(0), F.lit(7)), lambda g: F.conv(F.substring(h, g * 5 + 1, F.lit(5)), 16, 10).cast("int")),
            lambda v: F.array_join(
                F.flatten(F.transform(v, lambda x: F.array(*[F.substring(F.lit(BASE32), F.shiftright(x, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]))), ""
            ),
        ),
    )


def record_id(i: Column) -> Column:
    """A custom UUID that spells the id; null has a mark of its own."""
    h = F.lower(F.lpad(F.hex(F.coalesce(i, F.lit(0))), 16, "0"))
    mark = F.when(i.isNull(), "8fff").otherwise("8000")
    return F.concat(F.lit("<urn:uuid:0000"), F.substring(h, 1, 4), F.lit("-"), F.substring(h, 5, 4), F.lit("-"), mark, F.lit("-8000-0000"), F.substring(h, 9, 8), F.lit(">"))


def id_of(record: str) -> int | None:
    d = record.split(":")[-1].rstrip(">").replace("-", "")
    if d[12:16] == "8fff":
        return None
    value = int(d[4:12] + d[24:32], 16)
    return value - (1 << 64) if value >> 63 else value


def revisits(pages: DataFrame, id_col: str, body_col: str, min_bytes: int) -> DataFrame:
    """(id, same, last): the pages that repeat a payload of ``min_bytes`` or more,
    its SHA-256, and the largest id that holds it, the one they refer to. Found
    from ids and digests alone; a payload that fills the table is one row per
    task before the shuffle."""
    body = F.coalesce(F.col(body_col), F.lit(""))
    light = pages.where(F.col(id_col).isNotNull() & (F.octet_length(body) >= min_bytes)).select(F.col(id_col).cast("long").alias("id"), F.sha2(body, 256).alias("same"))
    scratch = Scratch(pages.sparkSession, "warc-revisits")
    # written: a join whose other side is no aggregate can be split at a hot payload
    last = scratch.write(light.groupBy("same").agg(F.max("id").alias("last"), F.min("id").alias("first")).where("first < last").drop("first"), "last")
    return scratch.write(light.join(last, "same").where("id < last").select("id", "same", "last").distinct(), "revisits")


def records(pages: DataFrame, id_col: str, url_col: str, body_col: str, captured: Column | None, min_bytes: int) -> DataFrame:
    """One row (value) per page: its record without the two line ends that close it.

    Of equal payloads of ``min_bytes`` or more, the page with the largest id is
    the response and the others revisit it (:func:`revisits`). A body meets what
    is known of its page by id and digest, never by digest alone, so pages that
    share a body do not gather in one task; pages without an id, which are
    responses all, meet nothing.
    """
    body = F.coalesce(F.col(body_col), F.lit(""))
    when = captured if captured is not None else F.timestamp_seconds(F.lit(1_704_067_200) + F.coalesce(F.col(id_col), F.lit(0)) % 1_000_000_000)
    own = pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.regexp_replace(F.coalesce(F.col(url_col), F.lit("")), "[\\x00-\\x20\\x7f]", "%20").alias("url"),
        body.alias("body"), F.octet_length(body).alias("size"), F.sha2(body, 256).alias("same"),
        F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("captured"),
    )
    known = own.where("id IS NOT NULL").join(revisits(pages, id_col, body_col, min_bytes), ["id", "same"], "left")
    placed = known.unionByName(own.where("id IS NULL").withColumn("last", F.lit(None).cast("long")))
    again = F.col("last").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size"), F.lit(END))
    block = F.concat(http, F.when(again, "").otherwise(F.col("body")))

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"\r\n{name}: "), value)

    return placed.withColumn("block", block).select(
        F.concat(
            F.lit("WARC/1.1"), line("WARC-Type", F.when(again, "revisit").otherwise("response")), line("WARC-Record-ID", record_id(F.col("id"))),
            line("WARC-Date", F.col("captured")), F.when(F.col("url") != "", line("WARC-Target-URI", F.col("url"))).otherwise(""),
            line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.encode("body", "UTF-8")))),
            F.when(again, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", record_id(F.col("last"))))).otherwise(""),
            F.lit("\r\nContent-Type: application/http;msgtype=response"), line("Content-Length", F.octet_length("block").cast("string")),
            F.lit(END), F.col("block"),
        ).alias("value")
    )


def write_archives(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
    captured: Column | None = None, min_bytes: int = 0, records_per_file: int | None = None,
) -> None:
    """Write one record per row to gzipped WARC files under ``path``, of at most
    ``records_per_file`` records: by default as many as make ``ARCHIVE_BYTES`` at
    the pages' mean size, and no more than ``ARCHIVE_RECORDS``. Two line ends close
    a record, so Spark's own text writer puts it on whatever store ``path`` names."""
    if records_per_file is None:
        mean = pages.agg(F.avg(F.coalesce(F.octet_length(body_col), F.lit(0)))).first()[0] or 0
        records_per_file = int(max(1, min(ARCHIVE_RECORDS, ARCHIVE_BYTES // (mean + 500))))
    records(pages, id_col, url_col, body_col, captured, min_bytes).write.option("lineSep", END).option(
        "maxRecordsPerFile", records_per_file
    ).option("compression", "gzip").text(path)


def url_key(url: str) -> str:
    """Host labels from the last to the first, then path and query, lower case."""
    try:
        parts = urlsplit(url)
        host, port = (parts.hostname or "").removeprefix("www."), parts.port
    except ValueError:
        return url.lower()
    if not host:
        return url.lower()
    shown = f":{port}" if port and port != {"http": 80, "https": 443}.get(parts.scheme) else ""
    return (",".join(reversed(host.split("."))) + shown + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")).lower()


def parse(stream: BinaryIO, archive: str) -> Iterator[tuple]:
    """The captures of one archive, as CAPTURE lists them, read record by record;
    response payloads are checked against their digest."""
    at = 0
    while stream.readline():  # the version
        lines, size_read = [], len("WARC/1.1\r\n")
        while (line := stream.readline()) != b"\r\n":
            if not line:
                raise ValueError(f"{archive} at {at}: the header has no end")
            lines.append(line.decode().rstrip("\r\n"))
            size_read += len(line)
        head = dict(line.split(": ", 1) for line in lines)
        block = stream.read(int(head["Content-Length"]))
        http, _, payload = block.partition(b"\r\n\r\n")
        size = int(http.rsplit(b"Content-Length: ", 1)[1])
        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
        if head["WARC-Type"] == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
            raise ValueError(f"{archive} at {at}: the payload does not match its digest")
        refers = head.get("WARC-Refers-To")
        url = head.get("WARC-Target-URI", "")
        length = size_read + 2 + len(block)
        yield (
            id_of(head["WARC-Record-ID"]), url, url_key(url), head["WARC-Date"], size, digest, head["WARC-Type"],
            id_of(refers) if refers else None, archive, at, length,
        )
        at += length + len(stream.read(4))


def _order(row: tuple) -> tuple:
    return row[2], row[3], row[0] is not None, row[0] or 0, row[8], row[9]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names, kinds = zip(*(c.split(" ") for c in CAPTURE.split(", ")))
    types = {"long": pa.int64(), "string": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array(c, types[k]) for c, k in zip(zip(*rows), kinds)], names=list(names))


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The captures of every archive under ``path``; those of one archive are a sorted run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer())), 1 << 16)
                rows = sorted(parse(stream, name.rsplit("/", 1)[-1]), key=_order)
                if rows:
                    yield _batch(rows)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, CAPTURE)


class LoserTree:
    """Merges sorted runs: inner nodes hold the run that lost there, so the next
    smallest costs one comparison per level. ``key`` orders the rows."""

    def __init__(self, runs: Sequence[Sequence], key: Callable = _order):
        self.runs, self.key = runs, key
        self.at = [0] * len(runs)
        self.heads = [key(r[0]) if len(r) else None for r in runs]
        self.tree = [-1] * max(1, len(runs))
        for i in range(len(runs)):
            self._play(i)

    def _less(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and x <= y)

    def _play(self, i: int) -> None:
        node, k = (i + len(self.runs)) // 2, i
        while node:
            other = self.tree[node]
            if other < 0:  # not yet met: wait here for the neighbour
                self.tree[node] = k
                return
            if self._less(other, k):
                self.tree[node], k = k, other
            node //= 2
        self.tree[0] = k

    def __iter__(self) -> Iterator:
        while len(self.runs) and self.heads[k := self.tree[0]] is not None:
            run, at = self.runs[k], self.at[k]
            yield run[at]
            self.at[k] = at + 1
            self.heads[k] = self.key(run[at + 1]) if at + 1 < len(run) else None
            self._play(k)


def merge_runs(runs: DataFrame, ranges: int | None = None) -> DataFrame:
    """All captures in the order of (URL key, time, id), range by range.

    Ranges are cut by the whole order, so one URL with a third of all captures
    spreads over many; there are as many as make ``RANGE_BYTES`` each, unless
    ``ranges`` says. A task holds one range, as Arrow columns; each run's part of
    it arrives in order, and what is merged are places.
    """
    if ranges is None:
        held = runs.agg(F.sum(F.octet_length("url") + F.octet_length("url_key") + 200)).first()[0] or 0
        ranges = max(1, -(-held // RANGE_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held)
        url_key, captured, id_, archive, offset = (table[c].to_pylist() for c in ("url_key", "captured", "id", "archive", "offset"))
        cuts = [0, *(i for i in range(1, len(archive)) if archive[i] != archive[i - 1]), len(archive)]
        parts = [range(a, b) for a, b in zip(cuts, cuts[1:]) if b > a]
        order = pa.array(LoserTree(parts, lambda i: (url_key[i], captured[i], id_[i] is not None, id_[i] or 0, archive[i], offset[i])), pa.int64())
        for at in range(0, len(order), 10_000):
            yield from table.take(order.slice(at, 10_000)).combine_chunks().to_batches()

    order = ["url_key", "captured", "id", "archive", "offset"]
    in_runs = ["archive", *(c for c in order if c != "archive")]
    return runs.repartitionByRange(ranges, *order).sortWithinPartitions(*in_runs).mapInArrow(run, CAPTURE)


def capture_histories(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", captured: Column | None = None, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives in the shared folder, read them back and merge
    their indexes: one row per input row (columns of CAPTURE) in global order.

    Null bodies are empty payloads; a null URL has no target and the empty key;
    a null id is a response of its own and nothing refers to it, unless no
    equal payload has an id. Rows repeated with the largest id are responses
    each. Other columns are ignored; an empty table gives an empty result. Ids are
    whole numbers. A page of any length is one record, held whole by its task.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark, "warc")
    write_archives(pages, scratch.path("archives"), id_col, url_col, body_col, captured, min_bytes)
    runs = scratch.write(read_runs(spark, scratch.path("archives")), "runs")
    return merge_runs(runs)
