"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint is cut into ``bits // 2 + 1`` segments, so two fingerprints that
differ in at most ``bits`` bits differ by at most one bit in some segment. Every
segment is indexed once per bit with that bit wiped; equal keys are joined and
the whole distance verified. Exact copies are one fingerprint from the start.

Fingerprints in a key shared by more than ``max_bucket`` of them are linked
another way, exactly and without pairs: two fingerprints at distance 4 or less
have a point within 2 bits of both, and all fingerprints within 2 bits of a
point are within 4 of each other. So each is sent to every point of its ball
(2,081 for 2 bits), and those that meet are joined to the smallest of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .components import connected_components
from .shared import Scratch, byte_chunks, free_name, row_key, texts_of

BITS = 64
SEED = 42


def fingerprint_of(text: bytes, shingle_words: int = 4) -> int:
    """Unsigned 64-bit SimHash of lower-cased word shingles, repeats included.

    Fewer words than a shingle: the whole sequence is one. No word: zero. A bit
    is set if it is set in more than half of the shingles' hashes.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle_words:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    hash_, counts, n = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64), len(words) - shingle_words + 1
    for at in range(0, n, 1 << 15):
        to = min(n, at + (1 << 15))
        spans = zip(starts[at:to], ends[at + shingle_words - 1 : to + shingle_words - 1])
        h = np.fromiter((hash_(joined[a : b - 1], SEED) for a, b in spans), np.uint64, to - at)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 4) -> DataFrame:
    """(id, key, fp): each row's id, the digest of its id and text, and its
    fingerprint as a signed long; null text as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_chunks(batches, 2):
            fps = np.fromiter((fingerprint_of(t, shingle_words) for t in texts_of(part.column(2))), np.uint64, part.num_rows)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(fps.view(np.int64))], names=["id", "key", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {dict(docs.dtypes)[id_col]}, key string, fp long")


def segment_masks(bits: int) -> list[int]:
    """For each of the 64 bits: its segment's mask without that bit, signed."""
    parts = bits // 2 + 1
    cuts = [round(BITS * i / parts) for i in range(parts + 1)]
    out = []
    for lo, hi in zip(cuts, cuts[1:]):
        whole = ((1 << (hi - lo)) - 1) << lo
        out += [whole & ~(1 << j) for j in range(lo, hi)]
    return [m - (1 << 64) if m >> 63 else m for m in out]


def ball(radius: int) -> np.ndarray:
    """All xor masks of at most ``radius`` bits."""
    return np.array([sum(1 << j for j in c) for r in range(radius + 1) for c in combinations(range(BITS), r)], np.uint64)


def links(fps: DataFrame, scratch: Scratch, bits: int = 4, max_bucket: int = 64) -> DataFrame:
    """Distinct ``fp`` longs -> (a, b) edges, each between fingerprints at most
    ``bits`` apart, that connect exactly what all such pairs connect."""
    if bits % 2:
        raise ValueError("bits must be even: the meeting points lie bits / 2 from either fingerprint")
    masks = F.array(*[F.lit(m).cast("long") for m in segment_masks(bits)])
    index = fps.select("fp", F.posexplode(masks).alias("j", "mask")).select("fp", "j", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
    crowded = scratch.write(index.groupBy("j", "key").agg(F.count("*").alias("n")).where(F.col("n") > max_bucket).select("j", "key"), "crowded")
    # most keys have one fingerprint: counted over sorted rows, they never reach a list
    rest = index.join(crowded, ["j", "key"], "left_anti").withColumn("n", F.count("*").over(W.partitionBy("j", "key")))
    met = rest.where("n > 1").groupBy("j", "key").agg(F.collect_list("fp").alias("fps"))
    apart = lambda a, b: (b > a) & (F.bit_count(b.bitwiseXOR(a)) <= bits)
    pairs = F.transform("fps", lambda a: F.transform(F.filter("fps", lambda b: apart(a, b)), lambda b: F.struct(a.alias("a"), b.alias("b"))))
    near = met.select(F.inline(F.flatten(pairs)))
    points = ball(bits // 2)

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                fp = batch.column(0).slice(at, 200).to_numpy(zero_copy_only=False).view(np.uint64)
                at_points = (fp[:, None] ^ points[None, :]).reshape(-1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at_points.view(np.int64)), pa.array(np.repeat(fp, len(points)).view(np.int64))], names=["point", "fp"]
                )

    hot = index.join(crowded, ["j", "key"], "left_semi").select("fp").distinct()
    # a window, not a set per point: rows stay in Spark's own sorted, spilling form
    lowest = F.min("fp").over(W.partitionBy("point"))
    met = hot.mapInArrow(expand, "point long, fp long").withColumn("a", lowest)
    dense = met.where("a != fp").select("a", F.col("fp").alias("b"))
    return near.unionByName(dense).distinct()


def _classes(docs: DataFrame, id_col: str, text_col: str, shingle_words: int, bits: int, max_bucket: int) -> tuple[DataFrame, DataFrame, Scratch]:
    """(id, key, fp) per row, and (fp, root) per fingerprint: the one that stands for its component."""
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = scratch.write(fingerprints(docs, id_col, text_col, shingle_words), "rows")
    # copies are added up in part before they are dealt; then as many partitions as
    # any shuffle, since few bytes here become 64 rows each
    wide = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    linked = links(rows.select("fp").distinct().repartition(wide, "fp"), scratch, bits, max_bucket)
    roots = scratch.write(connected_components(linked, scratch).select(F.col("node").alias("fp"), "root"), "roots")
    return rows, roots, scratch


def _of_components(rows: DataFrame, roots: DataFrame, value: Column) -> DataFrame:
    """(fp, root, best): the smallest ``value`` of the rows of each fingerprint's
    component. Rows are added up per fingerprint before they meet the others."""
    per_fp = rows.groupBy("fp").agg(F.min(value).alias("v")).join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    best = per_fp.groupBy("root").agg(F.min("v").alias("best"))
    return per_fp.select("fp", "root").join(best, "root")


def simhash_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 4, bits: int = 4, max_bucket: int = 64
) -> DataFrame:
    """One row (id, fingerprint, component_id) per input row.

    Fingerprints at most ``bits`` (even) apart are linked; ``component_id`` is
    the smallest id reachable. Null and empty texts share fingerprint zero and
    link like any other; repeated rows are returned as often as they come; a
    null id is never a component id unless its whole component has null ids.
    An empty table gives an empty result. Other columns are ignored.
    """
    rows, roots, scratch = _classes(docs, id_col, text_col, shingle_words, bits, max_bucket)
    # written: a join whose other side is no aggregate can be split at a hot fingerprint
    components = scratch.write(_of_components(rows, roots, F.col("id")), "components")
    return rows.join(components, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("best").alias("component_id")
    )


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 4, bits: int = 4, max_bucket: int = 64
) -> DataFrame:
    """The rows of ``docs``, all columns, but one per component: that with the
    smallest id (a null id only if there is no other). Cases as in
    ``simhash_groups``; of rows alike in id and text that stays whose other
    columns, as JSON, come first, and of rows alike in all columns one."""
    rows, roots, scratch = _classes(docs, id_col, text_col, shingle_words, bits, max_bucket)
    first = F.struct(F.col("id").isNull().alias("none"), "id", "key")
    best = _of_components(rows, roots, first).select("root", "best").distinct()
    key, row = free_name(docs, "row_key"), free_name(docs, "whole_row")
    kept = scratch.write(best.select(F.col("best.key").alias(key)), "kept")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    found = docs.withColumn(key, row_key(id_col, text_col)).join(kept, key, "left_semi")
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    return found.groupBy(key).agg(F.min_by(whole, F.to_json(F.struct(*others))).alias(row)).select(f"{row}.*")
