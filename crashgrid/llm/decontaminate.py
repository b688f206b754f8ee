"""Benchmark decontamination by winnowing.

Of the k-gram hashes in every run of ``window - k + 1`` consecutive ones, the
smallest (the last of equals) is a fingerprint, so documents and benchmark items
that share ``window`` consecutive words share a fingerprint inside that span. Equal
fingerprints are joined and each hit extended word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .flat import STEP, RangeHash, joined, mixed, word_ranges
from .shared import Scratch, byte_chunks, free_name, row_key, texts_of

GRAM = "array<struct<size:int,whole:boolean,hash:long,at:int,before:array<string>,mid:string,after:array<string>>>"
FILTER_BITS = 1 << 23


def word_table() -> np.ndarray:
    """Word bytes: digits, lower-case letters and every byte of other scripts."""
    out = np.zeros(256, bool)
    out[ord("0") : ord("9") + 1] = out[ord("a") : ord("z") + 1] = True
    out[0x80:] = True
    return out


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of every ``size`` consecutive word hashes."""
    n = max(0, len(words) - size + 1)
    out = np.zeros(n, np.uint64)
    for j in range(size):
        out = out * np.uint64(STEP) + words[j : j + n]
    return mixed(out)


def winnowed(grams: np.ndarray, run: int) -> np.ndarray:
    """Positions of the smallest hash, the last of equals, of every ``run`` consecutive ones."""
    n = len(grams) - run + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    low, at = grams[:n].copy(), np.arange(n)
    for j in range(1, run):
        later = grams[j : j + n] <= low
        low[later] = grams[j : j + n][later]
        at[later] = np.flatnonzero(later) + j
    return np.unique(at)


def _scan(docs: DataFrame, window: int, gram: int, short: list[int], filter_bits: np.ndarray | None, own: bool) -> DataFrame:
    """(id, key, n_words, grams): the fingerprints of each row, with the words
    around them that a hit may extend to. With a filter, only those in it."""
    is_word = word_table()

    def near(words: list[bytes], size: int, whole: bool, at: int, h: int) -> dict:
        reach = 0 if whole else window - size
        k = min(at, reach)
        text = [w.decode("utf-8", "replace") for w in words[at - k : at + size + reach]]
        return {
            "size": size, "whole": whole, "hash": h, "at": at,
            "before": text[:k][::-1], "mid": " ".join(text[k : k + size]), "after": text[k + size :],
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = RangeHash()
        for part in byte_chunks(batches, 2, 2 << 20):
            texts = [t.lower() for t in texts_of(part.column(2))]
            data, at = joined(texts)
            starts, ends = word_ranges(data, is_word)
            hashes = hasher.ranges(hasher.prefix(data), starts, ends)
            cuts = np.searchsorted(starts, at).tolist() + [len(starts)]
            found = []
            for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                h, got = hashes[a:b], []
                kinds = [(gram, False), *((n, True) for n in short)]
                if own:
                    kinds = [(gram, False)] if b - a >= window else [(b - a, True)] if b > a else []
                for size, whole in kinds:
                    grams = gram_hashes(h, size)
                    where = np.arange(len(grams)) if whole else winnowed(grams, window - gram + 1)
                    values = mixed(grams[where] ^ np.uint64(2 * size + whole))
                    if filter_bits is not None:
                        cells = filter_bits[(values >> np.uint64(3)) % np.uint64(len(filter_bits))]
                        hit = (cells >> (values & np.uint64(7)).astype(np.uint8)) & 1 > 0
                        where, values = where[hit], values[hit]
                    if len(where):
                        words = [texts[i][s:e] for s, e in zip((starts[a:b] - at[i]).tolist(), (ends[a:b] - at[i]).tolist())]
                        got += [near(words, size, whole, p, v) for p, v in zip(where.tolist(), values.view(np.int64).tolist())]
                found.append(got)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), part.column(1),
                    pa.array(np.diff(cuts), pa.int64()),
                    pa.array(found, pa.list_(pa.struct([("size", pa.int32()), ("whole", pa.bool_()), ("hash", pa.int64()), ("at", pa.int32()), ("before", pa.list_(pa.string())), ("mid", pa.string()), ("after", pa.list_(pa.string()))]))),
                ],
                names=["id", "key", "n_words", "grams"],
            )

    return docs.mapInArrow(run, f"id {dict(docs.dtypes)['id']}, key string, n_words long, grams {GRAM}")


def _filter_of(grams: DataFrame) -> np.ndarray:
    """A one-hash Bloom filter of FILTER_BITS bits over the items' fingerprints,
    as bytes. Its size is fixed; more items let more through, never less."""
    cells = FILTER_BITS // 8
    h = F.col("hash")
    # unsigned shift, so that the cell is the one numpy computes
    rows = grams.select(
        F.pmod(F.shiftrightunsigned(h, 3), F.lit(cells)).cast("int").alias("cell"), F.get(F.array(*[F.lit(1 << k) for k in range(8)]), h.bitwiseAND(7).cast("int")).alias("bit")
    ).groupBy("cell").agg(F.bit_or("bit").alias("bits"))
    out = np.zeros(cells, np.uint8)
    got = rows.toPandas()
    out[got["cell"].to_numpy(np.int64)] = got["bits"].to_numpy(np.uint8)
    return out


def _find(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str, window: int, gram: int) -> tuple[DataFrame, DataFrame]:
    """(id, key, n_words, grams) of every row; (key, item, lo, hi) of every hit:
    the words from lo to before hi are a stretch of the item's."""
    scratch = Scratch(docs.sparkSession, "decontaminate")
    keyed = lambda df, i, t: df.select(F.col(i).alias("id"), row_key(i, t).alias("key"), F.col(t).alias("text"))
    own = scratch.write(
        _scan(keyed(items, item_col, item_text_col), window, gram, [], None, True).select(F.col("id").alias("item"), F.inline("grams")).drop("at").distinct(),
        "items",
    )
    short = sorted(r[0] for r in own.where("whole").select("size").distinct().collect())  # at most window - 1 lengths
    scanned = scratch.write(_scan(keyed(docs, id_col, text_col), window, gram, short, _filter_of(own), False), "documents")
    hits = scanned.where(F.size("grams") > 0).select("key", F.inline("grams")).distinct()

    def run_of(side: str) -> Column:
        same = F.zip_with(f"d.{side}", f"i.{side}", lambda a, b: F.coalesce(a == b, F.lit(False)))
        first_off = F.array_position(same, False).cast("int")
        return F.when(first_off > 0, first_off - 1).otherwise(F.size(same))

    equal = [F.col(f"d.{c}") == F.col(f"i.{c}") for c in ("hash", "size", "whole", "mid")]
    reach = hits.alias("d").join(own.alias("i"), equal).select(
        "d.key", "i.item", "d.whole", "d.size", "d.at", run_of("before").alias("left"), run_of("after").alias("right")
    )
    # a hit counts where both texts agree over a whole window
    spans = reach.where(F.col("whole") | (F.col("left") + F.col("right") + F.col("size") >= window)).select(
        "key", "item", (F.col("at") - F.col("left")).alias("lo"), (F.col("at") + F.col("size") + F.col("right")).alias("hi")
    ).distinct()
    return scanned, scratch.write(spans, "spans")


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = 10, gram: int = 6,
) -> DataFrame:
    """One row per input row: id, n_words, n_hit, n_items, items (sorted strings), contaminated.

    A window is ``window`` consecutive item words, or a whole shorter item. Null
    and empty texts have no words and neither hit nor are hit. Repeated rows
    come back as often; a null id is a value like any other; items with a null
    id hit words but are in no list. Other columns are ignored; empty tables
    give no rows, or no hits.
    """
    scanned, spans = _find(docs, items, id_col, text_col, item_col, item_text_col, window, gram)
    covered = spans.select("key", "lo", "hi").distinct()
    before = F.max("hi").over(W.partitionBy("key").orderBy("lo", "hi").rowsBetween(W.unboundedPreceding, -1))
    n_hit = (
        covered.withColumn("from", F.greatest("lo", F.coalesce(before, F.lit(0)))).groupBy("key")
        .agg(F.sum(F.greatest(F.col("hi") - F.col("from"), F.lit(0))).cast("long").alias("hit"))
    )
    named = spans.select("key", F.col("item").cast("string").alias("item")).distinct().groupBy("key").agg(F.sort_array(F.collect_set("item")).alias("list"))
    told = n_hit.join(named, "key", "left")
    hit, listed = F.coalesce("hit", F.lit(0).cast("long")), F.coalesce("list", F.array().cast("array<string>"))
    return scanned.select("id", "key", "n_words").join(told, "key", "left").select(
        F.col("id").alias(id_col), "n_words", hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"),
        listed.alias("items"), (hit > 0).alias("contaminated"),
    )


def drop_contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = 10, gram: int = 6,
) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no window of any item. Cases as in ``contamination``."""
    _, spans = _find(docs, items, id_col, text_col, item_col, item_text_col, window, gram)
    key = free_name(docs, "row_key")
    bad = spans.select(F.col("key").alias(key)).distinct()
    return docs.withColumn(key, row_key(id_col, text_col)).join(bad, key, "left_anti").drop(key)
