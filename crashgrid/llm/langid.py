"""Language identification by language-bitmask n-gram filters.

A bit-sliced Bloom filter keeps one bit per language in every cell, in as many
64-bit words as the languages need: the cells of an n-gram, taken together, name
all languages whose filter holds it. A text's n-grams are counted per language, the counts corrected for what the
fill of each filter lets through by chance, and the largest decides.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .flat import mixed
from .shared import Scratch, byte_chunks, texts_of

LETTER = re.compile(r"[^\W\d_]")


def gram_keys(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All 4-byte n-grams of the texts' words, and the text of each.

    Words are lower-case runs of letters (and any byte of other scripts) with
    one space before and after; an n-gram does not span more than that.
    """
    raw = [b" " + t.lower().encode() + b" " for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    table = np.full(256, 32, np.uint8)
    table[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
    table[0x80:] = np.arange(0x80, 0x100)
    data = table[data]
    owner = np.repeat(np.arange(len(raw), dtype=np.int32), [len(r) for r in raw])
    keep = np.ones(len(data), bool)
    keep[1:] = (data[1:] != 32) | (data[:-1] != 32) | (owner[1:] != owner[:-1])
    data, owner = data[keep].astype(np.uint32), owner[keep]
    n = max(0, len(data) - 3)
    keys = data[:n] | data[1 : n + 1] << np.uint32(8) | data[2 : n + 2] << np.uint32(16) | data[3 : n + 3] << np.uint32(24)
    inside = (owner[:n] == owner[3:]) if n else np.zeros(0, bool)
    # the middle of an n-gram is letters: a space only at either end
    inside &= (data[1 : n + 1] != 32) & (data[2 : n + 2] != 32)
    return keys[inside], owner[:n][inside]


@dataclass(frozen=True)
class LanguageFilters:
    """``cells``: a language bitmask per cell, cells x words; ``chance``: per
    language, how often an n-gram it does not hold seems held."""

    languages: tuple[str, ...]
    cells: np.ndarray
    hashes: int
    chance: np.ndarray

    def masks(self, keys: np.ndarray) -> np.ndarray:
        """The languages of each n-gram as a bitmask, n-grams x words."""
        out = None
        for h in range(self.hashes):
            got = self.cells[_cell(keys, h, len(self.cells))]
            out = got if out is None else out & got
        return out

    def held(self, masks: np.ndarray, k: int) -> np.ndarray:
        """Whether language ``k`` is in each mask, as 0 or 1."""
        return (masks[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)

    def decide(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """The likeliest language of each text and its share of all corrected
        counts; ``und`` and 0 where a text has no letter. Equal counts go to the
        language first by name."""
        keys, owner = gram_keys(texts)
        masks = self.masks(keys)
        total = np.bincount(owner, minlength=len(texts)).astype(float)
        counts = np.stack([np.bincount(owner, self.held(masks, k), len(texts)) for k in range(len(self.languages))], 1)
        fair = np.maximum(0, (counts - total[:, None] * self.chance) / (1 - self.chance))
        best = fair.argmax(1)
        share = (fair[np.arange(len(texts)), best] + 0.5) / (fair.sum(1) + 0.5 * len(self.languages))
        has = [bool(LETTER.search(t)) for t in texts]
        return [self.languages[b] if ok else "und" for b, ok in zip(best.tolist(), has)], [s if ok else 0.0 for s, ok in zip(share.tolist(), has)]


def _cell(keys: np.ndarray, h: int, n: int) -> np.ndarray:
    return (mixed(keys.astype(np.uint64) + np.uint64((h + 1) << 32)) % np.uint64(n)).astype(np.int64)


def count_grams(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, key, n) over all rows with a language: a task adds up what it has
    read before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list] = {}

        def folded(lang: str) -> pa.RecordBatch:
            keys, n = (np.concatenate(x) for x in zip(*seen.pop(lang)))
            keys, at = np.unique(keys, return_inverse=True)
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.astype(np.int64)), pa.array(np.bincount(at, n).astype(np.int64))], names=["lang", "key", "n"])

        for part in byte_chunks(batches, 1):
            langs = part.column(0).to_pylist()
            texts = [t.decode() for t in texts_of(part.column(1))]
            for lang in set(langs):
                keys, n = np.unique(gram_keys([t for t, x in zip(texts, langs) if x == lang])[0], return_counts=True)
                kept = seen.setdefault(lang, [])
                kept.append((keys, n))
                if sum(len(k) for k, _ in kept) > 2_000_000:
                    yield folded(lang)
        for lang in list(seen):
            yield folded(lang)

    rows = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))


def train(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", share: float = 0.2, cells: int = 1 << 18, hashes: int = 3, most_bytes: int = 1 << 26
) -> LanguageFilters:
    """Filters from all labelled rows. An n-gram belongs to every language whose
    rate of it is at least ``share`` of the highest. There are ``cells`` cells, or
    the next power of two over 8 for each n-gram of the largest filter; their bits
    are set by a distributed bit_or, so the driver gathers cells, not n-grams.

    The table goes to every task, so it has at most ``most_bytes`` (64 MB: one
    million n-grams in the largest of up to 64 languages). Beyond that cells are
    shared by more n-grams: all n-grams stay in, more are held by chance, and the
    correction, which is made from the cells' fill, takes that off again. Rates
    near 1 would leave nothing to correct and are an error.
    """
    scratch = Scratch(docs.sparkSession, "langid")
    counts = scratch.write(count_grams(docs, text_col, lang_col), "grams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    rates = counts.join(F.broadcast(totals), "lang").withColumn("rate", F.col("n") / F.col("total"))  # a row per language
    top = rates.groupBy("key").agg(F.max("rate").alias("top"))
    held = scratch.write(rates.join(top, "key").where(F.col("rate") >= share * F.col("top")).select("lang", "key"), "held")
    sizes = {r["lang"]: r["count"] for r in held.groupBy("lang").count().collect()}
    languages = tuple(sorted(sizes)) or ("und",)
    words = -(-len(languages) // 64)
    cells = max(cells, 1 << (8 * max(sizes.values(), default=1) - 1).bit_length())
    while cells > 1 << 10 and cells * words * 8 > most_bytes:
        cells //= 2
    places = {lang: (k // 64, int(np.uint64(1 << k % 64).astype(np.int64))) for k, lang in enumerate(languages)}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(1).to_numpy().astype(np.uint32)
            word, bit = (np.array(x, np.int64) for x in zip(*(places[x] for x in batch.column(0).to_pylist()))) if len(keys) else (np.zeros(0, np.int64),) * 2
            at = np.concatenate([_cell(keys, h, cells) * words for h in range(hashes)])
            yield pa.RecordBatch.from_arrays([pa.array(at + np.tile(word, hashes)), pa.array(np.tile(bit, hashes))], names=["cell", "bit"])

    got = held.mapInArrow(place, "cell long, bit long").groupBy("cell").agg(F.expr("bit_or(bit)").alias("mask")).toPandas()
    table = np.zeros(cells * words, np.uint64)
    table[got["cell"].to_numpy(np.int64)] = got["mask"].to_numpy(np.int64).view(np.uint64)
    filters = LanguageFilters(languages, table.reshape(cells, words), hashes, np.zeros(len(languages)))
    chance = np.array([filters.held(filters.cells, k).mean() for k in range(len(languages))]) ** hashes
    if chance.max() > 0.9:
        raise ValueError(f"the filters are full: give them more than {most_bytes} bytes")
    return LanguageFilters(languages, filters.cells, hashes, chance)


def identify(docs: DataFrame, filters: LanguageFilters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) for every row, by its whole text.

    Null, empty and letterless texts give ``und`` and 0. Repeated rows come back
    as often, null ids too; other columns are ignored; an empty table gives an
    empty result. No training row: every text is ``und``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_chunks(batches, 1):
            langs, scores = filters.decide([t.decode() for t in texts_of(part.column(1))])
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["id", "lang_pred", "score"])

    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, lang_pred string, score double")
    return rows.withColumnRenamed("id", id_col)
