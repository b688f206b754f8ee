"""Alignment of two tokenizers over the same text by interval coalescing.

Each text is encoded by a byte-level tokenizer (A, of space+text) and by a
SentencePiece model (B, which adds the space). Every token covers a byte range.
The ranges of a pack of texts, A's and B's, are sorted together by start
(lexsort); the running maximum of their ends (``maximum.accumulate``) tells
where a start reaches all that came before: there both tokenizers end a token,
and a group is cut. Within the groups each distinct start is one overlapping
pair of an A and a B token, a link.

How often a pair of ids is linked in the whole corpus is counted by Spark: each
pack sends its distinct pairs with their counts, these are added up per pair,
and a pair's total goes back to the packs that hold it, which read their links
again as small numbers. What is shuffled is distinct pairs per pack, not links;
a pair that is everywhere is one row per pack. Nothing is collected or
broadcast but the highest count per B id, one row per piece of B's vocabulary.

Both libraries encode whole texts; A's vocabulary runs on the faster of two
libraries where they are known to agree (:class:`ByteLevel`).

Cases: texts that are null or empty, and texts whose tokens do not spell
space+text, have no tokens: zeros and an empty ``groups``. Repeated rows and ids
are rows of their own. A text of any length is one unit of work: a task holds
some hundred bytes per byte of its longest text. An empty table gives no rows.
Further columns are not read, whatever their names.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import Scratch, byte_chunks

#: Bytes of text aligned at once, and per pack.
CHUNK_BYTES, PACK_BYTES = 1 << 19, 8 << 20
# The pattern of the byte-level vocabulary, and the characters whose
# classes in it are old enough to be the same in every library.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_UNSETTLED = re.compile("[^\\x00-\u052f\u2010-\u205e\u20a0-\u20bf]")
#: Longest run of white space, or of other characters, that the faster library gets.
LONGEST_RUN = 400

PAIRS = T.ArrayType(T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()), T.StructField("n", T.LongType())]))


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: the
    printable Latin-1 characters for themselves, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class ByteLevel:
    """Ids of texts under a byte-level vocabulary file of ``tokenizers``.

    ``tiktoken`` encodes the same vocabulary some four times faster if the merges
    are numbered in their order; it gets the texts whose characters have had
    their classes for long and that have no very long runs, ``tokenizers`` the
    others. Special tokens' strings are plain text in both.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        byte = byte_alphabet()
        with open(path) as f:
            told = json.load(f)
        special = {t["id"] for t in told["added_tokens"]}
        self.spelled = [b""] * (max(told["model"]["vocab"].values()) + 1)
        for token, i in told["model"]["vocab"].items():
            if i not in special:
                self.spelled[i] = bytes(byte[c] for c in token)
        self.sizes = np.array([len(s) for s in self.spelled], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in told["model"]["merges"]]
        in_order = all(told["model"]["vocab"].get(x + y) == 256 + i for i, (x, y) in enumerate(merges))
        split = told["pre_tokenizer"] or {}
        usual = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space") and not told["normalizer"]
        ranks = {s: i for i, s in enumerate(self.spelled) if s}
        self.fast = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}) if in_order and usual else None

    def is_settled(self, text: str) -> bool:
        return (
            self.fast is not None and not _UNSETTLED.search(text)
            and max(map(len, text.split()), default=0) <= LONGEST_RUN and not _LONG_SPACE.search(text)
        )

    def ids(self, texts: Sequence[str]) -> list[list[int]]:
        out = [self.fast.encode_ordinary(t) if self.is_settled(t) else None for t in texts]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, found in zip(rest, self.tokenizer.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False)):
            out[i] = found.ids
        return out


_LONG_SPACE = re.compile(r"\s{%d}" % LONGEST_RUN)


class SentencePieces:
    """Ids of texts under a SentencePiece model, which adds the space before a text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.spelled = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in ((i, self.model.id_to_piece(i)) for i in range(self.model.get_piece_size()))
        ]
        self.sizes = np.array([len(s) for s in self.spelled], np.int64)

    def ids(self, texts: Sequence[str]) -> list[list[int]]:
        return self.model.encode(list(texts), num_threads=1)


def spells(tokens: ByteLevel | SentencePieces, ids: Sequence[int], text: bytes) -> bool:
    """Whether the tokens' bytes are the text's."""
    return b"".join(map(tokens.spelled.__getitem__, ids)) == text


def coalesce(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For two rows of token sizes that cover the same bytes: the group of each
    A token, of each B token, and the links as places in A and in B."""
    a_ends, b_ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
    starts = np.concatenate([a_ends - a_sizes, b_ends - b_sizes])
    is_b = np.zeros(len(starts), np.int8)
    is_b[len(a_sizes) :] = 1
    order = np.lexsort((is_b, starts))  # two sorted runs: the stable sort merges them
    starts, is_b = starts[order], is_b[order]
    reached = np.maximum.accumulate(np.concatenate([a_ends, b_ends])[order])
    first = np.ones(len(starts), bool)
    first[1:] = starts[1:] >= reached[:-1]
    group = np.cumsum(first) - 1
    last_here = np.ones(len(starts), bool)
    last_here[:-1] = starts[1:] != starts[:-1]
    b_at = np.cumsum(is_b)
    a_at = np.arange(1, len(starts) + 1) - b_at
    return group[is_b == 0], group[is_b == 1], a_at[last_here] - 1, b_at[last_here] - 1


class GroupText:
    """Groups as text: ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, largest: int):
        self.digits = [f"{i}{mark}" for i in range(largest + 1) for mark in ",|;"]
        self.sizes = np.array([len(x) for x in self.digits[::3]], np.int64)

    def of(self, a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray, cuts: np.ndarray) -> list[str]:
        """One text per run of groups; ``cuts`` holds the first group of each run and their number."""
        n = int(cuts[-1])
        n_a, n_b = np.bincount(a_group, minlength=n), np.bincount(b_group, minlength=n)
        a_before, b_before = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        marked = np.empty(len(a) + len(b), np.int64)
        a_place = np.arange(len(a)) + b_before[a_group]
        b_place = np.arange(len(b)) + (a_before + n_a)[b_group]
        marked[a_place], marked[b_place] = a.astype(np.int64) * 3, b.astype(np.int64) * 3
        ends = np.cumsum(n_a + n_b)
        marked[ends - 1] += 2
        marked[ends - n_b - 1] += 1
        text = "".join(map(self.digits.__getitem__, marked.tolist()))
        at = np.concatenate([[0], np.cumsum(self.sizes[marked // 3])])
        token_cuts = np.concatenate([[0], ends])[cuts]
        return [text[at[i] : at[j] - 1] for i, j in zip(token_cuts[:-1], token_cuts[1:])]


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of the given sizes; an empty run is 0."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


class _Pack:
    """The distinct pairs of a pack of texts, numbered as they come, and their counts."""

    def __init__(self, number: int):
        self.number, self.bytes = number, 0
        self.sorted, self.places = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pairs, self.counts = [], np.zeros(0, np.int64)

    def numbers(self, links: np.ndarray) -> np.ndarray:
        """The number of each link's pair; all are counted."""
        pairs, at, counts = np.unique(links, return_inverse=True, return_counts=True)
        new = np.setdiff1d(pairs, self.sorted, assume_unique=True)
        if len(new):
            self.pairs.append(new)
            numbers = np.arange(len(self.counts), len(self.counts) + len(new))
            where = np.searchsorted(self.sorted, new)
            self.sorted, self.places = np.insert(self.sorted, where, new), np.insert(self.places, where, numbers)
            self.counts = np.concatenate([self.counts, np.zeros(len(new), np.int64)])
        places = self.places[np.searchsorted(self.sorted, pairs)]
        self.counts[places] += counts
        return places.astype("<i4")[at]


def _align(path_a: str, path_b: str, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_tokens, b_tokens = ByteLevel(path_a), SentencePieces(path_b)
        writer = GroupText(max(len(a_tokens.sizes), len(b_tokens.sizes)))
        n_b_ids = len(b_tokens.sizes)
        pair_type = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())])
        none = np.zeros(0, np.int32)
        pack = _Pack(TaskContext.get().partitionId() << 32)

        def chunk(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            n = len(texts)
            both = list(zip(a_tokens.ids([" " + t for t in texts]), b_tokens.ids(texts)))
            for i, (text, (x, y)) in enumerate(zip(texts, both)):
                spaced = (" " + text).encode()
                told = text and spells(a_tokens, x, spaced) and spells(b_tokens, y, spaced)
                both[i] = (np.array(x, np.int32), np.array(y, np.int32)) if told else (none, none)
            n_a, n_b = (np.fromiter((len(e[i]) for e in both), np.int64, n) for i in (0, 1))
            a, b = (np.concatenate([none, *(e[i] for e in both)]) for i in (0, 1))
            a_group, b_group, a_link, b_link = coalesce(a_tokens.sizes[a], b_tokens.sizes[b])
            n_groups = _sums(np.diff(a_group, prepend=-1), n_a)
            n_links = n_a + n_b - n_groups  # a group of x A and y B tokens has x + y - 1 overlaps
            filled = np.flatnonzero(n_groups)
            groups = np.full(n, "", object)
            if len(filled):
                cuts = np.concatenate([[0], np.cumsum(n_groups)])
                groups[filled] = writer.of(a, b, a_group, b_group, np.append(cuts[filled], cuts[-1]))
            links = pack.numbers(a[a_link].astype(np.int64) * n_b_ids + b[b_link])
            cuts = np.concatenate([[0], np.cumsum(n_links)])
            pack.bytes += sum(map(len, texts))
            return pa.record_batch({
                "pack": pa.array([pack.number] * n, pa.int64()), "id": batch.column(0),
                "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links,
                "groups": pa.array(groups, pa.string()),
                "links": pa.array([links[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:])], pa.binary()),
                "pairs": pa.nulls(n, pa.list_(pair_type)),
            })

        def pairs() -> pa.RecordBatch:
            ids = np.concatenate([np.zeros(0, np.int64), *pack.pairs])
            each = [pa.array(ids // n_b_ids, pa.int32()), pa.array(ids % n_b_ids, pa.int32()), pa.array(pack.counts, pa.int64())]
            zero = pa.array([0], pa.int64())
            return pa.record_batch({
                "pack": pa.array([pack.number], pa.int64()), "id": pa.nulls(1, id_type), "n_a": zero, "n_b": zero, "n_groups": zero, "n_links": zero,
                "groups": pa.array([""]), "links": pa.array([b""], pa.binary()),
                "pairs": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.StructArray.from_arrays(each, ["a", "b", "n"])),
            })

        for batch in byte_chunks(batches, 1, CHUNK_BYTES):
            yield chunk(batch)
            if pack.bytes >= PACK_BYTES:
                yield pairs()
                pack = _Pack(pack.number + 1)
        yield pairs()

    return run


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The alignment of every row: ``id, n_a, n_b, n_groups, n_links, groups`` (as
    ``a1,a2|b1;a3|b2,b3``) and ``links``, each link as a little-endian 32-bit
    place in the distinct pairs of its ``pack``. A pack has one more row, with
    ``pairs`` (ids and count) and no id. For :func:`with_pair_counts`."""
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = docs.schema[id_col].dataType
    out = T.StructType(
        [T.StructField("pack", T.LongType()), T.StructField("id", id_type)]
        + [T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")]
        + [T.StructField("groups", T.StringType()), T.StructField("links", T.BinaryType()), T.StructField("pairs", PAIRS)]
    )
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_align(path_a, path_b, to_arrow_type(id_type)), out)


def pair_counts(pairs: DataFrame) -> DataFrame:
    """Per linked id pair: its links in the whole corpus (``links``) and whether
    no A id is linked to its B id more often (``best``)."""
    counts = pairs.groupBy("a", "b").agg(F.sum("n").alias("links"))
    most = counts.groupBy(F.col("b").alias("_b")).agg(F.max("links").alias("_most"))  # at most B's vocabulary
    joined = counts.join(F.broadcast(most), F.col("b") == F.col("_b"))
    return joined.select("a", "b", "links", (F.col("links") == F.col("_most")).alias("best"))


def _judge(kept: Sequence[str], schema: pa.Schema):
    def run(rows: pa.Table, pairs: pa.Table) -> pa.Table:
        order = np.argsort(pairs["place"].to_numpy())
        total = pairs["total"].to_numpy()[order]
        best = pairs["best"].to_numpy(zero_copy_only=False)[order].astype(np.int64)
        each = [np.frombuffer(x, "<i4") for x in rows["links"].to_pylist()]
        sizes = np.fromiter(map(len, each), np.int64, len(each))
        links = np.concatenate([np.zeros(0, np.int32), *each])
        return pa.Table.from_arrays(
            [*[rows[c] for c in kept], pa.array(_sums(best[links], sizes)), pa.array(_sums(total[links], sizes))], schema=schema)

    return run


def with_pair_counts(aligned: DataFrame) -> DataFrame:
    """What :func:`align` found, and per row ``n_best``, its links whose pair is the
    most frequent of its B id, and ``count_sum``, its links' corpus counts added
    up. Columns may have been added to or dropped from ``aligned``, other than
    ``pack``, ``links`` and ``pairs``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    scratch = Scratch(aligned.sparkSession, "alignment")
    written = scratch.write(aligned, "aligned")
    of_pack = written.where("pairs IS NOT NULL").select("pack", F.posexplode("pairs").alias("place", "pair"))
    of_pack = of_pack.select("pack", "place", "pair.a", "pair.b", "pair.n")
    counts = scratch.write(pair_counts(of_pack), "counts")
    back = of_pack.join(counts, ["a", "b"]).select(F.col("pack").alias("of"), "place", F.col("links").alias("total"), "best")
    kept = [c for c in written.columns if c not in ("pack", "links", "pairs")]
    out = T.StructType([*[written.schema[c] for c in kept], T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
    rows = written.where("pairs IS NULL").select("pack", "links", *kept)
    return rows.groupBy("pack").cogroup(back.groupBy("of")).applyInArrow(_judge(kept, to_arrow_schema(out)), out)
