"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

Text is cut where no piece of the model spans the cut, each distinct segment is
encoded once, and all new segments of a batch are merged together: flat numpy
symbol arrays, the smallest pair rank of every segment, its leftmost
non-overlapping occurrences merged at once, and compaction, until no segment
has a mergeable pair.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import byte_chunks, texts_of

SPACE = "▁"
NO_PAIR = np.iinfo(np.int32).max
CACHED_SEGMENTS = 300_000


@dataclass(frozen=True)
class Vocabulary:
    """What a model file says: pieces, their scores and their kinds
    ('piece', 'byte', 'control' or 'unknown'), and the end id."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[str, ...]
    end: int


def load_vocabulary(path: str) -> Vocabulary:
    """Read a BPE model with byte fallback, a leading space mark and no other
    normalisation; read on the driver, so executors need no copy of the file."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(m.get_piece_size())

    def kind(i: int) -> str:
        return "byte" if m.is_byte(i) else "control" if m.is_control(i) else "unknown" if m.is_unknown(i) else "piece"

    return Vocabulary(
        tuple(m.id_to_piece(i) for i in ids), tuple(m.get_score(i) for i in ids), tuple(kind(i) for i in ids), m.eos_id()
    )


class Codec:
    """Encoder and decoder of one task; keeps the segments it has seen."""

    def __init__(self, vocabulary: Vocabulary):
        v = vocabulary
        self.size, self.end = len(v.pieces), v.end
        ids = {p: i for i, p in enumerate(v.pieces) if v.kinds[i] == "piece"}
        byte_ids = {int(v.pieces[i][3:5], 16): i for i in range(self.size) if v.kinds[i] == "byte"}
        self.byte_ids = [byte_ids[b] for b in range(256)]
        ranks = {s: r for r, s in enumerate(sorted({v.scores[i] for i in ids.values()}, reverse=True))}
        self.rank = np.full(self.size, NO_PAIR, np.int32)
        self.rank[list(ids.values())] = [ranks[v.scores[i]] for i in ids.values()]

        pairs, alone = {}, np.zeros(self.size, bool)
        for p, i in ids.items():
            for k in range(1, len(p)):
                a, b = ids.get(p[:k]), ids.get(p[k:])
                if a is not None and b is not None:
                    pairs[a * self.size + b] = i
                # A part ranked no better than the whole: merging it may bring up a pair that goes first.
                for part in (a, b):
                    if part is not None and self.rank[part] >= self.rank[i]:
                        alone[part] = True
        keys = np.array(sorted(pairs), np.int64)
        self.pair_keys, self.pair_ids = keys, np.array([pairs[k] for k in keys.tolist()], np.int32)
        self.alone = alone

        joined = [p for p in ids if len(p) > 1]
        crosses = any(a != SPACE and b == SPACE for p in joined for a, b in zip(p, p[1:]))
        inner = "".join(sorted({c for p in joined for c in p} - {SPACE}))
        self.segments = None if crosses else re.compile(f"{SPACE}*[{re.escape(inner)}]+|{SPACE}+|[^{SPACE}{re.escape(inner)}]")

        self.char_ids = np.full(0x110000, -1, np.int32)
        for p, i in ids.items():
            if len(p) == 1:
                self.char_ids[ord(p)] = i

        self.numbers = list(range(self.size))
        self.id_text = [str(i) for i in self.numbers]
        self.is_byte = np.array([k == "byte" for k in v.kinds])
        self.kinds, self.controls = v.kinds, {i for i, k in enumerate(v.kinds) if k == "control"}
        self.surface = [
            bytes([int(p[3:5], 16)]) if k == "byte" else b"" if k == "control" else " ⁇ ".encode() if k == "unknown"
            else p.replace(SPACE, " ").encode()
            for p, k in zip(v.pieces, v.kinds)
        ]
        self.known: dict[str, tuple[int, ...]] = {}

    # -- encoding

    def encode(self, texts: Iterable[str]) -> list[list[int]]:
        """The ids of each text, with the end id."""
        cut = [self._cut(t) for t in texts]
        if len(self.known) > CACHED_SEGMENTS:
            self.known.clear()
        new = list(set(chain.from_iterable(cut)).difference(self.known))
        for at in range(0, len(new), 50_000):
            part = new[at : at + 50_000]
            self.known.update(zip(part, self._merge(part)))
        get = self.known.__getitem__
        return [[*chain.from_iterable(map(get, s)), self.end] for s in cut]

    def _cut(self, text: str) -> list[str]:
        if not text:
            return []
        marked = SPACE + text.replace(" ", SPACE)
        return self.segments.findall(marked) if self.segments else [marked]

    def _symbols(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Start symbols and their segment: a character's piece, or the pieces of its bytes."""
        points = np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)
        owner = np.repeat(np.arange(len(segments), dtype=np.int32), np.fromiter(map(len, segments), np.int64, len(segments)))
        symbols = self.char_ids[points]
        missing = np.flatnonzero(symbols < 0)
        if not len(missing):
            return symbols, owner
        spelled = [[self.byte_ids[b] for b in chr(points[i]).encode()] for i in missing]
        times = np.ones(len(points), np.int64)
        times[missing] = [len(s) for s in spelled]
        first = np.cumsum(times) - times
        out = np.repeat(symbols, times)
        for i, s in zip(first[missing].tolist(), spelled):
            out[i : i + len(s)] = s
        return out, np.repeat(owner, times)

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair merges to, or -1."""
        keys = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ids[at], -1).astype(np.int32)

    def _merge(self, segments: list[str]) -> list[tuple[int, ...]]:
        symbols, owner = self._symbols(segments)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        n = len(symbols)
        to = np.full(n, -1, np.int32)  # to[i]: what symbols i and i + 1 merge to
        same = np.flatnonzero(owner[:-1] == owner[1:])
        to[same] = self._lookup(symbols[same], symbols[same + 1])
        while len(symbols):
            rank = np.where(to >= 0, self.rank[to], NO_PAIR)
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            best = np.minimum.reduceat(rank, starts)
            lengths = np.diff(np.r_[starts, len(symbols)])
            live = np.repeat(best < NO_PAIR, lengths)
            if not live.all():  # segments without a pair are finished
                done.append((owner[~live], symbols[~live]))
                symbols, owner, to, rank = symbols[live], owner[live], to[live], rank[live]
                lengths, best = lengths[best < NO_PAIR], best[best < NO_PAIR]
                if not len(symbols):
                    break
                starts = np.cumsum(lengths) - lengths
            chosen = np.flatnonzero(rank == np.repeat(best, lengths))
            # of occurrences that overlap, every other one from the left
            heads = np.r_[True, chosen[1:] != chosen[:-1] + 1]
            run = np.maximum.accumulate(np.where(heads, chosen, 0))
            keep = (chosen - run) % 2 == 0
            first = np.r_[True, owner[chosen[1:]] != owner[chosen[:-1]]]
            chosen = chosen[keep & (first | ~np.repeat(self._careful(to, chosen, first), np.diff(np.r_[np.flatnonzero(first), len(chosen)])))]
            symbols[chosen] = to[chosen]
            kept = np.ones(len(symbols), bool)
            kept[chosen + 1] = False
            moved = np.cumsum(kept)[chosen] - 1
            symbols, owner, to = symbols[kept], owner[kept], to[kept]
            # only pairs beside a merge have changed
            at = np.unique(np.r_[moved, moved - 1])
            at = at[at >= 0]
            inside = (at + 1 < len(symbols)) & (owner[np.minimum(at + 1, len(symbols) - 1)] == owner[at])
            to[at] = -1
            at = at[inside]
            to[at] = self._lookup(symbols[at], symbols[at + 1])
        owners = np.concatenate([o for o, _ in done])
        ids = np.concatenate([s for _, s in done])
        order = np.argsort(owners, kind="stable")
        # the same number objects for all segments: they outnumber everything else kept
        ids, ends = [*map(self.numbers.__getitem__, ids[order].tolist())], np.cumsum(np.bincount(owners, minlength=len(segments))).tolist()
        return [tuple(ids[a:b]) for a, b in zip([0, *ends[:-1]], ends)]

    def _careful(self, to: np.ndarray, chosen: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Per segment with chosen pairs: whether any of them must be merged one at a time."""
        return np.logical_or.reduceat(self.alone[to[chosen]], np.flatnonzero(first))

    # -- decoding

    def decode(self, ids: list[int]) -> str:
        """The text of ids, as the library's decode(ids) gives it."""
        if not self.controls.isdisjoint(ids[:-1]):  # one inside ends a run of bytes
            return self._decode_slowly(ids)
        raw = b"".join(map(self.surface.__getitem__, ids))
        shown = next((i for i in ids if self.kinds[i] != "control"), None)
        # the mark before the text is not part of it
        cut = shown is not None and self.kinds[shown] == "piece" and self.surface[shown][:1] == b" "
        try:
            return raw[cut:].decode()
        except UnicodeDecodeError:
            return self._decode_slowly(ids)

    def _decode_slowly(self, ids: list[int]) -> str:
        """Run by run; byte pieces that spell no character: one replacement mark each."""
        shown = next((i for i in ids if self.kinds[i] != "control"), None)
        cut = shown is not None and self.kinds[shown] == "piece" and self.surface[shown][:1] == b" "
        out, spelled = [], b""
        for i in [*ids, self.end]:
            if self.kinds[i] == "byte":
                spelled += self.surface[i]
                continue
            while spelled:
                for n in (1, 2, 3, 4):
                    try:
                        out.append(spelled[:n].decode())
                        spelled = spelled[n:]
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    spelled = spelled[1:]
            out.append(self.surface[i].decode())
        return "".join(out)[cut:]


def encode_table(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): the ids of every row's whole text, the end id last.

    Null and empty texts give the end id alone; rows come back as often as they
    are repeated, null ids too; other columns are ignored; an empty table gives
    an empty result.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(vocabulary)
        for part in byte_chunks(batches, 1, 2 << 20):
            ids = codec.encode([t.decode() for t in texts_of(part.column(1))])
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], names=[id_col, "ids"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, F.col(text_col).alias("text")).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def round_trip(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) and, if asked for, ids: every
    whole text encoded and its ids decoded again. Both are digested in the task
    that made them, so texts and ids need not travel to be compared. Cases as
    in ``encode_table``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(vocabulary)
        sha, text_of = hashlib.sha256, codec.id_text.__getitem__
        for part in byte_chunks(batches, 1, 2 << 20):
            ids = codec.encode([t.decode() for t in texts_of(part.column(1))])
            out = {
                id_col: part.column(0),
                "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
                "ids_sha256": pa.array([sha(" ".join(map(text_of, x)).encode()).hexdigest() for x in ids]),
                "decoded_sha256": pa.array([sha(codec.decode(x).encode()).hexdigest() for x in ids]),
            }
            if with_ids:
                out["ids"] = pa.array(ids, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    kind = dict(docs.dtypes)[id_col]
    schema = f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return docs.select(id_col, F.col(text_col).alias("text")).mapInArrow(run, schema)
