"""Log-bilinear language model trained with noise-contrastive estimation.

Every word has a class: a frequent word one of its own, any other that of its
ending, the end of a text and the word never seen one each. A token's class is
predicted from the classes of the two tokens before it: the score is bilinear in
context and target vectors. Tables of both context positions against all targets
are products of two matrices, and so are all normalisers, so a class's exact
log-probability is three look-ups. A word's probability within its class is its
corpus-wide add-half share of it, so the whole distribution sums to 1.

Word counts cover all training rows and are a table; the numbers of classes grow
with the square root of the counted words, up to what the tables may hold. The
vectors are trained on all training rows too. Rows are dealt into shards by a
hash of their id and text, as many as the counted tokens ask for, and put in an order;
each shard learns its rows of a round, the shards' vectors are averaged by their
tokens, and the next round goes on from there. Neither shards nor order depend
on files, partitions or the number of machines, so neither does the model.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, byte_chunks

END = b"\n"  # no word: words hold no white space
UNSEEN, END_CLASS = 0, 1
ENDING = 3  # bytes of a word's ending
# Classes at most: the tables hold 4 * 3 * (their sum) ** 2 bytes, 28 MB.
MOST_OWN, MOST_ENDINGS = 1022, 512
TOKENS_PER_SHARD = 2_000_000
ROUNDS = 4


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts one after another, A-Z in lower case, and how many
    each text has; a null text has none."""
    split = pa.compute.ascii_split_whitespace(pa.compute.ascii_lower(pa.compute.fill_null(texts, "")))
    pieces = split.flatten()
    # white space at either end of a text leaves an empty piece
    real = pa.compute.not_equal(pa.compute.binary_length(pieces), 0)
    up_to = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    ends = np.cumsum(split.value_lengths().to_numpy(zero_copy_only=False))
    return pieces.filter(real).cast(pa.binary()), np.diff(up_to[np.concatenate([[0], ends])])


def count_words(docs: DataFrame, text_col: str, flush: int = 400_000, most_bytes: int = 64 << 20) -> DataFrame:
    """(word, n) over all rows, the end of each included; tasks add up first. A
    task adds up when it holds twice ``flush`` rows or ``most_bytes``, and passes
    on what is then more than ``flush`` or half of ``most_bytes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ends = [], 0

        def added() -> pa.Table:
            told = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")])
            return told.select(["word", "n_sum"]).rename_columns(["word", "n"])

        for part in byte_chunks(batches, 0):
            found = words_of(part.column(0))[0].value_counts()
            held.append(pa.table({"word": found.field("values"), "n": found.field("counts")}))
            ends += part.num_rows
            if sum(x.num_rows for x in held) > 2 * flush or sum(x.nbytes for x in held) > most_bytes:
                held = [added()]
                if held[0].num_rows > flush or held[0].nbytes > most_bytes // 2:
                    yield from held.pop().to_batches()
        if ends:
            held.append(pa.table({"word": pa.array([END], pa.binary()), "n": pa.array([ends], pa.int64())}))
            yield from added().to_batches()

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "word binary, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def ending_key(word: bytes, endings: int) -> int:
    """Which of ``endings`` numbers a word's last bytes lead to."""
    return zlib.crc32(word[-ENDING:]) % endings


@dataclass
class Lexicon:
    """Frequent words and their counts, most frequent first (the end is among
    them); the first ``own`` of them have classes of their own, after UNSEEN and
    END; then come the classes of the endings that occur. ``ending_class`` holds
    the class of each ending number, UNSEEN where no counted word has it."""

    index: dict[bytes, int]
    counts: np.ndarray
    own: int
    ending_class: np.ndarray
    ending_mass: np.ndarray  # add-half mass of the ending classes, in the order of their classes
    tokens: int  # N
    words: int  # V

    @property
    def mass(self) -> float:
        return self.tokens + 0.5 * (self.words + 1)

    def ending(self, word: bytes) -> int:
        return int(self.ending_class[ending_key(word, len(self.ending_class))])

    def ending_classes(self, words: pa.Array) -> np.ndarray:
        """The class of each word's ending; looked up once per ending."""
        endings = pa.compute.binary_slice(words, -ENDING).dictionary_encode()
        of = np.array([self.ending(x) for x in endings.dictionary.to_pylist()], np.int64)
        return of[endings.indices.to_numpy(zero_copy_only=False)]

    def class_of(self) -> np.ndarray:
        """The class of each word of the index."""
        out = self.ending_classes(pa.array(list(self.index), pa.binary()))
        if END in self.index:
            out[self.index[END]] = END_CLASS
        own = [i for w, i in self.index.items() if w != END][: self.own]
        out[own] = np.arange(len(own)) + 2
        return out

    def class_mass(self) -> np.ndarray:
        """Add-half mass of each class; a word never seen has one half."""
        own = [i for w, i in self.index.items() if w != END][: self.own]
        end = self.counts[self.index[END]] if END in self.index else 0
        return np.concatenate([[0.5, end + 0.5], self.counts[own] + 0.5, self.ending_mass]).astype(float)


def lexicon(counts: DataFrame, known: int = 200_000, most_own: int = MOST_OWN, most_endings: int = MOST_ENDINGS, longest: int = 64) -> Lexicon:
    """What is broadcast: about ``known`` words at most, none over ``longest``
    bytes, and the classes. The count that splits the words off comes from a
    histogram over eighths of powers of two, so nothing is sorted as a whole.
    Twice the square root of the counted words, at most ``most_own``, is the
    number of words with classes of their own, and once that, at most
    ``most_endings``, the number of endings' classes."""
    step = F.floor(F.log2("n") * 8).cast("int")
    total = counts.agg(F.sum("n"), F.count("*")).first()
    tokens, words = total[0] or 0, total[1]
    some = counts.where((F.octet_length("word") <= longest))
    steps = sorted(((r[0], r[1]) for r in some.groupBy(step).count().collect()), reverse=True)
    least, kept = None, 0
    for s, n in steps:
        if kept + n > known:
            break
        least, kept = s, kept + n
    rows = some.where((step >= (least if least is not None else 1 << 30)) | (F.col("word") == F.lit(END))).collect()
    rows = sorted(rows, key=lambda r: (-r["n"], bytes(r["word"])))
    index = {bytes(r["word"]): i for i, r in enumerate(rows)}
    listed = np.array([r["n"] for r in rows], np.int64)
    own = min(most_own, 2 * math.isqrt(words), len(index.keys() - {END}))
    endings = max(1, min(most_endings, math.isqrt(words)))

    size = F.octet_length("word")
    ending = F.crc32(F.when(size <= ENDING, F.col("word")).otherwise(F.substring("word", size - (ENDING - 1), F.lit(ENDING)))) % endings
    mass = np.zeros(endings)
    for r in counts.where(F.col("word") != F.lit(END)).groupBy(ending.alias("e")).agg(F.sum(F.col("n") + 0.5).alias("m")).collect():
        mass[r["e"]] = r["m"]
    for w in [w for w in index if w != END][:own]:
        mass[ending_key(w, endings)] -= listed[index[w]] + 0.5
    used = np.flatnonzero(mass > 0.25)  # every word adds 1.5 or more
    classes = np.full(endings, UNSEEN, np.int64)
    classes[used] = np.arange(len(used)) + 2 + own
    return Lexicon(index, listed, own, classes, mass[used], tokens, words)


@dataclass
class Vectors:
    """Context vectors of the last class and the one before it, target vectors, biases."""

    last: np.ndarray
    earlier: np.ndarray
    target: np.ndarray
    bias: np.ndarray

    @staticmethod
    def start(mass: np.ndarray, width: int, seed: int = 7) -> Vectors:
        """Small random vectors; biases make the model the unigram model."""
        rng, n = np.random.default_rng(seed), len(mass)
        draw = lambda: (rng.standard_normal((n, width)) * 0.1).astype(np.float32)
        return Vectors(draw(), draw(), draw(), np.log(mass / mass.sum()).astype(np.float32))

    def flat(self) -> np.ndarray:
        return np.concatenate([x.reshape(-1) for x in (self.last, self.earlier, self.target, self.bias)])

    def of_flat(self, flat: np.ndarray) -> Vectors:
        out, at = [], 0
        for x in (self.last, self.earlier, self.target, self.bias):
            out.append(flat[at : at + x.size].reshape(x.shape).astype(np.float32))
            at += x.size
        return Vectors(*out)


class NoiseContrast:
    """Stochastic steps with one set of noise classes per minibatch. A step reads
    and writes only the rows of the classes it meets."""

    def __init__(self, v: Vectors, mass: np.ndarray, noise: int = 32, rate: float = 0.15, seed: int = 0):
        self.v, self.noise, self.rate = v, noise, rate
        self.p = mass / mass.sum()
        self.log_noise = np.log(noise * self.p).astype(np.float32)
        self.cdf = np.cumsum(self.p)
        self.rng = np.random.default_rng(seed)
        self.sums = [np.full(x.shape, 1e-2, np.float32) for x in (v.last, v.earlier, v.target, v.bias)]
        self.d_target = np.zeros(v.target.shape, np.float32)  # zero between steps

    def step(self, c1: np.ndarray, c2: np.ndarray, w: np.ndarray) -> None:
        self.learn(c1, c2, w, len(w))

    def learn(self, c1: np.ndarray, c2: np.ndarray, w: np.ndarray, batch: int, planned: int = 64) -> None:
        """One step per ``batch`` tokens. Noise and the order in which rows are
        added up do not depend on the vectors: they are found for ``planned``
        steps at a time."""
        whole = len(w) - len(w) % batch
        cuts = [*range(0, whole, planned * batch), whole]
        blocks = [(a, b, batch) for a, b in zip(cuts, cuts[1:])] + [(whole, len(w), len(w) - whole)]
        for a, b, size in blocks:
            if a < b:
                x, y, z = (v[a:b].reshape(-1, size) for v in (c1, c2, w))
                drawn = np.minimum(np.searchsorted(self.cdf, self.rng.random((len(x), self.noise))), len(self.p) - 1)
                for planned_step in zip(x, y, z, drawn, _groups(x), _groups(y), _groups(z)):
                    self._step(*planned_step)

    def _step(self, c1: np.ndarray, c2: np.ndarray, w: np.ndarray, drawn: np.ndarray, by_c1: Groups, by_c2: Groups, by_w: Groups) -> None:
        v, size = self.v, len(self.v.bias)
        n, rate = np.float32(math.sqrt(len(w))), np.float32(self.rate)
        q, target, fake = v.last.take(c1, 0), v.target.take(w, 0), v.target.take(drawn, 0)
        q += v.earlier.take(c2, 0)
        true = (q * target).sum(1)
        true += v.bias.take(w)
        true -= self.log_noise.take(w)
        h = q @ fake.T
        h += v.bias[drawn] - self.log_noise[drawn]
        g = (1 / (1 + np.exp(_clipped(true)))).astype(np.float32)[:, None]  # 1 - P(true | data)
        np.negative(_clipped(h), out=h)
        np.exp(h, out=h)
        h += 1
        np.divide(-1, h, out=h)
        dq = target
        dq *= g
        dq += h @ fake
        self.d_target[by_w.told] = by_w.sums(g * q)
        np.add.at(self.d_target, drawn, h.T @ q)
        met = np.zeros(size, bool)
        met[by_w.told] = met[drawn] = True
        met = np.flatnonzero(met)
        d_target = self.d_target.take(met, 0)
        self.d_target[met] = 0
        for x, s, rows, d in zip((v.last, v.earlier, v.target), self.sums, (by_c1.told, by_c2.told, met), (by_c1.sums(dq), by_c2.sums(dq), d_target)):
            d /= n
            now = s.take(rows, 0)
            now += d * d
            s[rows] = now
            d *= rate
            d /= np.sqrt(now, out=now)
            d += x.take(rows, 0)
            x[rows] = d
        d_bias = np.bincount(w, g[:, 0], size).astype(np.float32)
        np.add.at(d_bias, drawn, h.sum(0))
        d_bias /= n
        self.sums[3] += d_bias * d_bias
        d_bias *= rate
        d_bias /= np.sqrt(self.sums[3])
        v.bias += d_bias


def _clipped(x: np.ndarray) -> np.ndarray:
    """``x`` itself, between -30 and 30."""
    np.maximum(x, -30, out=x)
    return np.minimum(x, 30, out=x)


@dataclass
class Groups:
    """The indices of a step, and how its rows are added up by them."""

    told: np.ndarray  # the indices that occur, ascending
    first: np.ndarray  # of each, its first row
    several: np.ndarray  # all rows of indices that occur more than once, in the order of these
    starts: np.ndarray  # where each of these begins in ``several``
    again: np.ndarray  # and in ``told``

    def sums(self, rows: np.ndarray) -> np.ndarray:
        """The sum of the rows of each index."""
        out = rows.take(self.first, 0)
        if len(self.starts):
            out[self.again] = np.add.reduceat(np.ascontiguousarray(rows.take(self.several, 0).T), self.starts, axis=1).T
        return out


def _groups(index: np.ndarray) -> Iterator[Groups]:
    """The groups of each line of ``index``."""
    lines, size = index.shape
    # numpy sorts 16 bits by radix, and more slowly what has more
    order = np.argsort(index.astype(np.uint16) if index.max() < 1 << 16 else index, axis=1, kind="stable")
    ranked, order = np.take_along_axis(index, order, 1), order.reshape(-1)
    ends = np.ones((lines, size + 1), bool)
    np.not_equal(ranked[:, 1:], ranked[:, :-1], out=ends[:, 1:-1])
    begins, ends = ends[:, :-1], ends[:, 1:]
    repeated = ~(begins & ends)
    cuts = lambda counts: np.concatenate([[0], np.cumsum(counts)])
    of_told, of_several, of_starts = cuts(begins.sum(1)), cuts(repeated.sum(1)), cuts((repeated & begins).sum(1))
    heads, several = np.flatnonzero(begins), np.flatnonzero(repeated)
    told, first = ranked.reshape(-1)[heads], order[heads]
    starts = np.flatnonzero(begins.reshape(-1)[several])
    line = several[starts] // size
    starts -= of_several[line]
    again = np.flatnonzero(repeated.reshape(-1)[heads]) - of_told[line]
    several = order[several]
    for a, b, c, d, e, f in zip(of_told, of_told[1:], of_several, of_several[1:], of_starts, of_starts[1:]):
        yield Groups(told[a:b], first[a:b], several[c:d], starts[e:f], again[e:f])


class Reader:
    """Texts as known words and classes."""

    def __init__(self, lex: Lexicon):
        self.lex, self.class_of = lex, np.append(lex.class_of(), UNSEEN)
        self.words, self.end = pa.array(list(lex.index), pa.binary()), lex.index.get(END, -1)

    def read(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """Of the tokens of all texts, each text's end included: those that are no
        known words; the known word of each (or -1); its class; the position of
        each text's first token."""
        words, counts = words_of(texts)
        last = np.cumsum(counts + 1) - 1
        listed = pa.compute.fill_null(pa.compute.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False)
        at = np.arange(len(words)) + np.repeat(np.arange(len(counts)), counts)
        known = np.full(len(words) + len(counts), self.end, np.int64)
        known[at] = listed
        classes = self.class_of[known]
        strange = np.flatnonzero(listed < 0)
        rest, at = words.take(pa.array(strange)), at[strange]
        if self.end < 0:  # nothing was counted, so that the ends are not known either
            order = np.argsort(np.concatenate([at, last]), kind="stable")
            rest, at = pa.concat_arrays([rest, pa.array([END] * len(last), pa.binary())]).take(pa.array(order)), np.arange(len(known))
        classes[at] = self.lex.ending_classes(rest)
        return rest, known, classes, last - counts


def _contexts(classes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The class before each token and the one before that; before a text stands the end class."""
    c1 = np.full(len(classes), END_CLASS, np.int64)
    c2 = c1.copy()
    c1[1:] = classes[:-1]
    c1[first] = END_CLASS
    c2[1:] = c1[:-1]
    c2[first] = END_CLASS
    return c1, c2


def class_rows(docs: DataFrame, text_col: str, lex: Lexicon, shards: int, rounds: int, id_col: str | None = None) -> DataFrame:
    """(shard, round, place, classes): each text as its classes, 16 bits each.
    Shard, round and place come from a hash of the text and, if there is one, the
    id, so that copies are dealt to all shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(lex)
        for part in byte_chunks(batches, 0):
            _, _, classes, first = reader.read(part.column(0))
            bounds, told = np.append(first, len(classes)) * 2, classes.astype("<u2")
            told = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(told)])
            yield pa.RecordBatch.from_arrays([part.column(1), told], names=["place", "classes"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    named = [F.col(id_col)] if id_col in docs.columns else []
    told = docs.select(text.alias("text"), F.xxhash64(*named, text).alias("place")).mapInArrow(run, "place long, classes binary")
    return told.select(F.pmod("place", F.lit(shards)).cast("int").alias("shard"), F.pmod(F.xxhash64("place"), F.lit(rounds)).cast("int").alias("round"), "place", "classes")


def train_vectors(
    docs: DataFrame, text_col: str, lex: Lexicon, scratch: Scratch, width: int = 24, batch: int = 512, rounds: int = ROUNDS, chunk: int = 1 << 18, id_col: str | None = None
) -> Vectors:
    """One pass over all rows in ``rounds`` rounds of averaged shards."""
    mass = lex.class_mass()
    shards = max(1, -(-lex.tokens // TOKENS_PER_SHARD))
    rows = scratch.write(class_rows(docs, text_col, lex, shards, rounds, id_col), "classes", partition_by="round")
    now, sums = Vectors.start(mass, width), None
    for r in range(rounds):
        if not lex.tokens:
            break
        dealt = rows.where(F.col("round") == r).repartition(shards, "shard").sortWithinPartitions("shard", "place", "classes")
        learnt = dealt.select("shard", "classes").mapInArrow(_learn(now, sums, mass, r, batch, chunk), "part int, n long, vectors binary")
        # tasks' sums are added up in a few more, so that the driver gets eight at most
        added = learnt.groupBy("part").applyInArrow(_add, "part int, n long, vectors binary").collect()
        n = sum(x["n"] for x in added)
        if n:
            flat = np.sum([np.frombuffer(x["vectors"], np.float64) for x in sorted(added, key=lambda x: x["part"])], axis=0) / n
            half = len(flat) // 2
            now, sums = now.of_flat(flat[:half]), now.of_flat(flat[half:])
    scratch.drop("classes")
    return now


def _add(table: pa.Table) -> pa.Table:
    total = np.sum([np.frombuffer(x, np.float64) for x in table["vectors"].to_pylist()], axis=0)
    return pa.table({"part": table["part"][:1], "n": pa.array([pa.compute.sum(table["n"]).as_py()]), "vectors": pa.array([total.tobytes()], pa.binary())})


def _learn(now: Vectors, sums: Vectors | None, mass: np.ndarray, round_: int, batch: int, chunk: int):
    """Every shard of a task learns from ``now``; what it has learnt, and the sums
    of squares that set its steps, are added up by its tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n_total, shard, learner, n, held, size = None, 0, None, None, 0, [], 0

        def learn() -> None:
            nonlocal held, size
            texts = [np.frombuffer(x, "<u2").astype(np.int64) for x in held]
            classes = np.concatenate(texts)
            lengths = np.fromiter(map(len, texts), np.int64, len(texts))
            c1, c2 = _contexts(classes, np.cumsum(lengths) - lengths)
            order = learner.rng.permutation(len(classes))
            learner.learn(c1[order], c2[order], classes[order], batch)
            held, size = [], 0

        def done() -> None:
            nonlocal total, n_total
            if held:
                learn()
            flat = np.concatenate([learner.v.flat(), Vectors(*learner.sums).flat()]).astype(np.float64) * n
            total, n_total = flat if total is None else total + flat, n_total + n

        for part in batches:
            for of, classes in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                if of != shard:
                    if shard is not None:
                        done()
                    shard, n = of, 0
                    learner = NoiseContrast(now.of_flat(now.flat()), mass, seed=of * 1009 + round_)
                    if sums is not None:
                        flat = sums.of_flat(sums.flat())
                        learner.sums = [flat.last, flat.earlier, flat.target, flat.bias]
                held.append(classes)
                size, n = size + len(classes) // 2, n + len(classes) // 2
                if size >= chunk:
                    learn()
        if shard is not None:
            done()
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard % 8], pa.int32()), pa.array([n_total], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["part", "n", "vectors"]
            )

    return run


@dataclass
class Tables:
    """Score = last[c1, w] + earlier[c2, w] - log_z[c1, c2], natural logs."""

    last: np.ndarray
    earlier: np.ndarray
    log_z: np.ndarray

    @staticmethod
    def of(v: Vectors) -> Tables:
        last, earlier = v.last @ v.target.T + v.bias, v.earlier @ v.target.T
        top, low = last.max(1), earlier.max(1)
        z = np.exp(last - top[:, None]) @ np.exp(earlier - low[:, None]).T
        return Tables(last, earlier, np.log(np.maximum(z, 1e-30)) + top[:, None] + low[None, :])

    def log_p(self, c1: np.ndarray, c2: np.ndarray, w: np.ndarray) -> np.ndarray:
        return (self.last[c1, w] + self.earlier[c2, w] - self.log_z[c1, c2]).astype(np.float64)


def scan(docs: DataFrame, lex: Lexicon, tables: Tables) -> DataFrame:
    """Of each row (id, text): its token count, what known words add to both
    scores, and the words whose counts are yet to be joined: how often each
    occurs, and what its places add to the score if it was seen (its count's
    logarithm aside) and if it was not."""
    counts, mass, class_mass = lex.counts, lex.mass, lex.class_mass()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(lex)
        of = reader.class_of[:-1]
        base = np.append(np.log10((counts + 0.5) / mass), 0.0)
        within = np.append(np.log10((counts + 0.5) / class_mass[of]), 0.0)
        row = TaskContext.get().partitionId() << 40
        for part in byte_chunks(batches, 1):
            words, known, classes, first = reader.read(part.column(1))
            c1, c2 = _contexts(classes, first)
            log_p = tables.log_p(c1, c2, classes) / math.log(10) + within[known]
            ends = np.append(first[1:], len(known))
            unknown = np.flatnonzero(known < 0)
            if_seen = log_p[unknown] - np.log10(class_mass[classes[unknown]])
            if_not = tables.log_p(c1[unknown], c2[unknown], np.full(len(unknown), UNSEEN)) / math.log(10)
            log_p[unknown] = 0.0
            # the pairs of a text and a word, numbered in ascending order
            words = words.dictionary_encode()
            text = np.searchsorted(first, unknown, side="right") - 1
            pairs, of = np.unique(text * (len(words.dictionary) + 1) + words.indices.to_numpy(zero_copy_only=False), return_inverse=True)
            text, word = np.divmod(pairs, len(words.dictionary) + 1)
            fields = [
                words.dictionary.take(pa.array(word)), pa.array(np.bincount(of, minlength=len(pairs))),
                pa.array(np.bincount(of, if_seen, len(pairs))), pa.array(np.bincount(of, if_not, len(pairs))),
            ]
            rest = pa.ListArray.from_arrays(
                np.searchsorted(text, np.arange(len(first) + 1)).astype(np.int32), pa.StructArray.from_arrays(fields, ["word", "times", "seen", "unseen"])
            )
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), pa.array(np.arange(row, row + len(first))), pa.array(ends - first),
                    pa.array(np.add.reduceat(known >= 0, first).astype(np.int64)),
                    pa.array(np.add.reduceat(base[known], first)), pa.array(np.add.reduceat(log_p, first)),
                    rest,
                ],
                names=["id", "row", "n_tokens", "n_known", "base_score", "score", "rest"],
            )
            row += len(first)

    return docs.mapInArrow(
        run, f"id {dict(docs.dtypes)['id']}, row long, n_tokens long, n_known long, base_score double, score double, "
        "rest array<struct<word:binary,times:long,seen:double,unseen:double>>"
    )


def score_texts(
    docs: DataFrame, training: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: int = 200_000, width: int = 24
) -> DataFrame:
    """One row (id, n_tokens, n_known, train_tokens, base_score, score) per row
    of ``docs``; base_score is the add-half unigram log10 probability, score the
    model's, both of the whole text and its end.

    Words outside the broadcast lexicon get their counts by a join on the word,
    so the lexicon's size changes the cost, not the result. Null and empty
    texts are the end alone. Repeated rows come back as often, null ids too;
    other columns are ignored; an empty ``docs`` gives an empty result; with
    no training rows every token is unseen. A text of any length is read whole.
    ``training`` may have the id as well: copies are then dealt to all shards.
    """
    scratch = Scratch(docs.sparkSession, "lm")
    counts = scratch.write(count_words(training, text_col), "counts")
    lex = lexicon(counts, known)
    tables = Tables.of(train_vectors(training, text_col, lex, scratch, width, id_col=id_col))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # written, so that a row's number is the same in every later step
    scanned = scratch.write(scan(rows, lex, tables), "scanned")
    n, seen = F.coalesce("n", F.lit(0)) + 0.5, F.col("n").isNotNull()
    added = (
        scanned.where(F.size("rest") > 0).select("row", F.inline("rest")).join(counts, "word", "left").groupBy("row")
        .agg(
            F.sum(F.when(seen, F.col("times")).otherwise(0)).alias("more_known"),
            F.sum(F.col("times") * F.log10(n / lex.mass)).alias("more_base"),
            F.sum(F.when(seen, F.col("seen") + F.col("times") * F.log10(n)).otherwise(F.col("unseen"))).alias("more"),
        )
    )
    zero = lambda c: F.coalesce(c, F.lit(0))
    return scanned.drop("rest").join(added, "row", "left").select(
        F.col("id").alias(id_col), "n_tokens", (F.col("n_known") + zero("more_known")).alias("n_known"),
        F.lit(lex.tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + zero("more_base")).alias("base_score"), (F.col("score") + zero("more")).alias("score"),
    )
