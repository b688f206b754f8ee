"""Toxicity by a linear-chain conditional random field.

Tokens are tagged toxic or not. Forward-backward marginals give each token's
probability; their maximum and sum give a document's score, and the tokens
above one half its offending offsets. Trained in numpy on a bounded sample of
labelled rows; token labels come from the sample itself. One task trains, block
by block of text; the driver only gets the weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .flat import RangeHash, joined, word_ranges
from .shared import byte_chunks, texts_of

#: Bytes of text whose tokens are in hand at once, in training and in scoring.
TEXT_BLOCK = 1 << 20
TABLE = 1 << 16
TEMPLATES = 5
BLOCK = 128


def word_table() -> np.ndarray:
    """Word bytes: digits, lower-case letters and every byte of other scripts."""
    out = np.zeros(256, bool)
    out[ord("0") : ord("9") + 1] = out[ord("a") : ord("z") + 1] = True
    out[0x80:] = True
    return out


@dataclass
class Tokens:
    """Tokens of some texts in a row: features (templates x tokens), the word's
    hash, byte spans, the text of each and whether it opens one."""

    features: np.ndarray
    words: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    owner: np.ndarray
    opens: np.ndarray


def tokens_of(texts: list[bytes], hasher: RangeHash) -> Tokens:
    data, at = joined([t.lower() for t in texts])
    starts, ends = word_ranges(data, word_table())
    owner = np.searchsorted(at, starts, "right") - 1
    prefix = hasher.prefix(data)
    words = hasher.ranges(prefix, starts, ends)
    opens = np.ones(len(starts), bool)
    opens[1:] = owner[1:] != owner[:-1]
    before, after = np.zeros_like(words), np.zeros_like(words)
    before[1:] = np.where(opens[1:], 0, words[:-1])
    after[:-1] = np.where(opens[1:], 0, words[1:])
    parts = [words, before, after, hasher.ranges(prefix, starts, np.minimum(starts + 4, ends)), hasher.ranges(prefix, starts, np.minimum(starts + 6, ends))]
    features = np.stack([(p % np.uint64(TABLE)).astype(np.int32) + k * TABLE for k, p in enumerate(parts)]) if len(starts) else np.zeros((TEMPLATES, 0), np.int32)
    return Tokens(features, words, starts, ends, owner, opens)


@dataclass
class Chain:
    """Weights of features for the toxic tag, transitions (from, to) and start, as logs."""

    weights: np.ndarray
    moves: np.ndarray
    start: np.ndarray

    def potentials(self, t: Tokens) -> np.ndarray:
        """2 x 2 per token: from tag, to tag. A token that opens a text does not
        depend on the one before, which cuts one long chain into texts."""
        x = np.exp(np.clip(self.weights[t.features].sum(0), -30, 30))
        m = np.empty((2, 2, len(x)))
        for i in (0, 1):
            for j in (0, 1):
                m[i, j] = np.where(t.opens, np.exp(self.start[j]), np.exp(self.moves[i, j])) * (x if j else 1.0)
        return m

    def marginals(self, t: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """Of each token: P(toxic), and P(tag before, tag) as 2 x 2."""
        m = self.potentials(t)
        n = m.shape[2]
        if not n:
            return np.zeros(0), np.zeros((2, 2, 0))
        ahead = _scan(m)
        back = _scan(m[:, :, ::-1].transpose(1, 0, 2))[:, ::-1]  # back[:, k]: weight of what begins at k, by the tag before k
        beta = np.ones((2, n))
        beta[:, :-1] = back[:, 1:]
        both = ahead * beta
        toxic = both[1] / both.sum(0)
        prev = np.ones((2, n))
        prev[:, 1:] = ahead[:, :-1]
        pair = prev[:, None, :] * m * beta[None, :, :]
        return toxic, pair / pair.sum((0, 1))


def _scan(m: np.ndarray) -> np.ndarray:
    """Running products ones @ m[..., 0] @ ... @ m[..., k], scaled to sum 1.

    The tokens are laid out as many blocks side by side: products of whole
    blocks first, then a short walk over blocks, then all blocks at once again.
    """
    n = m.shape[2]
    blocks = -(-n // BLOCK)
    pad = np.broadcast_to(np.eye(2)[:, :, None], (2, 2, blocks * BLOCK - n))
    grid = np.concatenate([m, pad], 2).reshape(2, 2, blocks, BLOCK)
    whole = np.repeat(np.eye(2)[:, :, None], blocks, 2)
    for k in range(BLOCK):
        step = grid[:, :, :, k]
        whole = np.stack([whole[:, 0] * step[0, j] + whole[:, 1] * step[1, j] for j in (0, 1)], 1)
        whole /= whole.sum((0, 1))
    into, v = np.empty((2, blocks)), np.full(2, 0.5)
    for b in range(blocks):
        into[:, b] = v
        v = v @ whole[:, :, b]
        v = v / v.sum()
    out = np.empty((2, blocks, BLOCK))
    for k in range(BLOCK):
        step = grid[:, :, :, k]
        into = np.stack([into[0] * step[0, j] + into[1] * step[1, j] for j in (0, 1)])
        into = into / into.sum(0)
        out[:, :, k] = into
    return out.reshape(2, -1)[:, :n]


@dataclass
class ToxicityModel:
    chain: Chain
    scale: np.ndarray  # of the document's features, the constant last

    def read(self, texts: list[bytes], hasher: RangeHash) -> tuple[np.ndarray, Tokens, np.ndarray]:
        """The score of each text, its tokens and their P(toxic)."""
        t = tokens_of(texts, hasher)
        toxic, _ = self.chain.marginals(t)
        x = document_features(t, toxic, len(texts))
        return 1 / (1 + np.exp(-np.clip(x @ self.scale, -30, 30))), t, toxic


def document_features(t: Tokens, toxic: np.ndarray, n: int) -> np.ndarray:
    """Of each text: the largest token log-odds, the expected number of toxic tokens
    among those tagged so (log), 1. Tokens not tagged add nothing, so a score
    does not rise with length."""
    most = np.full(n, 1e-4)
    np.maximum.at(most, t.owner, toxic)
    most = np.clip(most, 1e-4, 1 - 1e-4)
    total = np.bincount(t.owner, np.where(toxic >= 0.5, toxic, 0), n)
    return np.stack([np.log(most / (1 - most)), np.log1p(total), np.ones(n)], 1)


def token_labels(
    words: np.ndarray, owner: np.ndarray, opens: np.ndarray, labels: np.ndarray, least: int = 4, purity: float = 0.8
) -> np.ndarray:
    """Toxic tokens of the labelled texts: words of toxic texts that follow at
    least ``least`` different words there (those of copied passages always
    follow the same one), of whose texts ``purity`` are toxic, classes weighed
    alike, and more than the luckiest of as many indifferent words would have."""
    words, at = np.unique(words, return_inverse=True)
    seen = np.unique(at.astype(np.int64) * len(labels) + owner)
    bad = labels[seen % len(labels)] == 1
    word = seen // len(labels)
    toxic, clean = np.bincount(word[bad], minlength=len(words)), np.bincount(word[~bad], minlength=len(words))
    inner = ~opens & (labels[owner] == 1)
    before = np.r_[0, at[:-1]].astype(np.int64)
    pairs = np.unique(at[inner].astype(np.int64) * len(words) + before[inner])
    contexts = np.bincount(pairs // max(1, len(words)), minlength=len(words))
    rate_t, rate_c = toxic / max(1, (labels == 1).sum()), (clean + 0.5) / max(1, (labels == 0).sum())
    some, share = toxic + clean, (labels == 1).mean()
    excess = (toxic - share * some) / np.sqrt(np.maximum(some * share * (1 - share), 1e-9))
    luck = np.sqrt(2 * np.log(max(2, (some >= least).sum())))
    marked = (contexts >= least) & (toxic >= least) & (rate_t / (rate_t + rate_c) >= purity) & (excess >= luck)
    return marked[at] & (labels[owner] == 1)


def _blocks(texts: list[bytes]) -> list[list[bytes]]:
    """The texts in runs of about ``TEXT_BLOCK`` bytes; a longer one is its own."""
    out, size = [], TEXT_BLOCK
    for t in texts:
        if size + len(t) > TEXT_BLOCK:
            out.append([])
            size = 0
        out[-1].append(t)
        size += len(t)
    return out


def fit(texts: list[bytes], labels: np.ndarray, weights: tuple[float, float] = (1.0, 1.0), rounds: int = 50, rate: float = 1.0, decay: float = 1e-6) -> ToxicityModel:
    """Maximum likelihood of the token labels by AdaGrad, then a logistic fit of
    the document labels, where a text counts as its class's member of ``weights``.
    One class alone: a constant score on its side; no text at all: a constant
    score on the clean side. Gradients are added up over
    blocks of text: what is held of all texts is their features."""
    # A prior in favour of clean tokens: features never seen stay clean.
    chain = Chain(np.zeros(TEMPLATES * TABLE), np.log([[0.995, 0.005], [0.5, 0.5]]), np.log([0.995, 0.005]))
    if not texts:  # nothing to learn from: every text is clean
        return ToxicityModel(chain, np.array([0.0, 0.0, -4.0]))
    hasher, chunks = RangeHash(), _blocks(texts)
    blocks = [tokens_of(c, hasher) for c in chunks]
    firsts = np.cumsum([0, *map(len, chunks)])
    n_tokens = [len(t.words) for t in blocks]
    joint = lambda parts, kind: np.concatenate([np.zeros(0, kind), *parts])
    gold = token_labels(
        joint((t.words for t in blocks), np.uint64), joint((t.owner + f for t, f in zip(blocks, firsts)), np.int64),
        joint((t.opens for t in blocks), bool), labels,
    )
    golds = np.split(gold, np.cumsum(n_tokens)[:-1]) if blocks else []
    for t in blocks:
        t.words = t.starts = t.ends = np.zeros(0)
    sums, move_sums = np.full(len(chain.weights), 1e-6), np.full((2, 2), 1e-6)
    pairs = np.zeros((2, 2))
    for t, g in zip(blocks, golds):
        inner, g = np.flatnonzero(~t.opens), g.astype(int)
        np.add.at(pairs, (g[inner - 1], g[inner]), 1)
    for _ in range(rounds if gold.any() else 0):
        gradient = -decay * len(gold) * chain.weights
        move = pairs.copy()
        for t, g in zip(blocks, golds):
            toxic, pair = chain.marginals(t)
            wrong = g - toxic
            for features in t.features:
                gradient += np.bincount(features, wrong, len(chain.weights))
            move -= pair[:, :, ~t.opens].sum(2)
        sums += gradient**2
        chain.weights += rate * gradient / np.sqrt(sums)
        move_sums += move**2
        chain.moves += 0.1 * move / np.sqrt(move_sums)
    chain.weights = chain.weights.astype(np.float32)
    seen = [document_features(t, chain.marginals(t)[0], len(c)) for t, c in zip(blocks, chunks)]
    x = np.concatenate([np.zeros((0, 3)), *seen])
    return ToxicityModel(chain, _logistic(x, labels, np.asarray(weights)[labels]))


def _logistic(x: np.ndarray, y: np.ndarray, weights: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton steps on weighted rows; the ridge keeps a separable fit finite."""
    w = np.zeros(x.shape[1])
    weights = weights / weights.mean()
    penalty = ridge * np.diag([1.0] * (x.shape[1] - 1) + [1e-3])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (weights * p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(len(w))
        w = w + np.linalg.solve(hess, x.T @ (weights * (y - p)) - penalty @ w)
    return w


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    per_class: int = 1000, most_bytes: int = 20_000,
) -> ToxicityModel:
    """Fit on a bounded sample: at most ``per_class`` labelled rows of each
    class, first by a hash of the id, with texts of at most ``most_bytes``. The
    document scores are fitted to the classes' shares among all labels. The
    sample goes to one task (at most 2 * ``per_class`` * ``most_bytes`` bytes),
    whose weights, some 1.3 MB, are all that comes to the driver."""
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label in (0, 1)")
    order = F.xxhash64("id")
    ids = None
    for label in (0, 1):
        some = marked.where(F.col("label") == label).dropDuplicates(["id"]).orderBy(order, "id").limit(per_class)
        ids = some if ids is None else ids.unionByName(some)
    classes = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    rows = (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .where(F.octet_length("text") <= most_bytes)
        .join(F.broadcast(ids), "id")  # at most 2 * per_class ids
        .select("text", "label", F.xxhash64("id", "text").alias("at"))
        .repartition(1).sortWithinPartitions("at", "text", "label")
    )
    fitted = rows.mapInArrow(_fit_rows(classes), "weights binary, moves binary, start binary, scale binary").collect()
    if not fitted:  # no partition at all
        return fit([], np.zeros(0, np.int64))
    read = lambda name, kind: np.frombuffer(fitted[0][name], kind)
    chain = Chain(read("weights", np.float32), read("moves", np.float64).reshape(2, 2), read("start", np.float64))
    return ToxicityModel(chain, read("scale", np.float64))


def _fit_rows(classes: dict[int, int]):
    """Fits a model on the rows of a task (text, label, ...); ``classes`` holds
    the rows of each label among all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, found = [], []
        for batch in batches:
            texts += texts_of(batch.column(0))
            found += batch.column(1).to_pylist()
        labels = np.array(found, np.int64)
        shares = tuple(classes.get(c, 0) / max(1, (labels == c).sum()) or 1.0 for c in (0, 1))
        model = fit(texts, labels, shares)
        arrays = [model.chain.weights, model.chain.moves, model.chain.start, model.scale]
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in arrays], names=["weights", "moves", "start", "scale"])

    return run


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, spans) for every row, by its whole text; spans are (start,
    end) of toxic tokens in code points, end exclusive.

    Null and empty texts get the score of a text without toxic tokens and no
    spans. Repeated rows come back as often, null ids too; other columns are
    ignored; an empty table gives an empty result.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = RangeHash()
        for part in byte_chunks(batches, 1, TEXT_BLOCK):
            texts = texts_of(part.column(1))
            scores, t, toxic = model.read(texts, hasher)
            spans: list[list[dict]] = [[] for _ in texts]
            at = np.cumsum([0] + [len(x) + 1 for x in texts])
            for k in np.flatnonzero(toxic >= 0.5).tolist():
                i = int(t.owner[k])
                a, b = int(t.starts[k] - at[i]), int(t.ends[k] - at[i])
                start = len(texts[i][:a].decode("utf-8", "ignore")) if not spans[i] else spans[i][-1]["end"] + len(texts[i][last:a].decode("utf-8", "ignore"))
                spans[i].append({"start": start, "end": start + len(texts[i][a:b].decode("utf-8", "ignore"))})
                last = b
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores), pa.array(spans, kind)], names=["id", "score", "spans"])

    kind = dict(docs.dtypes)[id_col]
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, score double, spans array<struct<start:int,end:int>>"
    )
    return found.withColumnRenamed("id", id_col)


def keep_clean(docs: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, that score below ``threshold``. Rows
    are judged where they are read: no shuffle. Cases as in ``score``."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = RangeHash()
        for part in byte_chunks(batches, at, TEXT_BLOCK):
            scores, _, _ = model.read(texts_of(part.column(at)), hasher)
            yield part.filter(pa.array(scores < threshold))

    return docs.mapInArrow(run, docs.schema)
