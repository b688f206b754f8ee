"""Trained operators: exact parts against brute force, the rest on held-out rows."""

import math
import time
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pyarrow as pa
import pytest

from crashgrid.llm import langid, language_model, toxicity
from crashgrid.llm.shared import Scratch
from crashgrid.llm.flat import RangeHash
from crashgrid.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def remainder(i, n):
    return zlib.crc32(str(i).encode()) % n


# -- toxicity


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    texts = [b"", b"one", b"the big red dog", b"a b c d e f g", b"..."]
    t = toxicity.tokens_of(texts, RangeHash())
    chain = toxicity.Chain(rng.normal(size=toxicity.TEMPLATES * toxicity.TABLE), rng.normal(size=(2, 2)), rng.normal(size=2))
    got, pair = chain.marginals(t)
    score = chain.weights[t.features].sum(0)
    for i in range(len(texts)):
        at = np.flatnonzero(t.owner == i)
        if not len(at):
            continue
        total, toxic = 0.0, np.zeros(len(at))
        for tags in product((0, 1), repeat=len(at)):
            s = chain.start[tags[0]] + sum(chain.moves[a, b] for a, b in zip(tags, tags[1:])) + sum(score[k] for k, y in zip(at, tags) if y)
            total += math.exp(s)
            toxic += math.exp(s) * np.array(tags)
        assert got[at] == pytest.approx(toxic / total)
    assert pair.sum((0, 1)) == pytest.approx(np.ones(len(t.words)))


def test_long_chains_equal_plain_recursion():
    rng = np.random.default_rng(1)
    m = rng.random((2, 2, 1000)) + 0.01
    v, want = np.full(2, 0.5), []
    for k in range(1000):
        v = v @ m[:, :, k]
        v = v / v.sum()
        want.append(v)
    assert toxicity._scan(m) == pytest.approx(np.array(want).T)


def test_toxicity_on_held_out_rows(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = QUERIES["op4_toxicity"](spark, SF).collect()
    assert all(r.held_out == (remainder(r.doc_id, 5) == 0) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in got)
    judged = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert sum(p == y for p, y in judged) / len(judged) > 0.9


def test_toxicity_cases(spark):
    bad = [f"w{i} you a{i} idiot x{i} moron y{i}" for i in range(40)]
    good = [f"w{i} you a{i} friend x{i} hello y{i}" for i in range(40)]
    model = toxicity.fit([t.encode() for t in bad + good], np.array([1] * 40 + [0] * 40))
    rows = [(1, "é so idiot b"), (1, "é so idiot b"), (2, None), (None, ""), (3, "nice friend " * 20_000), (4, "!!!")]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, score double")
    got = toxicity.score(docs, model).collect()
    assert len(got) == 6 and toxicity.score(docs.limit(0), model).count() == 0
    assert all((r.score >= 0.5) == (r.doc_id == 1) for r in got)
    assert [[tuple(s) for s in r.spans] for r in got if r.doc_id == 1] == [[(5, 10)]] * 2
    clean = toxicity.keep_clean(docs, model)
    assert clean.columns == docs.columns and clean.count() == 4
    one_class = toxicity.fit([b"a b", b"c d"], np.array([0, 0]))
    assert (one_class.read([b"a b", b""], RangeHash())[0] < 0.5).all()


# -- language


def test_languages_on_held_out_rows(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op5_language_id"](spark, SF).collect()
    assert all(r.held_out == (remainder(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and lang[r.doc_id] is not None]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.97


def test_filters_hold_what_they_were_given():
    rng = np.random.default_rng(2)
    cells = np.zeros((1 << 14, 1), np.uint64)
    keys = {k: np.unique(rng.integers(0, 1 << 32, 500).astype(np.uint32)) for k in range(3)}
    for k, own in keys.items():
        for h in range(3):
            np.bitwise_or.at(cells[:, 0], langid._cell(own, h, len(cells)), np.uint64(1 << k))
    f = langid.LanguageFilters(("a", "b", "c"), cells, 3, np.full(3, 0.001))
    for k, own in keys.items():
        assert f.held(f.masks(own), k).all()
    others = rng.integers(0, 1 << 32, 20_000).astype(np.uint32)
    assert (f.masks(others) > 0).mean() < 0.02


def test_filters_hold_every_counted_gram(spark):
    rng = np.random.default_rng(3)
    word = lambda n, low, high: "".join(chr(c) for c in rng.integers(low, high, n))
    texts = {"ja": " ".join(word(12, 0x4E00, 0x9F00) for _ in range(1500)), "ru": " ".join(word(6, 0x430, 0x450) for _ in range(50))}
    filters = langid.train(spark.createDataFrame(list(texts.items()), "lang string, text string"))
    for k, lang in enumerate(filters.languages):
        keys = np.unique(langid.gram_keys([texts[lang]])[0])
        assert lang != "ja" or len(keys) > 20_000
        assert filters.held(filters.masks(keys), k).all()


def _grams(text):
    """The 4-byte n-grams of a text's words, one space around each, plainly."""
    raw = bytes(b if b >= 0x80 or chr(b).isalpha() else 32 for b in text.lower().encode())
    joined = b" " + b" ".join(raw.split()) + b" "
    return [joined[i : i + 4] for i in range(len(joined) - 3) if b" " not in joined[i + 1 : i + 3]]


@pytest.mark.parametrize("n_languages", [3, 70, 130])
def test_decisions_equal_plain_sets(spark, n_languages):
    """Sets in place of filters: the same n-grams held, the same languages chosen
    but where chance decides a near tie."""
    rng = np.random.default_rng(n_languages)
    syllables = ["".join(chr(c) for c in rng.integers(0x61, 0x7B, 3)) for _ in range(400)]
    own = {f"l{k:03d}": rng.choice(syllables, 25, replace=False) for k in range(n_languages)}
    text = lambda lang, n: " ".join("".join(rng.choice(own[lang], 2)) for _ in range(n))
    train = [(lang, text(lang, 120)) for lang in own for _ in range(2)]
    filters = langid.train(spark.createDataFrame(train, "lang string, text string"))
    assert filters.languages == tuple(sorted(own)) and filters.cells.shape[1] == -(-n_languages // 64)
    counts = {lang: Counter(g for x, t in train if x == lang for g in _grams(t)) for lang in own}
    rates = {lang: {g: n / sum(c.values()) for g, n in c.items()} for lang, c in counts.items()}
    top = Counter()
    for r in rates.values():
        for g, x in r.items():
            top[g] = max(top[g], x)
    held = {lang: {g for g, x in r.items() if x >= 0.2 * top[g]} for lang, r in rates.items()}
    for k, lang in enumerate(filters.languages):
        keys = np.array([int.from_bytes(g, "little") for g in held[lang]], np.uint32)
        assert filters.held(filters.masks(keys), k).all()
    rows = [(i, text(lang, 30), lang) for i, lang in enumerate(list(own) * 2)]
    got = {r.doc_id: r for r in langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), filters).collect()}
    same = 0
    for i, t, _ in rows:
        grams = _grams(t)
        exact = {lang: sum(g in held[lang] for g in grams) for lang in filters.languages}
        best = max(filters.languages, key=lambda x: (exact[x], [-ord(c) for c in x]))
        same += best == got[i].lang_pred
        want = (exact[best] + 0.5) / (sum(exact.values()) + 0.5 * n_languages)
        assert abs(got[i].score - want) < 0.05
    assert same >= 0.99 * len(rows)


def test_a_small_table_still_decides_and_a_full_one_is_an_error(spark):
    train = spark.createDataFrame([("en", "the cat and the dog ran home again"), ("de", "der Hund und die Katze gehen nach Hause")] * 5, "lang string, text string")
    small = langid.train(train, most_bytes=1 << 13)
    assert small.cells.nbytes <= 1 << 13
    assert small.decide(["the dog ran", "die Katze gehen"])[0] == ["en", "de"]
    words = " ".join("".join(chr(c) for c in np.random.default_rng(i).integers(0x61, 0x7B, 12)) for i in range(9000))
    with pytest.raises(ValueError, match="full"):
        langid.train(spark.createDataFrame([("a", words), ("b", words[::-1])], "lang string, text string"), most_bytes=1 << 13)


def test_language_cases(spark):
    train = [("en", "the cat and the dog"), ("de", "der Hund und die Katze"), ("en", None), (None, "le chat"), ("de", "")] * 3
    filters = langid.train(spark.createDataFrame(train, "lang string, text string"))
    rows = [(1, "The dog", "x"), (1, "The dog", "x"), (2, "die Katze", None), (3, None, "x"), (None, "", "x"), (4, "123 ... \n", "x"), (5, "und der Hund " * 20_000, "x"), (6, "漢字", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string")
    got = {(r.doc_id, r.lang_pred) for r in langid.identify(docs, filters).collect()}
    assert got >= {(1, "en"), (2, "de"), (3, "und"), (None, "und"), (4, "und"), (5, "de")}
    assert langid.identify(docs, filters).count() == 8 and langid.identify(docs.limit(0), filters).count() == 0
    nothing = langid.train(spark.createDataFrame([], "lang string, text string"))
    assert {r.lang_pred for r in langid.identify(docs, nothing).collect()} == {"und"}


# -- language model


def base_scores(docs, training):
    words = lambda t: (t or "").encode().lower().split()
    c = Counter(w for t in training for w in [*words(t), None])
    n, v = sum(c.values()), len(c)
    out = []
    for i, t in docs:
        tokens = [*words(t), None]
        out.append((i, len(tokens), sum(c[w] > 0 for w in tokens), n, math.fsum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)))
    return out


def test_counts_and_base_scores_equal_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    want = {x[0]: x for x in base_scores(docs, [t for i, t in docs if remainder(i, 5) != 1])}
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    training = spark.createDataFrame([(t,) for i, t in docs if remainder(i, 5) != 1], "text string")
    for known in (200_000, 300):  # the lexicon's size changes the cost, not the result
        got = language_model.score_texts(frame, training, known=known).collect()
        assert len(got) == len(docs)
        for r in got:
            i, n_tokens, n_known, n, base = want[r.doc_id]
            assert (r.n_tokens, r.n_known, r.train_tokens) == (n_tokens, n_known, n)
            assert r.base_score == pytest.approx(base, rel=1e-9)


def test_beats_the_base_on_held_out_rows(spark):
    got = QUERIES["op9_lm_scoring"](spark, SF).where("held_out").collect()
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def _plain_scores(docs, counts, v, own, endings):
    """Scores by sums over all classes, one token at a time; the share of a word in its class by adding up."""
    L = language_model
    ranked = [w for w, _ in sorted(((w, n) for w, n in counts.items() if w != L.END), key=lambda x: (-x[1], x[0]))]
    names = {w: i + 2 for i, w in enumerate(ranked[:own])}
    members = {}
    for w in ranked[own:]:
        members.setdefault(L.ending_key(w, endings), []).append(w)
    order = {e: 2 + own + i for i, e in enumerate(sorted(members))}

    def of(w):
        return L.END_CLASS if w == L.END else names.get(w) or order.get(L.ending_key(w, endings), L.UNSEEN)

    out = {}
    for i, text in docs:
        before, total = [L.END_CLASS, L.END_CLASS], 0.0
        for w in [*(text or "").encode().lower().split(), L.END]:
            q = v.last[before[-1]].astype(float) + v.earlier[before[-2]].astype(float)
            logits = [float(q @ v.target[c]) + float(v.bias[c]) for c in range(len(v.bias))]
            z = math.fsum(math.exp(x) for x in logits)
            if w in counts:
                group = [w] if w == L.END or w in names else members[L.ending_key(w, endings)]
                share = (counts[w] + 0.5) / sum(counts[x] + 0.5 for x in group)
                p = math.exp(logits[of(w)]) / z * share
            else:
                p = math.exp(logits[L.UNSEEN]) / z
            total += math.log10(p)
            before.append(of(w))
        out[i] = total
    return out


@pytest.mark.parametrize("known", [200_000, 40])
def test_scores_equal_brute_force(spark, known):
    L = language_model
    rows = [(r.doc_id, r.text[:900] if r.text else r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    rows += [(1000, None), (1001, "neverseen words herezzq"), (1002, "y" * 100)]
    training = [t for i, t in rows if i % 3]
    counts = Counter(w for t in training for w in [*(t or "").encode().lower().split(), L.END])
    frame = spark.createDataFrame(training, "string").toDF("text")
    scratch = Scratch(spark, "lm-test")
    lex = L.lexicon(scratch.write(L.count_words(frame, "text"), "counts"), known)
    assert lex.words == len(counts) and lex.tokens == sum(counts.values()) and 2 * math.isqrt(len(counts)) >= lex.own
    assert lex.class_mass().sum() == pytest.approx(lex.mass)  # every counted word is in one class
    v = L.train_vectors(frame, "text", lex, scratch)
    want = _plain_scores(rows, counts, v, lex.own, len(lex.ending_class))
    got = L.score_texts(spark.createDataFrame(rows, "doc_id long, text string"), frame, known=known).collect()
    for r in got:
        assert r.score == pytest.approx(want[r.doc_id], abs=2e-4 * r.n_tokens)


def test_scores_do_not_depend_on_the_layout(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    seen = {}
    for parts in (1, 32):
        got = language_model.score_texts(docs, docs.repartition(parts)).collect()
        seen[parts] = {r.doc_id: (r.score / r.n_tokens, r.base_score / r.n_tokens) for r in got}
    assert all(abs(seen[1][i][0] - seen[32][i][0]) < 0.01 for i in seen[1])
    gain = np.mean([a - b for a, b in seen[32].values()])
    assert gain > 0.158, gain


def test_tables_are_normalised():
    v = language_model.Vectors.start(np.array([1.0, 40, 9, 5, 2, 3]), 8, seed=1)
    t = language_model.Tables.of(v)
    c1, c2 = np.repeat(np.arange(6), 6), np.tile(np.arange(6), 6)
    total = sum(np.exp(t.log_p(c1, c2, np.full(36, w))) for w in range(6))
    assert total == pytest.approx(np.ones(36), rel=1e-5)


def test_noise_contrast_learns_what_follows():
    mass = np.full(6, 100.0)
    learner = language_model.NoiseContrast(language_model.Vectors.start(mass, 12), mass)
    seq = np.tile(np.arange(6), 4000)
    c1, c2, w = seq[1:-1], seq[:-2], seq[2:]
    for at in range(0, len(w), 256):
        learner.step(c1[at : at + 256], c2[at : at + 256], w[at : at + 256])
    p = np.exp(language_model.Tables.of(learner.v).log_p(c1[:6], c2[:6], w[:6]))
    assert p.min() > 0.6


def test_a_step_costs_by_the_classes_it_meets():
    def seconds(classes):
        learner = language_model.NoiseContrast(language_model.Vectors.start(np.ones(classes), 24), np.ones(classes))
        met = np.random.default_rng(3).integers(classes - 300, classes, (3, 512))
        spent = []
        for _ in range(4):
            start = time.process_time()
            for _ in range(20):
                learner.step(*met)
            spent.append(time.process_time() - start)
        return min(spent)

    assert seconds(70_000) < 12 * seconds(1_500)


def test_planned_steps_equal_plain_steps():
    rng, mass = np.random.default_rng(5), 1000 / np.arange(1.0, 41)
    told = np.minimum(rng.geometric(0.1, (3, 500)) - 1, 39)
    made = [language_model.NoiseContrast(language_model.Vectors.start(mass, 6), mass, seed=2) for _ in range(2)]
    made[0].learn(*told, 64, planned=3)  # seven steps and one of 52
    x, draws = made[1], np.random.default_rng(2)
    for at in range(0, 500, 64):
        c1, c2, w = told[:, at : at + 64]
        v, drawn = x.v, np.searchsorted(x.cdf, draws.random(x.noise))
        d = [np.zeros(y.shape) for y in (v.last, v.earlier, v.target, v.bias)]
        for a, b, c in zip(c1, c2, w):
            q, back = v.last[a].astype(float) + v.earlier[b], 0.0
            for k, true in [(c, True), *((k, False) for k in drawn)]:
                p = 1 / (1 + math.exp(-(q @ v.target[k] + v.bias[k] - x.log_noise[k])))
                d[2][k] += (true - p) * q
                d[3][k] += true - p
                back = back + (true - p) * v.target[k]
            d[0][a] += back
            d[1][b] += back
        for y, s, g in zip((v.last, v.earlier, v.target, v.bias), x.sums, d):
            g /= math.sqrt(len(w))
            s += g * g
            y += x.rate * g / np.sqrt(s)
    assert np.allclose(made[0].v.flat(), x.v.flat(), atol=2e-5)
    assert np.allclose(language_model.Vectors(*made[0].sums).flat(), language_model.Vectors(*x.sums).flat(), rtol=1e-3)


def test_words_are_counted_and_read_as_split(spark):
    L = language_model
    every = "".join(f"{chr(i)}B" for i in range(400))
    texts = [None, "", " \t\n", "a", " a\x0bB  a\x1cA\x85\u00a0\u3000c ", every, "É é ÉA", "x" * 70, None]
    texts += [f" w{i % 7} W{i} END\n" for i in range(50)]
    split = [(t or "").encode().lower().split() for t in texts]
    words, counts = L.words_of(pa.array(texts))
    assert words.to_pylist() == [w for ws in split for w in ws] and counts.tolist() == [len(ws) for ws in split]
    want = Counter(w for ws in split for w in [*ws, L.END])
    frame = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    for flush, most in ((400_000, 64 << 20), (1, 64 << 20), (400_000, 40)):
        assert {bytes(r.word): r.n for r in L.count_words(frame, "text", flush, most).collect()} == want
    lex = L.lexicon(L.count_words(frame, "text"), known=40)
    assert 0 < len(lex.index) < len(want)
    classes = dict(zip(lex.index, lex.class_of().tolist()))
    rest, known, got, first = L.Reader(lex).read(pa.array(texts))
    tokens = [w for ws in split for w in [*ws, L.END]]
    assert known.tolist() == [lex.index.get(w, -1) for w in tokens]
    assert rest.to_pylist() == [w for w in tokens if w not in lex.index]
    assert got.tolist() == [classes[w] if w in classes else lex.ending(w) for w in tokens]
    assert first.tolist() == np.cumsum([0, *(len(ws) + 1 for ws in split)])[:-1].tolist()


def test_language_model_cases(spark):
    rows = [(1, "A b c"), (1, "A b c"), (2, None), (None, ""), (3, "a " * 50_000), (4, "x" * 200 + " unseen")]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, word string")
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in language_model.score_texts(docs, docs.where("doc_id < 4")).collect()), key=str)
    want = sorted(((*x[:4], round(x[4], 6)) for x in base_scores(rows, [t for i, t in rows if i is not None and i < 4])), key=str)
    assert got == want
    assert language_model.score_texts(docs.limit(0), docs).count() == 0
    none = language_model.score_texts(docs, docs.limit(0)).collect()
    assert len(none) == 6 and all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in none)
