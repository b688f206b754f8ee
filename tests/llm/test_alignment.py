"""Cross-tokenizer alignment against brute force over whole-text encodings."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from crashgrid.llm import alignment
from crashgrid.llm.queries import op13_token_alignment, public_model

from .conftest import SF

PATH_A, PATH_B = public_model("byte_bpe_50k.json"), public_model()
ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  ", "  a  b ", "\n", "a\n\n b", "a\t b\x0b\x0c c", "!\x1c? \x1c!", "x\x85y\xa0z　 w v", "▁a ▁ b", "a▁",
    "<|endoftext|> and <s> </s> <unk> <0x0A>", "don't we'll I'M", "é漢字🙂 mixed 日本語 text", "1234567 8.9,10", "\0null", "é combining", "ﬁ ligature ½ ①",
    "word " * 50, "nospace" * 200, "   \n   \n  x", "\r\n\r\nq", "...!!!???   ---", "тест текста и ещё", "a" * 3000, "​‍﻿z", "\U0001f468‍\U0001f469",
]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(PATH_A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATH_B)


def spans(a, b, text):
    """Token (id, start, end) lists of one text, None if the tokens do not spell it."""
    if not text:
        return None
    alphabet = alignment.byte_alphabet()
    names = {i: t for t, i in a.get_vocab().items()}
    spelled = [
        [(i, bytes(alphabet[c] for c in names[i])) for i in a.encode(" " + text, add_special_tokens=False).ids],
        [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i in b.encode(text) for p in [b.id_to_piece(i)]],
    ]
    if any(b"".join(s for _, s in side) != (" " + text).encode() for side in spelled):
        return None
    out = []
    for side in spelled:
        at, placed = 0, []
        for i, s in side:
            placed.append((i, at, at + len(s)))
            at += len(s)
        out.append(placed)
    return out


def plain(a, b, texts):
    each, total = [], Counter()
    for text in texts:
        both = spans(a, b, text)
        if both is None:
            each.append((0, 0, 0, "", []))
            continue
        xs, ys = both
        cuts = sorted({e for *_, e in xs} & {e for *_, e in ys})
        groups = defaultdict(lambda: ([], []))
        for side, tokens in enumerate(both):
            for i, s, _ in tokens:
                groups[next(c for c in cuts if s < c)][side].append(str(i))
        links = [(i, j) for i, s, e in xs for j, t, f in ys if s < f and t < e]
        total.update(links)
        each.append((len(xs), len(ys), len(cuts), ";".join(",".join(groups[c][0]) + "|" + ",".join(groups[c][1]) for c in cuts), links))
    most = Counter()
    for (_, j), n in total.items():
        most[j] = max(most[j], n)
    return [
        (n_a, n_b, n_g, len(links), sum(total[p] == most[p[1]] for p in links), sum(total[p] for p in links), groups)
        for n_a, n_b, n_g, groups, links in each
    ]


def built(df):
    rows = alignment.with_pair_counts(alignment.align(df, PATH_A, PATH_B)).collect()
    return sorted((r.id if r.id is not None else -1, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in rows)


def test_odd_texts_repeats_and_null_ids(spark, libraries, monkeypatch):
    texts = ODD + ODD[5:9] + ["long words and spaces \n" * 3]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, ODD[17]), (3, ODD[17])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = sorted((i, *w) for (i, _), w in zip(rows, plain(*libraries, [t for _, t in rows])))
    assert built(df) == want
    assert sum(w[1] > 0 for w in want) > 25 and sum(w[1] == 0 for w in want) > 2


def test_query_equals_brute_force(spark, libraries):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    short = [r for r in docs if len(r.text or "") < 4000]
    got = {r.doc_id: r for r in op13_token_alignment(spark, SF).collect()}
    assert got.keys() == {r.doc_id for r in docs}
    for r, (n_a, n_b, n_g, n_l, _, _, groups) in zip(short, plain(*libraries, [r.text for r in short])):
        g = got[r.doc_id]
        assert (g.n_a, g.n_b, g.n_groups, g.n_links) == (n_a, n_b, n_g, n_l)
        assert g.groups_sha256 == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")
    assert all(0 < r.n_best <= r.n_links <= r.count_sum for r in got.values() if r.n_a)


def test_counts_over_many_packs(spark, libraries, monkeypatch):
    texts = [f"le mot {i % 7} et l'autre mot {i % 3}" for i in range(40)] + [None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    assert built(df) == sorted((i, *w) for i, w in enumerate(plain(*libraries, texts)))


def test_no_rows_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "some text"), (None, "more"), (2, None)], "doc_id long, text string")
    assert built(df.limit(0)) == []
    wide = df.withColumns({c: F.lit(0) for c in ("id", "pack", "links", "pairs", "groups", "place", "a", "b", "n")})
    assert built(wide) == built(df)
    assert built(df.where("text IS NULL")) == [(2, 0, 0, 0, 0, 0, 0, "")]


SETTLED = st.characters(min_codepoint=0, max_codepoint=0x52F)


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\x1c\x85\xa0　\u2028ab'1!é漢½²ˀ’—"), SETTLED, st.characters(codec="utf-8")), max_size=60))
def test_faster_library_gives_the_same_ids(text):
    a = _byte_level()
    assert a.ids([text])[0] == a.tokenizer.encode(text, add_special_tokens=False).ids


def test_every_settled_character_has_the_same_class():
    a = _byte_level()
    texts = [f"a{c}a 1{c}1 !{c}! {c} {c}{c}" for c in map(chr, [*range(0x530), *range(0x2010, 0x205F), *range(0x20A0, 0x20C0)])]
    assert all(map(a.is_settled, texts)) and not a.is_settled("漢") and not a.is_settled(" " * 500) and not a.is_settled("x" * 500)
    assert [a.fast.encode_ordinary(t) for t in texts] == [e.ids for e in a.tokenizer.encode_batch(texts, add_special_tokens=False)]


_MADE = []


def _byte_level():
    if not _MADE:
        _MADE.append(alignment.ByteLevel(PATH_A))
    return _MADE[0]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=20), st.data())
def test_coalescing_equals_overlaps(a_sizes, data):
    total, b_sizes = sum(a_sizes), []
    while sum(b_sizes) < total:
        b_sizes.append(data.draw(st.integers(1, min(4, total - sum(b_sizes)))))
    a_group, b_group, a_link, b_link = alignment.coalesce(np.array(a_sizes), np.array(b_sizes))
    ends = [np.cumsum(s) for s in (a_sizes, b_sizes)]
    common = sorted(set(ends[0].tolist()) & set(ends[1].tolist()))
    assert a_group.tolist() == [sum(c < e for c in common) for e in ends[0].tolist()]
    assert b_group.tolist() == [sum(c < e for c in common) for e in ends[1].tolist()]
    want = [(i, j) for i in range(len(a_sizes)) for j in range(len(b_sizes)) if ends[0][i] - a_sizes[i] < ends[1][j] and ends[1][j] - b_sizes[j] < ends[0][i]]
    assert sorted(zip(a_link.tolist(), b_link.tolist())) == want
