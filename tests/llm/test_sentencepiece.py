"""The codec against the library whose results it must equal."""

import random

import pytest

from crashgrid.llm import sentencepiece_bpe as S
from crashgrid.llm.queries import public_model

sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=public_model())


@pytest.fixture(scope="module")
def codec():
    return S.Codec(S.load_vocabulary(public_model()))


CASES = [
    "", " ", "   ", "a", " a", "a ", "a\nb", "\n\n x", "▁a", "\x00a\x7f", "é😀", "a  b" * 9, "<s> </s><0x41>", "\ta\r\n", "　x", "ﬁ", "é",
    " " * 70 + "x" + " " * 33, "aaaaaaaaaaaaaaaaaaaaaaaaaaa", "-" * 41, "=" * 100, "漢字かな交じり文", "мир " * 5, "x" * 5000, "\U0010ffff퟿",
]


def texts(n, seed):
    r = random.Random(seed)
    pools = ["ab ", "the of and\n", "  \n\t-=_*#", "éèüßñ ", "0123456789.,", "漢字かな😀\U0001f468‍", "abcdefghijklmnopqrstuvwxyz     ", "▁ a<>0x/s", "\x00\x01\x7f "]
    for _ in range(n):
        chosen = r.sample(pools, r.randint(1, 3))
        yield "".join(r.choice(r.choice(chosen)) for _ in range(r.randint(0, 120)))


def test_encodes_as_the_library(model, codec):
    batch = CASES + list(texts(4000, 1))
    assert codec.encode(batch) == [model.encode(t, add_eos=True) for t in batch]


def test_decodes_as_the_library(model, codec):
    r = random.Random(2)
    lists = [model.encode(t, add_eos=True) for t in CASES + list(texts(500, 3))]
    lists += [[r.choice([r.randrange(32000), r.randrange(3, 259), r.choice([0, 1, 2, 28705, 259])]) for _ in range(r.randint(0, 12))] for _ in range(5000)]
    for ids in lists:
        assert codec.decode(ids) == model.decode(ids), ids


def test_table_cases(spark, model):
    v = S.load_vocabulary(public_model())
    rows = [(1, "a b", "x"), (1, "a b", "x"), (2, None, "y"), (None, "", None), (3, "word " * 60_000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = {(r["doc_id"], r["n_tokens"]): r for r in S.round_trip(docs, v).collect()}
    assert S.round_trip(docs, v).count() == 5
    assert (2, 1) in got and (None, 1) in got
    long = model.encode("word " * 60_000, add_eos=True)
    assert got[(3, len(long))]["ids"] == long
    assert S.round_trip(docs.limit(0), v).count() == 0
    assert S.encode_table(docs.where("doc_id = 2"), v).first()["ids"] == [2]
