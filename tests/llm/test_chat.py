"""Chat formatting: what is read back is what was said."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crashgrid.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
TRICKY = [
    "", None, "plain", "\\### Assistant: </turn> ok", "</turn>\n### user:\nhi</turn>\n", "\\", "\\\\", "\\\\</turn>", "</tur", "n>", "### ", "####  ###",
    "a:b", "<</turn>", "é</turn>ü### 漢字\\", "line\nline\r\n", "</turn", "\\n", "🙂" * 5,
]


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def escaped(text, role=False):
    for mark in ["\\", "### ", "</turn>"] + [":"] * role:
        text = text.replace(mark, "\\" + mark)
    return text


def plain(rows):
    """conv_id -> (turns, digest, loss chars, loss digest, formatted text)"""
    out = {}
    key = lambda r: tuple((x is not None, x or (0 if i == 0 else "")) for i, x in enumerate((r[1], r[2], r[3])))
    for conv, _, role, text in sorted(rows, key=key):
        role, text = role or "", text or ""
        n, said, loss, formatted = out.get(conv, (0, "", "", ""))
        formatted += f"### {escaped(role, True)}:\n{escaped(text)}</turn>\n"
        out[conv] = (n + 1, said + f"{role}\n{text}\n", loss + text * (role == "assistant"), formatted)
    return out


def check(spark, rows, **options):
    formatted = chat.format_conversations(spark.createDataFrame(rows, SCHEMA))
    want = plain(rows)
    parts = formatted.collect()
    text, masked = {}, {}
    for p in parts:
        text[p.conv_id] = text.get(p.conv_id, "") + p.formatted
        masked.setdefault(p.conv_id, []).extend((s.start, s.end) for s in p.loss)
    assert text == {c: w[3] for c, w in want.items()}
    for c, spans in masked.items():
        assert "".join(chat.unescape(text[c][a:b]) for a, b in spans) == want[c][2]
    got = {r.conv_id: tuple(r)[1:] for r in chat.read_back(formatted, **options).collect()}
    assert got == {c: (n, H(said), len(loss), H(loss), len(f)) for c, (n, said, loss, f) in want.items()}
    return parts


def test_tricky_texts_roles_nulls_ties_and_repeats(spark):
    rows = [(i % 4, i // 4, ["user", "assistant", "a:b\\", None][i % 4 if i % 3 else 1], t) for i, t in enumerate(TRICKY * 2)]
    rows += [(None, 0, "assistant", "null id"), (None, None, "user", "null turn"), (9, 1, "assistant", "tie"), (9, 1, "assistant", "tie"), (9, 1, None, "b")]
    assert len(check(spark, rows, in_order=True)) == 6


def test_long_texts_and_long_conversations_are_parts(spark, monkeypatch):
    long = "word \\ </turn> é " * 100_000
    rows = [(1, i, ("user", "assistant")[i % 2], long if i in (3, 4) else f"t{i}" * 50) for i in range(8)]
    rows += [(2, i, ("user", "assistant")[i % 2], "x" * 700 + str(i)) for i in range(20_000)] + [(3, 0, "assistant", "")]
    parts = check(spark, rows)
    assert [p.part for p in parts if p.conv_id == 2] == list(range(sum(p.conv_id == 2 for p in parts)))
    assert sum(p.conv_id == 2 for p in parts) > 1 and max(len(p.formatted) for p in parts) < 3 * chat.PART_BYTES


def test_no_rows_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b")], SCHEMA)
    assert chat.format_conversations(df.limit(0)).collect() == []
    assert chat.read_back(chat.format_conversations(df.limit(0))).collect() == []
    wide = df.withColumns({c: F.lit(0) for c in ("conv", "part", "formatted", "loss", "n_turns")})
    assert chat.format_conversations(wide).collect() == chat.format_conversations(df).collect()


def test_foreign_text_is_an_error(spark):
    bad = chat.format_conversations(spark.createDataFrame([(1, 0, "user", "a")], SCHEMA)).withColumn("formatted", F.concat("formatted", F.lit("x")))
    with pytest.raises(Exception, match="not a turn"):
        chat.read_back(bad).collect()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="\\#< /turn>:é\nA漢", max_size=30), max_size=6))
def test_escaping_is_reversible(texts):
    import pyarrow as pa

    data, ends = chat._column_bytes(pa.array([*texts, None], pa.string()))
    data, ends = chat.escape(data, ends, chat.IN_TEXT)
    cut = [bytes(data[a:b]).decode() for a, b in zip([0, *ends], ends)]
    assert cut == [escaped(t) for t in [*texts, ""]]
    assert [chat.unescape(t) for t in cut] == [*texts, ""]
