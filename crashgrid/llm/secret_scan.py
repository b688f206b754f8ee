"""Secret scans: certain patterns, and weak parts linked into credentials.

Every step is a built-in column function, a join or a grouping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .native import let, matches_of
from .shared import Scratch, free_name, row_key


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# Patterns. Kinds are listed in the order that breaks ties.
ASSIGN = (
    "(" + "|".join(map(_any_case, ("password", "passwd", "secret", "token"))) + "|" + _any_case("api") + "_?" + _any_case("key") + ")"
    "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = "AKIA[A-Z0-9]{16,}"  # 20 characters or more: a shorter run holds no longer one
HEX = "[0-9a-f]{24,}"
WEAK_ACCESS = (
    "A[KS]IA[A-Z0-9]{8,}"
    "|(user|username|login|client_id|access_key_id|account_id|USER|USERNAME|LOGIN|CLIENT_ID|ACCESS_KEY_ID|ACCOUNT_ID)"
    "[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9_.@-]{3,}"
)
WEAK_SECRET = (
    "(pwd|pass|key|credential|signature|PWD|PASS|KEY|CREDENTIAL|SIGNATURE)[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9+/_.=-]{4,}"
    "|[A-Za-z0-9+/]{32,}"
)
ENDPOINT = (
    "(http|https|ftp|ssh|postgres|postgresql|mysql|mongodb|redis|amqp)://[A-Za-z0-9_.:@/-]{4,}"
    "|(host|server|endpoint|HOST|SERVER|ENDPOINT)[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9_.:/-]{4,}"
)

KINDS = ("assign", "access", "hex", "weak_access", "weak_secret", "endpoint")
BASE_KINDS = 3
ROLES = ("secret", "access", "secret", "access", "secret", "endpoint")
SPAN = "array<struct<start:int,rank:int,end:int>>"


def _ranked(spans: Column, rank: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end")))


def _listed(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"], s["end"])), ",")


def find_parts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per input row: id, key (a digest of id and text), the certain
    spans and the weak candidates."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), text.alias("text"))
    t = F.col("text")
    base = [matches_of(t, ASSIGN, lambda m, value: F.length(value) >= 6), matches_of(t, ACCESS), matches_of(t, HEX)]
    weak = [matches_of(t, p) for p in (WEAK_ACCESS, WEAK_SECRET, ENDPOINT)]
    return rows.select(
        "id", "key",
        F.sort_array(F.concat(*[_ranked(s, r) for r, s in enumerate(base)])).cast(SPAN).alias("base"),
        F.concat(*[_ranked(s, r + BASE_KINDS) for r, s in enumerate(weak)]).cast(SPAN).alias("weak"),
    )


def link_weak(parts: DataFrame, scope: int) -> DataFrame:
    """(key, weak): the weak candidates whose complementary parts lie within ``scope`` code points.

    An interval join: spans go to every stretch of ``scope`` code points they
    or their surroundings touch, and meet in equal (key, stretch). A stretch
    holds no more spans than fit into it, whatever the document's length.
    """
    some = parts.where((F.size("weak") > 0) & (F.size("weak") + F.size("base") > 1)).dropDuplicates(["key"])
    spans = some.select("key", F.inline(F.concat("base", "weak")))

    def spread(df: DataFrame, margin: int) -> DataFrame:
        lo, hi = F.floor((F.col("start") - margin) / scope), F.floor((F.col("end") + margin) / scope)
        return df.withColumn("stretch", F.explode(F.sequence(lo, hi)))

    is_weak = F.col("rank") >= BASE_KINDS
    at = spread(spans.where(~is_weak), 0).alias("b")
    over = (F.col("w.start") < F.col("b.end")) & (F.col("b.start") < F.col("w.end"))
    match = (F.col("w.key") == F.col("b.key")) & (F.col("w.stretch") == F.col("b.stretch"))
    covered = (
        spread(spans.where(is_weak), 0).alias("w").join(at, match & over).select("w.key", "w.start", "w.rank", "w.end").distinct()
    )
    weak = spans.where(is_weak).join(covered, ["key", "start", "rank", "end"], "left_anti")
    role = F.element_at(F.array(*[F.lit(r) for r in ROLES]), F.col("rank") + 1)
    known = spread(spans.where(~is_weak).unionByName(weak), scope).withColumn("role", role).alias("b")
    gap = F.greatest(F.col("b.start") - F.col("w.end"), F.col("w.start") - F.col("b.end"))
    near = spread(weak, 0).alias("w").join(known, match & (gap <= scope))
    has = lambda r: F.max(F.col("b.role") == r)
    judged = near.groupBy("w.key", "w.start", "w.rank", "w.end").agg(has("access").alias("access"), has("secret").alias("secret"))
    # an identifier needs a secret, a secret an identifier, an endpoint both
    told = (
        F.when(F.col("rank") == KINDS.index("weak_access"), F.col("secret"))
        .when(F.col("rank") == KINDS.index("weak_secret"), F.col("access"))
        .otherwise(F.col("access") & F.col("secret"))
    )
    return judged.where(told).groupBy("key").agg(F.collect_list(F.struct("start", "rank", "end")).cast(SPAN).alias("linked"))


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = 200) -> DataFrame:
    """One row (id, key, base, spans) per input row; spans are arrays of
    (start, rank in KINDS, end), code points, end exclusive; ``spans`` holds
    the certain ones and the linked weak ones.

    Null and empty texts hold none. Repeated rows come back as often, null ids
    too; other columns are ignored; an empty table gives an empty result.
    """
    parts = Scratch(docs.sparkSession, "secrets").write(find_parts(docs, id_col, text_col), "parts")
    linked = link_weak(parts, scope)
    whole = parts.select("id", "key", "base").join(linked, "key", "left")
    return whole.select(
        F.col("id").alias(id_col), "key", "base",
        F.sort_array(F.concat("base", F.coalesce("linked", F.array().cast(SPAN)))).alias("spans"),
    )


def scan_report(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts per certain kind, a digest of the certain spans and all spans as text."""
    count = lambda r: F.size(F.filter("base", lambda s: s["rank"] == r)).cast("long").alias(f"n_{KINDS[r]}")
    return found.select(
        id_col, count(0), count(1), count(2), F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans")
    )


# Code points of the blocks that a text is cut into, coarse and then fine.
COARSE, FINE = 1 << 14, 1 << 8


def _blocks(text: Column) -> Column:
    """A text that is not empty in blocks of FINE code points, in order. Cutting at
    a place walks there from the start, so it is done in two steps."""
    cut = lambda t, size: F.transform(
        F.sequence(F.lit(0), F.floor((F.length(t) - 1) / size).cast("int")), lambda i: F.substring(t, i * size + 1, F.lit(size))
    )
    return F.flatten(F.transform(cut(text, COARSE), lambda t: cut(t, FINE)))


def _reached(spans: Column) -> Column:
    """Of each span: the furthest end of those before it, 0 for the first. Maxima of
    blocks keep m spans at m * sqrt(m) steps."""

    def of(ends: Column) -> Column:
        def by_block(b: Column) -> Column:
            count = F.floor((F.size(ends) - 1) / b).cast("int")
            most = F.transform(F.sequence(F.lit(0), count), lambda q: F.array_max(F.slice(ends, q * b + 1, b)))
            return let(most, lambda m: F.transform(ends, lambda e, k: let(
                F.floor(k / b).cast("int"),
                lambda q: F.greatest(
                    F.lit(0), F.array_max(F.slice(m, F.lit(1), q)), F.array_max(F.slice(ends, q * b + 1, k - q * b))),
            )))

        return let(F.ceil(F.sqrt(F.size(ends))).cast("int"), by_block)

    return let(F.transform(spans, lambda s: s["end"]), of)


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with each stretch that sorted ``spans`` cover replaced by ``mark``.

    The gaps between stretches are cut from the text's blocks, and all pieces
    are joined once: the work grows with the text and the spans, not with
    their product. No spans: the text as it is."""

    def pieces(blocks: Column, reached: Column) -> Column:
        def cut(a: Column, b: Column) -> Column:
            i, j = F.floor(a / FINE).cast("int"), F.floor(b / FINE).cast("int")
            inside = F.substring(F.get(blocks, i), a - i * FINE + 1, b - a)
            across = F.concat(
                F.substring(F.get(blocks, i), a - i * FINE + 1, F.lit(FINE)), F.array_join(F.slice(blocks, i + 2, j - i - 1), ""),
                F.coalesce(F.substring(F.get(blocks, j), F.lit(1), b - j * FINE), F.lit("")),
            )
            return F.when(b <= a, "").when(i == j, inside).otherwise(across)

        fresh = F.filter(F.transform(spans, lambda s, k: F.struct(F.get(reached, k).alias("a"), s["start"].alias("b"))), lambda g: g["b"] >= g["a"])
        end = F.greatest(F.element_at(reached, -1), F.element_at(spans, -1)["end"])
        return F.concat(F.array_join(F.transform(fresh, lambda g: F.concat(cut(g["a"], g["b"]), F.lit(mark))), ""), cut(end, F.length(text)))

    whole = let(_blocks(text), lambda blocks: let(_reached(spans), lambda reached: pieces(blocks, reached)))
    return F.when((F.size(spans) == 0) | (F.length(text) == 0), text).otherwise(whole)


def redact_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars", scope: int = 200) -> DataFrame:
    """All rows and columns of ``docs`` with every span replaced in ``text_col``
    and ``chars_col`` (if there is one) counted anew where a text changed. Cases
    as in ``secret_spans``; a null text stays null."""
    key, spans = free_name(docs, "row_key"), free_name(docs, "secret_spans")
    found = secret_spans(docs, id_col, text_col, scope).where(F.size("spans") > 0)
    found = found.select(F.col("key").alias(key), F.col("spans").alias(spans)).dropDuplicates([key])
    rows = docs.withColumn(key, row_key(id_col, text_col)).join(found, key, "left")
    text = F.when(F.col(spans).isNotNull(), redact(F.col(text_col), F.col(spans))).otherwise(F.col(text_col))
    rows = rows.withColumn(text_col, text)
    if chars_col in docs.columns:
        kind = dict(docs.dtypes)[chars_col]
        rows = rows.withColumn(chars_col, F.when(F.col(spans).isNotNull(), F.length(text_col).cast(kind)).otherwise(F.col(chars_col)))
    return rows.select(*docs.columns)
