"""Quality rules: a threshold table compiled into one projection, no user functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .native import BLANKS, let, lines_of, words_of

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in is that it for on was be with as by this are or an at from "
    "le la les de des du et en un une que qui pour par au aux est "
    "der die das und ist von zu mit den ein eine auf nicht dem für "
    "el los las y del se por con una su al es lo"
).split()

SYMBOLS = "#*$%&|<>"
# Letters of the script the stop words are written in, marks that
# open a bullet line, marks that cut a line off.
LATIN = "[A-Za-z\u00C0-\u024F]"
BULLET = "^[-*\u2022\u2023\u25E6\u00B7\u2013]"
ELLIPSIS = "(\\.\\.\\.|\u2026)$"


@dataclass(frozen=True)
class Rule:
    """``metric``, a column of ``quality_rules``, must lie in [low, high]; a bound of
    None is open. Texts of under ``least_words`` words, or without the metric, are
    not judged by it: a ratio over few words says little."""

    metric: str
    low: float | None = None
    high: float | None = None
    least_words: int = 0


RULES = (
    Rule("n_words", low=10),
    Rule("mean_word_chars", low=2, high=20),
    Rule("symbols_per_word", high=0.1),
    Rule("stop_word_ratio", low=0.01, least_words=30),
    Rule("alpha_word_ratio", low=0.6, least_words=30),
    Rule("words_per_line", low=2, least_words=30),
    Rule("dup_line_ratio", high=0.5),
    Rule("bullet_line_ratio", high=0.9, least_words=30),
    Rule("ellipsis_line_ratio", high=0.3, least_words=30),
)


def _repeated_words(words: Column, window: int) -> Column:
    """Words inside windows of ``window`` words that occur twice or more.

    Hashes decide that a text repeats nothing, which holds for most; the
    others sort their windows, so equal ones are neighbours, and add up how far
    each repeated window reaches past the one before.
    """

    def exact(n: Column, w: Column) -> Column:
        spans = F.sort_array(
            F.transform(F.sequence(F.lit(0), n - window), lambda i: F.struct(F.concat_ws(" ", *[F.get(w, i + k) for k in range(window)]).alias("s"), i.alias("at")))
        )
        return let(
            spans,
            lambda s: let(
                F.sort_array(
                    F.transform(
                        F.filter(
                            F.sequence(F.lit(0), n - window),
                            lambda k: (F.get(s, k)["s"] == F.coalesce(F.get(s, k - 1)["s"], F.lit(""))) | (F.get(s, k)["s"] == F.coalesce(F.get(s, k + 1)["s"], F.lit(""))),
                        ),
                        lambda k: F.get(s, k)["at"],
                    )
                ),
                lambda p: F.aggregate(
                    F.sequence(F.lit(0), F.size(p) - 1),
                    F.lit(0),
                    lambda acc, k: acc + F.least(F.lit(window), F.coalesce(F.get(p, k + 1) - F.get(p, k), F.lit(window))),
                ),
            ),
        )

    def counted(w: Column) -> Column:
        n = F.size(w)
        hashes = F.transform(F.sequence(F.lit(0), n - window), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(window)]))
        repeats = let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
        return F.when(n < window + 1, F.lit(0)).when(repeats, exact(n, w)).otherwise(F.lit(0))

    return let(words, counted)


def quality_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES, window: int = 5
) -> DataFrame:
    """One row per input row: the base counts, the ratios, base_failed, the
    names of failed rules and ``kept``.

    Null and empty texts have no words and fail; ratios over no words or lines
    are 0. Stop words are listed for languages in Latin script only: a text of
    which under half the words have a Latin letter has no stop-word ratio and is
    not judged by it. Texts are read whole, however long. Repeated rows come back as often, null ids too; other columns are
    ignored; an empty table gives an empty result. The whole plan is one
    projection over the scan: no shuffle.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("id"), text.alias("text"), words_of(text).alias("words"), lines_of(text).alias("lines"))
    stops = F.size(F.filter("words", lambda w: F.lower(w).isin(STOP_WORDS)))
    count = lambda of, test: F.size(F.filter(of, test)).cast("long")
    counts = base.select(
        "id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeated_words(F.col("words"), window).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        stops.cast("long").alias("n_stop_words"),
        count("words", lambda w: w.rlike(r"\p{L}")).alias("n_alpha_words"),
        count("words", lambda w: w.rlike(LATIN)).alias("n_latin_words"),
        count("lines", lambda x: F.trim(x, F.lit(BLANKS)).rlike(BULLET)).alias("n_bullet_lines"),
        count("lines", lambda x: F.trim(x, F.lit(BLANKS)).rlike(ELLIPSIS)).alias("n_ellipsis_lines"),
    )

    def ratio(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    rated = counts.withColumns(
        {
            "mean_word_chars": ratio("word_chars", "n_words"),
            "symbols_per_word": ratio("n_symbols", "n_words"),
            "stop_word_ratio": F.when(2 * F.col("n_latin_words") >= F.col("n_words"), ratio("n_stop_words", "n_words")),
            "alpha_word_ratio": ratio("n_alpha_words", "n_words"),
            "words_per_line": ratio("n_words", "n_lines"),
            "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
            "bullet_line_ratio": ratio("n_bullet_lines", "n_lines"),
            "ellipsis_line_ratio": ratio("n_ellipsis_lines", "n_lines"),
            "base_failed": (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")),
        }
    )
    failed = F.array_compact(F.array(*[F.when(_breaks(r), F.lit(r.metric)) for r in rules]))
    return rated.withColumn("failed_rules", F.array_join(failed, ",")).select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("failed_rules") == "")).alias("kept"),
        "n_lines", "n_stop_words", "n_alpha_words", "n_latin_words", "n_bullet_lines", "n_ellipsis_lines", "failed_rules",
    )


def _breaks(rule: Rule) -> Column:
    out = F.lit(False)
    if rule.low is not None:
        out = out | (F.col(rule.metric) < F.lit(rule.low))
    if rule.high is not None:
        out = out | (F.col(rule.metric) > F.lit(rule.high))
    return out & (F.col("n_words") >= rule.least_words) if rule.least_words else out
