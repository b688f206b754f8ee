import re

from crashgrid.llm import quality as Q


def slow(text):
    t = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", t)
    lines = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    wins = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(wins) if wins.count(w) > 1 for k in range(5)}
    return (len(words), sum(map(len, words)), sum(c in Q.SYMBOLS for c in t), len(lines) - len(set(lines)), len(covered))


CASES = [
    "", None, " \t\n", "a", "a a a a a", "a a a a a a", "a b c d e a b c d e", "a b c d e f a b c d e g a b c d e", "x y x y x y x y x",
    "# $ % & | < > *##", "one\none\n\none \n \n", "é😀 ñ \x0bb\x0cc\rd", "the of and to in is that it for on was", "a b c d", "p q r s t\n" * 40,
    "k l m n o p k l m n o p k l m", " ".join(f"w{i}" for i in range(500)), "\x00 a\x1fb",
]


def test_counts_equal_brute_force(spark):
    docs = spark.createDataFrame([(i, t, [1]) for i, t in enumerate(CASES)], "doc_id long, text string, words array<int>")
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in Q.quality_rules(docs).collect()}
    assert got == {i: slow(t) for i, t in enumerate(CASES)}


def test_verdicts(spark):
    good = "The cat sat on the mat and looked at the moon that was bright in the sky."
    rows = [(1, good), (1, good), (None, good), (2, "the cat"), (3, good + " #" * 40), (4, " ".join(f"zx{i}" for i in range(40))), (7, "zx qv kw zz xq vk jj qq ww vv xx zk"), (5, (good + "\n") * 5), (6, "the " + "x" * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.base_failed, r.kept) for r in Q.quality_rules(docs).collect()), key=str)
    want = [(1, False, True)] * 2 + [(None, False, True), (2, True, False), (3, True, False), (4, False, False), (7, False, True), (5, True, False), (6, True, False)]
    assert got == sorted(want, key=str)
    assert Q.quality_rules(docs.limit(0)).count() == 0


def test_pipe_lists_fail_and_prose_stays(spark):
    good = "The cat sat on the mat and looked at the moon that was bright in the sky."
    rows = [(1, " | ".join(good.split())), (2, good + "\n" + " | ".join(["the", "moon", "and", "sky"] * 2 + ["is"])), (3, good), (4, good + " It cost $5 & more.")]
    got = {r.doc_id: (r.failed_rules, r.kept) for r in Q.quality_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: ("symbols_per_word,alpha_word_ratio", False), 2: ("symbols_per_word", False), 3: ("", True), 4: ("", True)}


def test_one_native_projection(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = Q.quality_rules(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_ratios_judge_what_they_can(spark):
    """Texts in a script without a stop-word list are kept; lists of words, bullets
    and cut-off lines are not; nor are texts of few words with letters."""
    russian = "это обычный текст о том как люди живут и работают в большом городе каждый день " * 4
    prose = "the people of the town went to the market and bought what they could find for the day " * 3 + "\n"
    varied = "\n".join(f"a line number {i} of the text that stands for itself and says {i * 7}" for i in range(12))
    cases = {
        1: russian.replace("день", "день {}").format(1, 2, 3, 4), 2: varied, 3: "\n".join(f"item{i}" for i in range(40)),
        4: "\n".join(f"- the point {i} of this list is one that stands alone" for i in range(12)),
        5: "\n".join(f"the story {i} goes on and is cut off here ..." for i in range(12)),
        6: " ".join(f"{i} {i + 1} the" if i % 2 else f"{i} -- word{i}" for i in range(30)), 7: "一 二 三 四 五 六 七 八 九 十 " * 4, 8: prose,
    }
    docs = spark.createDataFrame(list(cases.items()), "doc_id long, text string")
    got = {r.doc_id: r for r in Q.quality_rules(docs).collect()}
    assert "stop_word_ratio" not in got[1].failed_rules and "stop_word_ratio" not in got[7].failed_rules
    assert not got[2].failed_rules and got[8].failed_rules == ""
    assert "words_per_line" in got[3].failed_rules and "bullet_line_ratio" in got[4].failed_rules and "ellipsis_line_ratio" in got[5].failed_rules
    assert "alpha_word_ratio" in got[6].failed_rules and got[6].n_alpha_words < 0.6 * got[6].n_words
