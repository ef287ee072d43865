"""Patterns against Python's ``re`` on random texts, and the documented cases."""

import random
import re

from pyspark.sql import functions as F

from docloom.functions import math as latex
from docloom.functions import text as tx
from docloom.functions.segments import map_matches, map_outside


def fuzz(parts, n, seed=1, longest=30):
    r = random.Random(seed)
    return ["".join(r.choice(parts) for _ in range(r.randint(0, longest))) for _ in range(n)]


def through(spark, texts, change):
    df = spark.createDataFrame(list(enumerate(texts)), "i long, x string")
    got = {r.i: r.y for r in df.select("i", change(F.col("x")).alias("y")).collect()}
    return [got[i] for i in range(len(texts))]


def test_patterns_like_python(spark):
    texts = fuzz(["•", " ", "\t", "-", "* ", "\n", "\r", "\x85", " ", "a", "# AND12345/D", "## confidential AND proprietary x", "12", "\n\n", "٣"], 400)
    assert through(spark, texts, tx.bullets) == [re.sub(r"(?m)^([ \t]*)•[ \t]+", r"\1- ", re.sub(r"(?m)^([ \t]*[-*+][ \t]+)•[ \t]+", r"\1", t)) for t in texts]
    assert through(spark, texts, tx.strip_trailing_pageno) == [re.sub(r"\n{2,}\d{1,4}[ \t]*\Z", "\n", t) for t in texts]
    want = re.compile(r"(?mi)^[ \t]{0,3}#{1,6}[ \t]+(?:AND\d{5,}/D|CONFIDENTIAL AND PROPRIETARY[^\n]*)[ \t]*\n?")
    assert through(spark, texts, tx.strip_page_headers) == [want.sub("", t) for t in texts]


def test_number_runs(spark):
    def brute(text):
        lines = re.findall(r"[^\n]*\n|[^\n]+\Z", text)
        number = [bool(re.fullmatch(r"[ \t]*[0-9][0-9|.,:; \t-]*[ \t]*\n?", x)) for x in lines]
        keep, i = [], 0
        while i < len(lines):
            j = i
            while j < len(lines) and number[j] == number[i]:
                j += 1
            if not number[i] or j - i < 6:
                keep += lines[i:j]
            i = j
        return "".join(keep)

    texts = fuzz(["1", "2.5", " 3 ", "\n", "\n", "\n", "4|5", "a", "|6", "- "], 600, longest=50) + ["1\n" * 5, "1\n" * 6, "x\n" + "1\n" * 7 + "2"]
    got = through(spark, texts, tx.drop_number_runs)
    assert got == list(map(brute, texts)) and any(a != b for a, b in zip(got, texts))


def test_segments(spark):
    texts = fuzz(["```", "~~~", "\n", "a", "$1\\", "b"], 200) + [None, ""]
    fence = re.compile(r"(```.*?```|~~~.*?~~~)", re.S)
    up = lambda t: t if t is None else "".join(p if k % 2 else p.upper() for k, p in enumerate(fence.split(t)))
    assert through(spark, texts, lambda c: map_outside(c, tx.FENCE, F.upper)) == list(map(up, texts))
    assert through(spark, ["a$1b\\"], lambda c: map_matches(c, r"\$1", lambda m: F.concat(m, F.lit("\\$2")))) == ["a$1\\$2b\\"]


def test_despace(spark):
    cases = {r"\mu A": r"\mu A", r"\max  off": r"\max off", "R _ { B }": "R_{B}", "a \\": "a", "\\ x": "\\ x", "\\alpha\n x": "\\alpha x", "\\alpha 1": "\\alpha1", "\\\\ x": "\\\\x", "é ü": "éü", "\\a é": "\\a é", "": "", "\\, x": "\\,x"}
    assert through(spark, list(cases), latex.latex_despace) == list(cases.values())


def test_labels_and_alts(spark):
    labels = {"x\nEquation 12.\n\n": True, "[Equation 80]\n": False, "Eq. (3):\nGUID-1-low.gif\n": True, "Equation 12": False, "Equation 1\n" + "y" * 90 + "\n": False, "": False}
    df = spark.createDataFrame(list(enumerate(labels)), "i long, x string")
    got = {r.i: r.y for r in df.select("i", tx.preceded_by_equation_label(F.col("x"), F.length("x")).alias("y")).collect()}
    assert [got[i] for i in range(len(labels))] == list(labels.values())
    alts = {" a \n b ": "a b", "": None, " ": None, "<bound method x": None, "see data:image": None, "x" * 301: None, "x" * 300: "x" * 300}
    assert through(spark, [*alts, None], tx.alt_sanitize) == [*alts.values(), None]


LONG = 100_000


def test_long_texts(spark):
    """No pattern recurses or goes back over and over: each takes a text of many lines or blanks in one task."""
    numbers, blanks, feeds = "1 2\n" * LONG, " " * LONG, "\n" * LONG
    texts = ["x\n" + numbers + "y", numbers, "\r" + numbers, blanks, "a" + blanks + "b", feeds + "x", "x" + feeds + "12", "```" + blanks, "• " * LONG, "a <sub>" * LONG]
    assert through(spark, texts[:3], tx.drop_number_runs) == ["x\ny", "", "\r"]
    assert through(spark, texts[3:5], tx.strip) == ["", texts[4]]
    assert through(spark, texts[5:7], tx.strip_trailing_pageno) == [texts[5], "x\n"]
    assert [len(x) for x in through(spark, texts, tx.clean_markdown)] == [3, 0, 1, LONG, LONG + 2, LONG + 1, 2, LONG + 3, 2 * LONG, 7 * LONG]
    assert through(spark, texts[-1:], tx.subsup_tighten) == ["a<sub>" + "a<sub>" * (LONG - 1)]
    formulas = ["\\alpha" + blanks + "x", "\\alpha" + "\n\\" * LONG + "\nx", "$$" + "a\n" * LONG + "$$", "$" + "a " * LONG + "$"]
    assert through(spark, formulas[:1], latex.latex_despace) == ["\\alpha x"]
    assert len(through(spark, formulas, latex.latex_despace)[1]) < 20
    assert through(spark, formulas[2:], lambda c: F.size(latex.math_spans(c)).cast("string")) == ["1", "1"]
    assert through(spark, ["GUID-1.gif\n" * LONG, "x"], tx.drop_guid_lines) == ["", "x"]


def test_number_runs_after_any_line_separator(spark):
    seven = "7\n" * 6
    for c in "\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029":
        assert through(spark, ["a" + c + seven + "b"], tx.drop_number_runs) == ["a" + c + "b"], repr(c)
    for c in ("\t", " ", "x", "\u00a0"):
        assert through(spark, ["a" + c + "7\n" * 6 + "b"], tx.drop_number_runs) == ["a" + c + "7\n" * 6 + "b"], repr(c)


def test_unwrap():
    cases = {
        r"\mathsf{a}": "a", r"\mathsf{a\mathsf{b}}c": "abc", r"\mathrm{a": r"\mathrm{a", r"\times\mathrm{N}": r"\times N", r"\times\mathrm{1}": r"\times1", r"\mathsf{}x": "x",
        r"\mathsf{a}\mathsf{b": r"a\mathsf{b", r"\mathrm{a\mathsf{b}}": "ab", r"{\mathsf{a}}": "{a}", r"}\mathsf{a}": "}a", r"\mathsf{\mathsf}{x}": "x", r"\mathsf\mathsf{{x}}": "x", r"\mathsf\mathsf{{": r"\mathsf\mathsf{{",
        r"\x\mathsf{\mathsf{b}}": r"\x b", r"\x\mathsf{\mathsf{}b}": r"\xb", r"\mathsf {a}": r"\mathsf {a}", "": "", r"\mathsf{é}": "é", r"\x\mathrm{é}": r"\x é",
    }
    assert {k: latex.unwrap(k) for k in cases} == cases
    deep = r"\mathsf{" * 20000 + "a" + "}" * 20000
    assert latex.unwrap(deep) == "a" and latex.unwrap(r"\mathsf{" * 20000) == r"\mathsf{" * 20000 and latex.unwrap(r"\mathrm{a}" * 20000) == "a" * 20000


def test_a_pattern_is_run_once(spark):
    """The passes behind the HTML parser read a column: no pattern stands in the plan for each use of its result."""
    from docloom.plans.convert import text_pipeline
    from docloom.sources.html import with_markdown

    pages = spark.createDataFrame([(1, "<p>x</p>")], "id long, html string")
    plan = text_pipeline(with_markdown(pages, "html"))._jdf.queryExecution().executedPlan().toString()
    for pattern in ("{6,}", "CONFIDENTIAL AND PROPRIETARY", "four-layer"):
        assert plan.count(pattern) == 1, pattern
