"""Goldens and properties of section extraction, markup and text functions."""

import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerleaf.functions import markup as M, rules, text as X
from ledgerleaf.operators.catalog import header_pattern, items_for_filing
from ledgerleaf.operators.sections import collapsed, extract_section, sections_of, split_parts, Text

LONG = "word " * 30


def found(content, form):
    return {k: v for _, k, v in sections_of(content, form) if v}


def test_contents_list_is_not_taken():
    text = f"\nTABLE\nItem 1. Business 3\nItem 2. Properties 5\n\nITEM 1. BUSINESS\n{LONG}\nITEM 2. PROPERTIES\n{LONG}\nSIGNATURES\nBy x"
    got = found(text, "10-K")
    assert got["1"].startswith("ITEM 1. BUSINESS") and got["1"].endswith("word")
    assert got["2"].startswith("ITEM 2. PROPERTIES") and "SIGNATURES" not in got["2"]


def test_last_item_without_signature_runs_to_the_end():
    got = found(f"\nITEM 1. A\n{LONG}\nITEM 15. Exhibits\n{LONG} the end", "10-K")
    assert got["15"].endswith("the end")


def test_amended_controls_roman_numbers_and_spaced_letters():
    got = found(f"\nITEM 9A(T). Controls\n{LONG}\nITEM X. Directors\n{LONG}\nSIGNATURE\nx", "10-K")
    assert got["9A"].startswith("ITEM 9A(T).") and "1A" not in found(f"\nItem 1 A. x\n{LONG}\nITEM 2. y\nz", "10-K")
    assert got["10"].startswith("ITEM X.")


def test_adjacent_headers_share_no_line_end():
    assert Text("\nITEM 1\nITEM 2\n").spans("1", "2", 0) == []


def test_single_item_report_runs_to_the_end():
    assert found(f"\nItem 8.01. Other\n{LONG}", "8-K")["8.01"].startswith("Item 8.01.")


def test_parts_of_a_quarterly_report():
    body = f"\nPART I. FINANCE\nITEM 1. A\n{LONG}\nITEM 2. B\n{LONG}\nPART II. OTHER\nITEM 1. C\nx y z\nITEM 6. D\n{LONG}\nSIGNATURES\nBy x"
    got = found(body, "10-Q")
    assert got["part_1__1"].startswith("ITEM 1. A") and got["part_2__1"] == "ITEM 1. C\nx y z"
    assert got["part_2"].lstrip().startswith("PART II")


def test_missing_first_part_is_all_before_the_second():
    body = f"\nfinance {LONG}\nPART II. OTHER\nITEM 1. C\n{LONG}\nSIGNATURE\nBy x"
    assert split_parts(body)["part_1"].strip().startswith("finance")


def test_second_part_that_begins_in_the_contents_list():
    body = f"\nPART I. Finance 1\nPART II. Other 9\n\nPART I. FINANCE\n{'one ' * 3000}\nPART II. OTHER\n{'two ' * 50}\nSIGNATURE\nBy x"
    parts = split_parts(body)
    assert "one" in parts["part_1"] and parts["part_2"].count("two") == 50 and "one" not in parts["part_2"]


def spans_by_pattern(text, item, follower, offset, cased):
    """The plain reading: shortest stretches by one lazy pattern."""
    flags = re.DOTALL | (0 if cased else re.IGNORECASE)
    p = rf"\n{rules.BLANK}*{header_pattern(item)}[.*~\-:\s()].+?(\n{rules.BLANK}*{header_pattern(follower)}[.*~\-:\s(])"
    return [(offset + m.start(), offset + m.start(1), offset + m.end()) for m in re.finditer(p, text[offset:], flags)]


def test_offsets_give_what_the_lazy_pattern_gives():
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice(["\n", "ITEM 1", "Item 1", "ITEM 2", "item 2", "ITEM 1A", ".", " ", "x", "(", "\n\n"]) for _ in range(rng.randint(3, 18)))
        own = Text(text)
        for start in own.apart("1", r"[.*~\-:\s(]"):
            want = spans_by_pattern(text, "1", "2", start, True) or spans_by_pattern(text, "1", "2", start, False)
            assert own.spans("1", "2", start) == want, repr(text)


def test_sections_come_in_the_order_of_the_text():
    rng = random.Random(2)
    for _ in range(200):
        names = sorted(rng.sample(range(1, 9), 4))
        text = "".join(f"\nITEM {n}. H\n{LONG}" for n in names) + "\nSIGNATURE\nx"
        got = found(text, "10-K")
        assert [k for k in got if k != "SIGNATURE"] == [str(n) for n in names]


def test_cursor_keeps_sections_behind_each_other():
    text = Text(f"\nITEM 2. A\n{LONG}\nITEM 1. B\n{LONG}\nITEM 2. C\nx\nSIGNATURE\nx")
    cursor: list[int] = []
    assert extract_section(text, "1", ["2", "SIGNATURE"], cursor).startswith("\nITEM 1. B")
    assert extract_section(text, "2", ["SIGNATURE"], cursor).startswith("\nITEM 2. C")


def test_lines_collapse_as_with_the_repeated_group(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice(" \n\nab\t") for _ in range(rng.randint(0, 25))) for _ in range(500)] + ["a" + "\n" * 200_000 + "b"]

    def plain(t):
        t = re.sub(r"(( )*\n( )*){2,}", "#NEWLINE", t).replace("\n", " ")
        return re.sub(r"[ ]{2,}", " ", re.sub(r"(#NEWLINE)+", "\n", t).strip())

    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r[0]: r[1] for r in rows.select("i", X.collapse_lines(F.col("t"))).collect()}
    assert all(got[i] == plain(t) == collapsed(t) for i, t in enumerate(texts))


def test_cleaning_agrees_on_both_sides(spark):
    texts = ["\nP A R T  II x\nI T E M 7A- y\nSIGN ATURE ( s )  z", "\n-12-\n13\n14\n\nTABLE OF CONTENTS\n\nand f16 F-3\nPage 4\n x\x93\xa0", "", "plain"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert {r[0]: r[1] for r in rows.select("i", X.clean_text(F.col("t"))).collect()} == dict(enumerate(map(M.clean, texts)))


@pytest.mark.parametrize(
    ("html", "kept"),
    [
        ('<table><tr><td style="background-color:#CCEEFF">1</td></tr></table>', False),
        ('<table><tr bgcolor="#cceeff"><td>1</td></tr></table>', False),
        ('<table><tr><td style="background: WHITE">1</td></tr></table>', True),
        ("<table><tr><td>1</td></tr></table>", True),
        ('<table><tr><td bgcolor="red"><p>x</p>ITEM 1. y</td></tr></table>', True),
    ],
)
def test_coloured_tables(html, kept):
    root = M.tree(f"<div>a{html}</div>")
    M.drop_coloured_tables(root, ["1"])
    assert ("<table" in root.markup()) is kept


def test_implied_ends_give_closing_tags():
    assert M.tree("<p>a<p>b<ul><li>c<li>d</ul>").markup() == "<p>a</p><p>b</p><ul><li>c</li><li>d</li></ul>"


def test_unfinished_tail_is_lost():
    assert M.strip_tags("a<b>c</b>d<i") == "acd"


def test_cut_off_date_and_rejects(spark):
    rows = spark.createDataFrame([("8-K", "2004-08-22"), ("8-K", "2004-08-23"), ("8-K", "2004-08-24"), ("4", "2004-01-01"), ("10-K", "2004-01-01")], "Type string, Date string")
    got = items_for_filing(rows, ["1.01", "5"]).collect()
    assert [r["form"] for r in got] == ["8-K-old", "8-K-old", "8-K", None, "10-K"]
    assert [r["reject"] is None for r in got] == [True, True, True, False, True]
    assert [r["reject"] for r in items_for_filing(rows.where("Type = '10-K'"), ["1.01"]).collect()] == ["no item of this filing was asked for"]


def test_submission_with_several_documents(spark):
    doc = lambda kind, body: f"<DOCUMENT>\n<TYPE>{kind}\n{body}</DOCUMENT>\n" if kind else f"<DOCUMENT>\n{body}</DOCUMENT>\n"
    texts = [doc("10-K", "one") + doc("EX-10", "two") + doc("10-K/A", "three"), doc("EX-99", "x"), doc(None, "y") + doc("8-K", "z"), "bare"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r[0]: r[1] for r in rows.select("i", X.main_document(F.col("t"))).collect()}
    assert "three" in got[0] and "one" not in got[0]
    assert got[1] == texts[1] and "z" in got[2] and "y" not in got[2] and got[3] == "bare"


def test_making_filings_is_compiled(spark, sf):
    """Java leaves methods beyond 8000 bytes of code uncompiled for good."""
    from ledgerleaf.plans import synth as Y

    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else code is made only when a stage runs
    plans = [rows._jdf.queryExecution().executedPlan() for rows in (Y.filings(spark, sf), Y.case_filings(spark, sf), Y.case_filings(spark, sf, Y.ENDINGS, Y.ENDING_TYPES))]
    spark.conf.unset("spark.sql.adaptive.enabled")
    for plan in plans:
        found = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$").codegenStringSeq(plan)
        assert found.size() and all(found.apply(i)._3().maxMethodCodeSize() < 8000 for i in range(found.size()))


def test_items_without_a_line_cost_no_matching(monkeypatch):
    """Lines are told by what they name, once; no header of the other items is looked for."""
    from ledgerleaf.operators import sections as S

    asked = []
    matcher = S._matcher
    monkeypatch.setattr(S, "_matcher", lambda item, *more: asked.append(item) or matcher(item, *more))
    got = {k: v for _, k, v in sections_of(f"\nITEM 1. A\n{LONG}\nITEM 15. Exhibits\n{LONG}\nSIGNATURE\nBy x", "10-K") if v}
    assert set(got) == {"1", "15", "SIGNATURE"} and set(asked) == set(got)


def test_sections_collapse_as_the_column_does(spark):
    texts = ["", " ", "a \n b", "a  \n \n\n  b\nc", "#NEWLINE\n\n#NEWLINE", "\n\n a", "a \n\n", "x" + " \n" * 50 + "y", "a\n \t\nb  c"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", X.collapse_lines(F.col("t")).alias("y")).collect()
    assert {r["t"]: collapsed(r["t"]) for r in got} == {r["t"]: r["y"] for r in got}
