"""Fill-in-middle against a plain version over code points."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from llm_common import CLASHES, LONG, SCHEMA, awkward, empty
from pyspark.sql import functions as F

from ledgerleaf.llm import fill_in_middle as M


def plain(key, text, plain_share=10, spm_share=20):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(h[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 100 - plain_share:
        return len(units), "plain", None, None, text
    if h[3] % 100 < spm_share:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


WORDS = st.lists(st.text(alphabet="aZ@[`{ 0\n\t\x00\x7fßé漢\U0001f600<P>", max_size=40), min_size=1, max_size=6)


@settings(max_examples=300, deadline=None)
@given(WORDS)
def test_every_cut_is_where_the_units_end(texts):
    u = M.Units([t.encode() for t in texts])
    units = [re.findall(r"[A-Za-z]+|[^A-Za-z]", t) for t in texts]
    assert u.n.tolist() == list(map(len, units))
    for k in range(max(map(len, units)) + 1):
        want = ["".join(x[:k]) for x in units]
        size, points = u.cut(np.minimum(k, u.n))
        assert size.tolist() == [len(w.encode()) for w in want] and points.tolist() == list(map(len, want))


AWKWARD = ["", "x", "<P>", "a<S>b", "<P <M", "12345678", "abcdefgh", "abcdefgh i", "é" * 9, "\x00\x00", "A" * 5000 + "!", LONG]


@pytest.mark.parametrize("step", [1 << 20, 10])
def test_rows_are_those_of_the_plain_version(monkeypatch, step):
    monkeypatch.setattr(M, "STEP", step)
    keys = list(range(40)) + [None]
    rows = [(k, t) for k in keys for t in AWKWARD]
    draws = []
    for k, _ in rows:
        h = hashlib.sha256(f"1:{'' if k is None else k}".encode()).hexdigest()
        draws.append([int(h[8 * i : 8 * i + 8], 16) for i in range(4)])
    got = M._transform(pa.array([t for _, t in rows]), [pa.array([d[i] for d in draws]) for i in range(4)], 10, 20)
    assert list(zip(*(c.to_pylist() for c in got), strict=True)) == [plain(k, t) for k, t in rows]


def test_awkward_tables(spark):
    rows = awkward(spark).withColumns({"N": F.lit(1), "Form": F.lit("x"), "_cut": F.lit(2), "k0": F.lit(3)})
    out = M.fill_in_middle(rows)
    assert set(CLASHES) - {"n"} <= set(out.columns) and {"_cut", "k0"} <= set(out.columns) and not {"N", "Form"} & set(out.columns)
    got = out.withColumn("back", M.restored(F.col("output"), F.col("form"))).collect()
    assert sorted(repr((r["doc_id"], *plain(r["doc_id"], r["text"]))) for r in got) == sorted(repr((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"])) for r in got)
    assert all(r["back"] == (r["text"] or "") and r["_cut"] == 2 for r in got)
    assert M.fill_in_middle(empty(spark)).collect() == []


def test_every_form_is_restored(spark):
    rows = spark.createDataFrame([(i, f"one <two> {i} <<P S> <M\n", None, None) for i in range(200)], SCHEMA)
    for share, want in ((0, {"psm", "spm"}), (100, {"plain"})):
        got = M.fill_in_middle(rows, plain_share=share, spm_share=50).withColumn("back", M.restored(F.col("output"), F.col("form"))).collect()
        assert {r["form"] for r in got} == want and all(r["back"] == r["text"] for r in got)
