"""Every registered query of the library against its SQL on the smallest tables."""

import duckdb
import pytest

from ledgerleaf.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(round(r[i], 9) if isinstance(r[i], float) else r[i] for i in order)) for r in rows)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query_gives_the_rows_of_its_sql(spark, sf, duck, name):
    got = registry.queries()[name](spark, sf)
    want = duck.execute(registry.oracle_sql()[name])
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    assert plain([tuple(r) for r in got.collect()], got.columns) == plain(want.fetchall(), names)


def test_entry_is_a_query(spark):
    import __spark_entry__

    assert set(__spark_entry__.entry(spark).columns) == {"filename", "out_key", "section_text"}


def test_quarterly_cases_reach_every_repair(duck):
    """Of the reports by case, some take each way: a list that is passed over, a gap that is filled, an excess that is not mended."""
    from ledgerleaf.plans import synth as Y

    rows = duck.execute(f"WITH {Y.CASES_SQL} SELECT doc_id % 5 AS c, length(part_1) AS one, length(part_2) AS two FROM cases").fetchall()
    by = {c: [(a, b) for k, a, b in rows if k == c] for c in range(5)}
    assert all(a > 12 for a, _ in by[0])
    assert {a > 100 for a, _ in by[1]} == {True, False} and {a > 100 for a, _ in by[2]} == {True, False}
    assert {b - a > 5000 for a, b in by[3]} == {True, False} and all(a > 10 and b > 10 for a, b in by[4])
