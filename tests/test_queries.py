"""Every query of the reference's operators runs; those with SQL equal it."""

import duckdb
import pytest

from tessera.plans import catalog


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in "documents labels conversations benchmark embeddings pages events".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def canonical(rows):
    return sorted(tuple("null" if v is None else f"{v:.6f}" if isinstance(v, float) else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, sf, duck, name):
    got = catalog.QUERIES[name](spark, sf)
    names = sorted(got.columns)
    rows = [tuple(r) for r in got.select(*names).collect()]
    if name in catalog.SQL:
        want = duck.execute(f"SELECT {', '.join(names)} FROM ({catalog.SQL[name]})").fetchall()
        assert canonical(rows) == canonical(want)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_library_does_not_need_the_subpackage():
    import pathlib

    import tessera

    root = pathlib.Path(tessera.__file__).parent
    assert not [p for p in root.rglob("*.py") if "llm" not in p.parts and "llm" in p.read_text("utf-8")]
