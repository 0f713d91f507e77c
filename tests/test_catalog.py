"""Every registered query of the engine against its SQL, on the smallest tables."""

import datetime
import math
from pathlib import Path

import duckdb
import pytest

from graniteloom.plans import catalog, registry

SF = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no tables")


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, str(SF))
    columns = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in columns) for r in df.collect()), key=repr)
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    out = duck.execute(sql)
    names = [d[0] for d in out.description]
    assert sorted(names) == columns
    want = sorted((tuple(norm(r[names.index(c)]) for c in columns) for r in out.fetchall()), key=repr)
    assert got == want


def test_fused_scores_round_as_the_sql_does(spark, duck, monkeypatch):
    """Scores of six places that end in 50, as ties in decimal aren't ties in doubles."""
    scores = [(10 * i + 5) / 100_000 for i in range(20_000)]
    rows = [("s", str(i), 1, 1, x, "ok") for i, x in enumerate(scores)]
    found = spark.createDataFrame(rows, "source_id string, chunk_id string, rank int, source_count int, fused double, knn_status string")
    monkeypatch.setattr(catalog.hybrid, "by_repo", lambda *a: found)
    got = {int(r["chunk_id"]): r["fused"] for r in catalog.hybrid_by_repo(spark, str(SF)).collect()}
    want = duck.execute("SELECT i, round((10 * i + 5) / 100000, 4) FROM range(20000) AS r(i)").fetchall()
    assert got == dict(want)


def test_entry(spark):
    import __spark_entry__ as entry

    assert registry.flagship(spark, str(SF)).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
