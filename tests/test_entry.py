import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from medlattice.plans import REGISTRY
from medlattice.sources.tables import TABLES

SMALL = "/root/testdata/sf0.001"
SLOW = {"random_walk_ranks", "random_walk_patients"}


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["patient_id", "label", "features"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(REGISTRY) <= set(E.queries())
    assert {name for name, spec in REGISTRY.items() if spec.oracle} <= set(E.oracle_sql())


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10]
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted({name for name, spec in REGISTRY.items() if spec.oracle} - SLOW))
def test_oracle_matches_small(spark, con, name):
    sdf = E.queries()[name](spark, SMALL).toPandas()
    odf = con.execute(E.oracle_sql()[name]).df()
    assert sorted(sdf.columns) == sorted(odf.columns)
    cols = sorted(sdf.columns)

    def rows(pdf):
        out = []
        for r in pdf[cols].itertuples(index=False, name=None):
            out.append(tuple(None if (x is None or x is pd.NA or x != x) else _norm(x) for x in r))
        return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))

    assert len(sdf) == len(odf)
    assert rows(sdf) == rows(odf)
