import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, str(Path(__file__).parent), os.environ.get("PYTHONPATH", "")])

SMALL = "/root/testdata/sf0.001"
NAMES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "captions", "segments", "speakers", "matches",
         "concepts", "ref_concepts", "source_trust", "token_limits"]


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[4]").appName("talespan-tests").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for n in NAMES:
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM '{SMALL}/{n}.parquet'")
    return con


def canonical(rows):
    """Rows as a sorted list of comparable tuples."""

    def plain(v):
        if v is None or v != v:
            return ""
        if isinstance(v, bool):
            return str(v)
        if isinstance(v, float):
            return repr(round(v, 6))
        return str(v)

    return sorted(tuple(plain(v) for v in r) for r in rows)


def assert_same(df, con, sql):
    """A data frame holds the rows of a DuckDB query."""
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    want = canonical([[r[names.index(c)] for c in order] for r in cur.fetchall()])
    got = canonical([[r[c] for c in order] for r in df.collect()])
    assert got == want
