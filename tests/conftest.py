import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def same(spark_rows, sql: str, sf: str = SF) -> bool:
    """Whether rows equal what DuckDB gives for ``sql`` over the tables of ``sf``."""
    import duckdb

    con = duckdb.connect()
    for name in os.listdir(sf):
        con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{sf}/{name}'")
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    order = sorted(names)
    text = lambda v: repr(round(v, 9)) if isinstance(v, float) else str(v)
    ours = sorted(tuple(text(r[c]) for c in order) for r in spark_rows)
    theirs = sorted(tuple(text(row[names.index(c)]) for c in order) for row in got.fetchall())
    return ours == theirs
