import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")
DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    scratch = tempfile.mkdtemp(prefix="spark-")
    conf = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": f"file://{scratch}/shared", "spark.local.dir": scratch, "spark.sql.warehouse.dir": f"{scratch}/warehouse", "spark.sql.session.timeZone": "UTC"}
    session = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{DATA}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return con


def table(rows):
    """Rows as sorted texts, columns by name: floats rounded, so that both engines' values compare."""
    tell = lambda v: "null" if v is None or v != v else f"{v:.9g}" if isinstance(v, float) else str(v)
    return sorted(tuple(tell(r[k]) for k in sorted(r)) for r in rows)


def same(df, duck, sql):
    got = duck.execute(sql)
    names = [x[0] for x in got.description]
    assert sorted(df.columns) == sorted(names)
    assert table([r.asDict() for r in df.collect()]) == table([dict(zip(names, r, strict=True)) for r in got.fetchall()])
