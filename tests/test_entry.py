import duckdb
import pytest

import __spark_entry__ as E
from lodestone.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["word", "count"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(pdf):
    pdf = pdf[sorted(pdf.columns)]
    pdf = pdf.astype(object).where(pdf.notna(), None)
    return sorted(tuple(repr(v) for v in r) for r in pdf.itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF).toPandas()
    ref = duck.sql(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(ref.columns)
    assert _norm(got) == _norm(ref)


def test_kernels_run_from_another_directory(tmp_path):
    # the driver may import this file from anywhere: executors must get the package
    import os
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import importlib.util
from pyspark.sql import SparkSession
spec = importlib.util.spec_from_file_location("e", "{repo}/__spark_entry__.py")
m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("ROWS", m.queries()["kmedoids_assign"](spark, "{SF}").count())
print("ROWS", m.queries()["odd_primes_upto_max_orderkey"](spark, "{SF}").count())
spark.stop()
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True,
                         text=True, timeout=600)
    rows = [line for line in out.stdout.splitlines() if line.startswith("ROWS")]
    assert len(rows) == 2 and all(int(r.split()[1]) > 0 for r in rows), out.stderr[-2000:]
