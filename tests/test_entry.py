"""Every registered query against its SQL counterpart on the smallest tables."""

import os

import pandas as pd
import pytest

import __spark_entry__ as driver

duckdb = pytest.importorskip("duckdb")
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def canonical(frame):
    columns = sorted(frame.columns)
    clean = lambda v: None if pd.api.types.is_scalar(v) and pd.isna(v) else v
    return columns, sorted((tuple(clean(v) for v in row) for row in frame[columns].astype(object).values.tolist()), key=repr)


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query(spark, con, name):
    got = driver.queries()[name](spark, SF).toPandas()
    sql = driver.oracle_sql().get(name)
    if sql is None:
        assert len(got) > 0
    else:
        assert canonical(got) == canonical(con.sql(sql).df())


def test_entry(spark):
    assert driver.entry(spark).columns == ["term", "concept", "score", "rank"]


def test_every_oracle_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", ["cut_dump_rejects", "statements_namespaces", "concepts_job_rejects"])
def test_dumps_have_several_files(spark, monkeypatch, name):
    """No dump is made in one group or one task."""
    paths, path_of = [], driver.stage_path
    monkeypatch.setattr(driver, "stage_path", lambda s, n: paths.append((n, path_of(s, n))) or paths[-1][1])
    driver.queries()[name](spark, SF).collect()
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(dict(paths)["dumps"]).select("path").collect()
    folders = [f["path"].rsplit("/", 1)[0] for f in files]
    assert folders and all(folders.count(f) > 1 for f in folders)
