"""The range-clustered sink."""

from __future__ import annotations

import datetime as dt
import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from courtgrid.sources.tables import write_clustered

BY = ["client_code", "start"]
FILES = 40


def _mart(spark, n=40_000):
    """A third of the rows is one tenant's, and a tenth of those one instant's."""
    k = F.col("id")
    start = F.timestamp_seconds(F.lit(1_735_689_600) + F.when(k % 30 == 0, 0).otherwise(F.hash("id") % 1_296_000))
    return spark.range(n).select(F.when(k % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), (k % 20).cast("string"))).alias("client_code"),
                                 start.alias("start"), k.alias("_tie"))


def _scan(df):
    """(rows found, rows that the scan gave)"""
    found = len(df.collect())
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return found, leaf.metrics().apply("numOutputRows").value()


def test_a_tenants_day_is_read_from_few_files(spark, tmp_path):
    path = str(tmp_path / "mart")
    mart = _mart(spark)
    write_clustered(mart, path, BY, FILES)
    back = spark.read.parquet(path)
    assert back.columns == mart.columns and back.exceptAll(mart).isEmpty() and mart.exceptAll(back).isEmpty()
    day = (F.col("start") >= dt.datetime(2025, 1, 3)) & (F.col("start") < dt.datetime(2025, 1, 4))
    for tenant in ("hot", "t1"):
        one = back.filter(day & (F.col("client_code") == tenant))
        assert one.select("_metadata.file_path").distinct().count() <= 2
        found, read = _scan(one)
        assert 0 < found <= read <= back.count() * 5 / FILES  # row groups outside the range are not read


def test_a_hot_tenant_and_instant_are_many_bounded_files(spark, tmp_path):
    path = str(tmp_path / "mart")
    mart = _mart(spark)
    write_clustered(mart, path, BY, FILES, rows_per_file=800)
    sizes = [pq.read_metadata(f).num_rows for f in glob.glob(path + "/*.parquet")]
    assert sum(sizes) == 40_000 and max(sizes) <= 800
    back = spark.read.parquet(path).filter("client_code = 'hot'").withColumn("file", F.col("_metadata.file_path"))
    assert back.select("file").distinct().count() >= FILES / 4
    assert back.groupBy("start").agg(F.countDistinct("file").alias("n")).agg(F.max("n")).first()[0] > 1


def test_rows_are_sorted_in_each_file(spark, tmp_path):
    path = str(tmp_path / "mart")
    blank = spark.createDataFrame([(None, None, -1)], "client_code STRING, start TIMESTAMP, _tie BIGINT")
    write_clustered(_mart(spark, 2_000).unionByName(blank), path, BY, 4)
    spans = []
    for f in glob.glob(path + "/*.parquet"):
        keys = [(r["client_code"] or "", r["start"].replace(tzinfo=None) if r["start"] else dt.datetime.min)
                for r in pq.read_table(f, columns=BY).to_pylist()]
        assert keys == sorted(keys)
        spans.append((keys[0], keys[-1]))
    spans.sort()
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_an_empty_table_keeps_its_columns(spark, tmp_path):
    path = str(tmp_path / "mart")
    mart = _mart(spark, 0)
    write_clustered(mart, path, BY, 4)
    back = spark.read.schema(mart.schema).parquet(path)
    assert back.count() == 0 and back.columns == mart.columns
