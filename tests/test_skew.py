"""A key holding a third of the rows: partial limits before the shuffle and
AQE skew splitting after it (broadcasts disabled to force shuffle joins)."""

from __future__ import annotations

from pyspark.sql import functions as F

from courtgrid.operators import merge as M
from courtgrid.operators import quality as Q


def _skewed(spark, n=30000):
    # one third of the rows share key 'hot'
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
        .alias("k"), F.col("id").alias("pos"), (F.col("id") % 7).alias("u"))


def test_skewed_join_back_is_salted(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = _skewed(spark)
        rep = Q.duplicate_report(df, ["k"])
        rows = rep.collect()  # runs this DataFrame's own (adaptive) plan
        assert len(rows) == 10000 and all(r.n_rows == 10000 for r in rows)
        plan = rep._jdf.queryExecution().executedPlan().toString()
        # the join back is on (key, salt): the hot key is spread over the salts
        assert "_salt" in plan
        hot = rep.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(hot) > 1
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_key_dedupe_is_limited_before_shuffle(spark):
    df = _skewed(spark)
    out = M.dedupe_latest(df, ["k"], "u", "pos")
    assert out.filter("k = 'hot'").count() == 1
    plan = out._jdf.queryExecution().executedPlan().toString()
    # partial group limit below the exchange: the hot key leaves each map task as one row
    assert plan.index("WindowGroupLimit") < plan.rindex("WindowGroupLimit")


def test_replace_groups_spreads_hot_tenant(spark):
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cur = _skewed(spark).select(F.when(F.col("k") == "hot", "t_hot").otherwise("t_other").alias("tenant"),
                                    F.lit("s").alias("sys"), "pos")
        inc = spark.createDataFrame([("t_new", "s", 1)], "tenant string, sys string, pos bigint")
        out = M.replace_groups(cur, inc, ["tenant", "sys"])
        assert out.count() == 30001
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "_salt" in plan
    finally:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
