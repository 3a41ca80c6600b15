from pyspark.sql import Window
from pyspark.sql import functions as F

from pricelab.operators.groups import LIMIT_KEY, top_k


def test_salted_top_k_equals_plain_on_a_hot_group(spark):
    # one group holds ~90 % of the rows
    df = spark.range(20000).select(
        F.when(F.col("id") % 10 == 0, F.concat(F.lit("g"), (F.col("id") % 7).cast("string")))
         .otherwise(F.lit("hot")).alias("g"),
        F.col("id").cast("string").alias("k"),
        ((F.col("id") * 7919) % 1000).cast("double").alias("v"))
    top = lambda: top_k(df, ["g"], [F.col("v").asc(), F.col("k")], 5, salt_on="k", salt_buckets=16)
    plan = top()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("WindowGroupLimit") == 2      # limited before the exchange
    spark.conf.set(LIMIT_KEY, "3")              # beyond Spark's own limit: salted
    try:
        got = top()
        assert got._jdf.queryExecution().executedPlan().toString().count("Exchange") == 2
    finally:
        spark.conf.unset(LIMIT_KEY)
    w = Window.partitionBy("g").orderBy(F.col("v").asc(), F.col("k"))
    want = df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= 5)
    a = sorted((r["g"], r["k"], r["rank"]) for r in got.collect())
    assert a == sorted((r["g"], r["k"], r["rank"]) for r in top().collect())
    b = sorted((r["g"], r["k"], r["rank"]) for r in want.collect())
    assert a == b
