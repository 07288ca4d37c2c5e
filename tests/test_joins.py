from pyspark.sql import functions as F

from pageglean.operators import joins as J


def test_size_is_measured(spark):
    df = spark.range(1000).select("id", F.repeat(F.lit("x"), 100).alias("t"))
    assert J.fits_broadcast(df, 200_000) and not J.fits_broadcast(df, 100_000)
    assert J.fits_broadcast(df.filter("false"), 0)


def test_hot_key_is_split_when_the_other_side_is_too_large(spark):
    session = spark.newSession()
    for key, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB", "spark.sql.shuffle.partitions": "16",
    }.items():
        session.conf.set(key, value)
    # Half of all facts are about keyword 7.
    facts = session.range(0, 200_000, 1, 8).select("id", F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 999).alias("keyword_id"))
    words = session.range(1000).select(F.col("id").alias("keyword_id"), F.concat(F.lit("k"), "id").alias("keyword"))
    joined = J.lookup(facts, words, "keyword_id", max_bytes=1)
    rows = joined.groupBy("keyword").count()
    assert {r.keyword: r["count"] for r in rows.collect()}["k7"] >= 100_000
    assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()
