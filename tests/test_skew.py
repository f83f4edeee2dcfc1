"""A hot key (one target referenced by a third of all links) with AQE's skew-join split
forced on: results must equal the unskewed expectation."""

import datetime as dt

from pyspark.sql import functions as F

from linkmart.operators.checks import relationship_failures
from linkmart.operators.deadletters import dead_letter_links
from linkmart.operators.marts import dimension, fact
from linkmart.operators.snapshots import scd2_merge
from linkmart.plans.spec import EntitySpec, Link

A = EntitySpec("as", "a", links=(Link("bs", "bs", "bs", "b_url", "b_id"),))
B = EntitySpec("bs", "b")
SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


def test_hot_key_results(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        n = 6000
        # every third link points to the hot target "b0"; the rest spread over 100 targets,
        # of which "b99" does not exist
        links = spark.range(n).select(
            (F.col("id") % 500).cast("string").alias("a_id"),
            F.when(F.col("id") % 3 == 0, F.lit("b0"))
            .otherwise(F.concat(F.lit("b"), (F.col("id") % 100).cast("string"))).alias("b_id"))
        t = dt.datetime(2024, 1, 1)
        da = dimension(scd2_merge(None, spark.range(500).select(
            F.col("id").cast("string").alias("id"), F.lit("n").alias("name")), t), A)
        db = dimension(scd2_merge(None, spark.range(99).select(
            F.concat(F.lit("b"), F.col("id").cast("string")).alias("id"),
            F.lit("m").alias("name")), t), B)
        f = fact(links, da, A, db, B, A.link("bs"), "current")
        assert f.count() == n
        missing = links.where("b_id = 'b99'").count()
        assert f.where(F.col("b_sk").isNull()).count() == missing
        hot = links.where("b_id = 'b0'").count()
        assert hot >= n // 3
        assert f.where("b_id = 'b0'").where(F.col("b_sk").isNotNull()).count() == hot
        fails = relationship_failures(links, "b_id", db, "b_id").first()["failures"]
        assert fails == missing
        raw = links.groupBy("a_id").agg(F.collect_list(
            F.concat(F.lit("https://h/bs/"), F.col("b_id"))).alias("l")).select(
            F.col("a_id").alias("id"),
            F.to_json(F.struct(F.col("a_id").alias("id"), F.col("l").alias("bs"))).alias("payload"),
            F.lit(t).cast("timestamp").alias("extracted_at"))
        dl = dead_letter_links(raw, "as", "bs", db.select(F.col("b_id").alias("id")))
        expected = links.where("b_id = 'b99'").select("a_id").distinct().count()
        assert dl.count() == expected
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
