import time

from pyspark.sql import functions as F

from sluice import shared


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(found.size()) if (name := found.apply(i).getName()).startswith("shuffle_")}


def test_saved_leaves_no_shuffle_files(spark):
    rows = spark.range(20_000).withColumn("k", F.col("id") % 7)
    setting, before = spark.conf.get(shared.CLEANUP), shuffle_files(spark)
    out = shared.saved(rows.groupBy("k").agg(F.count("*").alias("n")).join(rows.repartition("k"), "k").repartition("id"), "counts")
    for _ in range(50):  # they go in the background
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert out.count() == 20_000 and {r.n for r in out.select("n").distinct().collect()} == {2857, 2858}
    assert spark.conf.get(shared.CLEANUP) == setting
    shared.discard(out)
