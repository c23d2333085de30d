"""Counter rates of a stream against those of the whole table."""

from pyspark.sql import functions as F

from timberline.operators import metrics
from timberline.plans.observing import counter
from timberline.streaming import rates


def test_streamed_rates_equal_those_of_the_table(spark, sf_dir, tmp_path):
    """A replay in several batches, with restarts of the counters, ties of a second and a stop in between."""
    samples = counter(spark, sf_dir).select("host", F.timestamp_seconds("at_s").alias("at"), "event_id", "value")
    days = [r.d for r in samples.select(F.to_date("at").alias("d")).distinct().orderBy("d").collect()]
    cuts = [days[0], *days[7::8], days[-1]]
    path, checkpoint = f"file://{tmp_path}/in", f"file://{tmp_path}/ck"
    flush = spark.createDataFrame([("flush", "2031-01-01 00:00:00", 0, 0)], "host string, at string, event_id long, value long").withColumn("at", F.col("at").cast("timestamp"))

    def deliver(part):
        part.coalesce(1).write.mode("append").parquet(path)

    def run():
        stream = spark.readStream.schema(samples.schema).option("maxFilesPerTrigger", 1).parquet(path)
        out = rates.counter_rates(stream, ["host"], 3600, 300, "10 minutes", ["event_id"])
        q = out.writeStream.outputMode("append").format("parquet").option("path", f"file://{tmp_path}/out").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        q.awaitTermination()

    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for a, b in zip(cuts, cuts[1:]):
            deliver(samples.where((F.to_date("at") >= F.lit(a)) & ((F.to_date("at") < F.lit(b)) | (F.lit(b) == F.lit(cuts[-1])))))
            run()
        for _ in range(2):
            deliver(flush)
            run()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    got = spark.read.parquet(f"file://{tmp_path}/out").where("host <> 'flush'")
    want = metrics.counter_rate(counter(spark, sf_dir), ["host"], "at_s", "value", 3600, 300, ties=["event_id"])
    rounded = lambda d: sorted((r.host, r.tick, round(r.rate, 9)) for r in d.collect())
    assert rounded(got) == rounded(want) and len(rounded(want)) > 500


def test_quantiles_of_streamed_histogram_rates(spark):
    rows = [("a", b, t, c / 10) for t in (300, 600) for b, c in ((1.0, 2), (2.0, 6), (float("inf"), 8))]
    got = rates.rate_quantiles(spark.createDataFrame(rows, "host string, bound double, tick long, rate double"), ["host"], 0.5)
    assert {(r.host, r.tick): round(r.value, 6) for r in got.collect()} == {("a", 300): 1.5, ("a", 600): 1.5}
