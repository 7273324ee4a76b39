from lexiforge.operators.books import latest as batch_latest
from lexiforge.streaming import ledger


def run(spark, df, name, mode):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.table(name)


def test_streams_agree_with_batch(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("event_id", "cast(ts as timestamp) as ts", "user_id", "event_type")
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = run(spark, ledger.latest(stream(), "user_id", "event_type", "event_id"), "latest", "complete")
    want = batch_latest(events.select("user_id", "event_type", "event_id"), "user_id", ["event_id"])
    assert sorted(map(tuple, got.select("user_id", "event_type").collect())) == sorted(map(tuple, want.select("user_id", "event_type").collect()))
    counts = run(spark, ledger.windowed_counts(stream(), "ts", "event_type", "1 day", "4000 days"), "counts", "update")
    assert counts.groupBy("window_start", "event_type").agg({"n": "max"}).agg({"max(n)": "sum"}).first()[0] == events.count()
