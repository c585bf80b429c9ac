"""Streams give what the batch operators give."""

from pyspark.sql import functions as F

from velograph.streaming.points import carried_gaps, dedup_stream, windowed_counts

SCHEMA = "source_entity_id string, point_id string, timestamp_utc timestamp"


def run(spark, df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).start()
    q.processAllAvailable()
    q.stop()
    return spark.table(name)


def points(spark, tmp_path):
    for i, rows in enumerate(([("a", "p1", 0), ("a", "p2", 10), ("b", "q1", 5)], [("a", "p2", 10), ("a", "p3", 25)])):
        df = spark.createDataFrame(rows, "source_entity_id string, point_id string, s long").withColumn("timestamp_utc", F.timestamp_seconds(F.col("s") + 1_650_000_000)).drop("s")
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / f"{i}"))
    return spark.readStream.schema(SCHEMA).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))


def test_dedup_and_carry(spark, tmp_path):
    assert run(spark, dedup_stream(points(spark, tmp_path)), "once").count() == 4
    got = run(spark, carried_gaps(points(spark, tmp_path / "x")), "gaps")
    assert {(r["point_id"], r["time_delta_sec"]) for r in got.collect()} >= {("p1", None), ("p2", 10), ("p3", 15), ("q1", None)}


def test_windows(spark, tmp_path):
    got = run(spark, windowed_counts(points(spark, tmp_path)), "windows", "update")
    assert got.agg(F.max("n")).first()[0] == 5
