"""Load statistics are counted while rows are written."""

from pyspark.sql import functions as F

from telescry.session import shared_dir
from telescry.sinks import tables as sinks
from telescry.sinks.statistics import STATISTICS, LoadLog, StreamLog
from telescry.sinks.tables import Batch
from telescry.streaming.run import read_once, run_stream

ITEMS = sinks.TableSpec("items", ("id",))


def test_counts_per_sink_take_no_job_of_their_own(spark):
    base, log = shared_dir(spark, "statistics"), LoadLog(lambda: F.lit("2024-01-01").cast("timestamp"))
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(1000).mapInArrow(count, "id long")
    sinks.append_table(log.watch(rows, "items"), ITEMS, base)
    sinks.append_table(log.watch(spark.range(30), "items"), ITEMS, base)
    sinks.append_table(log.watch(spark.range(5).filter("id > 7"), "none"), ITEMS, base)
    assert log.counts() == [("items", 1030), ("none", 0)] and log.counts() == []
    assert seen.value == 1000  # each row passed once: it was written and counted by the same job


def test_statistics_of_a_repeated_batch_and_of_a_stream(spark):
    base, listener = shared_dir(spark, "statistics"), StreamLog()
    spark.range(50).repartition(2).write.parquet(f"{base}/in")
    spark.streams.addListener(listener)
    try:
        def handle(rows, batch):
            for _ in range(2):
                log = LoadLog()
                sinks.append_table(log.watch(rows, "items"), ITEMS, base, batch)
                log.flush(rows.sparkSession, base, batch)

        stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
        run_stream(stream, read_once(handle), f"{base}/checkpoint", None, "items").awaitTermination()
        import time

        end = time.time() + 20
        while listener.rows() != [("items", 2, 50)] and time.time() < end:  # reports come a little later
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert listener.rows() == [("items", 2, 50)]
    stats = sinks.read_table(spark, base, STATISTICS.name)
    assert stats.agg(F.sum("record_count"), F.count("*")).first()[:] == (50, 2)
    log = LoadLog()
    sinks.append_table(log.watch(spark.range(3), "items"), ITEMS, base, Batch("other", 0))
    log.flush(spark, base)
    assert sinks.read_table(spark, base, STATISTICS.name).agg(F.sum("record_count")).first()[0] == 53
