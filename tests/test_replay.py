"""The replay harness: rows without an order are dealt over all cores."""

from collections import Counter

from pyspark.sql import functions as F

from strata.streaming import replay


def _drained(stream, folder):
    """(batch, value, map) of the stream's rows, and its number of batches."""
    def sink(batch, number):
        batch.select(F.lit(number).alias("batch"), "v", F.to_json("m").alias("m")).write.mode("append").parquet(folder)
    query = stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{folder}-ckpt").trigger(
        availableNow=True).start()
    replay.drain(query)
    return stream.sparkSession.read.parquet(folder).collect()


def test_unordered_rows_have_a_file_per_core_and_batch(spark, tmp_dir):
    # Equal rows, null rows and maps, from one partition.
    v = F.when(F.col("id") % 10 == 0, F.lit(None)).when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id"))
    table = spark.range(0, 4000, 1, 1).select(v.alias("v"), F.create_map(F.lit("k"), v.cast("string")).alias("m"))
    stream = replay.replayed(table, None, "replay-dealt")
    rows = _drained(stream, f"{tmp_dir}/all")
    expected = Counter((r.v, r.m) for r in table.select("v", F.to_json("m").alias("m")).collect())
    assert Counter((r.v, r.m) for r in rows) == expected
    per_batch = Counter(r.batch for r in rows)
    assert len(per_batch) == 4 and min(per_batch.values()) > 900


def test_unordered_files_are_even(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(replay, "scratch_path", lambda spark, name: f"{tmp_dir}/{name}")
    same = spark.range(0, 4000, 1, 1).select(F.lit(1).alias("v"))
    replay.replayed(same, None, "even")
    sizes = [n for _, n in spark.read.parquet(f"{tmp_dir}/even").groupBy(F.input_file_name()).count().collect()]
    cores = spark.sparkContext.defaultParallelism
    assert len(sizes) == 4 * cores and max(sizes) - min(sizes) <= 1


def test_unordered_empty_table(spark, tmp_dir):
    empty = spark.createDataFrame([], "v long, m map<string,string>")
    query = replay.replayed(empty, None, "replay-empty").select("v").writeStream.format("parquet").option(
        "path", f"{tmp_dir}/none").option("checkpointLocation", f"{tmp_dir}/ckpt").trigger(availableNow=True).start()
    replay.drain(query)
    assert replay.written(spark, f"{tmp_dir}/none", "v long").count() == 0
