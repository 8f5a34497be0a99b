"""Streams give what a batch over the same rows gives."""

from pyspark.sql import functions as F

from quernstone.operators.packing import next_fit
from quernstone.streaming import windows


def _files(spark, folder, rows, schema, parts=3):
    for i in range(parts):
        spark.createDataFrame(rows[i::parts], schema).coalesce(1).write.mode("append").parquet(folder)
    return schema


def test_ingest_reads_each_file_once(spark, tmp_path):
    schema = _files(spark, str(tmp_path / "in"), [(i,) for i in range(9)], "id long")
    seen = []
    sink = lambda df, n: seen.extend(r["id"] for r in df.collect())
    windows.ingest(windows.read_increments(spark, str(tmp_path / "in"), schema, 1), sink, str(tmp_path / "cp"))
    windows.ingest(windows.read_increments(spark, str(tmp_path / "in"), schema, 1), sink, str(tmp_path / "cp"))
    assert sorted(seen) == list(range(9))


def _run(spark, df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).start()
    q.processAllAvailable()
    q.stop()
    return spark.table(name)


def test_windows_and_duplicates(spark, tmp_path):
    rows = [(i % 5, f"2026-01-01 00:{i:02d}:00", float(i)) for i in range(30)]
    spark.createDataFrame(rows, "k long, t string, v double").select("k", F.to_timestamp("t").alias("t"), "v").coalesce(1).write.parquet(str(tmp_path / "ev"))
    stream = windows.read_increments(spark, str(tmp_path / "ev"), "k long, t timestamp, v double")
    got = _run(spark, windows.windowed(stream, "t", [], "10 minutes", "1 minute", value="v"), "w", "complete")
    assert sorted((r["n"], r["total"]) for r in got.collect()) == [(10, 45.0), (10, 145.0), (10, 245.0)]
    assert _run(spark, windows.deduplicated(stream, ["k"], "t", "1 hour"), "d").count() == 5
    assert _run(spark, windows.session_counts(stream, "t", ["k"], "6 minutes", "1 minute"), "s", "complete").count() == 5


def test_stream_packing(spark, tmp_path):
    rows = [("a", i, (i * 37) % 60 + 1) for i in range(20)]
    spark.createDataFrame(rows, "shard string, id long, n long").coalesce(1).write.parquet(str(tmp_path / "seq"))
    stream = windows.read_increments(spark, str(tmp_path / "seq"), "shard string, id long, n long")
    got = [r["items"] for r in _run(spark, windows.packed(stream, "shard", "id", "n", 100), "p", "append").orderBy("bin").collect()]
    assert got == next_fit([n for _, _, n in rows], 100)[:-1]
