"""Incremental refresh: restartable file stream, idempotent sink, merge on read."""

from pyspark.sql import functions as F

from perfscore.session import scratch_path
from perfscore.streaming.refresh import compact, file_stream, read_current, run_available


def _land(folder, name, rows):
    import pyarrow as pa
    import pyarrow.parquet as pq
    ids, views = zip(*rows)
    pq.write_table(pa.table({"video_id": list(ids), "views": pa.array(views, pa.int64())}),
                   f"{folder}/{name}.parquet")


def test_stream_restarts_and_keeps_latest_version(spark, tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    land = str(land)
    schema = "video_id string, views bigint"
    _land(land, "part1", [("a", 1), ("b", 2)])
    target = scratch_path(spark, "stream_target")
    ckpt = scratch_path(spark, "stream_ckpt")
    seen = []

    def transform(batch, batch_id):
        seen.append(batch_id)
        return batch.withColumn("views2", F.col("views") * 2)

    def stream():
        return file_stream(spark, land, "*.parquet", schema)

    run_available(stream(), transform, target, ckpt)
    first = {r.video_id: r.views2 for r in read_current(spark, target).collect()}
    assert first == {"a": 2, "b": 4}

    # New file with an update for "b" and a new key; the restart only reads the new file.
    _land(land, "part2", [("b", 5), ("c", 7)])
    n_before = len(seen)
    run_available(stream(), transform, target, ckpt)
    assert len(seen) > n_before
    cur = {r.video_id: r.views2 for r in read_current(spark, target).collect()}
    assert cur == {"a": 2, "b": 10, "c": 14}

    # A third run with nothing new processes no batch and changes nothing.
    n_before = len(seen)
    run_available(stream(), transform, target, ckpt)
    assert len(seen) == n_before
    assert {r.video_id: r.views2 for r in read_current(spark, target).collect()} == cur

    # Compaction keeps the answer; later batches still win over the base.
    upto = compact(spark, target)
    assert {r.video_id: r.views2 for r in read_current(spark, target).collect()} == cur
    _land(land, "part3", [("a", 100)])
    run_available(stream(), transform, target, ckpt)
    after = {r.video_id: r.views2 for r in read_current(spark, target).collect()}
    assert after == {"a": 200, "b": 10, "c": 14}
    assert compact(spark, target) > upto


def test_partial_sums_across_batches_equal_one_pass(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq
    from perfscore.streaming.refresh import read_summed

    land = tmp_path / "events"
    land.mkdir()
    rows = [("s1", float(v)) for v in range(10)] + [("s2", 5.0), ("s2", 7.0)]
    for name, part in (("e1", rows[:5]), ("e2", rows[5:])):
        seg, val = zip(*part)
        pq.write_table(pa.table({"segment": list(seg), "value": list(val)}), f"{land}/{name}.parquet")
    target, ckpt = scratch_path(spark, "sum_target"), scratch_path(spark, "sum_ckpt")

    def partial(batch, batch_id):
        return batch.groupBy("segment").agg(F.sum("value").alias("s"), F.count("value").alias("n"))

    # one file per trigger: two batches, each with partial sums
    run_available(file_stream(spark, str(land), "*.parquet", "segment string, value double",
                              max_files_per_trigger=1),
                  partial, target, ckpt)
    got = {r.segment: r.s / r.n for r in read_summed(spark, target, ["segment"], ["s", "n"]).collect()}
    assert got == {"s1": 4.5, "s2": 6.0}
