"""What the join of two streams keeps in its state store."""

from __future__ import annotations

import datetime

from repotide.streaming import sizes as size_stream


def _landed(spark, path, name, rows):
    frame = spark.createDataFrame(rows, f"commit long, {name}_at timestamp, {name}_value long")
    frame.write.mode("append").parquet(f"{path}/{name}")


def test_stream_join_keeps_one_store_a_task_and_need_not_count_rows(spark, tmp_path):
    day = datetime.datetime(2024, 1, 1)
    at = {i: day + datetime.timedelta(days=i) for i in range(20)}
    for start in (0, 10):
        for name in ("log", "sizes"):
            rows = [(i, at[i], i * 10) for i in range(start, start + 10)]
            _landed(spark, tmp_path, name, rows + rows[:3])
        stream = {
            name: spark.readStream.schema(f"commit long, {name}_at timestamp, {name}_value long")
            .parquet(str(tmp_path / name)) for name in ("log", "sizes")
        }
        joined = size_stream.size_log_join(
            stream["sizes"], stream["log"], ["commit"], "sizes_at", "log_at", "2 days"
        )
        query = size_stream.write_joined(joined, str(tmp_path / "joined"), str(tmp_path / "state"), counted=False)
        query.awaitTermination()
    got = sorted((r.commit, r.log_value) for r in spark.read.parquet(str(tmp_path / "joined")).collect())
    assert got == [(i, i * 10) for i in range(20)]
    # the operator of the join has the first number; each of its tasks had four stores
    stores = {p.name for p in (tmp_path / "state" / "state" / "0" / "0").iterdir() if p.is_dir()}
    assert not stores & {"left-keyToNumValues", "right-keyToNumValues"}
    assert spark.conf.get(size_stream.COUNTED, None) is None  # as it was before
