"""The ``.xz`` files that the archive queries read."""

from __future__ import annotations

import lzma
import os

from checks import inputs


def test_xz_files_hold_the_lines_of_their_day(spark, tmp_path):
    rows = [(k, k % 7, "view", 50.0 + k, f"2024-01-0{1 + k % 3} 10:00:00" if k % 5 else None, f"text {k}") for k in range(60)]
    events = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, value double, ts string, props string")
    events.withColumn("ts", events.ts.cast("timestamp")).repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    root = inputs.xz_archive(spark, str(tmp_path)).removeprefix("file:")
    found = {}
    for name in os.listdir(f"{root}/comments"):
        with open(f"{root}/comments/{name}", "rb") as file:
            packed = file.read()
        found[name] = sorted(lzma.decompress(packed).decode().splitlines())
        unpack = lzma.LZMADecompressor(memlimit=2 << 20)  # a small window is enough to read them
        assert unpack.decompress(packed)
    expected = {}
    for row in inputs.made_lines(spark, str(tmp_path), "comments").where("file is not null").collect():
        expected.setdefault(row["file"].replace(".zst", ".xz"), []).append(row["value"])
    assert found == {name: sorted(lines) for name, lines in expected.items()}
