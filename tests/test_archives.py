"""Archive files, pass-through, statistics and streams end to end."""

from __future__ import annotations

import bz2
import gzip
import json
import lzma
import os

import pyarrow as pa
import pytest
from conftest import rows
from pyspark.sql import functions as F

from threadloom.operators import counts as c
from threadloom.operators import parse as p
from threadloom.operators.filters import filter_subreddits
from threadloom.plans import pass_through as pt
from threadloom.plans import statistics as st
from threadloom.plans.materialize import discard, scratch_path, shared_folder, store
from threadloom.sinks import files, zstd_lines
from threadloom.sinks.published import read_published
from threadloom.sources import archive as a
from threadloom.sources import packed_lines
from threadloom.sources import tables as t
from threadloom.sources.paths import open_path, qualified
from threadloom.streaming import archives as sa


def _zstd_frame(data: bytes) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.CompressedOutputStream(sink, "zstd") as out:
        out.write(data)
    return sink.getvalue().to_pybytes()


def record(subreddit=None, author=None, **more) -> str:
    fields = {"subreddit": subreddit, "author": author, **more}
    return json.dumps({k: v for k, v in fields.items() if v is not None})


FIRST = [record("Huts", "Ada"), "", record("Huts", "Ben"), "{broken", record("Peaks", "Ada"), "[1]", "\0\0"]
SECOND = ["{}", record("Huts", "[deleted]"), record("Peaks", "Cleo"), record("Huts", "Ada"), record("Huts", "Dov")]


@pytest.fixture
def dataset(tmp_path):
    for name in ("comments", "submissions", "authors"):
        (tmp_path / name).mkdir()
    (tmp_path / "comments" / "RC_2018-01.zst").write_bytes(_zstd_frame("\n".join(FIRST).encode()))
    (tmp_path / "comments" / "RC_2018-02.gz").write_bytes(gzip.compress(("\n".join(SECOND) + "\n").encode()))
    (tmp_path / "comments" / "notes.txt").write_text(record("Huts", "nobody"))
    body = 'a "quote", a \\ and\na newline'
    submissions = [record("Huts", "Ada", id="1", title=body), record(None, "Ada", id="2", title="")]
    (tmp_path / "submissions" / "RS_2019-01.bz2").write_bytes(bz2.compress("\n".join(submissions).encode()))
    accounts = [record(author="Elif", created_utc=1577836800), record(author="[deleted]", created_utc=1)]
    (tmp_path / "authors" / "RA_2020-01.zst").write_bytes(_zstd_frame("\n".join(accounts).encode()))
    return tmp_path


@pytest.mark.parametrize("pack", [_zstd_frame, gzip.compress, bz2.compress, lzma.compress])
def test_every_codec_with_concatenated_streams(spark, tmp_path, pack):
    suffix = {_zstd_frame: "zst", gzip.compress: "gz", bz2.compress: "bz2", lzma.compress: "xz"}[pack]
    (tmp_path / f"RS_2008-03.{suffix}").write_bytes(pack(b"one\ntw") + pack(b"o\n\nthree"))
    found = a.read_archive(spark, str(tmp_path), "RS_")
    assert rows(found) == [(v, f"RS_2008-03.{suffix}") for v in sorted(["", "one", "three", "two"])]


def test_xz_lines_over_many_chunks(spark, tmp_path):
    text = [f"{n} " + "x" * (n % 997) for n in range(20000)]
    data = lzma.compress("\n".join(text[:9000]).encode()) + lzma.compress(("\n" + "\n".join(text[9000:])).encode())
    (tmp_path / "RC_1.xz").write_bytes(data)
    (tmp_path / "RS_1.xz").write_bytes(lzma.compress(b"other"))
    (tmp_path / "RC_1.gz").write_bytes(gzip.compress(b"plain"))
    for spreading in ({}, {"spread": 3}, {"spread": 3, "spread_above": 1000}):
        lines = a.read_archive(spark, str(tmp_path), "RC_", **spreading)
        assert lines.columns == ["value", "file"]
        assert sorted(r["value"] for r in lines.collect()) == sorted([*text, "plain"])
    assert a.read_xz_archive(spark, str(tmp_path), "RC_", excludes="_1").count() == 0


def test_carriage_returns_stay_in_the_line(spark, tmp_path):
    (tmp_path / "RS_1.gz").write_bytes(gzip.compress(b'{"a":1}\r\n{"b":\r2}\n'))
    assert rows(a.read_archive(spark, str(tmp_path)), "value") == [('{"a":1}\r',), ('{"b":\r2}',)]


def test_file_names_choose_files(spark, dataset):
    comments = str(dataset / "comments")
    assert rows(a.list_files(spark, comments, "RC_"), "file") == [("RC_2018-01.zst",), ("RC_2018-02.gz",)]
    assert rows(a.list_files(spark, comments, "RC_", "2018", "-01"), "file") == [("RC_2018-02.gz",)]
    assert rows(a.list_files(spark, comments, "RC_", "", "  "), "file") == [("RC_2018-01.zst",), ("RC_2018-02.gz",)]
    assert a.list_files(spark, comments, "RC_", "rc_").count() == 0


def test_unwanted_files_are_not_opened(spark, dataset):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lines = a.read_archive(spark, str(dataset / "comments"), "RC_", "2018-02")
        assert {r["file"] for r in lines.collect()} == {"RC_2018-02.gz"}
        scan = lines._jdf.queryExecution().executedPlan().collectLeaves().head()
        assert scan.metrics().apply("numFiles").value() == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_spread_keeps_all_lines(spark, dataset):
    plain = a.read_archive(spark, str(dataset / "comments"), "RC_")
    spread = a.read_archive(spark, str(dataset / "comments"), "RC_", spread=5)
    assert rows(plain) == rows(spread)
    assert spread.rdd.getNumPartitions() == 5
    sizes = {r["file"]: r["bytes"] for r in a.list_files(spark, str(dataset / "comments"), "RC_").collect()}
    limit = min(sizes.values())
    partly = a.read_archive(spark, str(dataset / "comments"), "RC_", spread=5, spread_above=limit)
    assert rows(partly) == rows(plain)


def test_pass_through(spark, dataset):
    root = str(dataset)
    comments = pt.pass_through(spark, root, "comments")
    assert comments.columns == ["subreddit", "id", "author", "body"]
    assert comments.count() == 6
    listed = spark.createDataFrame([("Peaks",)], "subreddit string")
    assert rows(pt.pass_through(spark, root, "comments", subreddits=listed, only_users=True)) == [
        ("Peaks", "Ada"),
        ("Peaks", "Cleo"),
    ]
    assert rows(pt.pass_through(spark, root, "authors", only_users=True)) == [("Elif", 1577836800)]
    raw = pt.pass_through(spark, root, "comments", subreddits=listed, original_json=True)
    assert rows(raw) == [(record("Peaks", "Ada"),), (record("Peaks", "Cleo"),)]
    with pytest.raises(ValueError):
        pt.pass_through(spark, root, "comments", original_json=True, only_users=True)
    with pytest.raises(ValueError):
        pt.run_pass_through(spark, root, {})


def test_list_is_case_sensitive_and_missing_subreddits_are_unlisted(spark, dataset):
    listed = spark.createDataFrame([("huts",), ("Huts",)], "subreddit string")
    assert rows(pt.pass_through(spark, str(dataset), "submissions", subreddits=listed), "id") == [("1",)]


@pytest.mark.parametrize("compress", [False, True])
def test_written_csv_reads_back_unchanged(spark, dataset, compress):
    paths = {kind: scratch_path(spark, kind) for kind in ("submissions", "authors")}
    counted = pt.run_pass_through(spark, str(dataset), paths, compress=compress)
    assert counted == {"submissions": 2, "authors": 1}
    back = t.read_entity_csv(spark, paths["submissions"], "submissions")
    assert rows(back) == [("Huts", "1", "Ada", 'a "quote", a \\ and\na newline'), (None, "2", "Ada", None)]
    assert rows(t.read_entity_csv(spark, paths["authors"], "authors")) == [("Elif", 1577836800)]


def test_csv_rows(spark):
    one = spark.createDataFrame(
        [("Lakes", "81", "Gil", "Cold-swims."), (None, 'a"b', "c,d", "e\nf")],
        "subreddit string, id string, author string, title string",
    )
    assert [r["value"] for r in files.to_csv_rows(one).collect()] == [
        "Lakes,81,Gil,Cold-swims.",
        ',"a""b","c,d","e\nf"',
    ]
    account = spark.createDataFrame([("Elif", 1577836800)], "author string, created_utc bigint")
    assert files.to_csv_rows(account).first()["value"] == "Elif,1577836800"


def test_raw_json_round_trip(spark, dataset):
    path = scratch_path(spark, "raw")
    assert pt.run_pass_through(spark, str(dataset), {"comments": path}, original_json=True) == {"comments": 6}
    assert p.parse_comments(a.read_archive(spark, path)).count() == 6


def test_zstd_files_are_named_by_their_rows(spark):
    path = scratch_path(spark, "named")
    data = spark.createDataFrame([(f"line {n}", f"RC_{n % 3}.zst") for n in range(100)], "value string, file string")
    files.write_zstd_lines(data.repartition(4), path)
    assert rows(a.list_files(spark, path), "file") == [("RC_0.zst",), ("RC_1.zst",), ("RC_2.zst",)]
    assert rows(a.read_archive(spark, path)) == rows(data)
    files.write_zstd_lines(data.select("value").limit(5), path, mode="overwrite")
    assert a.read_archive(spark, path).count() == 5


def test_lines_are_packed_before_they_are_dealt(spark):
    """Frames hold lines of one file and end at the given size; null lines and null names stay."""
    data = spark.createDataFrame([("x" * 10, "a"), (None, "a"), ("y" * 30, "a"), ("z", "b"), ("n", None)], "value string, file string")
    packed = data.coalesce(1).mapInArrow(zstd_lines.frames(11), "frame binary, file string").collect()
    assert [row["file"] for row in packed] == ["a", "a", "b", None]
    plain = [pa.decompress(row["frame"], decompressed_size=n, codec="zstd", asbytes=True) for row, n in zip(packed, (11, 32, 2, 2))]
    assert plain == [b"x" * 10 + b"\n", b"\n" + b"y" * 30 + b"\n", b"z\n", b"n\n"]


def test_arriving_files_are_read_by_many_tasks(spark):
    path = scratch_path(spark, "arriving")
    data = spark.range(64).selectExpr("concat('line ', id) as value", "concat('RC_', id % 16, '.zst') as file")
    files.write_zstd_lines(data, path)
    listed = spark.read.format("binaryFile").load(path).select("path", "length")
    read = packed_lines.lines_of_files(listed)
    assert rows(read) == rows(data)
    assert read.select(F.spark_partition_id()).distinct().count() > 4


def test_a_file_name_is_never_written_twice(spark):
    path = scratch_path(spark, "once")
    data = spark.range(100).selectExpr("concat('line ', id) as value", "'RC_1.zst' as file").repartition(4)
    files.write_zstd_lines(data, path)
    assert a.read_archive(spark, path).count() == 100
    with pytest.raises(Exception, match="exist already"):
        files.write_zstd_lines(data, path)
    zstd_lines.register(spark)
    with pytest.raises(Exception, match="written twice"):
        data.write.format("zstd_lines").mode("append").save(scratch_path(spark, "twice"))
    assert a.read_archive(spark, path).count() == 100


def test_outer_blanks_and_line_ends_survive(spark):
    values = [" lead", "trail ", "end\n", "\ttab", "  ", "a\r\nb", "\r", '"q" ', "x,y", "plain", "é\r\n"]
    data = spark.createDataFrame([("S", str(k), "u", v) for k, v in enumerate(values)], "subreddit string, id string, author string, title string")
    for write in (files.write_csv, files.write_compressed):
        for count in (1, len(values)):
            path = scratch_path(spark, "blanks")
            write(data.repartition(count, "id"), path)
            assert rows(t.read_entity_csv(spark, path, "submissions")) == rows(data)


def test_tables_without_newlines_are_split(spark, tmp_path):
    (tmp_path / "m.csv").write_text("".join(f"subreddit{n % 97},author {n}\n" for n in range(60_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        found = t.read_user_subreddit_csv(spark, str(tmp_path / "m.csv"))
        assert found.rdd.getNumPartitions() > 3
        assert found.distinct().count() == 60_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_prefix_per_kind(spark, dataset):
    (dataset / "authors" / "RA_2021-01.gz").write_bytes(gzip.compress(record(author="Flo", created_utc=5).encode()))
    paths = {kind: scratch_path(spark, kind) for kind in ("comments", "authors")}
    assert pt.run_pass_through(spark, str(dataset), paths) == {"comments": 6, "authors": 2}
    paths = {kind: scratch_path(spark, kind) for kind in ("comments", "authors")}
    counted = pt.run_pass_through(spark, str(dataset), paths, prefixes={"authors": "RA_2021"})
    assert counted == {"comments": 6, "authors": 1}
    with pytest.raises(ValueError, match="prefixes"):
        pt.run_pass_through(spark, str(dataset), paths, prefix="RA_")


def test_paths_belong_to_the_default_file_system(spark):
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    before = settings.get("fs.defaultFS")
    settings.set("fs.viewfs.mounttable.shared.link./data", "file:///tmp")
    settings.set("fs.defaultFS", "viewfs://shared/")
    try:
        assert qualified(spark, "/data/forum") == "viewfs://shared/data/forum"
        assert qualified(spark, "file:///data/forum").startswith("file:/")
    finally:
        settings.set("fs.defaultFS", before)
    assert open_path("file:/data/forum")[1] == "/data/forum"
    with pytest.raises(Exception, match="(?i)viewfs|libhdfs|scheme"):
        open_path("viewfs://shared/data/forum")


def test_periods_with_undated_rows_and_lists(spark, dataset):
    (dataset / "submissions" / "RS_undated.gz").write_bytes(gzip.compress(record("Peaks", "Eva", id="9").encode()))
    counts = st.count_per_period(a.read_contributions(spark, str(dataset)), "UserContributionsInSubreddits")
    found = {tuple(row) for row in counts.select("level", "period", "subreddit", "count").collect()}
    assert ("all", "all", "Peaks", 3) in found and ("year", "2018", "Peaks", 2) in found
    assert all(period for _, period, _, _ in found)
    path = st.export_top_lists_per_period(counts, (1, 2), scratch_path(spark, "lists"), "top")
    one = t.read_filter_list(spark, f"{path}/size=1/level=all/period=all")
    assert rows(one) == [("Huts",)]


def test_filter_list_names_stand_as_they_are(spark):
    names = ['a"b', " c", "d,e", "", "f "]
    counts = spark.createDataFrame([(name, 9 - k) for k, name in enumerate(names)], "subreddit string, count bigint")
    path = st.export_top_lists(counts, (5,), scratch_path(spark, "lists"), "x")[0]
    assert rows(t.read_filter_list(spark, path)) == sorted(((name,) for name in names), key=repr)
    data = spark.createDataFrame([(None, "u"), ("z", "u")], "subreddit string, author string")
    blank = t.read_filter_list(spark, st.export_top_lists(counts.where("subreddit = ''"), (1,), scratch_path(spark, "l"), "y")[0])
    assert rows(filter_subreddits(data, blank)) == [(None, "u")]


def test_stream_reads_xz(spark, dataset):
    (dataset / "comments" / "RC_2018-04.xz").write_bytes(lzma.compress(record("Lakes", "Ada").encode()))
    batch = c.contributions_per_subreddit(a.read_contributions(spark, str(dataset)))
    counts = sa.stream_contributions(sa.stream_contribution_rows(spark, str(dataset)))
    found = drained(spark, counts, scratch_path(spark, "out"), scratch_path(spark, "state"))
    assert rows(found) == rows(batch) and ("Lakes", 1) in rows(found)


def test_discard(spark):
    kept = store(spark.range(3), "gone")
    discard(spark, kept.path)
    assert not os.path.exists(kept.path.removeprefix("file:"))


def test_statistics(spark, dataset):
    out = scratch_path(spark, "stats")
    path = st.run_statistics(spark, str(dataset), "UsersInSubreddits", out, suffix="2018", contains="2018")
    assert path.endswith("/UsersInSubreddits_2018.csv")
    assert rows(t.read_counts_csv(spark, path)) == [("Huts", 3), ("Peaks", 2)]
    path = st.run_statistics(spark, str(dataset), "UserContributionsInSubreddits", out, suffix=" ")
    assert path.endswith("/UserContributionsInSubreddits.csv")
    assert rows(t.read_counts_csv(spark, path)) == [("Huts", 6), ("No-Subreddit-defined", 1), ("Peaks", 2)]
    with pytest.raises(ValueError):
        st.run_statistics(spark, str(dataset), "Other", out)


def test_statistics_per_period(spark, dataset):
    out = scratch_path(spark, "periods")
    path = st.run_statistics_per_period(spark, str(dataset), "UsersInSubreddits", out)
    one = t.read_counts_csv(spark, f"{path}/level=year/period=2018")
    assert rows(one) == [("Huts", 3), ("Peaks", 2)]


def test_filter_lists(spark, tmp_path):
    (tmp_path / "list.txt").write_text("Skipped\nA\nB\nA\n")
    (tmp_path / "empty.txt").write_text("subreddit\n")
    assert rows(t.read_filter_list(spark, str(tmp_path / "list.txt"))) == [("A",), ("B",)]
    assert t.read_filter_list(spark, str(tmp_path / "empty.txt")).isEmpty()
    counts = spark.createDataFrame([("x", 3), ("y", 9), ("z", 5)], "subreddit string, count bigint")
    paths = st.export_top_lists(counts, (1, 2), scratch_path(spark, "lists"), "UsersInSubreddits_2018")
    assert paths[1].endswith("UsersInSubreddits_2018~top-2.txt")
    assert [rows(t.read_filter_list(spark, path)) for path in paths] == [[("y",)], [("y",), ("z",)]]


def test_one_file_where_one_is_wanted(spark, dataset, tmp_path):
    path = st.run_statistics(spark, str(dataset), "UsersInSubreddits", str(tmp_path / "out"), suffix="x", single_file=True)
    assert os.path.isfile(path) and sorted(os.listdir(tmp_path / "out"))[-1] == "UsersInSubreddits_x.csv"
    assert not [name for name in os.listdir(tmp_path / "out") if os.path.isdir(tmp_path / "out" / name)]
    wanted = c.users_per_subreddit(a.read_contributions(spark, str(dataset)))
    assert rows(t.read_counts_csv(spark, path)) == rows(wanted)
    with pytest.raises(ValueError, match="exists already"):
        st.run_statistics(spark, str(dataset), "UsersInSubreddits", str(tmp_path / "out"), suffix="x", single_file=True)
    empty = spark.createDataFrame([], "subreddit string, count bigint")
    assert os.path.getsize(files.write_statistics(empty, str(tmp_path / "out"), "Nothing", single_file=True)) == 0


def test_counts_file_has_no_header(spark, tmp_path):
    (tmp_path / "c.csv").write_text("first,3\nsecond,2\n")
    assert rows(t.read_counts_csv(spark, str(tmp_path / "c.csv"))) == [("first", 3), ("second", 2)]


def test_membership_csv(spark, tmp_path):
    (tmp_path / "one.csv").write_text('A,u\n"B,b","v""w"\n,x\n')
    (tmp_path / "two.zst").write_bytes(_zstd_frame(b"A,u\nC,\n"))
    found = t.read_user_subreddit_csv(spark, [str(tmp_path / "one.csv"), str(tmp_path / "two.zst")])
    assert rows(found) == [("", "x"), ("A", "u"), ("A", "u"), ("B,b", 'v"w'), ("C", "")]


def test_stored_tables_report_their_size(spark):
    kept = store(spark.range(10).selectExpr("id", "'abcd' as name"), "sized")
    assert (kept.rows, kept.bytes, kept.table.count()) == (10, 10 * (32 + 4), 10)
    empty = store(spark.range(0), "empty")
    assert (empty.rows, empty.bytes) == (0, 0)
    assert shared_folder(spark) == shared_folder(spark)


def drained(spark, counts, path, checkpoint):
    sa.drain_to_table(counts, path, checkpoint)
    return read_published(spark, path)


def test_streams_equal_batch(spark, dataset):
    batch = a.read_contributions(spark, str(dataset))
    for stream, expected in (
        (sa.stream_contributions, c.contributions_per_subreddit(batch)),
        (sa.stream_users, c.users_per_subreddit(batch)),
        (sa.stream_users_approx, c.users_per_subreddit(batch)),
    ):
        counts = stream(sa.stream_contribution_rows(spark, str(dataset), files_per_trigger=1))
        found = drained(spark, counts, scratch_path(spark, "out"), scratch_path(spark, "state"))
        assert rows(found) == rows(expected)


def test_stream_goes_on_after_a_restart(spark, dataset):
    path, checkpoint = scratch_path(spark, "out"), scratch_path(spark, "state")

    def run():
        return rows(drained(spark, sa.stream_users(sa.stream_contribution_rows(spark, str(dataset))), path, checkpoint))

    before = run()
    more = "\n".join([record("Huts", "Ada"), record("New", "Ada"), record("New", "Eva")])
    (dataset / "comments" / "RC_2018-03.zst").write_bytes(_zstd_frame(more.encode()))
    after = run()
    assert before != after
    assert after == rows(c.users_per_subreddit(a.read_contributions(spark, str(dataset))))


def test_stream_periods_and_pass_through(spark, dataset):
    rows_of = sa.stream_contribution_rows(spark, str(dataset))
    found = drained(
        spark, sa.stream_counts_per_period(rows_of), scratch_path(spark, "out"), scratch_path(spark, "state")
    )
    found = {tuple(row) for row in found.select("level", "period", "subreddit", "count").collect()}
    assert {("month", "2018-01", "Huts", 2), ("month", "2018-02", "Huts", 3), ("year", "2018", "Huts", 5)} <= found
    path = scratch_path(spark, "csv")
    sa.drain_to_csv(sa.stream_pass_through(spark, str(dataset), "submissions"), path, scratch_path(spark, "state"))
    batch = pt.pass_through(spark, str(dataset), "submissions")
    assert rows(t.read_entity_csv(spark, path, "submissions"), "id") == rows(batch, "id")
