"""Streaming features: batch equality on closed windows, late-data rule."""

from pyspark.sql import functions as F

from windowlens.operators import features
from windowlens.plans.frames import Frames, rounded
from windowlens.session import work_path
from windowlens.sources import text
from windowlens.streaming import features as streaming


def _run(spark, folder, name):
    out = work_path(spark, name)
    lines = text.read_line_stream(spark, folder)
    streaming.run_available_now(streaming.feature_stream(lines, "1 hour"), out, out + "-ckpt")
    return out


def test_stream_equals_batch_on_closed_windows(spark, small_dir):
    f = Frames(spark, small_dir)
    folder = work_path(spark, "stream-lines")
    text.write_lines(f.lines, folder)
    out = rounded(spark.read.parquet(_run(spark, folder, "stream-out")))
    max_ts = f.typed.agg(F.max("ts")).first()[0]
    batch = rounded(features.window_features(f.deduped, "1 hour")).filter(
        F.col("window_start") + F.expr("INTERVAL 1 HOUR") <= F.lit(max_ts) - F.expr("INTERVAL 10 MINUTES"))
    assert out.count() == batch.count() > 0
    assert out.exceptAll(batch).count() == 0


def test_late_row_leaves_closed_window_unchanged(spark):
    folder = work_path(spark, "late-lines")
    first = ["2024-02-01 00:0%d:00 /api/view 200 100" % i for i in range(10)] + \
            ["2024-02-01 01:30:00 /api/view 200 100"]
    spark.createDataFrame([(v,) for v in first], "value string").coalesce(1).write.text(folder + "/a")
    out = work_path(spark, "late-out")
    ckpt = out + "-ckpt"
    lines = text.read_line_stream(spark, folder + "/*")
    streaming.run_available_now(streaming.feature_stream(lines, "1 hour"), out, ckpt)
    before = spark.read.parquet(out).collect()
    assert [r["total_requests"] for r in before] == [10]
    # a row for the closed 00:00 window arrives after the watermark passed it
    late = ["2024-02-01 00:30:00 /api/view 500 999", "2024-02-01 03:00:00 /api/view 200 100"]
    spark.createDataFrame([(v,) for v in late], "value string").coalesce(1).write.text(folder + "/b")
    lines = text.read_line_stream(spark, folder + "/*")
    streaming.run_available_now(streaming.feature_stream(lines, "1 hour"), out, ckpt)
    after = {str(r["window_start"]): r["total_requests"] for r in spark.read.parquet(out).collect()}
    assert after["2024-02-01 00:00:00"] == 10


def test_stream_static_enrichment_keeps_every_row(spark, small_dir):
    from windowlens.operators import enrich
    from windowlens.streaming.features import dedupe_stream, typed_stream
    f = Frames(spark, small_dir)
    folder = work_path(spark, "enrich-lines")
    text.write_lines(f.lines, folder)
    rows = dedupe_stream(typed_stream(text.read_line_stream(spark, folder)))
    enriched = enrich.enrich(rows, f.dimension)
    out = work_path(spark, "enrich-out")
    streaming.run_available_now(enriched, out, out + "-ckpt")
    got = spark.read.parquet(out)
    assert got.count() == f.deduped.where("ts is not null").count()
    unmatched = got.filter(F.col("service_owner").isNull()).select("endpoint").distinct().collect()
    assert {r["endpoint"] for r in unmatched} == {"/api/error"}


def test_hot_duplicate_row_is_deduped_exactly(spark):
    from windowlens.streaming.features import dedupe_stream, typed_stream
    folder = work_path(spark, "hot-lines")
    hot = "2024-03-01 10:00:00 /api/view 200 100"
    rows = [hot] * 3000 + ["2024-03-01 10:%02d:00 /api/click 200 %d" % (i % 60, i) for i in range(300)]
    spark.createDataFrame([(v,) for v in rows], "value string").repartition(6).write.text(folder)
    out = work_path(spark, "hot-out")
    stream = dedupe_stream(typed_stream(text.read_line_stream(spark, folder)), salt_buckets=4)
    streaming.run_available_now(stream, out, out + "-ckpt")
    got = spark.read.parquet(out)
    assert got.count() == 301
    assert got.filter(F.col("endpoint") == "/api/view").count() == 1


def test_stream_over_several_micro_batches_equals_batch(spark, small_dir):
    """Three time slices arrive as three files, one per micro-batch: state
    (dedupe, open windows) carries across batches and the closed windows
    still equal the batch result."""
    import time as _time
    f = Frames(spark, small_dir)
    folder = work_path(spark, "slices")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    stamp = F.substring("value", 1, 19).try_cast("timestamp_ntz")  # NULL for damaged lines
    day = F.floor((F.unix_timestamp(stamp) - F.unix_timestamp(start)) / 86400)
    lines = f.lines.withColumn("_slice", F.coalesce(F.least(day / 10, F.lit(2)).cast("int"), F.lit(0)))
    for i in range(3):
        lines.filter(F.col("_slice") == i).select("value").coalesce(1).write.text(f"{folder}/s{i}")
        _time.sleep(1.1)  # increasing file times: the source takes older files first
    out = work_path(spark, "slices-out")
    stream = streaming.feature_stream(
        text.read_line_stream(spark, folder + "/*", max_files_per_trigger=1), "1 hour")
    query = streaming.run_available_now(stream, out, out + "-ckpt")
    assert len(query.recentProgress) >= 3
    got = rounded(spark.read.parquet(out))
    max_ts = f.typed.agg(F.max("ts")).first()[0]
    batch = rounded(features.window_features(f.deduped, "1 hour")).filter(
        F.col("window_start") + F.expr("INTERVAL 1 HOUR") <= F.lit(max_ts) - F.expr("INTERVAL 10 MINUTES"))
    assert got.count() == batch.count()
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0


def test_rows_without_a_stamp_never_enter_state(spark):
    """After the watermark has passed all but one row, state holds that row's
    copies only."""
    from windowlens.streaming.features import dedupe_stream, typed_stream, unstamped
    folder = work_path(spark, "state-lines")
    bad = ["2024-13-45 99:99:99 /api/view 200 %d" % i for i in range(150)]
    for part, rows in (("a", bad + ["2024-02-01 00:00:%02d /api/view 200 1" % i for i in range(30)]),
                       ("b", ["2024-02-29 00:00:00 /api/view 200 1"]), ("c", ["2024-02-29 00:00:00 /api/view 200 1"])):
        spark.createDataFrame([(v,) for v in rows], "value string").coalesce(1).write.text(f"{folder}/{part}")
        out = work_path(spark, "state-out") if part == "a" else out
        typed = typed_stream(text.read_line_stream(spark, folder + "/*"))
        query = streaming.run_available_now(dedupe_stream(typed, salt_buckets=2), out, out + "-ckpt")
    held = [op["numRowsTotal"] for op in query.lastProgress["stateOperators"]]
    assert held == [1, 1]
    assert spark.read.parquet(out).count() == 31
    rest = work_path(spark, "state-rest")
    streaming.run_available_now(unstamped(typed_stream(text.read_line_stream(spark, folder + "/*"))), rest, rest + "-c")
    assert spark.read.parquet(rest).count() == 150


def test_open_windows_complete_the_stream(spark, small_dir):
    """The windows in state are those the sink lacks."""
    f = Frames(spark, small_dir)
    folder, out = work_path(spark, "open-lines"), work_path(spark, "open-out")
    text.write_lines(f.lines, folder)
    lines = text.read_line_stream(spark, folder)
    streaming.run_available_now(streaming.count_stream(lines, "1 hour"), out, out + "-ckpt")
    closed = spark.read.parquet(out)
    held = streaming.open_counts(spark, out + "-ckpt")
    assert held.count() > 0 and closed.join(held, "window_start", "left_semi").count() == 0
    whole, batch = streaming.all_windows(spark, closed, out + "-ckpt"), f.features("1 hour")
    assert batch.count() == whole.count()
    assert rounded(whole).exceptAll(rounded(batch)).count() == 0


def _folder(spark, name, rows, folder=None):
    folder = folder or work_path(spark, name)
    spark.createDataFrame([(v,) for v in rows], "value string").coalesce(1).write.mode("append").text(folder)
    return folder


def test_bridging_row_of_a_later_batch_merges_sessions(spark):
    at = "2024-03-01 10:%02d:00 /api/%s 200 %d"
    folder = _folder(spark, "bridge", [at % (0, "view", 10), at % (5, "view", 20), at % (25, "view", 30),
                                       at % (5, "click", 1)])
    out = work_path(spark, "bridge-out")

    def run():
        stream = streaming.session_stream(text.read_line_stream(spark, folder), "15 minutes", delay="1 hour")
        streaming.run_available_now(stream, out, out + "-ckpt")
        return {(r["endpoint"], str(r["session_start"])[11:16], str(r["session_end"])[11:16], r["total_requests"])
                for r in spark.read.parquet(out).collect()}
    assert run() == set()
    _folder(spark, "", [at % (15, "view", 40), at % (50, "view", 50)], folder)
    _folder(spark, "", [streaming.closing_line("2100-01-01 00:00:00")], folder)
    found = run()
    assert found == {("/api/view", "10:00", "10:40", 4), ("/api/view", "10:50", "11:05", 1),
                     ("/api/click", "10:05", "10:20", 1)}
    rows = spark.read.text(folder).where("not value like '2100%'")
    from windowlens.operators import clean, parse
    batch = features.session_features(clean.dedupe(clean.typed_rows(parse.parse_lines(rows))), "15 minutes")
    got = spark.read.parquet(out)
    assert rounded(got).select(*batch.columns).exceptAll(rounded(batch)).count() == 0 and batch.count() == 3


def test_label_stream_keeps_windows_without_rows(spark):
    """Every label comes out once, with nulls where no row is, and state
    holds no more than the closing label afterwards."""
    labels = ["window_start,is_anomalous,anomaly_type"] + ["2024-03-01 1%d:00:00,%d,none" % (h, h % 2) for h in range(6)]
    label_folder = _folder(spark, "labels", labels + ["not a stamp,1,size"])
    folder = _folder(spark, "label-lines", ["2024-03-01 11:%02d:00 /api/view 500 %d" % (m, m) for m in range(30)]
                     + ["2024-03-01 14:30:00 /api/view 200 7"])
    out = work_path(spark, "labelled-out")

    def run():
        stream = streaming.labeled_stream(streaming.label_stream(spark, label_folder),
                                          text.read_line_stream(spark, folder), "1 hour")
        query = streaming.run_available_now(stream, out, out + "-ckpt")
        got = {str(r["window_start"])[11:13]: r["total_requests"] for r in spark.read.parquet(out).collect()}
        return got, [op["numRowsTotal"] for op in query.lastProgress["stateOperators"]]
    assert run()[0] == {"10": None, "11": 30, "12": None, "13": None}
    _folder(spark, "", labels[:1] + ["2100-01-01 00:00:00,0,none"], label_folder)
    _folder(spark, "", [streaming.closing_line("2100-01-01 00:00:00")], folder)
    got, state = run()
    assert got == {"10": None, "11": 30, "12": None, "13": None, "14": 1, "15": None}
    assert spark.read.parquet(out).count() == 6 and max(state) <= 1
