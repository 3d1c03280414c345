"""Batches that add up: incremental load, late rows, model versions."""

import pytest
from pyspark.sql import functions as F

from windowlens.operators import clean, features, incremental, model
from windowlens.plans.frames import Frames, rounded
from windowlens.session import work_path
from windowlens.sources import text
from windowlens.streaming import features as streaming
from windowlens.streaming import load, scoring

ROW = "ts timestamp_ntz, endpoint string, status_code int, response_size bigint"


def rows(spark, *values):
    return spark.createDataFrame([(f"2024-03-0{d} {t}", e, s, n) for d, t, e, s, n in values],
                                 ROW.replace("timestamp_ntz", "string")).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def equal(a, b):
    a, b = rounded(a), rounded(b).select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_counts_add_up_to_the_features(spark, small_dir):
    typed = Frames(spark, small_dir).deduped
    part = F.pmod(F.xxhash64("ts", "endpoint"), F.lit(3))
    counts = [features.window_counts(typed.where(part == i), "1 hour") for i in range(3)]
    whole = features.features_of_counts(counts[0].unionByName(counts[1]).unionByName(counts[2]))
    assert equal(whole, features.window_features(typed, "1 hour"))


def test_batches_that_cut_windows_and_repeat_rows(spark, small_dir):
    typed = Frames(spark, small_dir).typed.checkpoint()
    store = work_path(spark, "store")
    half = F.pmod(F.unix_timestamp("ts"), F.lit(300)) < 150
    for name, batch in (("a", typed.where(half & (F.dayofmonth("ts") < 20))), ("b", typed.where(F.dayofmonth("ts") > 10)),
                        ("c", typed), ("b", typed.where(F.dayofmonth("ts") > 10)), ("d", typed.limit(0))):
        incremental.load_batch(batch, store, name)
    assert equal(incremental.stored_features(spark, store), features.window_features(clean.dedupe(typed)))
    kept = incremental.loaded_rows(spark, store)
    assert kept.count() == clean.dedupe(typed).where("ts is not null").count()


def test_a_batch_only_reads_and_writes_its_days(spark):
    store = work_path(spark, "days")
    incremental.load_batch(rows(spark, (1, "10:00:00", "a", 200, 1), (2, "10:00:00", "a", 200, 5)), store, "1")
    before = {f.path: f.modificationTime for f in files(spark, f"{store}/features")}
    incremental.load_batch(rows(spark, (2, "10:01:00", "a", 500, 7), (2, "10:01:00", "a", 500, 7),
                                (2, "10:00:00", "a", 200, 5), (3, "00:00:00", None, None, None)), store, "2")
    after = {f.path: f.modificationTime for f in files(spark, f"{store}/features")}
    assert {p: t for p, t in before.items() if "date=2024-03-01" in p}.items() <= after.items()
    got = {str(r["window_start"]): tuple(r)[1:] for r in rounded(incremental.stored_features(spark, store)).collect()}
    assert got == {"2024-03-01 10:00:00": (1, 0.0, 1.0, 1.0), "2024-03-02 10:00:00": (2, 0.5, 6.0, 6.9),
                   "2024-03-03 00:00:00": (1, None, None, None)}


def files(spark, path):
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
            .load(path).select("path", "modificationTime").collect())


def test_failed_batch_is_run_again(spark, monkeypatch):
    """Rows are stored but the counts fail: the next attempt repairs both."""
    store = work_path(spark, "again")
    batch = rows(spark, (1, "10:00:00", "a", 200, 1), (1, "10:01:00", "b", 404, 3))
    incremental.load_batch(rows(spark, (1, "10:00:00", "a", 200, 1)), store, "0")

    def fail(*_):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(incremental, "window_counts", fail)
        with pytest.raises(RuntimeError):
            incremental.load_batch(batch, store, "1")
    incremental.load_batch(batch, store, "1")
    assert [tuple(r)[1:] for r in rounded(incremental.stored_features(spark, store)).collect()] == [(2, 0.5, 2.0, 2.9)]


def test_late_rows_are_kept(spark):
    """closed + open + late = all distinct rows, whatever the order."""
    folder, store = work_path(spark, "late"), work_path(spark, "late-store")
    at = "2024-03-01 %02d:%02d:00 /api/view 200 %d"
    arrivals = [[at % (10, m, m) for m in range(0, 60, 5)],
                [at % (12, 30, 1), at % (10, 55, 55)],                       # a copy of a stored row
                [at % (10, 1, 1), at % (10, 1, 1), at % (10, 5, 5), at % (12, 25, 2), "broken"],
                [at % (10, 1, 1), at % (10, 2, 2), at % (13, 0, 3)]]         # a late row once more
    for i, lines in enumerate(arrivals):
        spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1).write.mode("append").text(folder)
        load.run_load_stream(text.read_line_stream(spark, folder), store, "1 hour")
    late = load.late_rows(spark, store)
    assert sorted((r["ts"].minute, r["batch"]) for r in late.collect()) == [(1, "2"), (2, "3")]
    states = {(r["window_start"].hour, r["state"]): r["total_requests"]
              for r in load.window_states(spark, store, "1 hour").collect()}
    assert states == {(10, "closed"): 12, (12, "open"): 2, (13, "open"): 1}
    load.load_micro_batch(clean.typed_rows(_parsed(spark, arrivals[3])), 3, store, "1 hour")   # run again
    assert load.late_rows(spark, store).count() == 2
    assert {(r["window_start"].hour, r["total_requests"]) for r in load.window_states(spark, store, "1 hour").collect()} \
        == {(10, 12), (12, 2), (13, 1)}


def _parsed(spark, lines):
    from windowlens.operators import parse
    return parse.parse_lines(spark.createDataFrame([(v,) for v in lines], "value string"))


def test_each_row_is_scored_by_its_version(spark, small_dir):
    train = Frames(spark, small_dir).hourly_training.checkpoint()
    base = work_path(spark, "registry")
    with pytest.raises(ValueError):
        scoring.newest(spark, base)
    at = "2024-03-%02d 10:%02d:00 /api/view 200 %d"
    for day, reg in ((1, 0.01), (5, 1.0), (9, None)):
        if reg:
            assert scoring.publish(model.fit(train, reg_param=reg), base, spark) == (1 if day == 1 else 2)
        spark.createDataFrame([(at % (day + x, m, m + 1),) for m in range(9) for x in (0, 1)], "value string").coalesce(
            1).write.mode("append").text(f"{base}/lines")
        stream = streaming.feature_stream(text.read_line_stream(spark, f"{base}/lines"), "1 hour")
        scoring.run_scored(stream, base, f"{base}/out", f"{base}/checkpoint")
    got = spark.read.parquet(f"{base}/out").collect()
    assert sorted((r["window_start"].day, r["version"]) for r in got) == [(1, 1), (2, 2), (5, 2), (6, 2), (9, 2)]
    for version in (1, 2):
        fitted = model.load(f"{base}/models/{version}")
        mine = [r for r in got if r["version"] == version]
        again = model.score(fitted, spark.createDataFrame(mine).drop("prediction", "prob_anomalous"), ["window_start"])
        assert {(r["window_start"], round(r["prob_anomalous"], 12)) for r in again.collect()} == {
            (r["window_start"], round(r["prob_anomalous"], 12)) for r in mine}
