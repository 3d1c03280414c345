"""Sketches, fingerprints of parts, numbered lines and the file ledger."""

import pytest
from pyspark.sql import functions as F

from windowlens.operators import lineage, quality, sketches
from windowlens.session import work_path
from windowlens.sources import text


@pytest.fixture(scope="module")
def many(spark):
    """60,000 rows of three hours in skewed sizes, some without one."""
    size = F.when(F.col("id") % 50 == 0, None).otherwise((F.pow(F.rand(3), 6) * 1e6).cast("bigint"))
    return spark.range(60_000, numPartitions=6).select(
        (F.lit("2024-03-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") * 10800 / 60000))
        .alias("ts"), F.lit(200).alias("status_code"), size.alias("response_size")).checkpoint()


def test_rolled_up_quantiles_stay_within_the_bound(spark, many):
    five = sketches.window_sketches(many, "5 minutes", k=200)
    hours = sketches.roll_up(five, "1 hour")
    for table, width, k in ((five, "5 minutes", 200), (hours, "1 hour", 200), (sketches.roll_up(hours, "3 hours"), "3 hours", 200)):
        found = sketches.sketch_features(table).checkpoint()
        assert found.agg(F.sum("total_requests")).first()[0] == 60_000
        checked = sketches.rank_check(found, many, width, sketches.kll_rank_error(k))
        assert checked.where("not within").count() == 0 and checked.count() == found.count()
        wrong = found.withColumn("p95_response_size", F.col("p95_response_size") * 2)
        assert sketches.rank_check(wrong, many, width, sketches.kll_rank_error(k)).where("within").count() == 0


def test_windows_without_sizes(spark, many):
    none = many.limit(10).withColumn("response_size", F.lit(None).cast("bigint"))
    got = sketches.sketch_features(sketches.roll_up(sketches.window_sketches(none), "1 day")).collect()
    assert [tuple(r)[1:] for r in got] == [(10, 0.0, None, None)]


def test_distinct_over_ranges(spark, many):
    parts = sketches.distinct_sketches(many, "response_size", F.minute("ts"))
    for span in (F.lit(0), F.col("part") % 3):
        exact = {r[0]: r[1] for r in many.withColumn("part", F.minute("ts")).groupBy(span.alias("s")).agg(
            F.count_distinct("response_size")).collect()}
        for r in sketches.distinct_over(parts, span).collect():
            assert abs(r["distinct_values"] - exact[r["span"]]) <= exact[r["span"]] * sketches.hll_error()


def table(spark, *rows):
    return spark.createDataFrame(rows, "date string, k long, v string").repartition(3)


def test_each_kind_of_damage_is_found(spark):
    whole = [("a", 1, "x"), ("a", 2, None), ("b", 1, "x"), ("b", 1, "x"), ("c", 5, "y"), ("d", 6, "z"), (None, 7, "n")]
    other = [("a", 2, None), ("a", 1, "x"), ("b", 1, "x"), ("c", 5, "Y"), ("d", 6, "z"), ("d", 6, "z"), ("e", 9, "w")]
    got = {r["date"]: (r["missing"], r["extra"])
           for r in quality.reconcile_parts(table(spark, *whole), table(spark, *other), ["k", "v"], "date").collect()}
    assert got == {"b": (1, 0), "c": (1, 1), "d": (0, 1), "e": (0, 1), None: (1, 0)}
    sizes = {r["date"]: (r["rows_in"], r["rows_out"])
             for r in quality.parts_that_differ(table(spark, *whole), table(spark, *other), ["k", "v"], "date").collect()}
    assert sizes == {"b": (2, 1), "c": (1, 1), "d": (1, 2), "e": (0, 1), None: (1, 0)}
    assert quality.reconcile_parts(table(spark, *whole), table(spark, *reversed(whole)), ["k", "v"], "date").count() == 0


def test_swapped_values_between_rows_are_found(spark):
    a, b = table(spark, ("a", 1, "x"), ("a", 2, "y")), table(spark, ("a", 1, "y"), ("a", 2, "x"))
    assert quality.reconcile_parts(a, b, ["k", "v"], "date").first().asDict() == {"date": "a", "missing": 2, "extra": 2}


def test_first_lines_under_any_split_size(spark):
    folder = work_path(spark, "numbered")
    want = []
    for f in range(4):
        lines = [f"file {f} line {i}" + "x" * (i % 7) for i in range(0 if f == 2 else 300 + f)]
        want += lines
        spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1).write.text(f"{folder}/{f}")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for cut in ("1kb", "7kb", "128mb"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", cut)
            for n in (0, 1, 299, 300, 301, 650, None, 5000):
                got = sorted((r["line_no"], r["value"]) for r in
                             text.numbered_lines(spark, folder + "/*", n).collect())
                assert got == list(enumerate(want[:n], 1)), (cut, n)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_only_new_files_are_read(spark):
    folder, ledger, seen = work_path(spark, "files"), work_path(spark, "ledger"), []

    def add(*lines):
        spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1).write.mode("append").text(folder)

    def run(name, fail=False):
        def job(rows):
            if fail:
                raise RuntimeError("lost")
            seen.append(sorted(r["value"] for r in rows.collect()))
        return lineage.run_once(spark, folder, ledger, name, job, "*.txt")
    add("a", "b")
    assert run("1") == 1 and run("2") == 0 and seen == [["a", "b"]]
    add("c")
    with pytest.raises(RuntimeError):
        run("3", fail=True)
    assert run("4") == 1 and seen[1:] == [["c"]] and run("5") == 0
    assert sorted(r["run"] for r in lineage.ledger(spark, ledger).collect()) == ["1", "4"]
