"""Parser edge lines (tag, reason, fields) and typed-row casts."""


from windowlens.operators.clean import typed_rows
from windowlens.operators.parse import parse_audit, parse_lines, quarantine

GOOD = "2026-07-01 14:23:45 /api/search 200 912"

CASES = [
    # line, parse_ok, reason, fields (timestamp, endpoint, status, size)
    (GOOD, True, "ok", ("2026-07-01 14:23:45", "/api/search", "200", "912")),
    ("2026-13-45 99:99:99 /api/search 200 912", True, "ok", ("2026-13-45 99:99:99", "/api/search", "200", "912")),
    ("2026-07-01 14:23:45 /api/search 200 99999999999", True, "ok",
     ("2026-07-01 14:23:45", "/api/search", "200", "99999999999")),
    ("2026-07-01 14:23:45 /api/search 912", False, "malformed", ("", "", "", "")),
    ("20XX-XX-XX 99:99:99 /api/search 200 912", False, "malformed", ("", "", "", "")),
    ("2026-07-01 1", False, "malformed", ("", "", "", "")),
    ("2026-07-01 14:23:45 /api/search 200 ABCxyz", False, "malformed", ("", "", "", "")),
    (GOOD + ' "extra=1" sid=deadbeef', False, "malformed", ("", "", "", "")),
    ("", False, "blank", ("", "", "", "")),
    (None, False, "null", (None, None, None, None)),
    # a final line terminator: Java's $ matches before it, so the fields are
    # filled, but the match is not the whole line and the line is rejected
    (GOOD + " ", False, "malformed", ("2026-07-01 14:23:45", "/api/search", "200", "912")),
    (GOOD + "\n", False, "malformed", ("2026-07-01 14:23:45", "/api/search", "200", "912")),
]


def _lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_edge_lines(spark):
    out = parse_lines(_lines(spark, [c[0] for c in CASES])).collect()
    got = {r["value"]: r for r in out}
    for line, ok, reason, fields in CASES:
        r = got[line]
        assert r["parse_ok"] is ok, line
        assert r["parse_reason"] == reason, line
        assert (r["timestamp"], r["endpoint"], r["status_code"], r["response_size"]) == fields, line


def test_typed_rows_casts(spark):
    typed = typed_rows(parse_lines(_lines(spark, [c[0] for c in CASES]))).collect()
    assert len(typed) == 3  # the three accepted lines
    by_size = {r["response_size"]: r for r in typed}
    assert by_size[99999999999]["ts"] is not None  # bigint keeps large sizes
    assert any(r["ts"] is None for r in typed)  # calendar-invalid stamp -> NULL, no failure
    assert all(isinstance(r["status_code"], int) for r in typed)


def test_quarantine_and_audit(spark):
    parsed = parse_lines(_lines(spark, [c[0] for c in CASES]))
    q = quarantine(parsed)
    assert q.count() == sum(1 for c in CASES if not c[1])
    a = parse_audit(parsed).first()
    assert a["lines"] == len(CASES) and a["rejected"] == q.count()


def test_one_regex_pass_no_python(spark):
    plan = parse_lines(_lines(spark, [GOOD]))._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_strict_timestamps_reject_calendar_invalid_stamps(spark):
    lines = _lines(spark, [GOOD, "2026-13-45 99:99:99 /api/search 200 912", ""])
    got = {r["value"]: r for r in parse_lines(lines, strict_timestamps=True).collect()}
    assert got[GOOD]["parse_ok"] is True
    bad = got["2026-13-45 99:99:99 /api/search 200 912"]
    assert bad["parse_ok"] is False and bad["parse_reason"] == "bad_timestamp"
    assert typed_rows(parse_lines(lines, strict_timestamps=True)).filter("ts is null").count() == 0
