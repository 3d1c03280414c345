"""Property: the one-regex-plus-split parser agrees with a plain full match
of the same pattern (Python ``re`` in ASCII mode, whose ``\\d``, ``\\S`` and
``$``-free full match agree with Java's for these inputs)."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from windowlens.functions import fixed
from windowlens.operators.parse import parse_lines

PATTERN = re.compile(fixed.LOG_LINE_PATTERN.rstrip("$").lstrip("^"), re.ASCII)

def fixed_digits(n):
    return st.text(alphabet="0123456789", min_size=n, max_size=n)


valid = st.builds(
    lambda y, mo, d, h, mi, sec, p, status, size: f"{y}-{mo}-{d} {h}:{mi}:{sec} /{p} {status} {size}",
    fixed_digits(4), fixed_digits(2), fixed_digits(2), fixed_digits(2), fixed_digits(2), fixed_digits(2),
    st.text(alphabet="/abcz-_.09", max_size=12), fixed_digits(3),
    st.text(alphabet="0123456789", min_size=1, max_size=12))
noise = st.sampled_from(list("0123456789 /aZ:-\t\"="))


@st.composite
def line(draw):
    """A valid line, then (half of the time) one random edit: replace, insert
    or delete one character, or append junk."""
    v = draw(valid)
    kind = draw(st.sampled_from(["none", "none", "none", "replace", "insert", "delete", "append"]))
    i = draw(st.integers(min_value=0, max_value=len(v) - 1))
    c = draw(noise)
    if kind == "replace":
        v = v[:i] + c + v[i + 1:]
    elif kind == "insert":
        v = v[:i] + c + v[i:]
    elif kind == "delete":
        v = v[:i] + v[i + 1:]
    elif kind == "append":
        v = v + c + draw(st.text(alphabet="aZ09=", max_size=4))
    return v


def expected(value):
    m = PATTERN.fullmatch(value)
    if m is None:
        return False, ("", "", "", "")
    return True, m.groups()


@settings(max_examples=4, deadline=None)
@given(st.lists(line(), min_size=60, max_size=120))
def test_parser_matches_full_match(spark, lines):
    lines = lines + ["2026-07-01 14:23:45 /api/x 200 1"]  # at least one accepted line per batch
    rows = parse_lines(spark.createDataFrame([(v,) for v in lines], "value string")).collect()
    for r in rows:
        ok, groups = expected(r["value"])
        assert r["parse_ok"] is ok, r["value"]
        if ok:
            assert (r["timestamp"], r["endpoint"], r["status_code"], r["response_size"]) == groups
