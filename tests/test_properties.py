"""Property tests: the lenient casts follow their stated rule on arbitrary text."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from commerce_lake.functions import scalars as X

_DOUBLE = re.compile(r"[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?", re.ASCII)
_INT = re.compile(r"[+-]?\d+", re.ASCII)

texts = st.one_of(
    st.integers(-10**12, 10**12).map(str),
    st.floats(allow_nan=False, allow_infinity=False, width=32).map(repr),
    st.text(alphabet="0123456789+-.eE ad", max_size=8),
    st.text(max_size=6),
)


def expected_double(t):
    return float(t) if t is not None and _DOUBLE.fullmatch(t) else 0.0


def expected_int(t):
    if t is None or not _INT.fullmatch(t):
        return 0
    v = int(t)
    return v if -2**31 <= v < 2**31 else 0


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(st.none(), texts), min_size=50, max_size=200))
def test_lenient_casts_match_rule(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = df.select("v", X.double_or_zero("v").alias("d"), X.int_or_zero("v").alias("i")).collect()
    for r in got:
        assert r["d"] == expected_double(r["v"]), r
        assert r["i"] == expected_int(r["v"]), r
