import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sonoledger.functions import scalars as S
from sonoledger.functions.paths import ancestors, basename, directory, parent_name, posix_path, stem
from sonoledger.functions.sparkline import sparkline


def column(spark, values, expr, ddl="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {ddl}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_tolerant_long(spark):
    cases = {
        "12": 12, "12.9": 12, "-12.9": -12, "1e3": 1000, " 7 ": 7, "1_000": 1000, "+.5": 0, "5.": 5,
        "": None, "NA": None, "12d": None, "12f": None, "nan": None, "inf": None, "Infinity": None,
        "1__0": None, "_1": None, "0x10": None, "1e400": None, "abc": None, "1 2": None, None: None,
    }
    assert column(spark, list(cases), S.tolerant_long("v")) == list(cases.values())


def test_seconds_to_ms_truncates(spark):
    values = ["0.1", "0.4", "1.5", "-1.5", "bad", "", None, "0.0019"]
    assert column(spark, values, S.seconds_to_ms("v")) == [100, 400, 1500, -1500, None, None, None, 1]


@settings(max_examples=3, deadline=None)
@given(st.lists(st.floats(0, 1e6), min_size=200, max_size=400))
def test_round_hundredths_is_exact(spark, values):
    values = [*values, 67.725, 90.275, 0.125, 2.675, 1.005, 0.375, 12345.675]
    got = column(spark, values, S.round_hundredths("v"), "double")
    assert got == [round(v, 2) for v in values]


def test_bucket_index(spark):
    values = [0, 59_999, 1_800_000, 3_600_000, None, -1]
    assert column(spark, values, S.bucket_index("v", 30), "bigint") == [0, 0, 1, 2, 0, -1]
    assert column(spark, [60_000], S.bucket_index("v", 0), "bigint") == [1]


def test_memory(spark):
    row = spark.range(1).select(
        S.memory_estimate_mb(F.lit(60.0), F.lit(32000), F.lit(2), F.lit(2)).alias("mb"),
        S.memory_limit_mb(F.lit(8192.0)).alias("limit"),
        S.memory_limit_mb(F.lit(0.1)).alias("small"),
        S.memory_limit_mb(F.lit(None).cast("double")).alias("none"),
    ).first()
    assert row.mb == pytest.approx(32000 * 4 * 4 * 60 * 1.35 / 2**20)
    assert (row.limit, row.small, row.none) == (pytest.approx(6553.6), 1.0, 4096.0)


def test_paths(spark):
    values = ["/a/b/c.wav", "/a/b.d/e", "x.tar.gz", "/a/.hidden", "/a/b/"]
    assert column(spark, values, basename("v")) == ["c.wav", "e", "x.tar.gz", ".hidden", "b"]
    assert column(spark, values, stem("v")) == ["c", "e", "x.tar", ".hidden", "b"]
    assert column(spark, values, parent_name("v")) == ["b", "b.d", "", "a", "a"]
    assert column(spark, values, directory("v")) == ["/a/b", "/a/b.d", "", "/a", "/a"]
    assert column(spark, ["/a/b/c"], ancestors("v")) == [["/a", "/a/b", "/a/b/c"]]
    assert column(spark, ["file:///a/b%20c+d"], posix_path("v", True)) == ["/a/b c+d"]
    assert column(spark, ["s3://x/y"], posix_path("v")) == ["s3://x/y"]


def expected_line(values, width, palette=" .:-=+*#%@"):
    if not values:
        return "-"
    n = len(values)
    pts = [values[math.floor(i * (n / width))] for i in range(width)] if n > width else values
    lo, hi = min(pts), max(pts)
    if lo == hi:
        return palette[5] * len(pts)
    return "".join(palette[int((v - lo) / (hi - lo) * 9)] for v in pts)


def test_sparkline(spark):
    series = [[5.0, 5.0, 5.0], [], [1.0], [float(i) for i in range(30)],
              [float(i * i % 17) for i in range(25)], [0.0, 1.0], None]
    got = column(spark, series, sparkline("v", width=12), "array<double>")
    assert got == [expected_line(s, 12) for s in series]
    assert column(spark, [[1.0, 2.0, 3.0]], sparkline("v", width=0), "array<double>") == ["+"]
