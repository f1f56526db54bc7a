"""Unit tests for Column builders on hand-built edge rows (FIXTURES §7)."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType

from lakemart.functions import (bucket_by_membership, by_period, code_to_bool, count_where,
                                harmonize, lenient_cast, map_codes, mean, n, rounded, row_mean,
                                safe_ratio, share_where)


def test_lenient_cast_integral(spark):
    df = spark.createDataFrame([("7",), (" 7 ",), ("2.0",), ("",), ("abc",), (None,), ("2.7",)], "x string")
    got = [r[0] for r in df.select(lenient_cast("x", LongType())).collect()]
    assert got == [7, 7, 2, None, None, None, 2]


def test_lenient_cast_double(spark):
    df = spark.createDataFrame([("1.5",), (" 2 ",), ("x",), (None,)], "x string")
    got = [r[0] for r in df.select(lenient_cast("x", DoubleType())).collect()]
    assert got == [1.5, 2.0, None, None]


def test_map_codes_with_and_without_default(spark):
    df = spark.createDataFrame([(1,), (9,), (None,)], "c int")
    labels = {1: "one", 2: "two"}
    rows = df.select(map_codes("c", labels).alias("a"), map_codes("c", labels, default="other").alias("b"),
                     map_codes(F.col("c"), labels, default="other").alias("c2")).collect()
    assert [tuple(r) for r in rows] == [("one", "one", "one"), (None, "other", "other"),
                                        (None, "other", "other")]


def test_code_to_bool(spark):
    df = spark.createDataFrame([(1,), (0,), (5,), (None,)], "c int")
    assert [r[0] for r in df.select(code_to_bool("c")).collect()] == [True, False, None, None]


def test_harmonize_periods(spark):
    rows = [(2023, 2, None), (2023, None, 1.0), (2024, None, 3.0), (2024, 2, 4.0), (2025, 2, 1.0)]
    df = spark.createDataFrame(rows, "ano int, tp_escola int, dep double")
    y, dep = F.col("ano"), F.col("dep")
    flag = harmonize([((y == 2023) & (F.col("tp_escola") == 2), True),
                      ((y == 2024) & dep.isin(1, 2, 3), True)], default=False)
    label = by_period(y, {2023: map_codes("tp_escola", {2: "pub", 3: "priv"}, default="unk"),
                          2024: harmonize([(dep.isin(1, 2, 3), "pub"), (dep == 4, "priv")], default="unk")})
    got = [tuple(r) for r in df.select(flag, label).collect()]
    assert got == [(True, "pub"), (False, "unk"), (True, "pub"), (False, "priv"), (False, None)]


def test_bucket_by_membership(spark):
    df = spark.createDataFrame([("SP",), ("AM",), ("ZZ",), (None,)], "uf string")
    g = {"Sudeste": ["SP", "RJ"], "Norte": ["AM"]}
    assert [r[0] for r in df.select(bucket_by_membership("uf", g)).collect()] == ["Sudeste", "Norte", None, None]
    assert [r[0] for r in df.select(bucket_by_membership(F.col("uf"), g, default="?")).collect()] == \
        ["Sudeste", "Norte", "?", "?"]


def test_rounded_half_away_from_zero_on_scaled_value(spark):
    df = spark.createDataFrame([(0.25,), (-2.25,), (1.005,), (2.675,), (0.15,), (None,), (-0.04,),
                                (0.049999999999999996,), (float("inf"),), (float("nan"),)], "x double")
    got = [r[0] for r in df.select(rounded("x", 1)).collect()]
    assert got[:2] == [0.3, -2.3]
    assert got[5] is None
    assert str(got[6]) == "-0.0" and got[7] == 0.0 and got[8] == float("inf") and got[9] != got[9]
    two = [r[0] for r in df.select(rounded("x", 2)).collect()]
    assert two[2] == 1.0          # 1.005 * 100 is just below 100.5


def test_row_mean_null_and_rounding(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (1.0, 1.0, 1.25)], "a double, b double, c double")
    got = [r[0] for r in df.select(row_mean(["a", "b", "c"], 1)).collect()]
    assert got == [None, 1.1]


def test_safe_ratio_zero_total(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (None, 3)], "p int, t int")
    assert [r[0] for r in df.select(safe_ratio("p", "t")).collect()] == [0.5, None, None]


def test_measures(spark):
    df = spark.createDataFrame([("a", 1.0, True), ("a", 2.0, None), ("a", None, False)], "k string, v double, f boolean")
    r = df.groupBy("k").agg(n().alias("n"), mean("v").alias("m"), count_where(F.col("f")).alias("c"),
                            share_where(F.col("f")).alias("s")).first()
    assert (r["n"], r["m"], r["c"], r["s"]) == (3, 1.5, 1, 33.3)


def _spark_non_ansi(spark, values, kind):
    """What Spark's own cast gives with ANSI off."""
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        return [r[0] for r in spark.createDataFrame([(v,) for v in values], "x string").selectExpr(f"CAST(x AS {kind})").collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_lenient_cast_equals_the_non_ansi_cast(spark):
    from hypothesis import given, settings, strategies as st, HealthCheck
    from lakemart.operators import conform
    from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

    texts = st.one_of(st.none(), st.text(alphabet=" \t\n\r\x00\x0b\x7f0123456789.+-aeE", max_size=12), st.sampled_from([".", "+.", "-", "", ".5", "-.7", "\t2.0", "2.0\t"]),
                      st.from_regex(r"[ \t]?[+-]?[0-9]{0,20}(\.[0-9]{0,9})?[ \n]?", fullmatch=True))

    @settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(texts, min_size=100, max_size=300))
    def check(values):
        df = spark.createDataFrame([(v,) for v in values], "x string")
        for to in (LongType(), IntegerType(), DoubleType()):
            want = list(map(repr, _spark_non_ansi(spark, values, to.simpleString())))
            for got in (df.select(lenient_cast("x", to)), conform(df, StructType([StructField("x", to)]))):
                got = [repr(r[0]) for r in got.collect()]
                assert got == want, [(v, g, w) for v, g, w in zip(values, got, want) if g != w][:5]
    check()


def test_lenient_cast_truncates_long_fractions(spark):
    df = spark.createDataFrame([("2.9999999",), ("-3.75",), ("12.",), ("1e3",), (".5",)], "x string")
    assert [r[0] for r in df.select(lenient_cast("x", LongType())).collect()] == [2, -3, 12, None, 0]


@pytest.mark.parametrize("size", [2, 6, 27])
@pytest.mark.parametrize("kind, codes", [("string", [f"k{i}" for i in range(30)]), ("int", list(range(30))), ("double", [float(i) for i in range(30)]),
                                         ("int", [f"{i:02d}" for i in range(30)]), ("double", [str(i) for i in range(30)])])
def test_one_mapping_rule_for_every_book_size(spark, size, kind, codes):
    """A book answers like a plain CASE in the column's own type, however long it is."""
    book = {c: f"label {c}" for c in codes[1:size + 1]}
    values = [f"k{i}" for i in range(30)] if kind == "string" else [float(i) if kind == "double" else i for i in range(30)]
    df = spark.createDataFrame([(v,) for v in [*values, None]], f"c {kind}")
    case = " ".join(f"WHEN c = {repr(k)} THEN '{v}'" for k, v in book.items())
    groups = {"first": list(book)[:size // 2], "rest": list(book)}
    member = f"CASE WHEN c IN ({', '.join(map(repr, groups['first']))}) THEN 'first' WHEN c IN ({', '.join(map(repr, groups['rest']))}) THEN 'rest' END"
    got = df.select(map_codes("c", book), map_codes("c", book, default="other"), bucket_by_membership("c", groups)).collect()
    want = df.selectExpr(f"CASE {case} END", f"CASE {case} ELSE 'other' END", member).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want] and sum(r[0] is not None for r in got) == size


def test_text_lookup_refuses_other_types(spark):
    from pyspark.errors import AnalysisException
    from lakemart.functions import lookup_text, members
    book = members({"g1": ["A", "B", "C"], "g2": ["C", "D"]})            # "C" in both: the first group wins
    df = spark.createDataFrame([("C",), ("D",), ("Q",), (None,)], "c string")
    assert [tuple(r) for r in df.select(lookup_text("c", book), lookup_text("c", book, "?")).collect()] == \
        [("g1", "g1"), ("g2", "g2"), (None, "?"), (None, "?")]
    with pytest.raises(AnalysisException):
        spark.range(3).select(lookup_text("id", book)).collect()


def test_dense_lookup_equals_a_case(spark):
    from lakemart.functions import lookup_dense
    book = {i: f"band {i}" for i in range(1, 13)}
    df = spark.createDataFrame([(x,) for x in [*range(-2, 16), 2**40, -2**62, None]], "c long")
    for default in (None, "other"):
        assert df.select(lookup_dense("c", book, default)).collect() == df.select(map_codes("c", book, default)).collect()
    with pytest.raises(ValueError):
        lookup_dense("c", {1: "a", 3: "b"})


def test_rounding_of_huge_values_returns_them(spark):
    rows = [1e308, -1e308, float("inf"), 1.7e308, 2.25, None]
    df = spark.createDataFrame([(x,) for x in rows], "x double")
    assert [r[0] for r in df.select(rounded("x", 1)).collect()] == [1e308, -1e308, float("inf"), 1.7e308, 2.3, None]
