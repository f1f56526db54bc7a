"""Footer check of partitioned data (S06) and types inferred once and pinned."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemart.sources import (SchemaDrift, infer_types, merge_types, pin_schema, pinned_schema, read_delimited, read_inferred,
                              read_pinned, register_table, require_no_drift, schema_drift, write_csv, write_partitioned)

SCHEMA = StructType().add("id", "long").add("grade", "double").add("town", "string").add("seen", "timestamp").add("ano", "string")


def _rows(spark, period, n=50):
    return spark.range(n).select("id", (F.col("id") / 3).alias("grade"), F.lit("x").alias("town"),
                                 F.timestamp_seconds("id").alias("seen"), F.lit(period).alias("ano"))


@pytest.fixture()
def lake(spark, scratch):
    path = scratch("lake")
    for period in ("2022", "2023"):
        write_partitioned(_rows(spark, period).repartition(3), path, "ano", mode="append")
    return path


def test_no_drift_registers(spark, lake):
    assert schema_drift(spark, lake, SCHEMA, "ano").count() == 0
    assert register_table(spark, "lm_drift_ok", lake, SCHEMA, ["ano"], check=True).count() == 100


def test_changed_type_is_named_before_the_catalog_changes(spark, lake):
    register_table(spark, "lm_drift", lake, SCHEMA, ["ano"])
    write_partitioned(_rows(spark, "2024").withColumn("grade", F.col("grade").cast("string")).repartition(2), lake, "ano", mode="append")
    found = {tuple(r) for r in schema_drift(spark, lake, SCHEMA, ["ano"]).drop("path").collect()}
    assert found == {("2024", "grade", "double", "string", "type")}
    with pytest.raises(SchemaDrift, match=r"ano=2024 grade: declared double, found string \(type, 2 files\)"):
        register_table(spark, "lm_drift", lake, SCHEMA, ["ano"], replace=False, check=True)
    assert {r[0] for r in spark.sql("SHOW PARTITIONS lm_drift").collect()} == {"ano=2022", "ano=2023"}


def test_missing_and_extra_columns_are_reported_and_refused_on_demand(spark, lake):
    write_partitioned(_rows(spark, "a b/ç").drop("town").withColumn("new.one", F.lit(1)), lake, "ano", mode="append")
    rows = schema_drift(spark, lake, SCHEMA, ["ano"]).select("ano", "column", "found", "problem").distinct().collect()
    assert {tuple(r) for r in rows} == {("a b/ç", "town", None, "missing"), ("a b/ç", "new.one", "int", "extra")}
    require_no_drift(spark, lake, SCHEMA, ["ano"])
    with pytest.raises(SchemaDrift, match="town"):
        require_no_drift(spark, lake, SCHEMA, ["ano"], refuse=("missing",))


def test_files_of_other_writers_names_in_other_case_and_broken_files(spark, scratch):
    path = scratch("foreign")
    folder = path.removeprefix("file:") + "/ano=1"
    import os
    os.makedirs(folder)
    ok = pa.table({"ID": pa.array([1], pa.int64()), "grade": [0.5], "town": ["x"], "seen": pa.array([0], pa.timestamp("us", tz="UTC"))})
    pq.write_table(ok, f"{folder}/new.parquet")
    pq.write_table(ok, f"{folder}/old.parquet", use_deprecated_int96_timestamps=True)
    assert schema_drift(spark, path, SCHEMA, ["ano"]).count() == 0
    pq.write_table(ok.set_column(0, "id", pa.array([1], pa.int32())), f"{folder}/int.parquet")
    with open(f"{folder}/torn.parquet", "wb") as f:
        f.write(b"PAR1 torn")
    open(f"{folder}/empty.parquet", "wb").close()
    rows = schema_drift(spark, path, SCHEMA, ["ano"]).collect()
    assert sorted((r["path"].rsplit("/", 1)[1], r["column"], r["problem"]) for r in rows) == [("int.parquet", "id", "type"), ("torn.parquet", None, "footer")]
    with pytest.raises(SchemaDrift, match="bigint, found int"):
        require_no_drift(spark, path, SCHEMA, ["ano"])


COLUMNS = {
    "ints": ["1", "-7", "+5", "007", None], "longs": ["1", "3000000000", "-9223372036854775808", None, "2"],
    "huge": ["9223372036854775808", "1", "12345678901234567890123", None, "0"], "beyond": ["1" * 39, "1", None, "2", "3"],
    "reals": ["1", "2.5", "-.5", "1e3", "NaN"], "infinite": ["Inf", "-Inf", "1", "Infinity", None], "padded": [" 1", "2", "3", "4 ", None],
    "days": ["2024-02-29", "1999-12-31", None, "0001-01-01", "2020-01-01"], "no_day": ["2023-02-30", "2023-01-01", None, None, None],
    "times": ["2024-01-01", "2024-01-01 10:00:00", "2024-01-01T10:00:00Z", None, "2024-01-01 10:00:00.123"],
    "flags": ["true", "FALSE", None, "True", "false"], "mixed": ["1", "true", "2024-01-01", "x", None], "number_day": ["1", "2024-01-01", None, None, "2"],
    "real_flag": ["1.5", "true", None, "2", "3"], "nothing": [None] * 5, "suffix": ["1d", "2f", "3", None, "4"], "a.b": ["é", "1", "2", "3", "4"],
}


def _mixed(spark):
    names = list(COLUMNS)
    return spark.createDataFrame(list(zip(*COLUMNS.values())), ", ".join(f"`{n}` string" for n in names))


def test_types_are_those_that_spark_infers(spark, scratch):
    path = scratch("mixed")
    write_csv(_mixed(spark), path, files=1)
    want = {f.name: f.dataType for f in read_inferred(spark, path).schema.fields}
    got = {f.name: f.dataType for f in infer_types(read_delimited(spark, path, sep=",", encoding="UTF-8")).fields}
    assert got == want


def test_types_do_not_hang_on_order_or_split(spark):
    one = infer_types(_mixed(spark).coalesce(1))
    assert one == infer_types(_mixed(spark).repartition(5)) == infer_types(_mixed(spark).orderBy(F.col("mixed").desc()))
    swapped = spark.createDataFrame([("2024-01-01 10:00:00",), ("2020",)], "t string")
    assert infer_types(swapped).fields[0].dataType.simpleString() == "string"


def test_defined_cases_of_inference(spark):
    assert [f.dataType.simpleString() for f in infer_types(spark.createDataFrame([], "a string, b string")).fields] == ["string", "string"]
    assert infer_types(spark.createDataFrame([("",), (None,)], "a string")).fields[0].dataType.simpleString() == "string"
    assert infer_types(spark.range(1).select()) == StructType([])


def test_pin_is_read_back_and_later_reads_do_not_infer(spark, scratch, monkeypatch):
    from lakemart.sources import inference
    path = scratch("pinned")
    write_csv(spark.createDataFrame([(1, 2.5, "a"), (2, 0.5, "b")], "id long, x double, s string"), path)
    assert pinned_schema(spark, path) is None
    first = read_pinned(spark, path)
    assert first.schema.simpleString() == "struct<id:int,x:double,s:string>" == pinned_schema(spark, path).simpleString()
    monkeypatch.setattr(inference, "infer_types", lambda df: pytest.fail("inferred again"))
    assert sorted(read_pinned(spark, path).collect()) == sorted(first.collect()) and first.count() == 2


def test_drifted_release_fails_until_refreshed(spark, scratch):
    path = scratch("drifting")
    write_csv(spark.createDataFrame([(1,)], "id int"), path)
    read_pinned(spark, path)
    write_csv(spark.createDataFrame([("x",)], "id string"), path, mode="append")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_pinned(spark, path).collect()
    assert {r.id for r in read_pinned(spark, path, mode="PERMISSIVE").collect()} == {1, None}
    assert {r.id for r in read_pinned(spark, path, refresh=True).collect()} == {"1", "x"}
    pin_schema(spark, path, StructType.fromDDL("other string"))
    with pytest.raises(Exception, match="(?i)header"):
        read_pinned(spark, path).collect()


def test_merge_types_is_the_least_above_both(spark):
    a, b = StructType.fromDDL("i int, d date, n int, s boolean"), StructType.fromDDL("i bigint, d timestamp, n decimal(21,0), s int, z double")
    assert merge_types(a, b).simpleString() == "struct<i:bigint,d:timestamp,n:decimal(21,0),s:string,z:double>"
