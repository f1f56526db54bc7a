"""Games-notebook flows on small typed samples of our own."""


from lakemart.plans.games import entry_ratios, export_csv, load_tables, top_list

ENTRIES = [("Archery", 64, 64, 128), ("Boxing", 102, 187, 289), ("Sailing", 175, 175, 350),
           ("Empty", 0, 0, 0)]


def test_entry_ratios_invariant_and_zero_total(spark):
    df = spark.createDataFrame(ENTRIES, "Discipline string, Female int, Male int, Total int")
    out = {r["Discipline"]: r for r in entry_ratios(df, {"Avg_Female": "Female", "Avg_Male": "Male"}, "Total").collect()}
    for name, r in out.items():
        assert r["Female"] + r["Male"] == r["Total"]
        if r["Total"]:
            assert abs(r["Avg_Female"] + r["Avg_Male"] - 1.0) < 1e-12
    assert out["Empty"]["Avg_Female"] is None and out["Empty"]["Avg_Male"] is None
    assert out["Archery"]["Avg_Female"] == 0.5


def test_csv_round_trip_with_inference(spark, scratch):
    df = spark.createDataFrame(ENTRIES, "Discipline string, Female int, Male int, Total int")
    paths = export_csv({"entriesgender": df}, scratch("games"))
    back = load_tables(spark, paths)["entriesgender"]
    assert [f.dataType.simpleString() for f in back.schema.fields] == ["string", "int", "int", "int"]
    assert sorted(tuple(r) for r in back.collect()) == sorted(ENTRIES)


def test_top_list_ties_nulls(spark):
    medals = spark.createDataFrame([("A", 3), ("B", None), ("C", 5), ("D", 3)] + [(f"X{i}", 1) for i in range(30)],
                                   "Team_Country string, Gold int")
    got = [tuple(r) for r in top_list(medals, "Gold", "Team_Country").collect()]
    assert len(got) == 20
    assert got[:3] == [("C", 5), ("A", 3), ("D", 3)]
    assert ("B", None) not in got


def test_read_inferred_with_pinned_schema_and_sampling(spark, scratch):
    from lakemart.sources import read_inferred, write_csv
    df = spark.createDataFrame(ENTRIES, "Discipline string, Female int, Male int, Total int")
    path = scratch("pinned")
    write_csv(df, path, files=2)
    pinned = read_inferred(spark, path, schema="Discipline string, Female long, Male long, Total long")
    assert [f.dataType.simpleString() for f in pinned.schema.fields] == ["string", "bigint", "bigint", "bigint"]
    sampled = read_inferred(spark, path, sampling_ratio=1.0)
    assert sorted(tuple(r) for r in sampled.collect()) == sorted(ENTRIES)


def test_preview_is_ordered_and_capped(spark):
    from lakemart.sources import preview
    df = spark.range(0, 100).selectExpr("99 - id AS k")
    assert [r[0] for r in preview(df, 5, by="k").collect()] == [0, 1, 2, 3, 4]
