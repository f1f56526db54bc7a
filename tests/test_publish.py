"""Write, audit, publish: what readers see before, after and in the middle."""

import json
import os

import pytest
from pyspark.sql import functions as F

from lakemart.operators import DataQualityError
from lakemart.plans.exam.bronze import BronzeInputs, audit_bronze, build_bronze, read_bronze
from lakemart.plans.fixtures import exam_bronze_columns, table, write_exam_raw
from lakemart.sources import publish as P

from conftest import SF_SMALL


def rows(spark, n, *periods):
    return spark.range(n).select("id", F.element_at(F.array(*map(F.lit, periods)), (F.col("id") % len(periods) + 1).cast("int")).alias("ano"))


def live(spark, root):
    return {r["ano"]: r["count"] for r in spark.read.schema("id long, ano string").parquet(root).groupBy("ano").count().collect()}


def leftovers(root):
    return [n for n in os.listdir(root.removeprefix("file:")) if n.startswith(("_staged", "_retired", "_publish"))]


def test_staged_rows_are_invisible_until_published(spark, scratch):
    root = scratch("wap")
    P.publish(spark, P.stage(rows(spark, 10, "2022", "2023"), root, "ano"))
    staged = P.stage(rows(spark, 6, "2023", "2024"), root, "ano")
    assert P.staged_rows(spark, staged) == {"2023": 3, "2024": 3}
    assert live(spark, root) == {"2022": 5, "2023": 5}
    assert P.publish(spark, staged, dynamic=True) == ["ano=2023", "ano=2024"]
    assert live(spark, root) == {"2022": 5, "2023": 3, "2024": 3}
    P.publish(spark, P.stage(rows(spark, 4, "2024"), root, "ano"))                    # not dynamic: the others are retired
    assert live(spark, root) == {"2024": 4} and leftovers(root) == []


def test_discarded_and_empty_stages(spark, scratch):
    root = scratch("wap2")
    P.publish(spark, P.stage(rows(spark, 4, "2024"), root, "ano"))
    P.discard(spark, P.stage(rows(spark, 9, "2024"), root, "ano"))
    assert live(spark, root) == {"2024": 4} and leftovers(root) == []
    nothing = P.stage(rows(spark, 0, "2024"), root, "ano")
    assert P.staged_rows(spark, nothing) == {}
    assert P.publish(spark, nothing, dynamic=True) == [] and live(spark, root) == {"2024": 4}


@pytest.mark.parametrize("moves", range(6))
def test_a_publication_cut_short_is_finished(spark, scratch, monkeypatch, moves):
    """The driver dies before any of the renames; the next writer (or reader's recover) carries on."""
    root = scratch("wap3")
    P.publish(spark, P.stage(rows(spark, 9, "2021", "2022", "2023"), root, "ano"))
    staged = P.stage(rows(spark, 8, "2022", "2023"), root, "ano")
    done, move = [], P._Files.move

    def dies(self, old, new):
        if len(done) >= moves:
            raise KeyboardInterrupt
        done.append(old)
        move(self, old, new)

    monkeypatch.setattr(P._Files, "move", dies)
    with pytest.raises(KeyboardInterrupt):
        P.publish(spark, staged)
        raise KeyboardInterrupt
    monkeypatch.undo()
    cut = any(n.startswith("_publish-") and not n.endswith(".part") for n in leftovers(root))
    finished = P.recover(spark, root)
    assert finished == ([staged.version] if cut else [])
    if moves == 0:                                       # not even the log was there: the old partitions stay
        assert live(spark, root) == {"2021": 3, "2022": 3, "2023": 3}
        return
    assert live(spark, root) == {"2022": 4, "2023": 4} and leftovers(root) == []
    assert P.recover(spark, root) == []


def test_a_stage_without_a_log_never_becomes_live(spark, scratch):
    root = scratch("wap4")
    P.publish(spark, P.stage(rows(spark, 4, "2024"), root, "ano"))
    P.stage(rows(spark, 9, "2024"), root, "ano")                                       # its driver died before the audit
    assert P.recover(spark, root) == [] and live(spark, root) == {"2024": 4} and leftovers(root) == []


@pytest.mark.parametrize("dynamic", [False, True])
def test_failed_audit_leaves_the_old_bronze(spark, scratch, dynamic):
    inputs = write_exam_raw(exam_bronze_columns(table(spark, SF_SMALL, "orders")), scratch("raw"))
    out = scratch("bronze")
    build_bronze(spark, inputs, out, dynamic=dynamic)
    before = sorted(map(str, read_bronze(spark, out).select("nu_inscricao", "ano", "nu_nota_mt").collect()))
    # a release in which absent candidates carry grades
    wrong = exam_bronze_columns(table(spark, SF_SMALL, "orders")).withColumn("tp_presenca_mt", F.lit(0)).withColumn("nu_nota_mt", F.lit(512.5))
    bad = write_exam_raw(wrong, scratch("raw-bad"))
    with pytest.raises(DataQualityError, match="nu_nota_mt"):
        build_bronze(spark, bad, out, dynamic=dynamic)
    with pytest.raises(DataQualityError, match="without rows"):
        empty = scratch("raw-empty")
        spark.createDataFrame([], "NU_INSCRICAO string").write.option("header", True).option("sep", ";").csv(empty)
        build_bronze(spark, BronzeInputs(single={"2023": empty}), out, dynamic=dynamic)
    assert sorted(map(str, read_bronze(spark, out).select("nu_inscricao", "ano", "nu_nota_mt").collect())) == before
    assert leftovers(out) == []
    assert build_bronze(spark, bad, out, dynamic=dynamic, audit=None)["inconsistent"]["nu_nota_mt"] > 0    # the caller may insist


def test_audit_names_what_does_not_add_up():
    info = {"rows": 5, "rows_by_period": {"2023": 5}, "staged_rows": {"2023": 4}, "inconsistent": {}}
    with pytest.raises(DataQualityError, match="do not add up"):
        audit_bronze(info)
    audit_bronze(info | {"staged_rows": {"2023": 5}})
    assert json.dumps(info)


def test_persistent_staging_view(spark, scratch):
    """Stored in its own schema, the same rows as the projection, partitions pruned through it, and it follows the table."""
    from lakemart.plans.exam.bronze import BRONZE_SCHEMA
    from lakemart.plans.exam.staging import stage_exam, staging_sql
    from lakemart.sources import create_view, register_table
    out = scratch("bronze-view")
    build_bronze(spark, write_exam_raw(exam_bronze_columns(table(spark, SF_SMALL, "orders")), scratch("raw")), out)
    bronze = register_table(spark, "default.lm_view_bronze", out, BRONZE_SCHEMA, ["ano"])
    spark.sql("CREATE DATABASE IF NOT EXISTS lm_view_staging")
    create_view(spark, "lm_view_staging.stg_exam", staging_sql("default.lm_view_bronze"))
    other = spark.newSession().table("lm_view_staging.stg_exam")
    want = stage_exam(bronze)
    assert [(f.name, f.dataType) for f in other.schema] == [(f.name, f.dataType) for f in want.schema]
    assert sorted(map(str, other.collect())) == sorted(map(str, want.collect()))
    plan = other.where("ano = 2023")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano" in plan and "tp_sexo" in plan and "q025" not in plan
    odd = want.limit(0).count()
    assert odd == 0 and not any(t.isTemporary for t in spark.catalog.listTables("lm_view_staging") if t.name == "stg_exam")
