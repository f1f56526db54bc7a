"""Exam lakehouse bindings (XB = exam_bronze derived from orders)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from lakemart.functions import by_period, count_where, eligible, n, n_of, row_mean
from lakemart.harness.common import exam_bronze, staging
from lakemart.harness.registry import ORACLE, register
from lakemart.harness.sqltext import (MART_STATE_SQL, avg1, named, share1, STG_CTE, with_facts,
                                      with_stg, with_xb)
from lakemart.operators.positional import positional_audit
from lakemart.plans.exam import adhoc, marts, vocab as V
from lakemart.plans.exam.bronze import BRONZE_COLUMNS
from lakemart.plans.exam.staging import public_school, school_type, stage_exam
from lakemart.plans.fixtures import _XB_EXPRS, DIRTY_DOUBLE, DIRTY_LONG

# ---------------------------------------------------------------- composite queries


@register("m01_income_by_sex", named(f"""
SELECT income.label, sex.label, count(f.nu_inscricao), {avg1('f.nu_nota_mt', 'f.nu_nota_redacao', 'f.nu_nota_ch')}
FROM fact f JOIN income ON income.code = f.q007 LEFT JOIN sex ON sex.code = f.tp_sexo
WHERE f.ano = '2024' AND f.sat_mt AND f.has_mt
GROUP BY income.code, income.label, sex.code, sex.label
""", V.REPORT_COLUMNS["income_by_sex"]))
def m01(spark, sf_dir):
    return adhoc.income_by_sex(exam_bronze(spark, sf_dir))


@register("m02_race_by_year", named(f"""
SELECT f.ano, race.label, count(f.nu_inscricao), {avg1('f.nu_nota_mt', 'f.nu_nota_lc', 'f.nu_nota_redacao')}, {share1('f.is_public')}
FROM fact f JOIN race ON race.code = f.tp_cor_raca
WHERE f.sat_mt AND f.sat_lc AND f.has_both
GROUP BY f.ano, race.code, race.label
""", V.REPORT_COLUMNS["race_by_year"]))
def m02(spark, sf_dir):
    return adhoc.race_by_year(exam_bronze(spark, sf_dir))


@register("m03_mother_schooling", named(f"""
SELECT s.label, count(f.nu_inscricao), {avg1('f.nu_nota_mt', 'f.nu_nota_redacao')}, {share1('f.is_public')}, {avg1('f.q005::DOUBLE')}
FROM schooling s JOIN fact f ON f.q002 = s.code AND f.ano = '2024'
WHERE f.sat_mt AND f.has_both
GROUP BY s.code, s.label
""", V.REPORT_COLUMNS["mother_schooling"]))
def m03(spark, sf_dir):
    return adhoc.mother_schooling(exam_bronze(spark, sf_dir))


@register("m04_income_band_by_school", named(f"""
SELECT coalesce(band.label, '{V.INCOME_9_OTHER}'), f.school_label, count(f.nu_inscricao),
       {avg1('f.nu_nota_mt', 'f.nu_nota_redacao', 'f.nu_nota_cn')}
FROM fact f LEFT JOIN band ON band.code = f.q007
WHERE f.ano = '2024' AND f.sat_mt AND f.has_both AND f.q007 <> '' AND f.school_label <> ''
GROUP BY 1, 2
""", V.REPORT_COLUMNS["income_band_by_school"]))
def m04(spark, sf_dir):
    return adhoc.income_band_by_school(exam_bronze(spark, sf_dir))


@register("m05_staging", with_stg("SELECT * FROM stg"))
def m05(spark, sf_dir):
    return staging(spark, sf_dir)


@register("m06_mart_state", with_stg(MART_STATE_SQL))
def m06(spark, sf_dir):
    return marts.mart_state(staging(spark, sf_dir))


_MARKS = ["s.nota_matematica", "s.nota_redacao", "s.nota_media_geral"]


@register("m07_mart_inequality", named(f"""
SELECT s.ano, race.label, school_kind.label, count(*), {avg1(*_MARKS)}
FROM stg s JOIN race ON race.label = s.cor_raca
JOIN (SELECT DISTINCT label FROM school) school_kind ON school_kind.label = s.tipo_escola
GROUP BY ALL
""", V.REPORT_COLUMNS["inequality"], STG_CTE.strip()))
def m07(spark, sf_dir):
    return marts.mart_inequality(staging(spark, sf_dir))


@register("m08_mart_mobility", named(f"""
SELECT s.ano, schooling.label, count(*), {avg1(*_MARKS)}, {share1('s.escola_publica')}, {avg1('s.pessoas_na_residencia::DOUBLE')}
FROM stg s JOIN schooling ON schooling.code = s.escolaridade_mae_cod
GROUP BY s.ano, schooling.label
""", V.REPORT_COLUMNS["mobility"], STG_CTE.strip()))
def m08(spark, sf_dir):
    return marts.mart_mobility(staging(spark, sf_dir))


# ---------------------------------------------------------------- period rules on XB


@register("p11_period_public_school", with_facts("SELECT nu_inscricao, ano, is_public AS escola_publica FROM fact"))
def p11(spark, sf_dir):
    xb = exam_bronze(spark, sf_dir)
    return xb.select("nu_inscricao", "ano", public_school(F.col("ano").cast(IntegerType())).alias("escola_publica"))


@register("p12_period_school_type", with_facts(
    f"SELECT nu_inscricao, ano, coalesce(school_label, '{V.SCHOOL_UNKNOWN}') AS tipo_escola FROM fact"))
def p12(spark, sf_dir):
    xb = exam_bronze(spark, sf_dir)
    return xb.select("nu_inscricao", "ano", school_type(F.col("ano").cast(IntegerType())).alias("tipo_escola"))


@register("p13_period_column_pick", with_xb("""
SELECT nu_inscricao, ano, MAP {'2023': q006, '2024': q007}[ano] AS renda_familiar_cod FROM xb
"""))
def p13(spark, sf_dir):
    xb = exam_bronze(spark, sf_dir)
    y = F.col("ano").cast(IntegerType())
    return xb.select("nu_inscricao", "ano",
                     by_period(y, {2023: F.col("q006"), 2024: F.col("q007")}).alias("renda_familiar_cod"))


@register("p17_row_mean", with_xb("""
SELECT nu_inscricao,
  ROUND((nu_nota_cn + nu_nota_ch + nu_nota_lc + nu_nota_mt + nu_nota_redacao) / 5, 1) AS nota_media_geral
FROM xb
"""))
def p17(spark, sf_dir):
    xb = exam_bronze(spark, sf_dir)
    return xb.select("nu_inscricao",
                     row_mean(["nu_nota_cn", "nu_nota_ch", "nu_nota_lc", "nu_nota_mt", "nu_nota_redacao"])
                     .alias("nota_media_geral"))


# ---------------------------------------------------------------- filters / aggregates on XB


@register("f05_is_not_null", with_xb("""
SELECT nu_inscricao, q007 FROM xb WHERE q007 IS NOT NULL
"""))
def f05(spark, sf_dir):
    return exam_bronze(spark, sf_dir).where(eligible(not_null=["q007"])).select("nu_inscricao", "q007")


@register("f08_not_equal", with_stg("""
SELECT nu_inscricao, ano, tipo_escola FROM stg WHERE tipo_escola != 'Não informado'
"""))
def f08(spark, sf_dir):
    st = staging(spark, sf_dir)
    return st.where(eligible(not_equal={"tipo_escola": "Não informado"})).select("nu_inscricao", "ano", "tipo_escola")


@register("f09_eligibility_scopes", with_xb("""
SELECT ano,
  SUM(CASE WHEN tp_presenca_mt = 1 AND tp_presenca_cn = 1 AND tp_presenca_ch = 1 AND tp_presenca_lc = 1
            AND nu_nota_mt > 0 AND nu_nota_redacao > 0 THEN 1 ELSE 0 END)::BIGINT AS staging_scope,
  SUM(CASE WHEN tp_presenca_mt = 1 AND tp_presenca_lc = 1 AND nu_nota_mt > 0 AND nu_nota_redacao > 0
            THEN 1 ELSE 0 END)::BIGINT AS math_language_scope,
  SUM(CASE WHEN tp_presenca_mt = 1 AND nu_nota_mt > 0 THEN 1 ELSE 0 END)::BIGINT AS math_scope
FROM xb GROUP BY ano
"""))
def f09(spark, sf_dir):
    xb = exam_bronze(spark, sf_dir)
    return xb.groupBy("ano").agg(
        count_where(eligible(present=["tp_presenca_mt", "tp_presenca_cn", "tp_presenca_ch", "tp_presenca_lc"],
                             positive=["nu_nota_mt", "nu_nota_redacao"])).alias("staging_scope"),
        count_where(eligible(present=["tp_presenca_mt", "tp_presenca_lc"],
                             positive=["nu_nota_mt", "nu_nota_redacao"])).alias("math_language_scope"),
        count_where(eligible(present=["tp_presenca_mt"], positive=["nu_nota_mt"])).alias("math_scope"))


@register("a02_count_non_null", with_xb("""
SELECT ano, COUNT(nu_nota_cn) AS graded_cn, COUNT(*) AS total FROM xb GROUP BY ano
"""))
def a02(spark, sf_dir):
    return exam_bronze(spark, sf_dir).groupBy("ano").agg(n_of("nu_nota_cn").alias("graded_cn"), n().alias("total"))


@register("d06_positional_audit", with_xb("""
SELECT COUNT(*) AS rows,
  SUM(CASE WHEN tp_presenca_mt <> 1 AND nu_nota_mt IS NOT NULL THEN 1 ELSE 0 END)::BIGINT AS nu_nota_mt_inconsistent,
  SUM(CASE WHEN tp_presenca_cn <> 1 AND nu_nota_cn IS NOT NULL THEN 1 ELSE 0 END)::BIGINT AS nu_nota_cn_inconsistent,
  SUM(CASE WHEN tp_presenca_ch <> 1 AND nu_nota_ch IS NOT NULL THEN 1 ELSE 0 END)::BIGINT AS nu_nota_ch_inconsistent,
  SUM(CASE WHEN tp_presenca_lc <> 1 AND nu_nota_lc IS NOT NULL THEN 1 ELSE 0 END)::BIGINT AS nu_nota_lc_inconsistent
FROM xb
"""))
def d06(spark, sf_dir):
    return positional_audit(exam_bronze(spark, sf_dir),
                            {"tp_presenca_mt": "nu_nota_mt", "tp_presenca_cn": "nu_nota_cn",
                             "tp_presenca_ch": "nu_nota_ch", "tp_presenca_lc": "nu_nota_lc"})


# ---------------------------------------------------------------- M09 raw → bronze

_DUCK = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}
# what the raw text of two columns (fixtures.DIRTY_LONG / DIRTY_DOUBLE, by key) must become
_RAW_RULES = {
    "nu_ano": "ano::BIGINT",
    "nu_sequencial": f"{[v for _, v in DIRTY_LONG]}[(nu_inscricao % {len(DIRTY_LONG)} + 1)::INTEGER]::BIGINT".replace("None", "NULL"),
    "co_escola": f"{[v for _, v in DIRTY_DOUBLE]}[(nu_inscricao % {len(DIRTY_DOUBLE)} + 1)::INTEGER]::DOUBLE".replace("None", "NULL"),
}
_XB_NAMES = {e.rsplit(" AS ", 1)[-1] for e in _XB_EXPRS}
_BRONZE_SQL = ", ".join(
    f"{_RAW_RULES.get(n) or (n if n in _XB_NAMES else f'NULL::{_DUCK[t.simpleString()]}')} AS {n}" for n, t in BRONZE_COLUMNS)


@register("m09_raw_to_bronze", with_xb(f"SELECT {_BRONZE_SQL} FROM xb"))
def m09(spark, sf_dir):
    from lakemart.plans.exam.bronze import build_bronze, read_bronze
    from lakemart.plans.fixtures import exam_bronze_columns, table, write_exam_raw
    from lakemart.session import Scratch, scratch_path
    out = scratch_path(spark, "exam_bronze")
    with Scratch(spark) as scope:
        inputs = write_exam_raw(exam_bronze_columns(table(spark, sf_dir, "orders")), scratch_path(spark, "exam_raw", scope))
        build_bronze(spark, inputs, out)
    return read_bronze(spark, out)


# ---------------------------------------------------------------- the reports over stored, partitioned bronze


def _stored_bronze(spark, sf_dir, name: str):
    """XB written as the period-partitioned bronze table and read back through the catalog."""
    from lakemart.plans.exam.bronze import BRONZE_SCHEMA
    from lakemart.session import scratch_path
    from lakemart.sources import register_table, write_partitioned
    path = scratch_path(spark, name)
    write_partitioned(exam_bronze(spark, sf_dir), path, "ano")
    return register_table(spark, f"lm_{name}", path, BRONZE_SCHEMA, ["ano"])


@register("m01_stored_bronze", ORACLE["m01_income_by_sex"])
def m01_stored(spark, sf_dir):
    return adhoc.income_by_sex(_stored_bronze(spark, sf_dir, "bronze_m01"))


@register("m06_stored_bronze", ORACLE["m06_mart_state"])
def m06_stored(spark, sf_dir):
    return marts.mart_state(stage_exam(_stored_bronze(spark, sf_dir, "bronze_m06")))


@register("m05_persistent_view", ORACLE["m05_staging"])
def m05_view(spark, sf_dir):
    """The staging view stored in its own schema, read by name from another session."""
    from lakemart.plans.exam.staging import staging_sql
    from lakemart.sources import create_view
    _stored_bronze(spark, sf_dir, "bronze_m05")
    spark.sql("CREATE DATABASE IF NOT EXISTS lm_exam_staging")
    create_view(spark, "lm_exam_staging.stg_exam", staging_sql("default.lm_bronze_m05"))
    return spark.newSession().table("lm_exam_staging.stg_exam")
