"""Bronze → staging (M05): eligible participants, harmonized across periods.

The same source column means different things per period (income is q006 in
2023 and q007 in 2024; the public-school flag comes from ``tp_escola`` in 2023
and from the administrative dependency in 2024), so the period-dependent
columns are built from rule lists.  The result is one projection over one
filtered scan: filters go to Parquet, only the ~25 referenced columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegerType

from lakemart.functions import (by_period, code_to_bool, eligible, harmonize, lookup_dense, lookup_text,
                                map_codes, members, rounded, row_mean)
from lakemart.functions.sqlexpr import literal
from lakemart.plans.exam import vocab as V

GRADES = ["nu_nota_cn", "nu_nota_ch", "nu_nota_lc", "nu_nota_mt", "nu_nota_redacao"]


def staging_filter() -> Column:
    """All four presences and positive math and essay grades (staging scope)."""
    return eligible(present=["tp_presenca_mt", "tp_presenca_cn", "tp_presenca_ch", "tp_presenca_lc"],
                    positive=["nu_nota_mt", "nu_nota_redacao"])


def public_school(year: Column) -> Column:
    """Period rule for the public-school flag; false when no rule applies."""
    dep = F.col("tp_dependencia_adm_esc")
    return harmonize([
        ((year == 2023) & (F.col("tp_escola") == 2), True),
        ((year == 2024) & dep.isin(*V.PUBLIC_DEPENDENCY), True),
    ], default=False)


def dependency_school_type() -> Column:
    dep = F.col("tp_dependencia_adm_esc")
    return harmonize([(dep.isin(*V.PUBLIC_DEPENDENCY), V.SCHOOL_PUBLIC),
                      (dep == V.PRIVATE_DEPENDENCY, V.SCHOOL_PRIVATE)], default=V.SCHOOL_UNKNOWN)


def school_type(year: Column) -> Column:
    """Nested period rule: per-period label with its own ELSE, no outer ELSE."""
    return by_period(year, {
        2023: map_codes("tp_escola", V.SCHOOL_2023, default=V.SCHOOL_UNKNOWN),
        2024: dependency_school_type(),
    })


def stage_exam(bronze: DataFrame) -> DataFrame:
    """The 23-column staging projection of eligible rows.

    The period is converted to an integer once (its own projection, kept
    separate by the optimizer because five rules reuse it) and the rules
    compare integers, as the modelled staging model does.
    """
    src = bronze.where(staging_filter()).select("*", F.col("ano").cast(IntegerType()).alias("_ano_int"))
    year = F.col("_ano_int")
    return src.select(
        F.col("nu_inscricao"),
        F.col("nu_sequencial"),
        year.alias("ano"),
        map_codes("tp_sexo", V.SEX).alias("sexo"),
        map_codes("tp_cor_raca", V.RACE, default=V.RACE_UNDECLARED).alias("cor_raca"),
        lookup_dense("tp_faixa_etaria", V.AGE_BAND, default=V.AGE_BAND_OTHER).alias("faixa_etaria"),
        map_codes("tp_st_conclusao", V.COMPLETION).alias("situacao_ensino_medio"),
        code_to_bool("in_treineiro").alias("eh_treineiro"),
        public_school(year).alias("escola_publica"),
        school_type(year).alias("tipo_escola"),
        by_period(year, {2023: F.col("q006"), 2024: F.col("q007")}).alias("renda_familiar_cod"),
        F.col("q001").alias("escolaridade_pai_cod"),
        F.col("q002").alias("escolaridade_mae_cod"),
        F.col("q005").cast(IntegerType()).alias("pessoas_na_residencia"),
        F.col("sg_uf_prova").alias("uf"),
        F.col("no_municipio_prova").alias("municipio"),
        lookup_text("sg_uf_prova", members(V.REGIONS)).alias("regiao"),
        rounded("nu_nota_cn").alias("nota_ciencias"),
        rounded("nu_nota_ch").alias("nota_humanas"),
        rounded("nu_nota_lc").alias("nota_linguagens"),
        rounded("nu_nota_mt").alias("nota_matematica"),
        rounded("nu_nota_redacao").alias("nota_redacao"),
        row_mean(["nu_nota_cn", "nu_nota_ch", "nu_nota_lc", "nu_nota_mt", "nu_nota_redacao"])
        .alias("nota_media_geral"),
    )


def _case(column: str, book, default: str | None = None) -> str:
    whens = " ".join(f"WHEN {literal(code)} THEN {literal(label)}" for code, label in book.items())
    return f"CASE {column} {whens}{f' ELSE {literal(default)}' if default is not None else ''} END"


def _round(x: str) -> str:
    """One decimal, the rule of :func:`lakemart.functions.rounded`."""
    v = f"({x}) * 10.0D"
    up = f"CASE WHEN abs({v}) - rint(abs({v})) = 0.5D THEN 1.0D ELSE 0.0D END"
    return f"CASE WHEN abs({v}) < double('Infinity') THEN signum({v}) * (rint(abs({v})) + {up}) / 10.0D ELSE {x} END"


def staging_sql(bronze_table: str) -> str:
    """:func:`stage_exam` as the text of a query over a catalog table, for a persistent view.

    The rules come from the same code books; what the two forms return is compared row by row in the tests and by the
    registered queries.  The period is compared as text, so a reader's filter on ``ano`` prunes partitions."""
    year = "CAST(ano AS INT)"
    public = ", ".join(map(str, V.PUBLIC_DEPENDENCY))
    dep = "tp_dependencia_adm_esc"
    by_dependency = (f"CASE WHEN {dep} IN ({public}) THEN {literal(V.SCHOOL_PUBLIC)} WHEN {dep} = {V.PRIVATE_DEPENDENCY} "
                     f"THEN {literal(V.SCHOOL_PRIVATE)} ELSE {literal(V.SCHOOL_UNKNOWN)} END")
    grades = {"nota_ciencias": "nu_nota_cn", "nota_humanas": "nu_nota_ch", "nota_linguagens": "nu_nota_lc",
              "nota_matematica": "nu_nota_mt", "nota_redacao": "nu_nota_redacao"}
    columns = {
        "nu_inscricao": "nu_inscricao",
        "nu_sequencial": "nu_sequencial",
        "ano": year,
        "sexo": _case("tp_sexo", V.SEX),
        "cor_raca": _case("tp_cor_raca", V.RACE, V.RACE_UNDECLARED),
        "faixa_etaria": _case("tp_faixa_etaria", V.AGE_BAND, V.AGE_BAND_OTHER),
        "situacao_ensino_medio": _case("tp_st_conclusao", V.COMPLETION),
        "eh_treineiro": _case("in_treineiro", {1: True, 0: False}),
        "escola_publica": f"CASE WHEN {year} = 2023 AND tp_escola = 2 THEN true WHEN {year} = 2024 AND {dep} IN ({public}) THEN true ELSE false END",
        "tipo_escola": f"CASE {year} WHEN 2023 THEN {_case('tp_escola', V.SCHOOL_2023, V.SCHOOL_UNKNOWN)} WHEN 2024 THEN {by_dependency} END",
        "renda_familiar_cod": f"CASE {year} WHEN 2023 THEN q006 WHEN 2024 THEN q007 END",
        "escolaridade_pai_cod": "q001",
        "escolaridade_mae_cod": "q002",
        "pessoas_na_residencia": "CAST(q005 AS INT)",
        "uf": "sg_uf_prova",
        "municipio": "no_municipio_prova",
        "regiao": _case("sg_uf_prova", members(V.REGIONS)),
        **{name: _round(grade) for name, grade in grades.items()},
        "nota_media_geral": _round(f"({' + '.join(GRADES)}) / {float(len(GRADES))}D"),
    }
    present = " AND ".join(f"tp_presenca_{area} = 1" for area in ("mt", "cn", "ch", "lc"))
    select = ", ".join(f"{expr} AS {name}" for name, expr in columns.items())
    return f"SELECT {select} FROM {bronze_table} WHERE {present} AND nu_nota_mt > 0 AND nu_nota_redacao > 0"
