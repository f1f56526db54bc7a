"""Staging → marts (M06–M08).  Each mart is one hash aggregation (partial
per task, final after a shuffle of at most a few thousand groups)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakemart.functions import mean, n, share_where, map_codes
from lakemart.operators.aggregate import grouped_report
from lakemart.plans.exam import vocab as V


def mart_state(staging: DataFrame, ordered: bool = True) -> DataFrame:
    """Performance by period, state and region (M06), best overall mean first."""
    return grouped_report(
        staging, ["ano", "uf", "regiao"],
        {
            "total_participantes": n(),
            "media_matematica": mean("nota_matematica"),
            "media_ciencias": mean("nota_ciencias"),
            "media_humanas": mean("nota_humanas"),
            "media_linguagens": mean("nota_linguagens"),
            "media_redacao": mean("nota_redacao"),
            "media_geral": mean("nota_media_geral"),
            "pct_escola_publica": share_where(F.col("escola_publica")),
        },
        order=[F.col("ano"), F.col("media_geral").desc(), F.col("uf"), F.col("regiao")] if ordered else None,
    )


def mart_inequality(staging: DataFrame, ordered: bool = True) -> DataFrame:
    """Race × school type × period (M07); undeclared/unknown excluded (NULLs drop too)."""
    src = staging.where((F.col("cor_raca") != V.RACE_UNDECLARED) & (F.col("tipo_escola") != V.SCHOOL_UNKNOWN))
    return grouped_report(
        src, ["ano", "cor_raca", "tipo_escola"],
        {
            "total": n(),
            "media_matematica": mean("nota_matematica"),
            "media_redacao": mean("nota_redacao"),
            "media_geral": mean("nota_media_geral"),
        },
        order=["ano", "cor_raca", "tipo_escola"] if ordered else None,
    )


def mart_mobility(staging: DataFrame, ordered: bool = True) -> DataFrame:
    """Mother's schooling × period (M08): grouped on the code, label projected."""
    src = staging.where(F.col("escolaridade_mae_cod").isin(list(V.SCHOOLING)))
    return grouped_report(
        src, ["ano", "escolaridade_mae_cod"],
        {
            "total": n(),
            "media_matematica": mean("nota_matematica"),
            "media_redacao": mean("nota_redacao"),
            "media_geral": mean("nota_media_geral"),
            "pct_escola_publica": share_where(F.col("escola_publica")),
            "media_pessoas_residencia": mean("pessoas_na_residencia", as_double=True),
        },
        labels={"ano": F.col("ano"),
                "escolaridade_mae": map_codes("escolaridade_mae_cod", V.SCHOOLING)},
        order=["ano", "escolaridade_mae_cod"] if ordered else None,
    )
