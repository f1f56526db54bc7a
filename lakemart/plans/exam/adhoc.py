"""Ad-hoc reports straight off bronze.

Each reads only the period(s) it needs — a partition filter when bronze is
the partitioned table — and averages the unrounded bronze grades (unlike the
marts, which average the rounded staging grades).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakemart.functions import eligible, harmonize, map_codes, mean, n_of, share_where
from lakemart.operators.aggregate import grouped_report
from lakemart.plans.exam import vocab as V
from lakemart.plans.exam.staging import dependency_school_type


def income_by_sex(bronze: DataFrame, period: str = "2024", ordered: bool = True) -> DataFrame:
    """Income band (17) × sex (M01); grouped on the raw codes, labels projected."""
    src = bronze.where((F.col("ano") == period) &
                       eligible(present=["tp_presenca_mt"], positive=["nu_nota_mt"], not_null=["q007"]))
    return grouped_report(
        src, ["q007", "tp_sexo"],
        {"total": n_of("nu_inscricao"), "media_matematica": mean("nu_nota_mt"),
         "media_redacao": mean("nu_nota_redacao"), "media_humanas": mean("nu_nota_ch")},
        labels={"faixa_renda": map_codes("q007", V.INCOME_17), "sexo": map_codes("tp_sexo", V.SEX)},
        order=["q007", "tp_sexo"] if ordered else None,
    )


def race_by_year(bronze: DataFrame, periods=V.PERIODS, ordered: bool = True) -> DataFrame:
    """Race × period with the public-school share."""
    src = bronze.where(F.col("ano").isin(list(periods)) &
                       eligible(present=["tp_presenca_mt", "tp_presenca_lc"],
                                positive=["nu_nota_mt", "nu_nota_redacao"],
                                between={"tp_cor_raca": (1, 5)}))
    public = harmonize([
        ((F.col("ano") == "2023") & (F.col("tp_escola") == 2), True),
        ((F.col("ano") == "2024") & F.col("tp_dependencia_adm_esc").isin(*V.PUBLIC_DEPENDENCY), True),
    ], default=False)
    return grouped_report(
        src, ["ano", "tp_cor_raca"],
        {"total_participantes": n_of("nu_inscricao"), "media_matematica": mean("nu_nota_mt"),
         "media_linguagens": mean("nu_nota_lc"), "media_redacao": mean("nu_nota_redacao"),
         "pct_escola_publica": share_where(public)},
        labels={"ano": F.col("ano"), "cor_raca": map_codes("tp_cor_raca", V.RACE)},
        order=["tp_cor_raca", "ano"] if ordered else None,
    )


def mother_schooling(bronze: DataFrame, period: str = "2024", ordered: bool = True) -> DataFrame:
    """Mother's schooling (M03) with public-school share and household size."""
    src = bronze.where((F.col("ano") == period) &
                       eligible(present=["tp_presenca_mt"], positive=["nu_nota_mt", "nu_nota_redacao"],
                                isin={"q002": list(V.SCHOOLING)}))
    return grouped_report(
        src, ["q002"],
        {"total": n_of("nu_inscricao"), "media_matematica": mean("nu_nota_mt"),
         "media_redacao": mean("nu_nota_redacao"),
         "pct_escola_publica": share_where(F.col("tp_dependencia_adm_esc").isin(*V.PUBLIC_DEPENDENCY)),
         "media_pessoas_residencia": mean("q005", as_double=True)},
        labels={"escolaridade_mae": map_codes("q002", V.SCHOOLING)},
        order=["q002"] if ordered else None,
    )


def income_band_by_school(bronze: DataFrame, period: str = "2024", ordered: bool = True) -> DataFrame:
    """Nine income bands × school type (M04): grouped on the band expressions,
    so codes sharing a band merge into one row."""
    src = bronze.where((F.col("ano") == period) &
                       eligible(present=["tp_presenca_mt"], positive=["nu_nota_mt", "nu_nota_redacao"],
                                not_null=["q007"],
                                isin={"tp_dependencia_adm_esc": [*V.PUBLIC_DEPENDENCY, V.PRIVATE_DEPENDENCY]}))
    return grouped_report(
        src,
        [map_codes("q007", V.INCOME_9, default=V.INCOME_9_OTHER).alias("faixa_renda"),
         dependency_school_type().alias("tipo_escola")],
        {"total": n_of("nu_inscricao"), "media_matematica": mean("nu_nota_mt"),
         "media_redacao": mean("nu_nota_redacao"), "media_ciencias": mean("nu_nota_cn")},
        order=["faixa_renda", "tipo_escola"] if ordered else None,
    )
