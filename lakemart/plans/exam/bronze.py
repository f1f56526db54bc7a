"""Raw → bronze (M09): delimited releases of each period, conformed to one
declared schema, stacked and written as a Parquet dataset partitioned by period.

Row counts and audit figures are taken by observation on the write itself, the positional join
of the two 2024 files uses the exact split ordinal of :mod:`lakemart.operators.positional`, and nothing
becomes visible before the audit passed (:mod:`lakemart.sources.publish`).
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from lakemart.operators.positional import zip_by_position
from lakemart.operators.quality import DataQualityError
from lakemart.operators.schema import conform, lower_names, tag
from lakemart.operators.sets import stack_periods
from lakemart.plans.exam.vocab import OVERLAP_2024
from lakemart.session import Scratch
from lakemart.sources import publish as P
from lakemart.sources.files import read_delimited

_L, _D, _S = LongType(), DoubleType(), StringType()

# FIXED VALUES — the bronze layout (79 columns, this order, these types).
BRONZE_COLUMNS = [
    # identity
    ("nu_inscricao", _L), ("nu_sequencial", _L), ("nu_ano", _L),
    # profile
    ("tp_faixa_etaria", _L), ("tp_sexo", _S), ("tp_estado_civil", _L), ("tp_cor_raca", _L),
    ("tp_nacionalidade", _L), ("tp_st_conclusao", _L), ("tp_ano_concluiu", _L),
    ("tp_escola", _L), ("tp_ensino", _D), ("in_treineiro", _L),
    # school
    ("co_escola", _D), ("co_municipio_esc", _D), ("no_municipio_esc", _S), ("co_uf_esc", _D),
    ("sg_uf_esc", _S), ("tp_dependencia_adm_esc", _D), ("tp_localizacao_esc", _D),
    ("tp_sit_func_esc", _D),
    # exam place
    ("co_municipio_prova", _L), ("no_municipio_prova", _S), ("co_uf_prova", _L), ("sg_uf_prova", _S),
    # presence
    ("tp_presenca_cn", _L), ("tp_presenca_ch", _L), ("tp_presenca_lc", _L), ("tp_presenca_mt", _L),
    # booklets
    ("co_prova_cn", _D), ("co_prova_ch", _D), ("co_prova_lc", _D), ("co_prova_mt", _D),
    # grades
    ("nu_nota_cn", _D), ("nu_nota_ch", _D), ("nu_nota_lc", _D), ("nu_nota_mt", _D),
    # essay
    ("nu_nota_comp1", _D), ("nu_nota_comp2", _D), ("nu_nota_comp3", _D), ("nu_nota_comp4", _D),
    ("nu_nota_comp5", _D), ("nu_nota_redacao", _D),
    # answers and keys
    ("tx_respostas_cn", _S), ("tx_respostas_ch", _S), ("tx_respostas_lc", _S), ("tx_respostas_mt", _S),
    ("tp_lingua", _L), ("tx_gabarito_cn", _S), ("tx_gabarito_ch", _S), ("tx_gabarito_lc", _S),
    ("tx_gabarito_mt", _S), ("tp_status_redacao", _D),
    # questionnaire
    ("q001", _S), ("q002", _S), ("q003", _S), ("q004", _S), ("q005", _L), ("q006", _S),
    ("q007", _S), ("q008", _S), ("q009", _S), ("q010", _S), ("q011", _S), ("q012", _S),
    ("q013", _S), ("q014", _S), ("q015", _S), ("q016", _S), ("q017", _S), ("q018", _S),
    ("q019", _S), ("q020", _S), ("q021", _S), ("q022", _S), ("q023", _S), ("q024", _S),
    ("q025", _S),
    # period
    ("ano", _S),
]
BRONZE_SCHEMA = StructType([StructField(n, t) for n, t in BRONZE_COLUMNS])


@dataclass
class BronzeInputs:
    """Where each period's raw files are.  ``single`` periods have one unified
    file (or folder); ``split`` periods have two keyless files of equal row
    count to be aligned by position (left = participants, right = results)."""
    single: dict = field(default_factory=dict)          # period -> path
    split: dict = field(default_factory=dict)           # period -> (left path, right path)
    sep: str = ";"
    encoding: str = "ISO-8859-1"
    overlap: list = field(default_factory=lambda: list(OVERLAP_2024))


def period_frame(spark: SparkSession, inputs: BronzeInputs, period: str, scope: Scratch | None = None) -> DataFrame:
    """One period conformed to the bronze schema."""
    read = lambda p: read_delimited(spark, p, sep=inputs.sep, encoding=inputs.encoding)
    if period in inputs.single:
        raw = lower_names(read(inputs.single[period]))
    else:
        left, right = inputs.split[period]
        raw = zip_by_position(read(left), read(right), expected_overlap=inputs.overlap,
                              prepare=lower_names, scope=scope)
    return conform(tag(raw, "ano", str(period)), BRONZE_SCHEMA)


def bronze_frame(spark: SparkSession, inputs: BronzeInputs, scope: Scratch | None = None) -> DataFrame:
    """All periods stacked (UNION ALL by name), lazily."""
    periods = sorted(set(inputs.single) | set(inputs.split))
    return stack_periods([period_frame(spark, inputs, p, scope) for p in periods])


PRESENCE_GRADE = {"tp_presenca_mt": "nu_nota_mt", "tp_presenca_cn": "nu_nota_cn",
                  "tp_presenca_ch": "nu_nota_ch", "tp_presenca_lc": "nu_nota_lc"}


def audit_bronze(info: dict) -> None:
    """The gate between write and publish: every period has rows, the files hold what the write pass counted, and no
    row marked absent carries a grade (which a slipped positional join would give)."""
    empty = [p for p, n in info["rows_by_period"].items() if not n]
    if empty:
        raise DataQualityError(f"periods without rows: {empty}")
    if info["staged_rows"] != info["rows_by_period"] or sum(info["rows_by_period"].values()) != info["rows"]:
        raise DataQualityError(f"rows do not add up: {info['rows']} read, {info['rows_by_period']} by period, {info['staged_rows']} written")
    wrong = {k: v for k, v in info["inconsistent"].items() if v}
    if wrong:
        raise DataQualityError(f"rows marked absent carry a grade: {wrong}")


def build_bronze(spark: SparkSession, inputs: BronzeInputs, path: str, dynamic: bool = False,
                 max_records_per_file: int | None = None, audit=audit_bronze) -> dict:
    """Write bronze partitioned by ``ano``: staged, audited, then published.

    The audit's figures ride on the write pass itself (an ``Observation``, no extra
    scan): total rows, rows per period (reconciliation) and, per presence
    flag, rows marked absent that still carry a grade (positional-join audit); the
    rows of each staged partition are counted in the files.  ``audit`` raises to stop the
    publication: the bronze that was there stays as it was (None: publish unseen).
    """
    periods = sorted(set(inputs.single) | set(inputs.split))
    obs = Observation("bronze_audit")
    count = lambda c, name: F.sum(F.when(c, 1).otherwise(0)).alias(name)
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [count(F.col("ano") == p, f"rows_{p}") for p in periods]
    metrics += [count((F.col(pf) != 1) & F.col(g).isNotNull(), f"{g}_inconsistent") for pf, g in PRESENCE_GRADE.items()]
    with Scratch(spark) as scope:    # the tables of split offsets go once bronze is written
        staged = P.stage(bronze_frame(spark, inputs, scope).observe(obs, *metrics), path, "ano", max_records_per_file)
        got = obs.get
    info = {"rows": got["rows"], "path": path,
            "rows_by_period": {p: got[f"rows_{p}"] or 0 for p in periods},
            "inconsistent": {g: got[f"{g}_inconsistent"] or 0 for g in PRESENCE_GRADE.values()}}
    if audit is not None:
        seen = P.staged_rows(spark, staged)
        try:
            audit(info | {"staged_rows": {p: seen.get(p, 0) for p in info["rows_by_period"]} | {p: n for p, n in seen.items() if p not in periods}})
        except Exception:
            P.discard(spark, staged)
            raise
    P.publish(spark, staged, dynamic)
    return info


def build_periods(spark: SparkSession, inputs: BronzeInputs, path: str, max_records_per_file: int | None = None, audit=audit_bronze) -> dict:
    """Like :func:`build_bronze`, but every period is written, audited and published by itself: one that fails (unreadable files, parts of
    unequal length, a failed audit) leaves its partition as it was and does not keep the others from being published.

    Returns ``periods`` (one ``{period, status, rows, error}`` each, ``status`` is ``published`` or ``failed``), ``rows`` and
    ``failures`` (period -> error, as :func:`~lakemart.operators.quality.ingest_summary` takes it).
    """
    done = []
    for period in sorted(set(inputs.single) | set(inputs.split)):
        only = replace(inputs, single={p: v for p, v in inputs.single.items() if p == period},
                       split={p: v for p, v in inputs.split.items() if p == period and p not in inputs.single})
        try:
            rows = build_bronze(spark, only, path, True, max_records_per_file, audit)["rows"]
            done.append({"period": period, "status": "published", "rows": rows, "error": None})
        except Exception as e:                          # reported by period; an interrupt still ends the run
            done.append({"period": period, "status": "failed", "rows": 0, "error": f"{type(e).__name__}: {e}".split("\n", 1)[0]})
    return {"path": path, "rows": sum(d["rows"] for d in done), "periods": done,
            "failures": {d["period"]: d["error"] for d in done if d["status"] == "failed"}}


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """Bronze as written, ``ano`` pinned to string by the declared schema."""
    return spark.read.schema(BRONZE_SCHEMA).parquet(path)
