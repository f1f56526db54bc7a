"""``exam_bronze`` (XB): an exam-shaped table derived from ``orders``.

There is no exam microdata among the supplied tables, so the exam plans run
on a table derived row-for-row from ``orders`` with integer formulas (one
narrow projection — no shuffle, grows with ``orders``).  The formulas
exercise every edge the exam rules care about: unmapped codes, NULL codes,
columns present in only one period, a variable that changes meaning per
period, zero grades, absent participants, accented text, a state with no
region.  Everything else is a typed NULL after ``conform``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, LongType

from lakemart.operators.schema import conform
from lakemart.plans.exam.bronze import BRONZE_SCHEMA

# FIXED VALUES — letter alphabets and the 2-letter state slots (ZZ has no region).
LETTERS_8 = "ABCDEFGH"
LETTERS_17 = "ABCDEFGHIJKLMNOPQ"
UF_SLOTS = "ACALAPAMBACEDFESGOMAMTMSMGPAPBPRPEPIRJRNRSRORRSCSPSETOZZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A supplied table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _letter(alphabet: str, idx: str) -> str:
    return f"substr('{alphabet}', CAST(({idx}) + 1 AS INT), 1)"


def _grade(a: int, b: int, absent_mod: int) -> str:
    return (f"CASE WHEN k % {absent_mod} = 0 THEN CAST(NULL AS DOUBLE) "
            f"ELSE CAST((k * {a} + u * {b}) % 401 AS DOUBLE) * 2.5D END")


# Derived exam columns over k = o_orderkey, u = o_custkey, y23 = period 2023.
_XB_EXPRS = [
    "k AS nu_inscricao",
    "CASE WHEN u % 2 = 0 THEN 'F' ELSE 'M' END AS tp_sexo",
    "k % 7 AS tp_cor_raca",
    "k % 15 + 1 AS tp_faixa_etaria",
    "u % 5 + 1 AS tp_st_conclusao",
    "CASE u % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 END AS in_treineiro",
    "CASE WHEN y23 THEN 1 + k % 3 END AS tp_escola",
    "CASE WHEN NOT y23 AND k % 6 <> 0 THEN CAST(k % 5 + 1 AS DOUBLE) END AS tp_dependencia_adm_esc",
    f"{_letter(LETTERS_8, '(k + u) % 8')} AS q001",
    f"{_letter(LETTERS_8, 'k % 8')} AS q002",
    "u % 10 + 1 AS q005",
    f"CASE WHEN y23 THEN {_letter(LETTERS_17, 'u % 17')} ELSE {_letter('AB', 'u % 2')} END AS q006",
    f"CASE WHEN y23 THEN {_letter('ABCD', 'u % 4')} "
    f"WHEN u % 19 <> 0 THEN {_letter(LETTERS_17, 'u % 17')} END AS q007",
    "concat('São ', CAST(u % 50 AS STRING)) AS no_municipio_prova",
    f"substr('{UF_SLOTS}', CAST((u % 28) * 2 + 1 AS INT), 2) AS sg_uf_prova",
    "CASE WHEN k % 11 = 0 THEN 0 ELSE 1 END AS tp_presenca_mt",
    "CASE WHEN k % 13 = 0 THEN 0 ELSE 1 END AS tp_presenca_cn",
    "CASE WHEN k % 17 = 0 THEN 2 ELSE 1 END AS tp_presenca_ch",
    "CASE WHEN k % 19 = 0 THEN 0 ELSE 1 END AS tp_presenca_lc",
    f"{_grade(7919, 104729, 11)} AS nu_nota_mt",
    f"{_grade(6101, 7207, 13)} AS nu_nota_cn",
    f"{_grade(5303, 9109, 17)} AS nu_nota_ch",
    f"{_grade(4409, 8101, 19)} AS nu_nota_lc",
    "CAST((k * 31 + u * 17) % 51 AS DOUBLE) * 20.0D AS nu_nota_redacao",
    "CASE WHEN y23 THEN '2023' ELSE '2024' END AS ano",
]


def exam_bronze_columns(orders: DataFrame) -> DataFrame:
    """The derived exam columns (before conforming to the bronze schema)."""
    base = orders.selectExpr("o_orderkey AS k", "o_custkey AS u", "year(o_orderdate) <= 1998 AS y23")
    return base.selectExpr(*_XB_EXPRS)


def exam_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """XB conformed to the 79-column bronze schema."""
    return conform(exam_bronze_columns(table(spark, sf_dir, "orders")), BRONZE_SCHEMA)


# Columns of the two keyless 2024 files (the split is ours; only the overlap is given).
PARTICIPANT_COLS = ["nu_inscricao", "nu_sequencial", "tp_sexo", "tp_cor_raca", "tp_faixa_etaria", "tp_st_conclusao",
                    "in_treineiro", "q001", "q002", "q005", "q006", "q007"]
RESULT_COLS = ["co_escola", "tp_escola", "tp_dependencia_adm_esc", "tp_presenca_mt", "tp_presenca_cn",
               "tp_presenca_ch", "tp_presenca_lc", "nu_nota_mt", "nu_nota_cn", "nu_nota_ch",
               "nu_nota_lc", "nu_nota_redacao"]
SHARED_COLS = ["nu_ano", "co_municipio_prova", "no_municipio_prova", "co_uf_prova", "sg_uf_prova"]


# FIXED VALUES — raw texts of two otherwise empty columns, by ``nu_inscricao`` modulo their number, and the
# value the declared type must give (an engine that throws or that drops the row fails the check).
DIRTY_LONG = [("2.0", 2), (" 7 ", 7), ("\t3", 3), ("", None), ("junk", None), (".5", 0), ("-.7", 0), ("1e3", None), ("4.9999\t", 4),
              ("99999999999999999999", None)]
DIRTY_DOUBLE = [("2.5", 2.5), (" 3 ", 3.0), ("\t4\t", 4.0), ("", None), ("x", None), (".5", 0.5), ("1e3", 1000.0)]

#: Files of the two keyless sides: different numbers, so their bounds never coincide.
LEFT_FILES, RIGHT_FILES = 4, 7


def write_exam_raw(xb_columns: DataFrame, root: str, left_files: int = LEFT_FILES, right_files: int = RIGHT_FILES):
    """Lay XB out as raw releases: 2023 as one unified `;`/Latin-1 folder with
    upper-case headers; 2024 as two keyless folders (participants / results)
    in key order, with different file counts and a padding column on one side
    so their split boundaries never coincide.  ``nu_sequencial`` and
    ``co_escola`` carry dirty text.  Returns ``BronzeInputs``."""
    from lakemart.plans.exam.bronze import BronzeInputs

    opts = {"header": True, "sep": ";", "encoding": "ISO-8859-1", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    dirty = lambda texts: F.element_at(F.array(*(F.lit(t) for t, _ in texts)), (F.col("nu_inscricao") % len(texts)).cast("int") + 1)
    shout = lambda cols: [F.col(c).alias(c.upper()) for c in cols]
    xb = xb_columns.withColumn("nu_ano", F.col("ano").cast(LongType())) \
                   .withColumn("co_municipio_prova", F.lit(None).cast(LongType())) \
                   .withColumn("co_uf_prova", F.lit(None).cast(LongType())) \
                   .withColumns({"nu_sequencial": dirty(DIRTY_LONG), "co_escola": dirty(DIRTY_DOUBLE)})
    every = PARTICIPANT_COLS + RESULT_COLS + SHARED_COLS
    xb.where(F.col("ano") == "2023").select(*shout(every)).write.options(**opts).csv(f"{root}/ano=2023")
    y24 = xb.where(F.col("ano") == "2024")
    (y24.repartitionByRange(left_files, "nu_inscricao").sortWithinPartitions("nu_inscricao")
        .select(*shout(PARTICIPANT_COLS + SHARED_COLS))
        .write.options(**opts).csv(f"{root}/ano=2024/participantes"))
    (y24.repartitionByRange(right_files, "nu_inscricao").sortWithinPartitions("nu_inscricao")
        .select(*shout(SHARED_COLS + RESULT_COLS),
                F.repeat(F.lit("-"), (F.col("nu_inscricao") % 53).cast(IntegerType())).alias("PADDING"))
        .write.options(**opts).csv(f"{root}/ano=2024/resultados"))
    return BronzeInputs(single={"2023": f"{root}/ano=2023"},
                        split={"2024": (f"{root}/ano=2024/participantes", f"{root}/ano=2024/resultados")})
