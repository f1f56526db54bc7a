"""DuckDB SQL shared by several oracles, stated from the fixture contract and the rules:
code books, regions and school codes are relations made of the fixed values, and reports
join them; nothing is generated from the Spark plans."""

from lakemart.plans.exam import vocab as V

XB_CTE = """
xb AS (
  SELECT
    o_orderkey                                                   AS nu_inscricao,
    CAST(NULL AS BIGINT)                                         AS nu_sequencial,
    CASE WHEN o_custkey % 2 = 0 THEN 'F' ELSE 'M' END            AS tp_sexo,
    o_orderkey % 7                                               AS tp_cor_raca,
    o_orderkey % 15 + 1                                          AS tp_faixa_etaria,
    o_custkey % 5 + 1                                            AS tp_st_conclusao,
    CAST(CASE o_custkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 END AS BIGINT) AS in_treineiro,
    CASE WHEN year(o_orderdate) <= 1998 THEN 1 + o_orderkey % 3 END AS tp_escola,
    CASE WHEN year(o_orderdate) > 1998 AND o_orderkey % 6 <> 0
         THEN CAST(o_orderkey % 5 + 1 AS DOUBLE) END             AS tp_dependencia_adm_esc,
    substr('ABCDEFGH', CAST((o_orderkey + o_custkey) % 8 + 1 AS INTEGER), 1) AS q001,
    substr('ABCDEFGH', CAST(o_orderkey % 8 + 1 AS INTEGER), 1)   AS q002,
    o_custkey % 10 + 1                                           AS q005,
    CASE WHEN year(o_orderdate) <= 1998
         THEN substr('ABCDEFGHIJKLMNOPQ', CAST(o_custkey % 17 + 1 AS INTEGER), 1)
         ELSE substr('AB', CAST(o_custkey % 2 + 1 AS INTEGER), 1) END AS q006,
    CASE WHEN year(o_orderdate) <= 1998
         THEN substr('ABCD', CAST(o_custkey % 4 + 1 AS INTEGER), 1)
         WHEN o_custkey % 19 <> 0
         THEN substr('ABCDEFGHIJKLMNOPQ', CAST(o_custkey % 17 + 1 AS INTEGER), 1) END AS q007,
    'São ' || CAST(o_custkey % 50 AS VARCHAR)                    AS no_municipio_prova,
    substr('ACALAPAMBACEDFESGOMAMTMSMGPAPBPRPEPIRJRNRSRORRSCSPSETOZZ',
           CAST((o_custkey % 28) * 2 + 1 AS INTEGER), 2)         AS sg_uf_prova,
    CAST(CASE WHEN o_orderkey % 11 = 0 THEN 0 ELSE 1 END AS BIGINT) AS tp_presenca_mt,
    CAST(CASE WHEN o_orderkey % 13 = 0 THEN 0 ELSE 1 END AS BIGINT) AS tp_presenca_cn,
    CAST(CASE WHEN o_orderkey % 17 = 0 THEN 2 ELSE 1 END AS BIGINT) AS tp_presenca_ch,
    CAST(CASE WHEN o_orderkey % 19 = 0 THEN 0 ELSE 1 END AS BIGINT) AS tp_presenca_lc,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL
         ELSE ((o_orderkey * 7919 + o_custkey * 104729) % 401) * CAST(2.5 AS DOUBLE) END AS nu_nota_mt,
    CASE WHEN o_orderkey % 13 = 0 THEN NULL
         ELSE ((o_orderkey * 6101 + o_custkey * 7207) % 401) * CAST(2.5 AS DOUBLE) END AS nu_nota_cn,
    CASE WHEN o_orderkey % 17 = 0 THEN NULL
         ELSE ((o_orderkey * 5303 + o_custkey * 9109) % 401) * CAST(2.5 AS DOUBLE) END AS nu_nota_ch,
    CASE WHEN o_orderkey % 19 = 0 THEN NULL
         ELSE ((o_orderkey * 4409 + o_custkey * 8101) % 401) * CAST(2.5 AS DOUBLE) END AS nu_nota_lc,
    ((o_orderkey * 31 + o_custkey * 17) % 51) * CAST(20.0 AS DOUBLE) AS nu_nota_redacao,
    CASE WHEN year(o_orderdate) <= 1998 THEN '2023' ELSE '2024' END AS ano
  FROM orders
)"""


# ---- the rules as relations: every code book is a table built from the fixed values, joined on its code


def _value(v) -> str:
    return "NULL" if v is None else str(v).lower() if isinstance(v, bool) else str(v) if isinstance(v, (int, float)) else f"'{v}'"


def relation(name: str, columns: str, rows) -> str:
    """A CTE of literal rows."""
    return f"{name}({columns}) AS (VALUES {', '.join('(' + ', '.join(map(_value, r)) + ')' for r in rows)})"


def _books() -> list[str]:
    schools = [("2023", code, label, label == V.SCHOOL_PUBLIC) for code, label in V.SCHOOL_2023.items()]
    schools += [("2024", code, V.SCHOOL_PUBLIC, True) for code in V.PUBLIC_DEPENDENCY]
    schools += [("2024", V.PRIVATE_DEPENDENCY, V.SCHOOL_PRIVATE, False)]
    return [relation("sex", "code, label", V.SEX.items()), relation("race", "code, label", V.RACE.items()),
            relation("age", "code, label", V.AGE_BAND.items()), relation("completion", "code, label", V.COMPLETION.items()),
            relation("income", "code, label", V.INCOME_17.items()), relation("band", "code, label", V.INCOME_9.items()),
            relation("schooling", "code, label", V.SCHOOLING.items()),
            relation("region", "uf, label", [(uf, r) for r, ufs in V.REGIONS.items() for uf in ufs]),
            relation("school", "ano, code, label, public", schools)]


# one school code per row: each period fills only its own column (fixture contract)
_FACTS = """
fact AS (
  SELECT xb.*, school.label AS school_label, coalesce(school.public, false) AS is_public,
         tp_presenca_mt = 1 AS sat_mt, tp_presenca_lc = 1 AS sat_lc,
         (tp_presenca_mt, tp_presenca_cn, tp_presenca_ch, tp_presenca_lc) = (1, 1, 1, 1) AS sat_all,
         coalesce(nu_nota_mt, 0) > 0 AS has_mt, coalesce(nu_nota_mt * nu_nota_redacao, 0) > 0 AS has_both
  FROM xb LEFT JOIN school ON school.ano = xb.ano AND school.code = coalesce(tp_escola, tp_dependencia_adm_esc)
)"""


def named(body: str, columns: list[str], *ctes: str) -> str:
    """``body`` over the fixture, the books and the fact rows, its columns named by position."""
    head = ",\n".join([XB_CTE.strip(), *_books(), _FACTS.strip(), *ctes])
    return f"WITH {head},\nout({', '.join(columns)}) AS (\n{body.strip()}\n)\nSELECT * FROM out"


def avg1(*columns: str) -> str:
    return ", ".join(f"round(avg({c}), 1)" for c in columns)


def share1(condition: str) -> str:
    return f"round(count(*) FILTER (WHERE {condition}) * 100::DOUBLE / count(*), 1)"


_STG_COLUMNS = ", ".join(V.REPORT_COLUMNS["staging"])
STG_CTE = f"""
stg({_STG_COLUMNS}) AS (
  SELECT f.nu_inscricao, f.nu_sequencial, f.ano::INTEGER, sex.label, coalesce(race.label, '{V.RACE_UNDECLARED}'),
         coalesce(age.label, '{V.AGE_BAND_OTHER}'), completion.label, f.in_treineiro = 1, f.is_public,
         coalesce(f.school_label, '{V.SCHOOL_UNKNOWN}'), MAP {{'2023': f.q006, '2024': f.q007}}[f.ano], f.q001, f.q002, f.q005::INTEGER,
         f.sg_uf_prova, f.no_municipio_prova, region.label,
         round(f.nu_nota_cn, 1), round(f.nu_nota_ch, 1), round(f.nu_nota_lc, 1), round(f.nu_nota_mt, 1), round(f.nu_nota_redacao, 1),
         round((f.nu_nota_cn + f.nu_nota_ch + f.nu_nota_lc + f.nu_nota_mt + f.nu_nota_redacao) / 5, 1)
  FROM fact f
  LEFT JOIN sex ON sex.code = f.tp_sexo
  LEFT JOIN race ON race.code = f.tp_cor_raca
  LEFT JOIN age ON age.code = f.tp_faixa_etaria
  LEFT JOIN completion ON completion.code = f.tp_st_conclusao
  LEFT JOIN region ON region.uf = f.sg_uf_prova
  WHERE f.sat_all AND f.has_both
)"""


def with_xb(body: str) -> str:
    return f"WITH {XB_CTE.strip()}\n{body.strip()}"


def with_facts(body: str) -> str:
    return f"WITH {', '.join([XB_CTE.strip(), *_books(), _FACTS.strip()])}\n{body.strip()}"


def with_stg(body: str) -> str:
    head = ",\n".join([XB_CTE.strip(), *_books(), _FACTS.strip(), STG_CTE.strip()])
    return f"WITH {head}\n{body.strip()}"


_STATE = ["nota_matematica", "nota_ciencias", "nota_humanas", "nota_linguagens", "nota_redacao", "nota_media_geral"]
MART_STATE_SQL = f"""
SELECT * FROM (
  SELECT s.ano, s.uf, s.regiao, count(*), {avg1(*_STATE)}, {share1('s.escola_publica')}
  FROM stg s GROUP BY ALL
) AS m({', '.join(V.REPORT_COLUMNS['state'])})
"""
