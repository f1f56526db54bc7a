"""Code books of the exam microdata.

FIXED VALUES — the labels, code lists and state groups below must equal the
published report text exactly (they are output values, not logic).  They
are kept together, in their natural order, as plain data.
"""

# ---- fixed values: participant profile ---------------------------------------
SEX = {"M": "Masculino", "F": "Feminino"}

RACE = {1: "Branca", 2: "Preta", 3: "Parda", 4: "Amarela", 5: "Indígena"}
RACE_UNDECLARED = "Não declarado"

AGE_BAND = {
    1: "Menor de 17", 2: "17 anos", 3: "18 anos", 4: "19 anos", 5: "20 anos",
    6: "21 anos", 7: "22 anos", 8: "23 anos", 9: "24 anos", 10: "25 anos",
    11: "Entre 26 e 30", 12: "Entre 31 e 35",
}
AGE_BAND_OTHER = "Acima de 35"

COMPLETION = {
    1: "Já concluiu", 2: "Concluirá este ano",
    3: "Concluirá após este ano", 4: "Não concluiu",
}

# ---- fixed values: school type -------------------------------------------------
SCHOOL_PUBLIC = "Pública"
SCHOOL_PRIVATE = "Privada"
SCHOOL_UNKNOWN = "Não informado"
# 2023: tp_escola code → label; 2024: administrative dependency codes
SCHOOL_2023 = {2: SCHOOL_PUBLIC, 3: SCHOOL_PRIVATE}
PUBLIC_DEPENDENCY = (1, 2, 3)
PRIVATE_DEPENDENCY = 4

# ---- fixed values: household income (2024 questionnaire) ------------------------
INCOME_17 = {
    "A": "01. Nenhuma renda",
    "B": "02. Até R$1.412",
    "C": "03. R$1.412 a R$2.118",
    "D": "04. R$2.118 a R$2.824",
    "E": "05. R$2.824 a R$3.530",
    "F": "06. R$3.530 a R$4.236",
    "G": "07. R$4.236 a R$5.648",
    "H": "08. R$5.648 a R$7.060",
    "I": "09. R$7.060 a R$8.472",
    "J": "10. R$8.472 a R$9.884",
    "K": "11. R$9.884 a R$11.296",
    "L": "12. R$11.296 a R$12.708",
    "M": "13. R$12.708 a R$14.120",
    "N": "14. R$14.120 a R$16.944",
    "O": "15. R$16.944 a R$21.180",
    "P": "16. R$21.180 a R$28.240",
    "Q": "17. Acima de R$28.240",
}
# nine-band version: the first eight bands, everything else collapsed
INCOME_9 = {k: INCOME_17[k] for k in "ABCDEFGH"}
INCOME_9_OTHER = "09. Acima de R$7.060"

# ---- fixed values: mother's / father's schooling ------------------------------------
SCHOOLING = {
    "A": "1. Nunca estudou",
    "B": "2. Fundamental incompleto",
    "C": "3. Fundamental completo",
    "D": "4. Médio incompleto",
    "E": "5. Médio completo",
    "F": "6. Superior completo",
    "G": "7. Pós-graduação",
}

# ---- fixed values: state → region ---------------------------------------------------
REGIONS = {
    "Norte": ["AM", "RR", "AP", "PA", "TO", "RO", "AC"],
    "Nordeste": ["MA", "PI", "CE", "RN", "PB", "PE", "AL", "SE", "BA"],
    "Centro-Oeste": ["MT", "MS", "GO", "DF"],
    "Sudeste": ["SP", "RJ", "ES", "MG"],
    "Sul": ["PR", "SC", "RS"],
}

# ---- fixed values: periods and quality rules -------------------------------------------
PERIODS = ("2023", "2024")
ACCEPTED_SEX = ["Masculino", "Feminino"]
STAGING_NOT_NULL = ["nu_inscricao", "ano", "sexo", "cor_raca", "uf",
                    "nota_matematica", "nota_redacao", "escola_publica"]
# columns repeated in both 2024 files (participants / results)
OVERLAP_2024 = ["nu_ano", "co_municipio_prova", "no_municipio_prova", "co_uf_prova", "sg_uf_prova"]

# ---- fixed values: output columns of the reports and marts, in order ------------------------
REPORT_COLUMNS = {
    "income_by_sex": ["faixa_renda", "sexo", "total", "media_matematica", "media_redacao", "media_humanas"],
    "race_by_year": ["ano", "cor_raca", "total_participantes", "media_matematica", "media_linguagens", "media_redacao",
                     "pct_escola_publica"],
    "mother_schooling": ["escolaridade_mae", "total", "media_matematica", "media_redacao", "pct_escola_publica",
                         "media_pessoas_residencia"],
    "income_band_by_school": ["faixa_renda", "tipo_escola", "total", "media_matematica", "media_redacao", "media_ciencias"],
    "staging": ["nu_inscricao", "nu_sequencial", "ano", "sexo", "cor_raca", "faixa_etaria", "situacao_ensino_medio",
                "eh_treineiro", "escola_publica", "tipo_escola", "renda_familiar_cod", "escolaridade_pai_cod",
                "escolaridade_mae_cod", "pessoas_na_residencia", "uf", "municipio", "regiao", "nota_ciencias",
                "nota_humanas", "nota_linguagens", "nota_matematica", "nota_redacao", "nota_media_geral"],
    "state": ["ano", "uf", "regiao", "total_participantes", "media_matematica", "media_ciencias", "media_humanas",
              "media_linguagens", "media_redacao", "media_geral", "pct_escola_publica"],
    "inequality": ["ano", "cor_raca", "tipo_escola", "total", "media_matematica", "media_redacao", "media_geral"],
    "mobility": ["ano", "escolaridade_mae", "total", "media_matematica", "media_redacao", "media_geral",
                 "pct_escola_publica", "media_pessoas_residencia"],
}
