"""In-line test inputs: the municipality sample and its directories."""

from pyspark.sql import types as T

METAS_COLS = ["ano", "sigla_uf", "id_municipio", "meta_alfabetizacao", "indicador_alfabetizacao",
              "media_proficiencia_saeb"]
METAS_ROWS = [
    (2023, "PR", "4106902", 70.0, 73.5, 761.0),
    (2023, "SC", "4205407", 64.0, 60.8, 731.0),
    (2023, "PE", "2611606", 50.0, 56.0, 770.5),
    (2023, "PE", "2609600", 80.0, 82.0, 801.5),
    (2023, "PA", "1501402", 60.0, 51.0, 702.0),
    (2023, "MA", "2111300", 72.0, 66.6, 684.0),
    (2023, "GO", "5208707", 75.0, 104.5, 744.0),
    (2023, "MS", "5002704", 68.0, 64.6, 752.0),
]
METAS_SCHEMA = T.StructType([
    T.StructField("ano", T.IntegerType()), T.StructField("sigla_uf", T.StringType()),
    T.StructField("id_municipio", T.StringType()), T.StructField("meta_alfabetizacao", T.DoubleType()),
    T.StructField("indicador_alfabetizacao", T.DoubleType()),
    T.StructField("media_proficiencia_saeb", T.DoubleType()),
])

MUNICIPIOS = [(r[2], f"Municipio {r[2]}", r[1]) for r in METAS_ROWS]
UFS = [("PR", "Parana", "Sul"), ("SC", "Santa Catarina", "Sul"), ("GO", "Goias", "Centro-Oeste"),
       ("MS", "Mato Grosso do Sul", "Centro-Oeste"), ("PE", "Pernambuco", "Nordeste"),
       ("MA", "Maranhao", "Nordeste"), ("PA", "Para", "Norte")]
CENSUS_COLS = ["id_municipio", "sigla_uf", "ano", "id_escola", "localizacao", "dependencia_administrativa"]
CENSUS = [("4106902", "PR", 2023, "E1", "Urbana", "Municipal"),
          ("4205407", "SC", 2023, "E2", "Rural", "Municipal"),
          ("2611606", "PE", 2023, "E3", "Urbana", "Estadual"),
          ("2609600", "PE", 2023, "E4", "Urbana", "Municipal"),
          ("1501402", "PA", 2023, "E5", "Rural", "Estadual")]

from aurum.config import IBGE_STATE_CODES as STATE_CODES  # noqa: E402


def metas(spark, rows=None):
    return spark.createDataFrame(rows or METAS_ROWS, METAS_SCHEMA)


def sources(spark):
    return {
        "metas_municipio": metas(spark),
        "municipios": spark.createDataFrame(MUNICIPIOS, "id_municipio string, nome_municipio string, sigla_uf string"),
        "ufs": spark.createDataFrame(UFS, "sigla_uf string, nome_uf string, regiao string"),
        "censo_escolar": spark.createDataFrame(CENSUS, ", ".join(
            f"{c} {'int' if c == 'ano' else 'string'}" for c in CENSUS_COLS)),
    }
