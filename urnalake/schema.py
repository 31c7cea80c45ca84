"""Column types, contract rules and lookup values of the turnout tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Names, formats and lookup tables the results depend on.
# ---------------------------------------------------------------------------
BRONZE_DATASET = "comparecimento_abstencao"
SILVER_DATASET = "comparecimento_abstencao_silver"
KNOWN_DATASETS = (BRONZE_DATASET, SILVER_DATASET)

SOURCE_PREFIX = "tse"
ORIGIN_FORMAT = (
    "https://cdn.tse.jus.br/estatistica/sead/odsele/"
    "perfil_comparecimento_abstencao/perfil_comparecimento_abstencao_%d.zip"
)
PUBLISHED_YEARS = (2024, 2022, 2020, 2018, 2016, 2014)
FIRST_YEAR, LAST_YEAR = 2000, 2030

CSV_SEPARATOR = ";"
NULL_TOKENS = ("#NULO#", "#NE#")

STATUS_OK, STATUS_FAILED, STATUS_PARTIAL = "sucesso", "falha", "parcial"

SAMPLE_ROWS, SAMPLE_SEED = 100, 42

OVERSEAS_UF = "ZZ"
OVERSEAS_REGION = "Exterior"
UNKNOWN_REGION = "Desconhecido"
REPORT_REGIONS = ("Norte", "Nordeste", "Centro-Oeste", "Sudeste", "Sul", "Exterior")

REGION_BY_UF = {
    "AC": "Norte", "AP": "Norte", "AM": "Norte", "PA": "Norte",
    "RO": "Norte", "RR": "Norte", "TO": "Norte",
    "AL": "Nordeste", "BA": "Nordeste", "CE": "Nordeste", "MA": "Nordeste", "PB": "Nordeste",
    "PE": "Nordeste", "PI": "Nordeste", "RN": "Nordeste", "SE": "Nordeste",
    "DF": "Centro-Oeste", "GO": "Centro-Oeste", "MT": "Centro-Oeste", "MS": "Centro-Oeste",
    "PR": "Sul", "RS": "Sul", "SC": "Sul",
    "ES": "Sudeste", "MG": "Sudeste", "RJ": "Sudeste", "SP": "Sudeste",
    "ZZ": "Exterior",
}

STATE_NAME_BY_UF = {
    "AC": "Acre", "AL": "Alagoas", "AP": "Amapá", "AM": "Amazonas", "BA": "Bahia",
    "CE": "Ceará", "DF": "Distrito Federal", "ES": "Espírito Santo", "GO": "Goiás",
    "MA": "Maranhão", "MT": "Mato Grosso", "MS": "Mato Grosso do Sul", "MG": "Minas Gerais",
    "PA": "Pará", "PB": "Paraíba", "PR": "Paraná", "PE": "Pernambuco", "PI": "Piauí",
    "RJ": "Rio de Janeiro", "RN": "Rio Grande do Norte", "RS": "Rio Grande do Sul",
    "RO": "Rondônia", "RR": "Roraima", "SC": "Santa Catarina", "SP": "São Paulo",
    "SE": "Sergipe", "TO": "Tocantins",
}

NATIONAL_ROW, INTERNATIONAL_ROW = "Nacional", "Internacional"

REPORT_LABELS = {
    "NOME_REGIAO": "Região",
    "SG_UF": "Estado (UF)",
    "taxa_comparecimento": "Taxa de Comparecimento (%)",
    "comparecimento_total": "Total de Comparecimentos",
    "abstencao_total": "Total de Abstenções",
    "nome_estado": "Nome Estado",
    "tipo": "Tipo",
}
# ---------------------------------------------------------------------------

BRONZE_SCHEMA = T.StructType(
    [
        T.StructField("ANO_ELEICAO", T.IntegerType()),
        T.StructField("CD_MUNICIPIO", T.IntegerType()),
        T.StructField("NM_MUNICIPIO", T.StringType()),
        T.StructField("SG_UF", T.StringType()),
        T.StructField("QT_APTOS", T.LongType()),
        T.StructField("QT_COMPARECIMENTO", T.LongType()),
        T.StructField("QT_ABSTENCAO", T.LongType()),
        T.StructField("NR_ZONA", T.IntegerType()),
        T.StructField("NR_TURNO", T.ByteType()),
        T.StructField("NM_UF", T.StringType()),
    ]
)
OPTIONAL_FIELDS = ("NR_ZONA", "NR_TURNO", "NM_UF")
REQUIRED_FIELDS = tuple(f.name for f in BRONZE_SCHEMA if f.name not in OPTIONAL_FIELDS)

LINEAGE_TIMESTAMP = "_metadata_ingestion_timestamp"
LINEAGE_SOURCE = "_metadata_source"

RATE_TURNOUT = "TAXA_COMPARECIMENTO_PCT"
RATE_ABSTENTION = "TAXA_ABSTENCAO_PCT"
REGION = "NOME_REGIAO"

SILVER_SCHEMA = T.StructType(
    [f for f in BRONZE_SCHEMA if f.name in REQUIRED_FIELDS]
    + [
        T.StructField(RATE_TURNOUT, T.DoubleType()),
        T.StructField(RATE_ABSTENTION, T.DoubleType()),
        T.StructField(REGION, T.StringType()),
    ]
)

KIND_BATCH = "fluxo"

_AUDIT_KEY = [
    T.StructField("dataset", T.StringType()),
    T.StructField("ano", T.IntegerType()),
    T.StructField("timestamp_inicio", T.TimestampType()),
    T.StructField("timestamp_fim", T.TimestampType()),
]
_AUDIT_END = [T.StructField("erro", T.StringType()), T.StructField("run_id", T.StringType())]

BRONZE_AUDIT_SCHEMA = T.StructType(
    _AUDIT_KEY
    + [
        T.StructField("linhas", T.LongType()),
        T.StructField("tamanho_bytes", T.LongType()),
        T.StructField("duracao_segundos", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("checksum", T.StringType()),
        # Lines with too few fields; older log files have no such column.
        T.StructField("linhas_malformadas", T.LongType()),
        # KIND_BATCH for a batch of the stream; NULL for the load of a year.
        T.StructField("carga", T.StringType()),
        # The encoding, or how many files had which; older log files have no such column.
        T.StructField("codificacao", T.StringType()),
    ]
    + _AUDIT_END
)
SILVER_AUDIT_SCHEMA = T.StructType(
    _AUDIT_KEY
    + [
        T.StructField("linhas_antes", T.LongType()),
        T.StructField("linhas_depois", T.LongType()),
        T.StructField("duracao_segundos", T.DoubleType()),
        T.StructField("status", T.StringType()),
    ]
    + _AUDIT_END
)

# Mergeable measures of one region and state of a year; rate_sum leaves out NaN and infinite rates.
CELL_SCHEMA = T.StructType(
    [T.StructField(REGION, T.StringType()), T.StructField("SG_UF", T.StringType())]
    + [T.StructField(c, T.LongType()) for c in ("comparecimento_total", "abstencao_total")]
    + [T.StructField("rate_sum", T.DoubleType())]
    + [T.StructField(c, T.LongType()) for c in ("rate_count", "rate_nan", "rate_infinite", "rate_negative_infinite")]
)

INTEGER_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
DECIMAL_TYPES = (T.FloatType, T.DoubleType)
TEXT_TYPES = (T.StringType,)


@dataclass(frozen=True)
class Rule:
    """One value rule: rows where ``broken`` is true violate it, NULLs do not."""

    field: str
    name: str
    broken: Column


def bronze_rules() -> list[Rule]:
    year, city = F.col("ANO_ELEICAO"), F.col("CD_MUNICIPIO")
    rules = [
        Rule("ANO_ELEICAO", "minimum", year < FIRST_YEAR),
        Rule("ANO_ELEICAO", "maximum", year > LAST_YEAR),
        Rule("CD_MUNICIPIO", "minimum", city < 1),
        Rule("NM_MUNICIPIO", "not_empty", F.trim("NM_MUNICIPIO") == ""),
        Rule("SG_UF", "length", F.length("SG_UF") != 2),
    ]
    for quantity in ("QT_APTOS", "QT_COMPARECIMENTO", "QT_ABSTENCAO"):
        rules.append(Rule(quantity, "minimum", F.col(quantity) < 0))
    return rules


def silver_rules() -> list[Rule]:
    rules = bronze_rules()
    for rate in (RATE_TURNOUT, RATE_ABSTENTION):
        rules.append(Rule(rate, "minimum", F.col(rate) < 0))
        rules.append(Rule(rate, "maximum", F.col(rate) > 100))
    return rules
