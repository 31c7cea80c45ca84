"""Turnout-shaped inputs derived from the driver tables, as DataFrames and as SQL text.

The driver tables hold no turnout data. Line items stand in for voter-profile cells,
suppliers for municipalities and orders for audit runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urnalake import schema as S
from urnalake.operators.silver import to_silver

# Nation key 0..24 to state code, with one overseas and one unknown code.
UF_BY_NATION = [
    "AC", "AP", "AM", "PA", "RO", "RR", "TO", "AL", "BA", "CE", "MA", "PB", "PE",
    "PI", "RN", "SE", "DF", "GO", "MT", "MS", "PR", "RS", "MG", "ZZ", "XX",
]
REQUIRED = list(S.REQUIRED_FIELDS)


_LAYOUTS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Its columns are inferred once per process, its files listed every time."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _LAYOUTS:
        _LAYOUTS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_LAYOUTS[path]).parquet(path)


def bronze(spark: SparkSession, sf_dir: str, empty_cells: bool = False) -> DataFrame:
    """Bronze-shaped rows; ``empty_cells`` lowers the electorate by one, so that some are 0.

    Supplier grows with the data, so there is no broadcast hint: Spark broadcasts it only
    under its size threshold and otherwise shuffles both sides, where adaptive execution
    splits the partitions of a supplier that holds many line items.
    """
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate"
    )
    supplier = (
        table(spark, sf_dir, "supplier")
        .select("s_suppkey", "s_name", "s_nationkey")
        .where(F.col("s_nationkey").between(0, len(UF_BY_NATION) - 1))
    )
    cells = lineitem.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    uf = F.get(F.expr("array(" + ", ".join(f"'{u}'" for u in UF_BY_NATION) + ")"), "s_nationkey")
    electorate = F.col("l_quantity").cast("long") - F.lit(1 if empty_cells else 0)
    absent = F.least(F.col("l_linenumber").cast("long"), electorate)
    return cells.select(
        F.year("l_shipdate").alias("ANO_ELEICAO"),
        F.col("l_suppkey").cast("int").alias("CD_MUNICIPIO"),
        F.col("s_name").alias("NM_MUNICIPIO"),
        F.when(F.col("l_orderkey") % 97 != 0, uf).alias("SG_UF"),
        electorate.alias("QT_APTOS"),
        (electorate - absent).alias("QT_COMPARECIMENTO"),
        absent.alias("QT_ABSTENCAO"),
    )


def _bronze_sql(empty_cells: bool) -> str:
    electorate = f"(CAST(l.l_quantity AS BIGINT) - {1 if empty_cells else 0})"
    absent = f"LEAST(CAST(l.l_linenumber AS BIGINT), {electorate})"
    nations = ", ".join(f"({i}, '{uf}')" for i, uf in enumerate(UF_BY_NATION))
    return f"""bronze AS (
  SELECT CAST(year(l.l_shipdate) AS INT) AS ANO_ELEICAO,
         CAST(l.l_suppkey AS INT) AS CD_MUNICIPIO,
         s.s_name AS NM_MUNICIPIO,
         CASE WHEN l.l_orderkey % 97 = 0 THEN NULL ELSE m.uf END AS SG_UF,
         {electorate} AS QT_APTOS,
         {electorate} - {absent} AS QT_COMPARECIMENTO,
         {absent} AS QT_ABSTENCAO
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN (VALUES {nations}) AS m(nk, uf) ON s.s_nationkey = m.nk
)"""


_REGIONS = ", ".join(f"('{uf}', '{region}')" for uf, region in S.REGION_BY_UF.items())
_NOT_NULL = " AND ".join(f"{c} IS NOT NULL" for c in REQUIRED)
RATES_SQL = """QT_COMPARECIMENTO / QT_APTOS * 100 AS TAXA_COMPARECIMENTO_PCT,
         QT_ABSTENCAO / QT_APTOS * 100 AS TAXA_ABSTENCAO_PCT"""


def with_bronze(query: str, empty_cells: bool = False) -> str:
    """SQL over ``bronze``."""
    return f"WITH {_bronze_sql(empty_cells)}\n{query}"


def with_silver(query: str, empty_cells: bool = False) -> str:
    """SQL over ``bronze``, ``regions`` and ``silver`` (which has the report year ``Ano``)."""
    return f"""WITH {_bronze_sql(empty_cells)},
regions(uf, regiao) AS (VALUES {_REGIONS}),
silver AS (
  SELECT b.*, {RATES_SQL},
         coalesce(r.regiao, '{S.UNKNOWN_REGION}') AS NOME_REGIAO, ANO_ELEICAO AS Ano
  FROM bronze b LEFT JOIN regions r ON b.SG_UF = r.uf
  WHERE {_NOT_NULL}
)
{query}"""


def silver(spark: SparkSession, sf_dir: str, empty_cells: bool = False) -> DataFrame:
    """Silver rows with the report year."""
    return to_silver(bronze(spark, sf_dir, empty_cells)).withColumn("Ano", F.col("ANO_ELEICAO"))


def perturbed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows where the counts of one municipality in fifty do not add up."""
    extra = F.when(F.col("CD_MUNICIPIO") % 50 == 0, 1).otherwise(0)
    return bronze(spark, sf_dir).withColumn("QT_ABSTENCAO", F.col("QT_ABSTENCAO") + extra)


def with_perturbed(query: str) -> str:
    return with_bronze(query).replace(
        "\n)\n",
        """
), perturbed AS (
  SELECT ANO_ELEICAO, CD_MUNICIPIO, NM_MUNICIPIO, SG_UF, QT_APTOS, QT_COMPARECIMENTO,
         QT_ABSTENCAO + CASE WHEN CD_MUNICIPIO % 50 = 0 THEN 1 ELSE 0 END AS QT_ABSTENCAO
  FROM bronze
)
""",
        1,
    )


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed text: null tokens in two columns, an optional and an unknown column."""
    rows = bronze(spark, sf_dir)
    text = {c: F.col(c).cast("string") for c in REQUIRED}
    text["NM_MUNICIPIO"] = F.when(F.col("CD_MUNICIPIO") % 7 == 0, S.NULL_TOKENS[0]).otherwise(
        text["NM_MUNICIPIO"]
    )
    text["QT_APTOS"] = F.when(F.col("QT_APTOS") % 13 == 0, S.NULL_TOKENS[1]).otherwise(text["QT_APTOS"])
    text["NR_TURNO"] = (F.col("QT_ABSTENCAO") % 2 + 1).cast("string")
    text["DS_PERFIL"] = F.concat(F.lit("perfil "), F.col("QT_ABSTENCAO").cast("string"))
    return rows.select(*[c.alias(name) for name, c in text.items()])


def with_landed(query: str) -> str:
    first, second = S.NULL_TOKENS
    return with_bronze(query).replace(
        "\n)\n",
        f"""
), landed AS (
  SELECT CAST(ANO_ELEICAO AS VARCHAR) AS ANO_ELEICAO, CAST(CD_MUNICIPIO AS VARCHAR) AS CD_MUNICIPIO,
         CASE WHEN CD_MUNICIPIO % 7 = 0 THEN '{first}' ELSE NM_MUNICIPIO END AS NM_MUNICIPIO, SG_UF,
         CASE WHEN QT_APTOS % 13 = 0 THEN '{second}' ELSE CAST(QT_APTOS AS VARCHAR) END AS QT_APTOS,
         CAST(QT_COMPARECIMENTO AS VARCHAR) AS QT_COMPARECIMENTO,
         CAST(QT_ABSTENCAO AS VARCHAR) AS QT_ABSTENCAO,
         CAST(QT_ABSTENCAO % 2 + 1 AS VARCHAR) AS NR_TURNO,
         'perfil ' || CAST(QT_ABSTENCAO AS VARCHAR) AS DS_PERFIL
  FROM bronze
)
""",
        1,
    )


def audit_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit log rows: orders as runs, priority and year as the key."""
    orders = table(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    return orders.select(
        F.col("o_orderpriority").alias("dataset"),
        F.year("o_orderdate").alias("ano"),
        F.col("o_orderdate").alias("timestamp_inicio"),
        F.expr("o_orderdate + make_dt_interval(0, 0, 0, o_orderkey % 3600)").alias("timestamp_fim"),
        F.col("o_custkey").alias("linhas"),
        F.floor("o_totalprice").cast("long").alias("tamanho_bytes"),
        F.when(status == "F", S.STATUS_OK)
        .when(status == "O", S.STATUS_FAILED)
        .otherwise(S.STATUS_PARTIAL)
        .alias("status"),
        F.md5(F.col("o_orderkey").cast("string")).alias("checksum"),
        F.when(status == "O", F.concat(F.lit("run "), F.col("o_orderkey").cast("string"))).alias("erro"),
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("run_id"),
    )


_RUNS_SQL = f"""runs AS (
  SELECT o_orderpriority AS dataset, CAST(year(o_orderdate) AS INT) AS ano,
         o_orderdate AS timestamp_inicio,
         o_orderdate + to_seconds(CAST(o_orderkey % 3600 AS INT)) AS timestamp_fim,
         o_custkey AS linhas, CAST(floor(o_totalprice) AS BIGINT) AS tamanho_bytes,
         CASE o_orderstatus WHEN 'F' THEN '{S.STATUS_OK}' WHEN 'O' THEN '{S.STATUS_FAILED}'
              ELSE '{S.STATUS_PARTIAL}' END AS status,
         md5(CAST(o_orderkey AS VARCHAR)) AS checksum,
         CASE WHEN o_orderstatus = 'O' THEN 'run ' || CAST(o_orderkey AS VARCHAR) END AS erro,
         lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS run_id
  FROM orders
), latest AS (
  SELECT * EXCLUDE (n) FROM (
    SELECT *, row_number() OVER (PARTITION BY dataset, ano ORDER BY timestamp_fim DESC, run_id DESC) AS n
    FROM runs) WHERE n = 1
)"""


def with_runs(query: str) -> str:
    """SQL over ``runs`` and ``latest``."""
    return f"WITH {_RUNS_SQL}\n{query}"


def years_of_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.year("l_shipdate").alias("ano")).distinct()


def work_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(dataset, ano) of all runs and of the years after them, which have no run yet."""
    keys = audit_runs(spark, sf_dir).select("dataset", "ano").distinct()
    return keys.select("dataset", F.explode(F.array("ano", F.col("ano") + 7)).alias("ano")).distinct()


WORK_MANIFEST_SQL = """manifest AS (
  SELECT dataset, ano FROM runs UNION SELECT dataset, CAST(ano + 7 AS INT) AS ano FROM runs
), years AS (SELECT DISTINCT CAST(year(l_shipdate) AS INT) AS ano FROM lineitem)"""


def with_work(query: str) -> str:
    """SQL over ``runs``, ``latest``, ``manifest`` and the lineitem ``years``."""
    return f"WITH {_RUNS_SQL}, {WORK_MANIFEST_SQL}\n{query}"
