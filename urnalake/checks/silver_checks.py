"""Sources, casts, projections and filters up to silver."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from urnalake import schema as S
from urnalake.checks import inputs as I
from urnalake.checks.registry import check
from urnalake.functions import casting, text
from urnalake.operators import audit, quality, ranking, silver
from urnalake.sources import landed_csv, manifest, tables

_COLUMNS = ", ".join(I.REQUIRED)


@check(I.with_bronze("SELECT * FROM bronze WHERE ANO_ELEICAO = 1997"))
def bronze_one_year(spark, sf_dir):
    return I.bronze(spark, sf_dir).where("ANO_ELEICAO = 1997")


@check(I.with_bronze("SELECT count(*) AS n_rows FROM bronze"))
def row_count(spark, sf_dir):
    return I.bronze(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_rows"))


@check(I.with_bronze(f"SELECT *, {I.RATES_SQL} FROM bronze"))
def silver_rates(spark, sf_dir):
    return silver.with_rates(I.bronze(spark, sf_dir))


_REGION_SQL = f"""SELECT b.*, coalesce(r.regiao, '{S.UNKNOWN_REGION}') AS NOME_REGIAO
FROM bronze b LEFT JOIN (VALUES {I._REGIONS}) AS r(uf, regiao) ON b.SG_UF = r.uf"""


@check(I.with_bronze(_REGION_SQL))
def silver_region(spark, sf_dir):
    return silver.with_region(I.bronze(spark, sf_dir))


@check(I.with_bronze(_REGION_SQL))
def silver_region_join(spark, sf_dir):
    return silver.with_region_joined(I.bronze(spark, sf_dir))


@check(I.with_silver("SELECT * EXCLUDE (Ano) FROM silver"))
def silver_null_drop(spark, sf_dir):
    return silver.to_silver(I.bronze(spark, sf_dir))


@check(
    I.with_bronze(
        f"SELECT *, {I.RATES_SQL} FROM bronze WHERE {I._NOT_NULL}", empty_cells=True
    )
)
def silver_nan_edge(spark, sf_dir):
    """Rates of cells without electorate are NaN and their rows stay."""
    rows = silver.with_rates(I.bronze(spark, sf_dir, empty_cells=True))
    return silver.drop_incomplete(rows)


@check(
    I.with_bronze(
        """SELECT n AS rows_before, k AS rows_after, n - k AS rows_removed,
       CASE WHEN n > 0 THEN (n - k) / n * 100 END AS pct_removed
FROM (SELECT count(*) AS n, count(SG_UF) AS k FROM bronze)"""
    )
)
def null_drop_stats(spark, sf_dir):
    return silver.removal_stats(I.bronze(spark, sf_dir))


@check(I.with_bronze("SELECT * FROM bronze WHERE SG_UF <> 'ZZ'"))
def exclude_overseas(spark, sf_dir):
    return I.bronze(spark, sf_dir).where(F.col("SG_UF") != S.OVERSEAS_UF)


@check(I.with_bronze("SELECT * FROM bronze WHERE NM_MUNICIPIO = (SELECT min(s_name) FROM supplier)"))
def municipality_lookup(spark, sf_dir):
    """All cells of one named municipality, the first by name."""
    first = I.table(spark, sf_dir, "supplier").agg(F.min("s_name"))
    return I.bronze(spark, sf_dir).where(F.col("NM_MUNICIPIO") == first.scalar())


@check(
    I.with_perturbed(
        "SELECT * FROM perturbed WHERE QT_COMPARECIMENTO + QT_ABSTENCAO = QT_APTOS"
    )
)
def consistent_rows(spark, sf_dir):
    return I.perturbed(spark, sf_dir).where(quality.is_consistent())


def _nullified(column: str) -> str:
    tokens = ", ".join(f"'{t}'" for t in S.NULL_TOKENS)
    return f"CASE WHEN {column} NOT IN ({tokens}) THEN {column} END"


_LANDED = [*I.REQUIRED, "NR_TURNO", "DS_PERFIL"]


@check(
    I.with_landed(
        "SELECT " + ", ".join(f"{_nullified(c)} AS {c}" for c in _LANDED) + " FROM landed"
    )
)
def null_tokens(spark, sf_dir):
    return casting.nullify_tokens(I.landed(spark, sf_dir))


_SQL_TYPES = {
    "ANO_ELEICAO": "INT", "CD_MUNICIPIO": "INT", "QT_APTOS": "BIGINT",
    "QT_COMPARECIMENTO": "BIGINT", "QT_ABSTENCAO": "BIGINT", "NR_TURNO": "TINYINT",
}


@check(
    I.with_landed(
        "SELECT "
        + ", ".join(
            f"CAST({_nullified(c)} AS {_SQL_TYPES[c]}) AS {c}" if c in _SQL_TYPES else f"{_nullified(c)} AS {c}"
            for c in _LANDED
        )
        + " FROM landed"
    )
)
def typed_casts(spark, sf_dir):
    """Types by name: an optional column is cast, an unknown one stays text, absent ones are fine."""
    return landed_csv.typed(I.landed(spark, sf_dir))


@check(
    I.with_bronze(
        f"""SELECT *, 'tse:{S.BRONZE_DATASET}:' || CAST(ANO_ELEICAO AS VARCHAR) AS _metadata_source
FROM bronze"""
    )
)
def lineage_source(spark, sf_dir):
    source = text.source_id(F.lit(S.BRONZE_DATASET), F.col("ANO_ELEICAO"))
    return landed_csv.with_lineage(I.bronze(spark, sf_dir), source).drop(S.LINEAGE_TIMESTAMP)


@check(
    I.with_bronze(
        """SELECT NM_MUNICIPIO, SG_UF, QT_COMPARECIMENTO, QT_APTOS FROM bronze
ORDER BY QT_COMPARECIMENTO DESC, NM_MUNICIPIO NULLS LAST, SG_UF NULLS LAST, QT_APTOS DESC LIMIT 10"""
    )
)
def top10_turnout(spark, sf_dir):
    return ranking.top_by_turnout(I.bronze(spark, sf_dir))


_KEY_SQL = "md5(concat_ws('|', '42', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in I.REQUIRED) + "))"


def _sample_sql(n: int) -> str:
    return I.with_silver(
        f"""SELECT * EXCLUDE (n) FROM (
  SELECT *, row_number() OVER (PARTITION BY Ano ORDER BY {_KEY_SQL}, {_COLUMNS}) AS n FROM silver
) WHERE n <= {n}"""
    )


@check(_sample_sql(100))
def sample_exact(spark, sf_dir):
    """Exactly a hundred rows per year, the same on every run."""
    return ranking.exact_sample(I.silver(spark, sf_dir), hash_columns=I.REQUIRED)


@check(_sample_sql(1500))
def sample_exact_large(spark, sf_dir):
    """A sample beyond the optimizer's group-limit threshold."""
    return ranking.exact_sample(I.silver(spark, sf_dir), n=1500, hash_columns=I.REQUIRED)


@check(
    """SELECT ano FROM (SELECT DISTINCT CAST(year(o_orderdate) + 3 AS INT) AS ano FROM orders)
WHERE ano NOT IN (SELECT year(l_shipdate) FROM lineitem)"""
)
def missing_years(spark, sf_dir):
    """Requested years (order years, three later) without a line item."""
    orders = I.table(spark, sf_dir, "orders")
    requested = orders.select((F.year("o_orderdate") + 3).alias("ano")).distinct()
    return audit.missing_years(requested, I.years_of_lineitem(spark, sf_dir))


_MANIFEST_SQL = f"""SELECT '{S.BRONZE_DATASET}' AS dataset, ano,
  printf('{S.ORIGIN_FORMAT}', ano) AS origin,
  '{S.BRONZE_DATASET}:' || CAST(ano AS VARCHAR) AS dataset_id,
  'tse:{S.BRONZE_DATASET}:' || CAST(ano AS VARCHAR) AS source_id
FROM (SELECT DISTINCT CAST(year(l_shipdate) AS INT) AS ano FROM lineitem) ORDER BY ano DESC"""


@check(_MANIFEST_SQL)
def manifest_years(spark, sf_dir):
    years = I.years_of_lineitem(spark, sf_dir)
    return manifest.manifest_of(years).orderBy(F.desc("ano"))


_ORIGINS = (
    "https://example.com/a.zip", "http://example.com/a", "/data/a.csv", "C:\\a.csv", "ftp://x", " ",
    "s3a://bucket/a/*.zip", "hdfs://name/a", "abfss://c@account/a", "gs://bucket/a", "file:///a.csv", "s4://bucket/a",
)
_ORIGIN_STARTS = ("http://", "https://", "/", "_:", "s3://", "s3a://", "hdfs://", "abfs://", "abfss://", "gs://", "file:/")


@check(
    f"""WITH m AS (
  SELECT o_orderkey,
         CASE o_orderstatus WHEN 'F' THEN '{S.BRONZE_DATASET}' WHEN 'O' THEN '{S.SILVER_DATASET}'
              ELSE CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 'outro' END END AS dataset,
         CAST(year(o_orderdate) + o_orderkey % 40 AS INT) AS ano,
         CASE o_orderkey % {len(_ORIGINS)} {" ".join(f"WHEN {i} THEN '{o}'" for i, o in enumerate(_ORIGINS))} END AS origin
  FROM orders
), r AS (
  SELECT *, trim(dataset) <> '' AS name_given,
         dataset IN ('{S.BRONZE_DATASET}', '{S.SILVER_DATASET}') AS name_known,
         ano BETWEEN 2000 AND 2030 AS year_in_range,
         ({" OR ".join(f"origin LIKE '{start}%'" for start in _ORIGIN_STARTS)})
           AND trim(origin) <> '' AS origin_valid
  FROM m
)
SELECT *, name_given AND name_known AND year_in_range AND origin_valid AS is_valid,
       concat_ws(':', dataset, CAST(ano AS VARCHAR)) AS dataset_id FROM r"""
)
def manifest_rules(spark, sf_dir):
    status = F.col("o_orderstatus")
    origin = F.get(F.array(*[F.lit(o) for o in _ORIGINS]), (F.col("o_orderkey") % len(_ORIGINS)).cast("int"))
    rows = I.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(status == "F", S.BRONZE_DATASET)
        .when(status == "O", S.SILVER_DATASET)
        .when(F.col("o_orderkey") % 2 == 0, "")
        .otherwise("outro")
        .alias("dataset"),
        (F.year("o_orderdate") + F.col("o_orderkey") % 40).cast("int").alias("ano"),
        origin.alias("origin"),
    )
    return manifest.with_validity(rows).withColumn("dataset_id", text.dataset_id("dataset", "ano"))


_CONFORMANCE_TYPES = {
    "ANO_ELEICAO": "INT", "CD_MUNICIPIO": "INT", "NM_MUNICIPIO": "VARCHAR", "SG_UF": "VARCHAR",
    "QT_APTOS": "BIGINT", "QT_COMPARECIMENTO": "BIGINT", "QT_ABSTENCAO": "BIGINT", "NR_TURNO": "TINYINT",
}
_BAD_TURNOUT = "CASE WHEN CD_MUNICIPIO % 10 = 3 THEN 'foo' ELSE CAST(QT_COMPARECIMENTO AS VARCHAR) END"
_BAD_ROUND = "CASE WHEN QT_ABSTENCAO = 5 THEN '300' ELSE '1' END"


def _conformance_line(field: T.StructField) -> str:
    present = field.name in _CONFORMANCE_TYPES
    bad = (
        f"(SELECT count(*) FROM t WHERE {field.name} IS NOT NULL"
        f" AND TRY_CAST({field.name} AS {_CONFORMANCE_TYPES[field.name]}) IS NULL)"
        if present
        else "CAST(0 AS BIGINT)"
    )
    required = field.name not in S.OPTIONAL_FIELDS
    return (
        f"SELECT '{field.name}' AS field, '{field.dataType.simpleString()}' AS expected_type,"
        f" {required} AS required, {present} AS present, {bad} AS bad_values"
    )


@check(
    I.with_bronze("").rstrip()
    + f""", t AS (
  SELECT CAST(ANO_ELEICAO AS VARCHAR) AS ANO_ELEICAO, CAST(CD_MUNICIPIO AS VARCHAR) AS CD_MUNICIPIO,
         NM_MUNICIPIO, SG_UF, CAST(QT_APTOS AS VARCHAR) AS QT_APTOS,
         {_BAD_TURNOUT} AS QT_COMPARECIMENTO, CAST(QT_ABSTENCAO AS VARCHAR) AS QT_ABSTENCAO,
         {_BAD_ROUND} AS NR_TURNO
  FROM bronze
)
"""
    + " UNION ALL ".join(_conformance_line(f) for f in S.BRONZE_SCHEMA)
)
def type_conformance(spark, sf_dir):
    """Unreadable numbers, a value too large for its type and two absent optional columns."""
    rows = I.bronze(spark, sf_dir)
    bad_turnout = F.when(F.col("CD_MUNICIPIO") % 10 == 3, "foo").otherwise(
        F.col("QT_COMPARECIMENTO").cast("string")
    )
    text_rows = rows.select(
        *[
            bad_turnout.alias(c) if c == "QT_COMPARECIMENTO" else F.col(c).cast("string").alias(c)
            for c in I.REQUIRED
        ],
        F.when(F.col("QT_ABSTENCAO") == 5, "300").otherwise("1").alias("NR_TURNO"),
    )
    return quality.type_conformance(text_rows)
