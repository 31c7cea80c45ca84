"""Queries that go through files: landed CSV, tables, samples, archives, audit, streaming.

The derived rows are written to a new folder below the cluster's shared scratch folder and
read back through the library's own sources and plans. The SQL side computes the same
answer straight from the driver tables.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import functions as F

from urnalake import schema as S
from urnalake.checks import inputs as I
from urnalake.checks.registry import check
from urnalake.checks.report_checks import FUSED_SQL, NATIONAL_SQL, REGIONAL_SQL, STATE_SQL, rounded
from urnalake.checks.quality_checks import _SILVER_RULES
from urnalake.checks.silver_checks import _LANDED, _SQL_TYPES, _nullified, _sample_sql
from urnalake.operators import audit, rollups
from urnalake.operators.ranking import exact_sample
from urnalake.operators.union import unite
from urnalake.plans import bronze as bronze_plan
from urnalake.plans import cells, checked
from urnalake.plans import silver as silver_plan
from urnalake.plans.lake import Lake
from urnalake.plans.reports import report_of
from urnalake.plans.years import run_years
from urnalake.session import scratch_folder
from urnalake.sources import archives, audit_log, encodings, files, landed_csv, tables, versions
from urnalake.streaming.bronze import load_new_files

_TYPED_SQL = ", ".join(
    f"CAST({_nullified(c)} AS {_SQL_TYPES[c]}) AS {c}" if c in _SQL_TYPES else f"{_nullified(c)} AS {c}"
    for c in _LANDED
)


def _land(rows, folder: str, by_year: bool = False) -> None:
    """Write rows as landed CSV text files."""
    writer = rows.write.options(sep=S.CSV_SEPARATOR, header="true")
    (writer.partitionBy("year") if by_year else writer).csv(folder)


def _landed_years(spark, sf_dir: str) -> str:
    """Landed files of the derived rows, one folder per year."""
    folder = scratch_folder(spark, "landed")
    rows = I.bronze(spark, sf_dir)
    _land(rows.withColumn("year", F.col("ANO_ELEICAO")), folder, by_year=True)
    return folder


@check(I.with_landed(f"SELECT {_TYPED_SQL} FROM landed"))
def csv_roundtrip(spark, sf_dir):
    """Landed text written as CSV, read back, null tokens and types applied."""
    folder = scratch_folder(spark, "csv")
    _land(I.landed(spark, sf_dir), folder)
    return landed_csv.typed(landed_csv.read_landed(spark, folder))


@check(
    I.with_landed(
        f"""SELECT * REPLACE (NM_MUNICIPIO || chr(10) || '"' || SG_UF || ';"' AS NM_MUNICIPIO) FROM (SELECT {_TYPED_SQL} FROM landed)
        WHERE NM_MUNICIPIO IS NOT NULL AND SG_UF IS NOT NULL"""
    )
)
def csv_multiline(spark, sf_dir):
    """Names with line breaks, separators and quote signs, read from byte ranges of the files."""
    folder = scratch_folder(spark, "csv")
    rows = landed_csv.nullify_tokens(I.landed(spark, sf_dir)).where("NM_MUNICIPIO IS NOT NULL AND SG_UF IS NOT NULL")
    name = F.concat("NM_MUNICIPIO", F.lit('\n"'), "SG_UF", F.lit(';"'))
    rows.withColumn("NM_MUNICIPIO", name).write.options(sep=S.CSV_SEPARATOR, header="true", escape='"').csv(folder)
    return landed_csv.typed(landed_csv.read_landed(spark, folder, multi_line=True, range_bytes=100_000))


@check(
    I.with_landed(
        f"""SELECT * REPLACE ('São João ' || NM_MUNICIPIO AS NM_MUNICIPIO) FROM (SELECT {_TYPED_SQL} FROM landed)
        WHERE NM_MUNICIPIO IS NOT NULL"""
    )
)
def csv_encodings(spark, sf_dir):
    """A folder of files in two encodings, each read by the one its bytes tell."""
    folder = scratch_folder(spark, "csv")
    rows = landed_csv.nullify_tokens(I.landed(spark, sf_dir)).where("NM_MUNICIPIO IS NOT NULL")
    rows = rows.withColumn("NM_MUNICIPIO", F.concat(F.lit("São João "), "NM_MUNICIPIO"))
    for odd, encoding in enumerate((encodings.UTF_8, encodings.LATIN_1)):
        half = rows.where(F.col("CD_MUNICIPIO") % 2 == odd).write.options(sep=S.CSV_SEPARATOR, header="true")
        half.option("encoding", encoding).csv(f"{folder}/half={odd}")
    chosen = encodings.files_by_encoding(spark, [folder], range_bytes=100_000)
    return landed_csv.typed(landed_csv.read_landed(spark, folder, chosen))


def _table_of_years(spark, sf_dir: str) -> str:
    root = scratch_folder(spark, "silver")
    rows = I.silver(spark, sf_dir).drop("Ano").withColumn("year", F.col("ANO_ELEICAO"))
    rows.write.options(**tables.PARQUET_OPTIONS).partitionBy("year").parquet(root)
    return root


@check(I.with_silver(f"SELECT * FROM ({REGIONAL_SQL}) WHERE Ano IN (1996, 1999)"))
def table_roundtrip(spark, sf_dir):
    """Rollup over two years of a year-partitioned silver table; a third year has no data."""
    root = _table_of_years(spark, sf_dir)
    chosen = tables.read_years(spark, root, [1996, 1999, 2024])
    return rounded(rollups.regional_by_year(chosen))


@check(I.with_silver(f"SELECT * FROM ({STATE_SQL}) WHERE Ano <> 1999"))
def table_replace_year(spark, sf_dir):
    """One year replaced by nothing, the others untouched."""
    root = _table_of_years(spark, sf_dir)
    nothing = tables.read_year(spark, root, 1999).where(F.lit(False))
    tables.write_year(nothing, root, 1999)
    all_years = tables.read_years(spark, root, tables.years_in(spark, root))
    return rounded(rollups.state_by_year(all_years))


@check(_sample_sql(100).replace("* EXCLUDE (n)", ", ".join([*I.REQUIRED, "NOME_REGIAO", "Ano"])))
def sample_roundtrip(spark, sf_dir):
    """Exact samples written as CSV per year and read back with silver types."""
    folder = scratch_folder(spark, "samples")
    sample = exact_sample(I.silver(spark, sf_dir), hash_columns=I.REQUIRED)
    tables.write_samples(sample.withColumn("year", F.col("Ano")).drop("Ano"), folder)
    return tables.read_samples(spark, folder).select(*I.REQUIRED, S.REGION, "Ano")


def _lake(spark, sf_dir: str) -> tuple[Lake, list[int]]:
    """Bronze and silver of all years, built by the audited plans from landed files."""
    landed = _landed_years(spark, sf_dir)
    years = tables.years_in(spark, landed)
    lake = Lake(scratch_folder(spark, "lake"))
    run_years(lambda y: bronze_plan.ingest_year(spark, lake, y, f"{landed}/year={y}"), years)
    run_years(lambda y: silver_plan.build_silver_year(spark, lake, y), years)
    return lake, years


@check(I.with_silver(NATIONAL_SQL))
def lake_end_to_end(spark, sf_dir):
    """Landed files to bronze to silver to report."""
    lake, years = _lake(spark, sf_dir)
    return rounded(report_of(tables.read_years(spark, lake.silver, years), years).national)


@check(
    I.with_silver(
        f"""SELECT '{S.SILVER_DATASET}' AS dataset, b.ANO_ELEICAO AS ano, '{S.STATUS_OK}' AS status,
  count(*) AS linhas_antes, count(b.SG_UF) AS linhas_depois, true AS same_bronze_rows
FROM bronze b GROUP BY b.ANO_ELEICAO"""
    )
)
def lake_audit(spark, sf_dir):
    """Audit rows of the plans: true row counts before and after the null removal."""
    lake, _ = _lake(spark, sf_dir)
    bronze_log = audit.latest(audit_log.read_log(spark, lake.bronze_log, S.BRONZE_AUDIT_SCHEMA))
    silver_log = audit.latest(audit_log.read_log(spark, lake.silver_log, S.SILVER_AUDIT_SCHEMA))
    same = F.col("linhas") == F.col("linhas_antes")
    return silver_log.join(bronze_log.select("ano", "linhas"), "ano").select(
        "dataset", "ano", "status", "linhas_antes", "linhas_depois", same.alias("same_bronze_rows")
    )


@check(I.with_bronze("SELECT * FROM bronze"))
def union_years(spark, sf_dir):
    """All yearly frames of a table together; each reads its own partition only."""
    root = scratch_folder(spark, "bronze")
    rows = I.bronze(spark, sf_dir).withColumn("year", F.col("ANO_ELEICAO"))
    rows.write.options(**tables.PARQUET_OPTIONS).partitionBy("year").parquet(root)
    return tables.union_years([tables.read_year(spark, root, y) for y in tables.years_in(spark, root)])


@check(
    I.with_bronze(
        f"""SELECT *, ANO_ELEICAO AS year, 'tse:{S.BRONZE_DATASET}:' || CAST(ANO_ELEICAO AS VARCHAR)
  AS _metadata_source FROM bronze"""
    )
)
def stream_bronze(spark, sf_dir):
    """Landed files loaded by the file stream into a lake; a second run finds nothing new."""
    landed = _landed_years(spark, sf_dir)
    lake = Lake(scratch_folder(spark, "stream"))
    for _ in range(2):
        load_new_files(spark, landed, lake, f"{lake.root}/checkpoint", I.REQUIRED)
    years = tables.years_in(spark, lake.bronze)
    return tables.read_years_in_full(spark, lake.bronze, years).drop(S.LINEAGE_TIMESTAMP, "Ano")


def _zip_files(csv_files, out_dir: str):
    """One archive per CSV file below ``year=Y``, with two smaller members and one of another kind."""
    out_dir = files.qualified(csv_files.sparkSession, out_dir)

    def zip_each(batches):
        import hashlib
        import re
        import zipfile

        import pandas as pd

        for batch in batches:
            for path in batch["path"]:
                source, inside = files.open_filesystem(path)
                name = hashlib.sha256(path.encode()).hexdigest()[:16]
                year = re.search(r"year=(\d+)", path).group(1)
                archive_path = f"{out_dir}/{year}/{name}.zip"
                target, target_inside = files.open_filesystem(archive_path)
                target.create_dir(target_inside.rsplit("/", 1)[0], recursive=True)
                with (
                    source.open_input_stream(inside) as stream,
                    target.open_output_stream(target_inside) as sink,
                    zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED) as archive,
                ):
                    archive.writestr("first.csv", "A;B\n1;2\n")
                    with archive.open("rows.csv", "w", force_zip64=True) as member:
                        for block in files.chunks(stream):
                            member.write(block)
                    archive.writestr("notes.txt", "no rows")
                    archive.writestr("last.csv", "A;B\n")
                yield pd.DataFrame({"archive": [archive_path]})

    return csv_files.select("path").mapInPandas(zip_each, "archive string")


@check(I.with_bronze(f"SELECT {', '.join(I.REQUIRED)} FROM bronze"))
def archive_landing(spark, sf_dir):
    """Archives of landed files: the largest CSV of each is extracted and read."""
    landed = _landed_years(spark, sf_dir)
    root = scratch_folder(spark, "archives")
    _zip_files(files.list_files(spark, landed, "*.csv"), f"{root}/zip").write.parquet(f"{root}/made")
    found = files.list_files(spark, f"{root}/zip", "*.zip")
    archives.land_archives(spark, found, f"{root}/landing")
    extracted = landed_csv.read_landed(spark, f"{root}/landing/*/raw.csv")
    return landed_csv.typed(extracted)


def _landed_halves(spark, sf_dir: str) -> str:
    """Landed files of the derived rows: per year two folders below each other."""
    folder = scratch_folder(spark, "landed")
    half = F.when(F.col("QT_ABSTENCAO") % 2 == 0, F.lit("a")).otherwise(F.lit("b"))
    rows = I.bronze(spark, sf_dir).withColumns({"year": F.col("ANO_ELEICAO"), "half": half, "part": half})
    rows.write.options(sep=S.CSV_SEPARATOR, header="true").partitionBy("year", "half", "part").csv(folder)
    return folder


@check(
    I.with_bronze(
        """SELECT ANO_ELEICAO AS ano, count(*) AS linhas, CAST(0 AS BIGINT) AS linhas_malformadas,
  count(*) AS n_rows, sum(QT_APTOS)::BIGINT AS aptos FROM bronze GROUP BY ANO_ELEICAO"""
    )
)
def lake_many_files(spark, sf_dir):
    """Several archives of a year (even years) and nested folders (odd years): nothing is left out."""
    landed = _landed_halves(spark, sf_dir)
    root = scratch_folder(spark, "archives")
    _zip_files(files.list_files(spark, landed, "*.csv"), f"{root}/zip").write.parquet(f"{root}/made")
    years = tables.years_in(spark, landed)
    origins = {y: f"{root}/zip/{y}/*.zip" if y % 2 == 0 else f"{landed}/year={y}" for y in years}
    lake = Lake(f"{root}/lake")
    run_years(lambda y: bronze_plan.ingest_year(spark, lake, y, origins[y]), years)
    log = audit.latest(audit_log.read_log(spark, lake.bronze_log, S.BRONZE_AUDIT_SCHEMA))
    rows = tables.read_years_in_full(spark, lake.bronze, years).groupBy("Ano")
    sums = rows.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("QT_APTOS").alias("aptos"))
    return log.join(sums, log["ano"] == sums["Ano"]).select(
        log["ano"], "linhas", "linhas_malformadas", "n_rows", "aptos"
    )


def _land_lines(lines, folder: str) -> None:
    """Text lines as files that begin with the header."""
    header = S.CSV_SEPARATOR.join(I.REQUIRED)

    def with_header(batches):
        first = True
        for batch in batches:
            if first and len(batch):
                batch = batch.copy()
                batch.iloc[0, 0] = f"{header}\n{batch.iloc[0, 0]}"
                first = False
            yield batch

    lines.select("line").mapInPandas(with_header, "line string").write.text(folder)


def _lines(rows, last=None):
    """Bronze rows as landed text lines; NULL is an empty field."""
    columns = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in I.REQUIRED]
    return rows.withColumn("line", F.concat_ws(S.CSV_SEPARATOR, *columns[:-1], *([] if last else columns[-1:])))


@check(
    I.with_bronze(
        """SELECT ANO_ELEICAO AS ano, count(*) AS linhas,
  count(*) FILTER (QT_ABSTENCAO = 5) AS linhas_malformadas FROM bronze GROUP BY ANO_ELEICAO"""
    )
)
def malformed_lines(spark, sf_dir):
    """Lines without their last field are padded, and the audit row of the load counts them."""
    root = scratch_folder(spark, "lines")
    rows = I.bronze(spark, sf_dir)
    short = _lines(rows.where("QT_ABSTENCAO = 5"), last=True)
    whole = _lines(rows.where("QT_ABSTENCAO <> 5"))
    years = sorted(r["ANO_ELEICAO"] for r in rows.select("ANO_ELEICAO").distinct().collect())
    lake = Lake(f"{root}/lake")

    def load(year):
        for name, lines in (("short", short), ("whole", whole)):
            _land_lines(lines.where(F.col("ANO_ELEICAO") == year), f"{root}/{year}/{name}")
        bronze_plan.ingest_year(spark, lake, year, f"{root}/{year}")

    run_years(load, years)
    log = audit.latest(audit_log.read_log(spark, lake.bronze_log, S.BRONZE_AUDIT_SCHEMA))
    return log.select("ano", "linhas", "linhas_malformadas")


def _shifted_origins(spark, sf_dir: str, poisoned: int | None = None) -> dict[int, str]:
    """Landed files whose years the manifest allows: twenty years later. One may be unreadable."""
    folder = scratch_folder(spark, "landed")
    rows = I.bronze(spark, sf_dir).withColumn("ANO_ELEICAO", F.col("ANO_ELEICAO") + _SHIFT)
    rows = rows.withColumn("year", F.col("ANO_ELEICAO"))
    if poisoned is not None:
        bad = F.when(F.col("year") == poisoned, F.lit("foo")).otherwise(F.col("QT_APTOS").cast("string"))
        rows = rows.withColumn("QT_APTOS", bad)
    _land(rows, folder, by_year=True)
    return {y: f"{folder}/year={y}" for y in tables.years_in(spark, folder)}


_SHIFT, _POISONED = 20, 2018


@check(
    I.with_bronze(
        f"""SELECT ANO_ELEICAO + {_SHIFT} AS ano,
  CASE WHEN ANO_ELEICAO + {_SHIFT} = {_POISONED} THEN '{S.STATUS_FAILED}' ELSE '{S.STATUS_OK}' END AS status,
  CASE WHEN ANO_ELEICAO + {_SHIFT} = {_POISONED} THEN 0 ELSE count(*) END AS linhas,
  ANO_ELEICAO + {_SHIFT} = {_POISONED} AS no_bytes, ANO_ELEICAO + {_SHIFT} = {_POISONED} AS names_cause,
  ANO_ELEICAO + {_SHIFT} <> {_POISONED} AS in_silver FROM bronze GROUP BY ANO_ELEICAO"""
    )
)
def lake_failure(spark, sf_dir):
    """One unreadable year: its failure is logged with zero counts and raised, the others succeed."""
    origins = _shifted_origins(spark, sf_dir, _POISONED)
    lake = Lake(scratch_folder(spark, "lake"))
    raised = False
    try:
        bronze_plan.ingest(spark, lake, origins)
    except Exception:
        raised = True
    built = silver_plan.build_silver(spark, lake, sorted(origins))
    log = audit.latest(audit_log.read_log(spark, lake.bronze_log, S.BRONZE_AUDIT_SCHEMA))
    return log.where(F.lit(raised)).select(
        "ano", "status", "linhas",
        ((F.col("tamanho_bytes") == 0) & (F.col("checksum") == "")).alias("no_bytes"),
        F.coalesce(F.col("erro").contains("cannot read 'foo'"), F.lit(False)).alias("names_cause"),
        F.col("ano").isin(built).alias("in_silver"),
    )


@check(
    I.with_silver(
        f"""SELECT * REPLACE (CAST(Ano + {_SHIFT} AS INT) AS Ano), CAST(0 AS BIGINT) AS loaded_again,
  CAST(0 AS BIGINT) AS built_again FROM ({NATIONAL_SQL})"""
    )
)
def lake_skip(spark, sf_dir):
    """Manifest to report by the plans' own entry points; a second run has nothing to do."""
    origins = _shifted_origins(spark, sf_dir)
    lake, years = Lake(scratch_folder(spark, "lake")), sorted(origins)
    bronze_plan.ingest(spark, lake, origins)
    silver_plan.build_silver(spark, lake, years)
    loaded_again = bronze_plan.ingest(spark, lake, origins)
    built_again = silver_plan.build_silver(spark, lake, years)
    national = rounded(report_of(tables.read_years(spark, lake.silver, years), years).national)
    return national.withColumns(
        {
            "loaded_again": F.lit(len(loaded_again)).cast("long"),
            "built_again": F.lit(len(built_again)).cast("long"),
        }
    )


@check(
    I.with_bronze(
        """SELECT ANO_ELEICAO AS Ano, CAST(CD_MUNICIPIO AS BIGINT) AS CD_MUNICIPIO,
  CAST(QT_COMPARECIMENTO AS DOUBLE) AS QT_COMPARECIMENTO, CAST(QT_ABSTENCAO AS DECIMAL(21,2)) AS QT_ABSTENCAO FROM bronze"""
    )
)
def years_of_other_types(spark, sf_dir):
    """Yearly tables with counts as int, long, double and decimal, united without loss."""
    root = scratch_folder(spark, "types")
    rows = I.bronze(spark, sf_dir).withColumn("CD_MUNICIPIO", F.col("CD_MUNICIPIO").cast("int"))
    kinds = [("int", "int", "int"), ("bigint", "bigint", "bigint"), ("bigint", "double", "decimal(7,2)")]
    years = sorted(r["ANO_ELEICAO"] for r in rows.select("ANO_ELEICAO").distinct().collect())
    for place, year in enumerate(years):
        types = zip(("CD_MUNICIPIO", "QT_COMPARECIMENTO", "QT_ABSTENCAO"), kinds[place % 3], strict=True)
        cast = rows.where(F.col("ANO_ELEICAO") == year).select(*[F.col(c).cast(t) for c, t in types])
        tables.write_year(cast, root, year)
    return tables.read_years_in_full(spark, root, years).drop("year")


_MORE_THAN_10 = "(SELECT * FROM silver WHERE Ano <> 1999 OR QT_APTOS > 10) AS silver"


@check(I.with_silver(STATE_SQL.replace("FROM silver", f"FROM {_MORE_THAN_10}")))
def table_replace_rows(spark, sf_dir):
    """One year replaced by other rows, here a part of its own; the others untouched."""
    root = _table_of_years(spark, sf_dir)
    part = I.silver(spark, sf_dir).drop("Ano").where("ANO_ELEICAO = 1999 AND QT_APTOS > 10")
    tables.write_year(part, root, 1999)
    all_years = tables.read_years(spark, root, tables.years_in(spark, root))
    return rounded(rollups.state_by_year(all_years))


@check(I.with_silver(f"SELECT *, Ano = 1999 AS made_again FROM ({FUSED_SQL.replace('FROM silver', f'FROM {_MORE_THAN_10}')})", empty_cells=True))
def rollups_incremental(spark, sf_dir):
    """Rollups from cells of every year; after one year is replaced, only its cells are made again."""
    lake = Lake(scratch_folder(spark, "lake"))
    rows = I.silver(spark, sf_dir, empty_cells=True).drop("Ano").withColumn("year", F.col("ANO_ELEICAO"))
    rows.write.options(**tables.PARQUET_OPTIONS).partitionBy("year").parquet(lake.silver)
    years = tables.years_in(spark, lake.silver)
    cells.refresh(spark, lake, years)
    start = datetime.now(UTC)
    kept = tables.write_year(rows.where("year = 1999 AND QT_APTOS > 10").drop("year"), lake.silver, 1999)["rows"]
    built = audit_log.silver_success(spark, S.SILVER_DATASET, 1999, start, datetime.now(UTC), kept, kept)
    audit_log.append(built, lake.silver_log)
    again = cells.refresh(spark, lake, years)
    stored = tables.read_years(spark, lake.cells, years, S.CELL_SCHEMA)
    return rounded(rollups.rollups_of_cells(stored)).withColumn("made_again", F.col("Ano").isin(again))


_VERSIONS_SQL = " UNION ALL ".join(
    f"SELECT {number} AS version, Ano, count(*) AS n, sum(QT_COMPARECIMENTO)::BIGINT AS comparecimento FROM silver WHERE {rows} GROUP BY Ano"
    for number, rows in ((1, "true"), (2, "Ano <> 1999 OR QT_APTOS > 10"), (3, "(Ano <> 1999 OR QT_APTOS > 10) AND Ano <> 1996"))
)


@check(I.with_silver(_VERSIONS_SQL))
def lake_versions(spark, sf_dir):
    """Three versions of a table, each still readable: all years, one replaced by fewer rows, one emptied.

    A fourth commit has written its rows but not its manifest, so no version has them.
    """
    root = scratch_folder(spark, "versions")
    rows = I.silver(spark, sf_dir).drop("Ano").withColumn("year", F.col("ANO_ELEICAO"))
    years = [r["year"] for r in rows.select("year").distinct().collect()]
    versions.replace_years(rows, root, years)
    versions.replace_years(rows.where("year = 1999 AND QT_APTOS > 10"), root, [1999])
    versions.replace_years(rows.where(F.lit(False)), root, [1996])
    versions.stage(rows, root)
    read = [
        versions.read_years(spark, root, years, at=versions.version(spark, root, n)).withColumn("version", F.lit(n))
        for n in versions.versions_in(spark, root)
    ]
    return tables.union_years(read).groupBy("version", "Ano").agg(
        F.count(F.lit(1)).alias("n"), F.sum("QT_COMPARECIMENTO").alias("comparecimento")
    )


_REASONS_SQL = ", ".join(f"CASE WHEN {p} THEN '{f}:{r}' END" for f, r, p in _SILVER_RULES if f != "ANO_ELEICAO")


@check(
    I.with_silver(
        f"""SELECT CASE WHEN why = '' THEN 'table' ELSE 'quarantine' END AS layer, Ano, why, count(*) AS n,
  sum(QT_COMPARECIMENTO)::BIGINT AS comparecimento
FROM (SELECT *, concat_ws(',', {_REASONS_SQL}) AS why FROM silver) GROUP BY ALL""",
        empty_cells=True,
    )
)
def quarantine(spark, sf_dir):
    """Rows that keep the value rules and rows that break some, with the rules they break."""
    root = scratch_folder(spark, "checked")
    rows = I.silver(spark, sf_dir, empty_cells=True)
    years = [r["Ano"] for r in rows.select("Ano").distinct().collect()]
    rules = [rule for rule in S.silver_rules() if rule.field != "ANO_ELEICAO"]
    run_years(lambda y: checked.write_checked_year(rows.where(F.col("Ano") == y), root, y, rules), years)
    layers = [
        unite([tables.read_year(spark, checked.layer(root, name), y) for y in tables.years_in(spark, checked.layer(root, name))])
        .withColumn("layer", F.lit(name))
        for name in (checked.TABLE, checked.QUARANTINE)
    ]
    why = F.coalesce(F.array_join(checked.REASONS, ","), F.lit("")).alias("why")
    return tables.union_years(layers).groupBy("layer", "Ano", why).agg(
        F.count(F.lit(1)).alias("n"), F.sum("QT_COMPARECIMENTO").alias("comparecimento")
    )


def _page_files(spark, sf_dir: str) -> str:
    """The html of every page as a file of its own, named by the page."""
    folder = files.qualified(spark, scratch_folder(spark, "pages"))

    def write_each(batches):
        import pandas as pd

        target, inside = files.open_filesystem(folder)
        target.create_dir(inside, recursive=True)
        for batch in batches:
            for page, html in zip(batch["page_id"], batch["html"], strict=True):
                with target.open_output_stream(f"{inside}/{page}.html") as out:
                    out.write(html.encode("utf-8"))
            yield pd.DataFrame({"page_id": batch["page_id"]})

    pages = I.table(spark, sf_dir, "pages").select("page_id", F.coalesce("html", F.lit("")).alias("html"))
    pages.mapInPandas(write_each, "page_id long").write.format("noop").mode("overwrite").save()
    return folder


@check(
    """SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS size_bytes, sha256(coalesce(html, '')) AS sha256 FROM pages"""
)
def file_checksums(spark, sf_dir):
    """Size and SHA-256 of files, each the html of a page; empty pages are empty files."""
    digests = files.digests(files.list_files(spark, _page_files(spark, sf_dir)))
    return digests.select(_page_of_file().alias("page_id"), "size_bytes", "sha256")


def _page_of_file():
    return F.regexp_extract("path", r"/(-?\d+)\.html$", 1).cast("long")


_TREE_SQL = """
WITH bytes AS (SELECT page_id, hex(encode(coalesce(html, ''))) AS h FROM pages
), leaves AS (
  SELECT page_id, i, sha256(unhex(substr(h, i * 1000 + 1, 1000))) AS d
  FROM bytes, LATERAL unnest(range(0, greatest((length(h) + 999) // 1000, 1))) AS u(i)
), nodes AS (SELECT page_id, i // 3 AS i, sha256(string_agg(d, '' ORDER BY i)) AS d FROM leaves GROUP BY ALL
), upper_nodes AS (SELECT page_id, i // 3 AS i, sha256(string_agg(d, '' ORDER BY i)) AS d FROM nodes GROUP BY ALL
), top AS (SELECT page_id, i // 3 AS i, sha256(string_agg(d, '' ORDER BY i)) AS d FROM upper_nodes GROUP BY ALL)
SELECT page_id, i::BIGINT AS part, d AS sha256 FROM top
"""


@check(_TREE_SQL)
def file_tree_digests(spark, sf_dir):
    """Digest trees of files over ranges of 500 bytes: the nodes of the third level, parts of 13,500 bytes."""
    leaves = files.range_digests(files.list_files(spark, _page_files(spark, sf_dir)), 500)
    # Parts of a file have a tree each, so that all trees have the same three levels.
    parts = leaves.select(
        F.concat_ws("#", "path", F.floor(F.col("number") / 27).cast("string")).alias("path"),
        F.lit(26).alias("last"), (F.col("number") % 27).alias("number"), "sha256",
    )
    for _ in range(3):
        parts = files.next_level(parts, 3)
    name = F.substring_index("path", "#", 1)
    return parts.select(
        F.regexp_extract(name, r"/(-?\d+)\.html$", 1).cast("long").alias("page_id"),
        F.substring_index("path", "#", -1).cast("long").alias("part"), "sha256",
    )


_PIECES_SQL = ", ".join(
    f"sum(('0x' || substr(sha256(coalesce(html, '')), {start}, 16))::UBIGINT)::VARCHAR" for start in range(1, 65, 16)
)


@check(
    f"""SELECT count(*) AS n_files, sum(strlen(coalesce(html, '')))::BIGINT AS size_bytes,
  sha256(concat_ws('|', count(*)::VARCHAR, sum(strlen(coalesce(html, '')))::VARCHAR, {_PIECES_SQL})) AS sha256
FROM pages"""
)
def folder_checksum(spark, sf_dir):
    """One checksum over a folder of files, from the files' own."""
    return files.folder_digest(files.digests(files.list_files(spark, _page_files(spark, sf_dir))))
