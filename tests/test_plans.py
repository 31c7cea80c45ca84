import zipfile

import pytest
from helpers import HEADER, write_text
from pyspark.sql import functions as F

from urnalake import schema as S
from urnalake.operators import audit
from urnalake.plans import Lake, build_silver, export_samples, ingest, report
from urnalake.plans.reports import missing_years
from urnalake.sources import audit_log, tables


def lines(year, n=3, uf="PE"):
    return [f"{year};{i};Cidade {i};{uf};100;80;20" for i in range(1, n + 1)]


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


def bronze_log(spark, lake):
    return audit.latest(audit_log.read_log(spark, lake.bronze_log, S.BRONZE_AUDIT_SCHEMA))


def silver_log(spark, lake):
    return audit.latest(audit_log.read_log(spark, lake.silver_log, S.SILVER_AUDIT_SCHEMA))


def test_files_to_report(spark, lake, tmp_path):
    origins = {y: write_text(tmp_path / f"{y}.csv", HEADER, *lines(y)) for y in (2020, 2022)}
    assert ingest(spark, lake, origins) == [2020, 2022]
    assert ingest(spark, lake, origins) == []
    assert build_silver(spark, lake, [2020, 2022, 2024]) == [2020, 2022]
    assert build_silver(spark, lake, [2020, 2022, 2024]) == []
    row = bronze_log(spark, lake).where("ano = 2022").first()
    assert (row["status"], row["linhas"]) == ("sucesso", 3)
    assert row["tamanho_bytes"] == (tmp_path / "2022.csv").stat().st_size
    assert len(row["checksum"]) == 64
    shown = report(spark, lake, [2020, 2022, 2024])
    assert {r["Ano"]: r["comparecimento_total"] for r in shown.national.collect()} == {2020: 240, 2022: 240}
    shown.release()
    assert missing_years(spark, lake, [2020, 2022, 2024]) == [2024]
    assert tables.years_in(spark, lake.silver) == [2020, 2022]


def test_report_before_any_load_is_empty(spark, lake):
    shown = report(spark, lake, [2022])
    assert shown.national.count() == 0 and shown.map().count() == 0
    shown.release()
    assert missing_years(spark, lake, [2022]) == [2022]


def test_zip_origin(spark, lake, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as archive:
        archive.writestr("readme.txt", "x" * 10000)
        archive.writestr("small.csv", "A\n1\n")
        archive.writestr("rows.csv", "\n".join([HEADER, *lines(2022)]) + "\n")
    assert ingest(spark, lake, {2022: str(tmp_path / "a.zip")}) == [2022]
    assert tables.read_year(spark, lake.bronze, 2022).count() == 3


def test_folder_origin(spark, lake, tmp_path):
    for part in range(3):
        write_text(tmp_path / "in" / f"{part}.csv", HEADER, *lines(2022))
    assert ingest(spark, lake, {2022: str(tmp_path / "in")}) == [2022]
    assert bronze_log(spark, lake).first()["linhas"] == 9


def test_checksum_of_any_file_name(spark, lake, tmp_path):
    import hashlib

    path = write_text(tmp_path / "rows.CSV", HEADER, *lines(2022))
    ingest(spark, lake, {2022: path})
    row = bronze_log(spark, lake).first()
    assert row["checksum"] == hashlib.sha256((tmp_path / "rows.CSV").read_bytes()).hexdigest()
    assert row["tamanho_bytes"] == (tmp_path / "rows.CSV").stat().st_size


def test_missing_origin_is_a_logged_failure(spark, lake, tmp_path):
    with pytest.raises(Exception, match="(?i)path"):
        ingest(spark, lake, {2022: str(tmp_path / "none.csv")})
    assert bronze_log(spark, lake).first()["status"] == "falha"


def test_failure_is_logged_and_raised_and_retried(spark, lake, tmp_path):
    path = write_text(tmp_path / "a.csv", HEADER, lines(2022)[0].replace("100", "foo"))
    with pytest.raises(Exception, match="cannot read 'foo'"):
        ingest(spark, lake, {2022: path})
    row = bronze_log(spark, lake).first()
    assert (row["status"], row["linhas"], row["tamanho_bytes"], row["checksum"]) == ("falha", 0, 0, "")
    assert "cannot read 'foo'" in row["erro"]
    assert tables.years_in(spark, lake.bronze) == []
    write_text(tmp_path / "a.csv", HEADER, *lines(2022))
    assert ingest(spark, lake, {2022: path}) == [2022]
    assert bronze_log(spark, lake).first()["status"] == "sucesso"


def test_one_failing_year_does_not_stop_the_others(spark, lake, tmp_path):
    origins = {
        2020: write_text(tmp_path / "2020.csv", HEADER, *lines(2020)),
        2022: write_text(tmp_path / "2022.csv", "A;B", "1;2"),
    }
    with pytest.raises(ValueError, match="required fields missing"):
        ingest(spark, lake, origins)
    status = {r["ano"]: r["status"] for r in bronze_log(spark, lake).collect()}
    assert status == {2020: "sucesso", 2022: "falha"}


def test_failed_reload_leaves_the_year_as_it_was(spark, lake, tmp_path):
    from urnalake.plans.bronze import ingest_year

    good = write_text(tmp_path / "good.csv", HEADER, *lines(2022))
    bad = write_text(tmp_path / "bad.csv", HEADER, *lines(2022), "2022;9;X;PE;foo;1;1")
    ingest_year(spark, lake, 2022, good)
    with pytest.raises(Exception, match="foo"):
        ingest_year(spark, lake, 2022, bad)
    assert tables.read_year(spark, lake.bronze, 2022).count() == 3


def test_invalid_manifest_rows_are_refused(spark, lake):
    with pytest.raises(ValueError, match="1999"):
        ingest(spark, lake, {1999: "/data/a.csv"})
    with pytest.raises(ValueError, match="ftp"):
        ingest(spark, lake, {2022: "ftp://x"})


def test_bronze_year_absent_leaves_no_trace(spark, lake):
    assert build_silver(spark, lake, [2022]) == []
    assert silver_log(spark, lake).count() == 0
    assert tables.years_in(spark, lake.silver) == []


def test_rows_before_and_after(spark, lake, tmp_path):
    path = write_text(tmp_path / "a.csv", HEADER, *lines(2022), "2022;9;#NULO#;PE;1;1;0")
    ingest(spark, lake, {2022: path})
    build_silver(spark, lake, [2022])
    row = silver_log(spark, lake).first()
    assert (row["linhas_antes"], row["linhas_depois"], row["status"]) == (4, 3, "sucesso")


def test_bronze_without_required_columns_is_a_logged_failure(spark, lake):
    tables.write_year(spark.sql("SELECT 2022 AS ANO_ELEICAO, 100L AS QT_APTOS"), lake.bronze, 2022)
    with pytest.raises(Exception, match="QT_COMPARECIMENTO|columns"):
        build_silver(spark, lake, [2022])
    row = silver_log(spark, lake).first()
    assert (row["status"], row["linhas_antes"], row["linhas_depois"]) == ("falha", 0, 0)
    assert row["erro"]


def test_silver_is_built_again_when_its_output_is_gone(spark, lake, tmp_path):
    ingest(spark, lake, {2022: write_text(tmp_path / "a.csv", HEADER, *lines(2022))})
    assert build_silver(spark, lake, [2022]) == [2022]
    (tmp_path / "lake" / "silver" / S.BRONZE_DATASET / "year=2022").rename(tmp_path / "moved")
    assert build_silver(spark, lake, [2022]) == [2022]


def test_year_without_complete_rows(spark, lake, tmp_path):
    path = write_text(tmp_path / "a.csv", HEADER, "2022;9;#NULO#;PE;1;1;0")
    ingest(spark, lake, {2022: path})
    assert build_silver(spark, lake, [2022]) == [2022]
    assert tables.read_year(spark, lake.silver, 2022).count() == 0
    assert build_silver(spark, lake, [2022]) == []
    assert silver_log(spark, lake).first()["linhas_depois"] == 0


def test_header_only_file(spark, lake, tmp_path):
    ingest(spark, lake, {2022: write_text(tmp_path / "a.csv", HEADER)})
    assert bronze_log(spark, lake).first()["linhas"] == 0
    assert build_silver(spark, lake, [2022]) == [2022]
    row = silver_log(spark, lake).first()
    assert (row["linhas_antes"], row["linhas_depois"]) == (0, 0)


def test_years_with_different_extra_columns(spark, lake, tmp_path):
    origins = {
        2020: write_text(tmp_path / "a.csv", HEADER, *lines(2020)),
        2022: write_text(tmp_path / "b.csv", HEADER + ";DS_X", *[x + ";x" for x in lines(2022)]),
    }
    ingest(spark, lake, origins)
    build_silver(spark, lake, [2020, 2022])
    both = tables.read_years_in_full(spark, lake.silver, [2020, 2022, 2024])
    assert {(r["Ano"], r["DS_X"]) for r in both.collect()} == {(2020, None), (2022, "x")}


def test_samples(spark, lake, tmp_path):
    origins = {
        2020: write_text(tmp_path / "a.csv", HEADER, *lines(2020, 250)),
        2022: write_text(tmp_path / "b.csv", HEADER, *lines(2022, 40)),
    }
    ingest(spark, lake, origins)
    build_silver(spark, lake, [2020, 2022])
    export_samples(spark, lake, [2020, 2022])
    sample = tables.read_samples(spark, lake.samples)
    assert {r["Ano"]: r["count"] for r in sample.groupBy("Ano").count().collect()} == {2020: 100, 2022: 40}
    assert dict(sample.dtypes)[S.RATE_TURNOUT] == "double"
    assert sample.agg(F.sum("QT_COMPARECIMENTO")).first()[0] == 140 * 80


def test_zstd_with_statistics(spark, lake, tmp_path):
    import pyarrow.parquet as pq

    ingest(spark, lake, {2022: write_text(tmp_path / "a.csv", HEADER, *lines(2022))})
    (file,) = (tmp_path / "lake" / "bronze" / S.BRONZE_DATASET / "year=2022").glob("*.parquet")
    column = pq.ParquetFile(file).metadata.row_group(0).column(4)
    assert column.compression == "ZSTD"
    assert (column.statistics.min, column.statistics.max) == (100, 100)


def test_union_of_years_is_strict(spark):
    a, b = spark.sql("SELECT 1 AS x, 2 AS y"), spark.sql("SELECT 3 AS y, 4 AS x")
    assert tables.union_years([a, b]).collect() == [(1, 2), (4, 3)]
    with pytest.raises(Exception, match="x|column"):
        tables.union_years([a, spark.sql("SELECT 1 AS y")])


def test_views_for_direct_sql(spark, lake, tmp_path):
    ingest(spark, lake, {2022: write_text(tmp_path / "a.csv", HEADER, *lines(2022))})
    tables.register_views(spark, bronze_turnout=lake.bronze)
    assert spark.sql("SELECT sum(QT_APTOS) FROM bronze_turnout WHERE year = 2022").first()[0] == 300


def _archive(path, year, n):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w") as archive:
        archive.writestr("rows.csv", "\n".join([HEADER, *lines(year, n)]) + "\n")


def test_all_archives_of_an_origin_are_loaded(spark, lake, tmp_path):
    from urnalake.plans.bronze import ingest_year

    for name, n in (("a", 1), ("b", 2), ("c", 4)):
        _archive(tmp_path / "in" / f"{name}.zip", 2022, n)
    ingest(spark, lake, {2022: str(tmp_path / "in" / "*.zip")})
    row = bronze_log(spark, lake).first()
    assert (row["linhas"], tables.read_year(spark, lake.bronze, 2022).count()) == (7, 7)
    text = [len("\n".join([HEADER, *lines(2022, n)])) + 1 for n in (1, 2, 4)]
    assert row["tamanho_bytes"] == sum(text)
    (tmp_path / "in" / "c.zip").unlink()
    ingest_year(spark, lake, 2022, str(tmp_path / "in" / "*.zip"))
    assert tables.read_year(spark, lake.bronze, 2022).count() == 3


def test_nested_folder_origin(spark, lake, tmp_path):
    write_text(tmp_path / "in" / "a.csv", HEADER, *lines(2022, 1))
    write_text(tmp_path / "in" / "sub" / "b.csv", HEADER, *lines(2022, 2))
    ingest(spark, lake, {2022: str(tmp_path / "in")})
    assert bronze_log(spark, lake).first()["linhas"] == 3


def test_short_lines_are_counted(spark, lake, tmp_path):
    path = write_text(tmp_path / "a.csv", HEADER, *lines(2022), "2022;9;X;PE;10;8", "2022;9;Y;PE")
    ingest(spark, lake, {2022: path})
    row = bronze_log(spark, lake).first()
    assert (row["linhas"], row["linhas_malformadas"]) == (5, 2)


def test_file_addresses_and_published_addresses(spark, lake, tmp_path):
    path = write_text(tmp_path / "a.csv", HEADER, *lines(2022))
    assert ingest(spark, lake, {2022: f"file://{path}"}) == [2022]
    _archive(tmp_path / "b.zip", 2020, 2)
    assert ingest(spark, lake, {2020: f"file://{tmp_path}/b.zip"}) == [2020]
    with pytest.raises(ValueError, match="land the file first"):
        ingest(spark, lake, {2018: "https://example.com/a.zip"})


def test_old_log_files_have_no_malformed_count(spark, lake, tmp_path):
    ingest(spark, lake, {2022: write_text(tmp_path / "a.csv", HEADER, *lines(2022))})
    old = audit_log.read_log(spark, lake.bronze_log, S.BRONZE_AUDIT_SCHEMA).drop("linhas_malformadas", "run_id")
    audit_log.append(old.withColumn("ano", F.lit(2020)), lake.bronze_log)
    assert {r["ano"]: r["linhas_malformadas"] for r in bronze_log(spark, lake).collect()} == {2022: 0, 2020: None}
