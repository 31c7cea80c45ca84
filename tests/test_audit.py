from datetime import UTC, datetime, timedelta

import pytest

from urnalake import schema as S
from urnalake.operators import audit
from urnalake.sources import audit_log

START = datetime(2024, 1, 1, 12, tzinfo=UTC)


def _end(seconds):
    return START + timedelta(seconds=seconds)


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "audit")


def _bronze(spark, root):
    return audit_log.read_log(spark, root, S.BRONZE_AUDIT_SCHEMA)


def _silver(spark, root):
    return audit_log.read_log(spark, root, S.SILVER_AUDIT_SCHEMA)


def test_empty_log(spark, root):
    log = _bronze(spark, root)
    assert log.schema.names == S.BRONZE_AUDIT_SCHEMA.names
    assert audit.lookup(log, "d", 2022).count() == 0
    assert audit.listing(log).count() == 0


def test_bronze_success_and_failure(spark, root):
    audit_log.append(audit_log.bronze_success(spark, "d", 2022, START, _end(60), 10, 1000, "abc"), root)
    audit_log.append(audit_log.bronze_failure(spark, "d", 2020, START, _end(1), "no file"), root)
    rows = audit.listing(_bronze(spark, root)).collect()
    assert [r["ano"] for r in rows] == [2022, 2020]
    ok, failed = rows
    assert (ok["status"], ok["linhas"], ok["tamanho_bytes"], ok["checksum"], ok["erro"]) == (
        "sucesso", 10, 1000, "abc", None,
    )
    assert ok["duracao_segundos"] == 60.0
    assert (failed["status"], failed["linhas"], failed["tamanho_bytes"], failed["checksum"], failed["erro"]) == (
        "falha", 0, 0, "", "no file",
    )


def test_times_are_instants(spark, root):
    audit_log.append(audit_log.bronze_success(spark, "d", 2022, START, _end(60), 1, 1, "x"), root)
    text = _bronze(spark, root).selectExpr("date_format(timestamp_inicio, \"yyyy-MM-dd'T'HH:mm:ssXXX\") AS t")
    assert text.first()["t"] == "2024-01-01T12:00:00Z"


def test_second_run_replaces_every_value(spark, root):
    audit_log.append(audit_log.silver_failure(spark, "d", 2022, START, _end(300), "broken"), root)
    audit_log.append(audit_log.silver_success(spark, "d", 2022, _end(400), _end(1000), 12, 10), root)
    rows = audit.latest(_silver(spark, root)).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row["duracao_segundos"], row["linhas_antes"], row["linhas_depois"], row["erro"]) == (600.0, 12, 10, None)


def test_listing_is_by_year_descending(spark, root):
    for year in (2022, 2024, 2018):
        audit_log.append(audit_log.silver_success(spark, "d", year, START, _end(1), 1, 1), root)
    assert [r["ano"] for r in audit.listing(_silver(spark, root)).collect()] == [2024, 2022, 2018]


def test_lookup(spark, root):
    audit_log.append(audit_log.silver_failure(spark, "d", 2022, START, _end(1), "broken"), root)
    log = _silver(spark, root)
    assert audit.lookup(log, "d", 2022).first()["erro"] == "broken"
    assert audit.lookup(log, "d", 2020).count() == 0
    assert audit.lookup(log, "other", 2022).count() == 0


def test_older_files_lack_columns(spark, root):
    audit_log.append(audit_log.bronze_success(spark, "d", 2020, START, _end(1), 1, 1, "x").drop("checksum"), root)
    audit_log.append(audit_log.bronze_success(spark, "d", 2022, START, _end(1), 1, 1, "y"), root)
    rows = {r["ano"]: r["checksum"] for r in audit.latest(_bronze(spark, root)).collect()}
    assert rows == {2020: None, 2022: "y"}


def test_equal_end_times_have_one_winner(spark):
    ddl = "dataset string, ano int, timestamp_fim timestamp, run_id string"
    log = spark.createDataFrame([("d", 2022, START, r) for r in ("a", "c", "b")], ddl)
    assert [r["run_id"] for r in audit.latest(log).collect()] == ["c"]


def test_planning(spark):
    ddl = "dataset string, ano int, timestamp_fim timestamp, run_id string, status string"
    log = spark.createDataFrame(
        [
            ("d", 2014, START, "a", "falha"), ("d", 2014, _end(1), "b", "sucesso"),
            ("d", 2016, START, "a", "sucesso"), ("d", 2016, _end(1), "b", "falha"),
            ("d", 2018, START, "a", "sucesso"), ("other", 2020, START, "a", "sucesso"),
        ],
        ddl,
    )
    manifest = spark.createDataFrame([("d", y) for y in (2014, 2016, 2018, 2020, 2022)], "dataset string, ano int")
    pending = {r["ano"] for r in audit.pending_bronze(manifest, log).collect()}
    assert pending == {2016, 2020, 2022}

    def years(*values):
        return spark.createDataFrame([(v,) for v in values], "ano int")

    todo = audit.pending_silver(manifest, log, silver_years=years(2014, 2016), bronze_years=years(2014, 2016, 2018, 2020))
    assert {r["ano"] for r in todo.collect()} == {2016, 2018, 2020}
    missing = audit.missing_years(years(2014, 2022), years(2014, 2016))
    assert [r["ano"] for r in missing.collect()] == [2022]
