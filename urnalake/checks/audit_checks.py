"""Audit views and work planning over orders as runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from urnalake import schema as S
from urnalake.checks import inputs as I
from urnalake.checks.registry import check
from urnalake.operators import audit


@check(I.with_runs("SELECT * FROM latest"))
def audit_latest(spark, sf_dir):
    return audit.latest(I.audit_runs(spark, sf_dir))


@check(I.with_runs("SELECT * FROM latest WHERE dataset = '2-HIGH' AND ano = 1998"))
def audit_lookup(spark, sf_dir):
    return audit.lookup(I.audit_runs(spark, sf_dir), "2-HIGH", 1998)


@check(I.with_runs("SELECT * FROM latest WHERE dataset = '2-HIGH' AND ano = 2024"))
def audit_lookup_unknown(spark, sf_dir):
    return audit.lookup(I.audit_runs(spark, sf_dir), "2-HIGH", 2024)


@check(I.with_runs("SELECT * FROM latest ORDER BY ano DESC, dataset"))
def audit_list(spark, sf_dir):
    return audit.listing(I.audit_runs(spark, sf_dir))


@check(
    I.with_runs(
        """SELECT * FROM runs WHERE ano >= 1998
UNION ALL BY NAME
SELECT * EXCLUDE (status, checksum, erro) FROM runs WHERE ano < 1998"""
    )
)
def audit_evolve(spark, sf_dir):
    """Older rows without status, checksum and error get NULL there."""
    runs = I.audit_runs(spark, sf_dir)
    older = runs.where("ano < 1998").drop("status", "checksum", "erro")
    return audit.evolve(older, runs.where("ano >= 1998"))


@check(
    I.with_runs(
        """SELECT dataset, ano, run_id,
  CAST(date_diff('microsecond', timestamp_inicio, timestamp_fim) AS DOUBLE) / 1000000.0 AS duracao_segundos
FROM runs"""
    )
)
def audit_duration(spark, sf_dir):
    runs = audit.with_duration(I.audit_runs(spark, sf_dir))
    return runs.select("dataset", "ano", "run_id", "duracao_segundos")


_DONE = f"SELECT dataset, ano FROM latest WHERE status = '{S.STATUS_OK}'"


@check(I.with_work(f"SELECT * FROM manifest EXCEPT {_DONE}"))
def plan_bronze(spark, sf_dir):
    return audit.pending_bronze(I.work_manifest(spark, sf_dir), I.audit_runs(spark, sf_dir))


@check(
    I.with_work(
        f"""SELECT * FROM manifest WHERE ano IN (SELECT ano FROM years)
EXCEPT ({_DONE} AND ano IN (SELECT ano FROM years WHERE ano <= 1998))"""
    )
)
def plan_silver(spark, sf_dir):
    """Silver output exists up to 1998; years without bronze data are passed over."""
    bronze_years = I.years_of_lineitem(spark, sf_dir)
    return audit.pending_silver(
        I.work_manifest(spark, sf_dir),
        I.audit_runs(spark, sf_dir),
        silver_years=bronze_years.where(F.col("ano") <= 1998),
        bronze_years=bronze_years,
    )
