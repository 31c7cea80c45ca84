import math
from datetime import UTC, datetime
from pathlib import Path

import pytest
from helpers import bronze_rows, cell

from urnalake import schema as S
from urnalake.operators import rollups
from urnalake.operators.silver import to_silver
from urnalake.plans import cells, report
from urnalake.plans.lake import Lake
from urnalake.sources import audit_log, tables


def build(spark, lake, year, rows):
    """A silver year as the silver build leaves it."""
    start = datetime.now(UTC)
    n = tables.write_year(to_silver(bronze_rows(spark, rows)), lake.silver, year)["rows"]
    audit_log.append(audit_log.silver_success(spark, S.SILVER_DATASET, year, start, datetime.now(UTC), n, n), lake.silver_log)


def shown(rollup):
    return sorted((tuple(str(v) for v in row) for row in rollup.collect()), key=str)


def same_reports(spark, lake, years):
    mine, other = cells.report(spark, lake, years), report(spark, lake, years)
    for part in ("national", "regional", "states"):
        assert shown(getattr(mine, part)) == shown(getattr(other, part))
    mine.release()
    other.release()


YEARS = [2018, 2020, 2022]


def test_only_changed_years_are_aggregated(spark, tmp_path):
    lake = Lake(str(tmp_path))
    for year in YEARS:
        build(spark, lake, year, [cell(year=year), cell("RJ", 50, 25, 25, year=year), cell("ZZ", 8, 1, 7, year=year)])
    assert cells.refresh(spark, lake, YEARS) == YEARS
    assert cells.refresh(spark, lake, YEARS) == []
    same_reports(spark, lake, YEARS)
    build(spark, lake, 2020, [cell("AM", 4, 1, 3, year=2020)])
    same_reports(spark, lake, YEARS)
    build(spark, lake, 2022, [cell("AM", 4, 3, 1, year=2022)])
    for year in (2018, 2020):
        for file in Path(lake.silver, f"year={year}").glob("part-*"):
            file.write_bytes(b"nothing may read this")
            file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    assert cells.refresh(spark, lake, YEARS) == [2022]


def test_years_without_rows_or_data(spark, tmp_path):
    lake = Lake(str(tmp_path))
    assert cells.refresh(spark, lake, YEARS) == []
    assert cells.report(spark, lake, YEARS).fused.count() == 0
    build(spark, lake, 2018, [cell(uf=None)])
    assert cells.refresh(spark, lake, YEARS) == [2018]
    assert cells.refresh(spark, lake, YEARS) == []
    build(spark, lake, 2018, [cell(year=2018)])
    build(spark, lake, 2020, [cell(year=2020)])
    same_reports(spark, lake, YEARS)
    build(spark, lake, 2018, [cell(uf=None)])
    same_reports(spark, lake, YEARS)


@pytest.mark.parametrize(
    "rates",
    [[(0, 0), (10, 5)], [(0, 5), (10, 5)], [(0, -5), (10, 5)], [(0, 5), (0, -5)], [(0, 0), (0, 5)], [(10, 5), (3, 1)]],
)
def test_nan_and_infinite_rates_merge(spark, tmp_path, rates):
    lake = Lake(str(tmp_path))
    states = ["SP", "RJ", "AM"]
    build(spark, lake, 2022, [cell(uf, n, turnout, 0) for (n, turnout), uf in zip(rates, states, strict=False)])
    cells.refresh(spark, lake, [2022])
    stored = tables.read_years(spark, lake.cells, [2022], S.CELL_SCHEMA)
    assert all(math.isfinite(row["rate_sum"]) for row in stored.collect())
    assert shown(rollups.rollups_of_cells(stored)) == shown(rollups.rollups_fused(tables.read_years(spark, lake.silver, [2022])))


def test_a_failure_is_logged_and_leaves_the_cells(spark, tmp_path):
    lake = Lake(str(tmp_path))
    build(spark, lake, 2022, [cell()])
    cells.refresh(spark, lake, [2022])
    before = shown(tables.read_years(spark, lake.cells, [2022], S.CELL_SCHEMA))
    build(spark, lake, 2022, [cell(turnout=70)])
    for file in Path(lake.silver, "year=2022").glob("part-*"):
        file.write_bytes(b"broken")
        file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    with pytest.raises(Exception):  # noqa: B017
        cells.refresh(spark, lake, [2022])
    assert shown(tables.read_years(spark, lake.cells, [2022], S.CELL_SCHEMA)) == before
    log = audit_log.read_log(spark, lake.silver_log, S.SILVER_AUDIT_SCHEMA).where(f"dataset = '{cells.DATASET}'")
    assert [r["status"] for r in log.orderBy("timestamp_fim").collect()] == [S.STATUS_OK, S.STATUS_FAILED]
