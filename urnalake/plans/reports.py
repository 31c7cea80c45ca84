"""The report over the silver table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from urnalake import schema as S
from urnalake.operators import rollups, selection
from urnalake.operators.ranking import exact_sample
from urnalake.plans.lake import Lake
from urnalake.sources import tables


@dataclass(frozen=True)
class Report:
    """The three rollups and everything the report shows, as lazy frames."""

    national: DataFrame
    regional: DataFrame
    states: DataFrame
    years: tuple[int, ...]
    regions: tuple[str, ...]
    fused: DataFrame

    def release(self) -> None:
        self.fused.unpersist()

    def latest_figures(self) -> DataFrame:
        return selection.latest_figures(self.national, self.years)

    def latest_figures_text(self) -> DataFrame:
        return selection.latest_figures_text(self.national, self.years)

    def trend(self) -> DataFrame:
        return selection.national_trend(self.national)

    def regional_evolution(self) -> DataFrame:
        return selection.regional_evolution(selection.choose_regions(self.regional, self.regions))

    def map(self, year: int | None = None) -> DataFrame:
        shown = selection.map_slice(self.states, self.years, year, self.regions)
        return rollups.with_state_name(shown)

    def national_table(self) -> DataFrame:
        return selection.labelled(selection.with_row_type(self.national))

    def regional_table(self) -> DataFrame:
        chosen = selection.choose_regions(self.regional, self.regions)
        return selection.labelled(selection.with_row_type(chosen))


def report_of(
    silver: DataFrame, years: list[int], regions: tuple[str, ...] = S.REPORT_REGIONS
) -> Report:
    """Report over silver rows tagged with ``Ano``.

    All rollups come from one fused result of a few hundred rows, which is cached: the table
    is scanned once however many parts of the report are shown. A lost executor only means
    that Spark computes the missing part again.
    """
    return report_of_rollups(rollups.rollups_fused(selection.choose_years(silver, years)), years, regions)


def report_of_rollups(rows: DataFrame, years: list[int], regions: tuple[str, ...] = S.REPORT_REGIONS) -> Report:
    """Report over the three rollups in fused form, of ``years`` alone."""
    fused = rows.cache()
    return Report(
        national=rollups.level_of(fused, rollups.NATIONAL),
        regional=rollups.level_of(fused, rollups.REGIONAL),
        states=rollups.level_of(fused, rollups.STATE),
        years=tuple(years),
        regions=tuple(regions),
        fused=fused,
    )


def missing_years(spark: SparkSession, lake: Lake, years: list[int]) -> list[int]:
    """Requested years without silver data; a report simply has no rows for them."""
    return sorted(set(years) - set(tables.years_in(spark, lake.silver)))


def report(spark: SparkSession, lake: Lake, years: list[int], **options) -> Report:
    return report_of(tables.read_years(spark, lake.silver, years), years, **options)


def export_samples(spark: SparkSession, lake: Lake, years: list[int], n: int = S.SAMPLE_ROWS) -> None:
    """Exact repeatable CSV samples of the silver table, one folder per year."""
    silver = tables.read_years_in_full(spark, lake.silver, years)
    tables.write_samples(exact_sample(silver, n).drop("Ano"), lake.samples)
