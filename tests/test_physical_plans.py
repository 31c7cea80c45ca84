"""What the plans must look like to hold at scale."""

from __future__ import annotations

import re
import time

import __spark_entry__ as entry_point
import pytest
from helpers import bronze_rows, cell
from pyspark.sql import functions as F

from urnalake import schema as S
from urnalake.checks import inputs
from urnalake.operators import audit, ranking, rollups
from urnalake.operators.silver import to_silver
from urnalake.plans.silver import silver_frame
from urnalake.sources import tables


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("table") / "silver")
    rows = [cell(uf, 100, 80, 20, year=y) for y in (2018, 2020, 2022) for uf in ("SP", "ZZ")]
    silver = to_silver(bronze_rows(spark, rows)).withColumn("year", F.col("ANO_ELEICAO"))
    silver.write.partitionBy("year").parquet(path)
    return path


def test_silver_is_map_only_and_stays_in_the_jvm(spark, tmp_path):
    bronze_rows(spark, [cell()]).write.parquet(str(tmp_path / "b"))
    plan = physical(to_silver(spark.read.parquet(str(tmp_path / "b"))))
    assert "Exchange" not in plan and "Python" not in plan
    assert "PushedFilters: [IsNotNull(ANO_ELEICAO)" in plan


def test_reports_prune_years_and_columns(spark, root):
    plan = physical(rollups.rollups_fused(tables.read_years(spark, root, [2020, 2022])))
    assert re.search(r"PartitionFilters: \[year#\d+ IN \(2020,2022\)\]", plan)
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {c.split(":")[0] for c in read.split(",")} == {
        "SG_UF", "QT_COMPARECIMENTO", "QT_ABSTENCAO", S.RATE_TURNOUT, S.REGION,
    }
    assert plan.count("FileScan") == 1


def test_fused_rollup_expands_cells_not_rows(spark, root):
    plan = physical(rollups.rollups_fused(tables.read_years(spark, root, [2020])))
    expand, scan = plan.index("Expand"), plan.index("FileScan")
    between = plan[expand:scan]
    assert between.count("HashAggregate") == 2 and "Exchange" in between


def test_state_rollup_pushes_the_overseas_filter(spark, root):
    plan = physical(rollups.state_by_year(tables.read_years(spark, root, [2020])))
    assert "Not(EqualTo(SG_UF,ZZ))" in plan


def test_top_n_never_sorts_everything(spark, root):
    assert "TakeOrderedAndProject" in physical(ranking.top_by_turnout(spark.read.parquet(root)))


def test_samples_and_latest_rows_are_cut_before_the_shuffle(spark, root):
    sample = physical(ranking.exact_sample(tables.read_years(spark, root, [2020])))
    assert len(re.findall("WindowGroupLimit", sample)) == 4
    assert sample.count("FileScan") == 1
    by_slice = re.search(r"Exchange hashpartitioning\(Ano#\d+, __slice#\d+", sample)
    assert "WindowGroupLimit" in sample[by_slice.end():]
    assert "Join" not in sample
    ddl = "dataset string, ano int, timestamp_fim timestamp, run_id string"
    latest = physical(audit.latest(spark.createDataFrame([], ddl)))
    assert "WindowGroupLimit" in latest[latest.rindex("Exchange"):]


def test_one_year_is_found_without_opening_files(spark, root):
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("listing", "")
    try:
        assert tables.years_in(spark, root) == [2018, 2020, 2022]
        assert tables.years_in(spark, root + "-none") == []
        assert list(jobs.getJobIdsForGroup("listing")) == []
    finally:
        spark.sparkContext.setJobGroup("tests", "")


def _skewed(spark, folder):
    """A third of all line items belong to one supplier."""
    hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000)
    spark.range(0, 600_000, 1, 16).select(
        F.col("id").alias("l_orderkey"), hot.alias("l_suppkey"),
        (F.col("id") % 7 + 1).cast("int").alias("l_linenumber"),
        (F.col("id") % 50 + 1).cast("double").alias("l_quantity"),
        F.make_timestamp_ntz(F.lit(1995) + (F.col("id") % 7).cast("int"), *[F.lit(1)] * 2, *[F.lit(0)] * 3)
        .alias("l_shipdate"),
    ).write.parquet(f"{folder}/lineitem.parquet")
    spark.range(1000).select(
        F.col("id").alias("s_suppkey"), F.concat(F.lit("S"), "id").alias("s_name"),
        (F.col("id") % 25).cast("int").alias("s_nationkey"),
    ).write.parquet(f"{folder}/supplier.parquet")


@pytest.mark.parametrize(("hash_join_bytes", "join"), [("1", "SortMergeJoin"), ("64MB", "ShuffledHashJoin")])
def test_a_hot_supplier_is_split(spark, tmp_path, hash_join_bytes, join):
    """Without a broadcast, adaptive execution splits the partition of the hot key."""
    _skewed(spark, str(tmp_path))
    expected = sorted(map(tuple, rollups.regional_by_year(inputs.silver(spark, str(tmp_path))).collect()))
    settings = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": hash_join_bytes,
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100000",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        df = rollups.regional_by_year(inputs.silver(spark, str(tmp_path)))
        got = sorted(map(tuple, df.collect()))
        assert f"{join}(skew=true)" in physical(df)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert [r[:4] for r in got] == [r[:4] for r in expected]
    assert [r[4] for r in got] == pytest.approx([r[4] for r in expected])


def test_hot_groups_do_not_slow_the_small_results(spark):
    """One audit key and one year hold nearly all rows; both reduce before the shuffle."""
    rows = spark.range(0, 2_000_000, 1, 16)
    log = rows.select(
        F.lit("d").alias("dataset"), F.when(F.col("id") < 10, 2020).otherwise(2022).alias("ano"),
        F.timestamp_seconds("id").alias("timestamp_fim"), F.col("id").cast("string").alias("run_id"),
    )
    start = time.time()
    assert {r["ano"]: r["run_id"] for r in audit.latest(log).collect()} == {2020: "9", 2022: "1999999"}
    assert time.time() - start < 60


@pytest.mark.parametrize("split", ["256m", "128MB", "134217728b", "134217728"])
def test_any_split_size_setting_is_taken(spark, root, split):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, split)
        assert tables.read_years(spark, root, [2020]).count() == 2
        assert tables.read_year(spark, root, 2020).count() == 2
        assert spark.conf.get(key) == split
    finally:
        spark.conf.set(key, before)


def test_queries_leave_the_settings_as_they_were(spark):
    def settings():
        return {k: v for k, v in spark.conf.getAll.items() if k.startswith("spark.sql.")}

    before = settings()
    for name in ("national_by_year", "sample_exact_large", "table_roundtrip", "plan_silver"):
        entry_point.queries()[name](spark, "/root/testdata/sf0.001").collect()
    assert settings() == before


def test_silver_job_filters_in_the_scan(spark, tmp_path):
    bronze_rows(spark, [cell()]).write.parquet(str(tmp_path / "b"))
    plan = physical(silver_frame(spark.read.parquet(str(tmp_path / "b"))))
    assert "PushedFilters: [IsNotNull(ANO_ELEICAO)" in plan and "CollectMetrics" not in plan


def test_yearly_write_neither_sorts_nor_shuffles(spark, root, tmp_path):
    silver = to_silver(tables.read_year(spark, root, 2020).select(*S.REQUIRED_FIELDS))
    tables.write_year(silver, str(tmp_path / "t"), 2020)
    executions = spark._jsparkSession.sharedState().statusStore().executionsList()
    plan = executions.apply(executions.size() - 1).physicalPlanDescription()
    assert "WriteFiles" in plan
    assert "Sort" not in plan and "Exchange" not in plan and "Python" not in plan
