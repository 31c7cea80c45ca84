import pytest
from helpers import HEADER, write_text

from urnalake import schema as S
from urnalake.operators import audit
from urnalake.plans import Lake, build_silver, ingest
from urnalake.sources import audit_log, tables
from urnalake.streaming import load_new_files


def _run(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    load_new_files(spark, str(tmp_path / "in"), lake, str(tmp_path / "checkpoint"), S.REQUIRED_FIELDS)
    return tables.read_years_in_full(spark, lake.bronze, tables.years_in(spark, lake.bronze))


def test_only_new_files_are_loaded(spark, tmp_path):
    write_text(tmp_path / "in" / "year=2020" / "a.csv", HEADER, "2020;1;A;PE;10;8;2", "2020;2;#NULO#;PE;10;8;2")
    first = _run(spark, tmp_path)
    assert first.count() == 2 and first.where("NM_MUNICIPIO IS NULL").count() == 1
    assert {r[S.LINEAGE_SOURCE] for r in first.collect()} == {"tse:comparecimento_abstencao:2020"}
    assert _run(spark, tmp_path).count() == 2
    write_text(tmp_path / "in" / "year=2022" / "b.csv", HEADER, "2022;1;A;PE;10;8;2")
    assert {r["year"]: r["count"] for r in _run(spark, tmp_path).groupBy("year").count().collect()} == {
        2020: 2, 2022: 1,
    }


@pytest.mark.parametrize(
    "lines",
    [(HEADER, "2020;1;A;PE;foo;8;2"), (HEADER, "2020;1;A;PE;10;8;2;9"), (HEADER.replace("CD_", "XX_"), "2020;1;A;PE;1;8;2")],
)
def test_bad_input_stops_the_stream(spark, tmp_path, lines):
    write_text(tmp_path / "in" / "year=2020" / "a.csv", *lines)
    with pytest.raises(Exception):  # noqa: B017
        _run(spark, tmp_path)


def _counts(spark, lake):
    years = tables.years_in(spark, lake.bronze)
    rows = tables.read_years_in_full(spark, lake.bronze, years).groupBy("Ano").count().collect()
    return {r["Ano"]: r["count"] for r in rows}


def test_stream_and_ingest_share_a_lake(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    write_text(tmp_path / "in" / "year=2020" / "a.csv", HEADER, "2020;1;A;PE;10;8;2")
    _run(spark, tmp_path)
    other = write_text(tmp_path / "other.csv", HEADER, *[f"2022;{i};A;PE;10;8;2" for i in range(1, 4)])
    assert ingest(spark, lake, {2022: other}) == [2022]
    write_text(tmp_path / "in" / "year=2020" / "b.csv", HEADER, "2020;2;B;PE;10;8;2", "2020;3;C;PE;10;8;2")
    write_text(tmp_path / "in" / "year=2022" / "c.csv", HEADER, "2022;9;B;PE;10;8;2")
    _run(spark, tmp_path)
    assert _counts(spark, lake) == {2020: 3, 2022: 4}
    assert spark.read.parquet(lake.bronze).count() == 7
    log = audit_log.read_log(spark, lake.bronze_log, S.BRONZE_AUDIT_SCHEMA)
    assert sorted((r["ano"], r["linhas"], r["status"]) for r in log.collect()) == [
        (2020, 1, "sucesso"), (2020, 2, "sucesso"), (2022, 1, "sucesso"), (2022, 3, "sucesso"),
    ]
    assert audit.latest(log).count() == 2


def test_replayed_batch_is_added_once(spark, tmp_path):
    """The commit of the last batch is taken back, as after a failure between write and commit."""
    write_text(tmp_path / "in" / "year=2020" / "a.csv", HEADER, "2020;1;A;PE;10;8;2")
    _run(spark, tmp_path)
    write_text(tmp_path / "in" / "year=2020" / "b.csv", HEADER, "2020;2;A;PE;10;8;2")
    assert _run(spark, tmp_path).count() == 2
    commits = tmp_path / "checkpoint" / "commits"
    (commits / "1").unlink()
    (commits / ".1.crc").unlink(missing_ok=True)
    assert _run(spark, tmp_path).count() == 2


def test_columns_are_checked_before_the_stream_starts(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    write_text(tmp_path / "in" / "year=2020" / "a.csv", HEADER, "2020;1;A;PE;10;8;2")
    with pytest.raises(ValueError, match="QT_APTOS"):
        load_new_files(spark, str(tmp_path / "in"), lake, str(tmp_path / "c"), [c for c in S.REQUIRED_FIELDS if c != "QT_APTOS"])


def test_a_streamed_year_is_still_ingested(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    write_text(tmp_path / "in" / "year=2022" / "a.csv", HEADER, "2022;9;A;PE;10;8;2")
    _run(spark, tmp_path)
    origin = write_text(tmp_path / "other.csv", HEADER, *[f"2022;{i};A;PE;10;8;2" for i in range(1, 4)])
    assert ingest(spark, lake, {2022: origin}) == [2022]
    assert _counts(spark, lake) == {2022: 3}
    write_text(tmp_path / "in" / "year=2022" / "b.csv", HEADER, "2022;8;A;PE;10;8;2")
    _run(spark, tmp_path)
    assert ingest(spark, lake, {2022: origin}) == []
    assert _counts(spark, lake) == {2022: 4}


def test_streamed_rows_reach_silver(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    origin = write_text(tmp_path / "other.csv", HEADER, "2022;1;A;PE;10;8;2")
    ingest(spark, lake, {2022: origin})
    assert build_silver(spark, lake, [2022]) == [2022] and build_silver(spark, lake, [2022]) == []
    write_text(tmp_path / "in" / "year=2022" / "a.csv", HEADER, "2022;2;A;PE;10;8;2", "2022;3;A;PE;10;8;2")
    _run(spark, tmp_path)
    assert build_silver(spark, lake, [2022]) == [2022] and build_silver(spark, lake, [2022]) == []
    assert tables.read_years(spark, lake.silver, [2022]).count() == 3


def test_short_lines_of_a_batch_are_counted_per_year(spark, tmp_path):
    write_text(tmp_path / "in" / "year=2020" / "a.csv", HEADER, "2020;1;A;PE;10;8", "2020;2;A;PE;10", "2020;3;A;PE;10;8;2")
    write_text(tmp_path / "in" / "year=2022" / "b.csv", HEADER, "2022;1;A;PE;10;8;2")
    rows = _run(spark, tmp_path)
    assert rows.count() == 4 and "__is_malformed" not in rows.columns
    log = audit_log.read_log(spark, Lake(str(tmp_path / "lake")).bronze_log, S.BRONZE_AUDIT_SCHEMA)
    assert {r["ano"]: (r["linhas"], r["linhas_malformadas"]) for r in log.collect()} == {2020: (3, 2), 2022: (1, 0)}


def test_a_year_of_both_loads_has_the_columns_of_both(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    origin = write_text(tmp_path / "other.csv", f"{HEADER};NR_ZONA", "2022;1;A;PE;10;8;2;7", "2022;4;A;PE;10;8;2;#NULO#")
    ingest(spark, lake, {2022: origin})
    write_text(tmp_path / "in" / "year=2022" / "a.csv", HEADER, "2022;2;A;PE;10;8;2")
    rows = {r["CD_MUNICIPIO"]: r["NR_ZONA"] for r in _run(spark, tmp_path).collect()}
    assert rows == {1: 7, 2: None, 4: None}
    assert build_silver(spark, lake, [2022]) == [2022]
    silver = tables.read_years_in_full(spark, lake.silver, [2022])
    assert {r["CD_MUNICIPIO"]: r["NR_ZONA"] for r in silver.collect()} == {1: 7, 2: None}
