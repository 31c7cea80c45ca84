from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import types as T

from urnalake.sources import versions

LAYOUT = T.StructType([T.StructField("v", T.LongType())])


def rows(spark, *pairs):
    return spark.createDataFrame(pairs, "v long, year int")


def read(spark, root, years, at=None):
    return sorted((r["Ano"], r["v"]) for r in versions.read_years(spark, root, years, LAYOUT, at).collect())


def test_versions_stay_as_they_were(spark, tmp_path):
    root = str(tmp_path / "t")
    assert versions.version(spark, root) == versions.Version(0, {})
    assert read(spark, root, [2020]) == []
    first, figures = versions.replace_years(rows(spark, (1, 2020), (2, 2022)), root, [2020, 2022])
    assert (first.number, figures) == (1, {"rows": 2})
    open_reader = versions.read_years(spark, root, [2020, 2022], LAYOUT)
    second, _ = versions.replace_years(rows(spark, (3, 2022), (4, 2022)), root, [2022])
    assert read(spark, root, [2020, 2022, 2024]) == [(2020, 1), (2022, 3), (2022, 4)]
    assert read(spark, root, [2022], versions.version(spark, root, 1)) == [(2022, 2)]
    assert sorted(r["v"] for r in open_reader.collect()) == [1, 2]
    versions.replace_years(rows(spark), root, [2020])
    assert read(spark, root, [2020, 2022]) == [(2022, 3), (2022, 4)]
    assert versions.unused_runs(spark, root, 1) == [first.runs[2020]]
    assert second.runs[2022] not in versions.unused_runs(spark, root, 3)


def test_a_killed_commit_is_never_seen(spark, tmp_path):
    root = str(tmp_path / "t")
    versions.replace_years(rows(spark, (1, 2020)), root, [2020])
    run, _ = versions.stage(rows(spark, (9, 2020)), root)
    assert read(spark, root, [2020]) == [(2020, 1)]
    assert versions.unused_runs(spark, root, 1) == [run]


def test_two_writers_of_one_year(spark, tmp_path):
    root = str(tmp_path / "t")
    base, _ = versions.replace_years(rows(spark, (1, 2020), (1, 2022)), root, [2020, 2022])
    mine, _ = versions.stage(rows(spark, (2, 2020)), root)
    theirs, _ = versions.stage(rows(spark, (3, 2020)), root)
    other, _ = versions.stage(rows(spark, (4, 2022)), root)
    versions.commit(spark, root, theirs, [2020], base)
    with pytest.raises(versions.ConcurrentChange, match="2020"):
        versions.commit(spark, root, mine, [2020], base)
    assert versions.commit(spark, root, other, [2022], base).number == 3
    assert read(spark, root, [2020, 2022]) == [(2020, 3), (2022, 4)]


def test_writers_of_different_years_all_succeed(spark, tmp_path):
    root = str(tmp_path / "t")
    years = list(range(2000, 2008))
    with ThreadPoolExecutor(len(years)) as pool:
        numbers = list(pool.map(lambda y: versions.replace_years(rows(spark, (y, y)), root, [y])[0].number, years))
    assert sorted(numbers) == list(range(1, 9))
    assert read(spark, root, years) == [(y, y) for y in years]


def test_rows_of_other_years_change_nothing(spark, tmp_path):
    root = str(tmp_path / "t")
    for wrong in ((1, 2021), (1, None)):
        with pytest.raises(ValueError, match="other years"):
            versions.replace_years(rows(spark, (1, 2020), wrong), root, [2020])
    assert versions.versions_in(spark, root) == []


def test_two_creators_of_one_file(spark, tmp_path):
    path = str(tmp_path / "v" / "1.json")
    assert versions._create(spark, path, "a") and not versions._create(spark, path, "b")
    assert (tmp_path / "v" / "1.json").read_text() == "a"
    assert [p.name for p in (tmp_path / "v").iterdir() if not p.name.startswith(".")] == ["1.json"]
