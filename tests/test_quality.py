import pytest
from helpers import BRONZE_DDL, bronze_rows, cell, write_text
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urnalake import schema as S
from urnalake.functions import does_not_conform
from urnalake.operators import quality
from urnalake.operators.silver import to_silver
from urnalake.sources import landed_csv, manifest


def test_type_conformance_counts_unreadable_values(spark):
    ddl = ", ".join(f"{c} string" for c in [*S.REQUIRED_FIELDS, "NR_TURNO"])
    rows = [
        ("2022", "1", "A", "SP", "foo", "80", "20", "300"),
        ("x", "1", None, "SP", "bar", "80", None, "1"),
    ]
    report = {r["field"]: r for r in quality.type_conformance(spark.createDataFrame(rows, ddl)).collect()}
    assert len(report) == len(S.BRONZE_SCHEMA)
    assert report["QT_APTOS"]["bad_values"] == 2
    assert report["ANO_ELEICAO"]["bad_values"] == 1
    assert report["NR_TURNO"]["bad_values"] == 1
    assert report["QT_ABSTENCAO"]["bad_values"] == 0
    assert not report["NM_UF"]["present"] and not report["NM_UF"]["required"]


def test_contract_break_names_the_missing_field(spark, tmp_path):
    header = "ANO_ELEICAO;CD_MUNICIPIO;NM_MUNICIPIO;SG_UF;QT_APTOS;QT_COMPARECIMENTO;QT_ABSTENCOES;CD_TIPO_ELEICAO"
    path = write_text(tmp_path / "a.csv", header, "2024;1;A;SP;10;8;2;0", "2024;2;B;RJ;10;8;2;0")
    landed = landed_csv.read_landed(spark, path)
    violations = quality.contract_violations(quality.type_conformance(landed)).collect()
    assert [r["field"] for r in violations] == ["QT_ABSTENCAO"]
    with pytest.raises(quality.ContractError, match="QT_ABSTENCAO$"):
        quality.require_contract(landed)


def test_silver_contract(spark):
    silver = to_silver(bronze_rows(spark, [cell(), cell()]))
    report = quality.schema_contract(silver).collect()
    assert [r["field"] for r in report] == S.SILVER_SCHEMA.names
    assert all(r["type_ok"] and r["nulls"] == 0 for r in report)
    quality.require_schema(silver)
    broken = silver.drop(S.REGION).withColumn(S.RATE_TURNOUT, silver["NM_MUNICIPIO"])
    wrong = [(r["field"], r["actual_type"]) for r in quality.schema_contract(broken).where("NOT type_ok").collect()]
    assert wrong == [(S.RATE_TURNOUT, "string"), (S.REGION, None)]
    with pytest.raises(quality.ContractError, match=f"{S.RATE_TURNOUT}, {S.REGION}"):
        quality.require_schema(broken)


def test_contract_counts_nulls(spark):
    df = bronze_rows(spark, [cell(), cell(uf=None), cell(name=None), cell(uf=None)])
    nulls = {r["field"]: r["nulls"] for r in quality.schema_contract(df).collect()}
    assert (nulls["SG_UF"], nulls["NM_MUNICIPIO"], nulls["QT_APTOS"], nulls[S.REGION]) == (2, 1, 0, None)


def test_a_narrower_integer_is_still_an_integer(spark):
    silver = to_silver(bronze_rows(spark, [cell()]))
    quality.require_schema(silver.withColumn("QT_APTOS", silver["QT_APTOS"].cast("smallint")))


def test_rules_count_and_keep_rows(spark):
    rows = [
        cell(year=1999), cell(year=2031), cell(city=0), cell(name="  "), cell(uf="SPX"),
        cell(electorate=-1), cell(turnout=-1), cell(absent=-1), cell(uf=None, name=None), cell(),
    ]
    report = quality.rule_violations(bronze_rows(spark, rows), S.bronze_rules()).collect()
    assert [(r["field"], r["rule"], r["violations"]) for r in report] == [
        ("ANO_ELEICAO", "minimum", 1), ("ANO_ELEICAO", "maximum", 1), ("CD_MUNICIPIO", "minimum", 1),
        ("NM_MUNICIPIO", "not_empty", 1), ("SG_UF", "length", 1), ("QT_APTOS", "minimum", 1),
        ("QT_COMPARECIMENTO", "minimum", 1), ("QT_ABSTENCAO", "minimum", 1),
    ]


def test_consistency(spark):
    rows = [cell()] * 99 + [cell(absent=21)]
    df = bronze_rows(spark, rows)
    assert quality.consistency_gate(df).first() == (100, 99, 0.99, True)
    assert quality.consistency_gate(df, minimum=0.995).first()["passes"] is False
    assert quality.consistency_by_state(df).first() == (2022, "SP", 100, 99, 0.99)


def test_real_data_gates(spark):
    df = bronze_rows(spark, [cell("SP", 100, 80, 20), cell("RJ", 0, 0, 0)])
    assert quality.minimum_quantities(df).first() == (0, 0, 0)
    assert [r[0] for r in quality.years_present(df).collect()] == [2022]


def test_malformed_lines_are_counted(spark, tmp_path):
    path = write_text(tmp_path / "a.csv", "A;B;C", "1;2;3", "1;2", "1;2;3;4")
    lines = landed_csv.read_landed(spark, path, keep_malformed=True)
    assert quality.malformed_rows(lines, landed_csv.CORRUPT).first() == (3, 3, 2)


@pytest.mark.parametrize(
    ("dataset", "year", "origin", "valid"),
    [
        (S.BRONZE_DATASET, 2022, "https://example.com/dataset.zip", True),
        (S.BRONZE_DATASET, 2000, "http://example.com/a", True),
        (S.SILVER_DATASET, 2030, "/data/bronze/x.parquet", True),
        (S.BRONZE_DATASET, 2022, "C:\\data\\x.csv", True),
        (S.BRONZE_DATASET, 1999, "https://example.com/a", False),
        (S.BRONZE_DATASET, 2031, "https://example.com/a", False),
        (S.BRONZE_DATASET, 2022, "ftp://example.com/a", False),
        (S.BRONZE_DATASET, 2022, "", False),
        (S.BRONZE_DATASET, 2022, None, False),
        ("", 2022, "https://example.com/a", False),
        ("outro", 2022, "https://example.com/a", False),
        (S.BRONZE_DATASET, None, "https://example.com/a", False),
    ],
)
def test_manifest_rules(spark, dataset, year, origin, valid):
    rows = spark.createDataFrame([(dataset, year, origin)], "dataset string, ano int, origin string")
    assert manifest.with_validity(rows).first()["is_valid"] is valid


def test_published_years(spark):
    years = [r["ano"] for r in manifest.published_years(spark).collect()]
    assert years == [2024, 2022, 2020, 2018, 2016, 2014]
    row = manifest.manifest_of(manifest.published_years(spark)).first()
    assert row["origin"].endswith(f"_{row['ano']}.zip")
    assert row["dataset_id"] == f"{S.BRONZE_DATASET}:{row['ano']}"
    assert BRONZE_DDL.startswith("ANO_ELEICAO int")


ODD_TEXTS = [
    "", " ", "+", "-", "1", "+1", "-1", " 12 ", "\t7\n", "1 2", "12.0", "12.", ".5", "1e2", "0x1", "1L", "١", "--1",
    "127", "128", "-128", "-129", "32767", "32768", "2147483647", "2147483648", "-2147483648", "-2147483649",
    "9223372036854775807", "9223372036854775808", "-9223372036854775808", "-9223372036854775809",
    "000000000000000000000000005", "99999999999999999999999", "foo", "5\u00a0", "5\x00", "NaN", "true",
]


@pytest.mark.parametrize("data_type", [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.DoubleType()])
def test_conformance_agrees_with_the_cast(spark, data_type):
    df = spark.createDataFrame([(x,) for x in [*ODD_TEXTS, None]], "x string")
    differing = df.where(
        does_not_conform("x", data_type) != (F.col("x").isNotNull() & F.col("x").try_cast(data_type).isNull())
    )
    assert differing.collect() == []
