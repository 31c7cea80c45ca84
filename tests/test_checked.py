import pytest
from helpers import bronze_rows, cell

from urnalake import schema as S
from urnalake.operators import audit
from urnalake.operators.silver import to_silver
from urnalake.plans import checked
from urnalake.plans.lake import Lake
from urnalake.sources import audit_log, tables


def layers(spark, root, year):
    found = {}
    for name in (checked.TABLE, checked.QUARANTINE):
        there = year in tables.years_in(spark, checked.layer(root, name))
        found[name] = tables.read_year(spark, checked.layer(root, name), year).collect() if there else None
    return found


def test_rows_are_in_one_layer_with_their_reasons(spark, tmp_path):
    rows = [cell(), cell(), cell(uf="SPX", name=" "), cell(electorate=0, turnout=0, absent=0), cell(electorate=10, turnout=20, absent=-1)]
    silver = to_silver(bronze_rows(spark, rows))
    assert checked.write_checked_year(silver, str(tmp_path), 2022, S.silver_rules()) == (2, 3)
    found = layers(spark, str(tmp_path), 2022)
    assert [r[checked.REASONS] for r in found["table"]] == [None, None]
    assert sorted(r[checked.REASONS] for r in found["quarantine"]) == [
        ["NM_MUNICIPIO:not_empty", "SG_UF:length"],
        ["QT_ABSTENCAO:minimum", "TAXA_COMPARECIMENTO_PCT:maximum", "TAXA_ABSTENCAO_PCT:minimum"],
        ["TAXA_COMPARECIMENTO_PCT:maximum", "TAXA_ABSTENCAO_PCT:maximum"],
    ]
    assert silver.columns + [checked.REASONS] == [c for c in tables.read_year(spark, checked.layer(str(tmp_path), "table"), 2022).columns]


def test_a_year_is_replaced_in_both_layers(spark, tmp_path):
    root = str(tmp_path)
    good, bad = to_silver(bronze_rows(spark, [cell()])), to_silver(bronze_rows(spark, [cell(city=0)]))
    checked.write_checked_year(bad, root, 2020, S.silver_rules())
    checked.write_checked_year(good.unionByName(bad), root, 2022, S.silver_rules())
    assert checked.write_checked_year(good, root, 2022, S.silver_rules()) == (1, 0)
    assert layers(spark, root, 2022)["quarantine"] is None
    assert checked.write_checked_year(bad, root, 2022, S.silver_rules()) == (0, 1)
    assert layers(spark, root, 2022)["table"] is None
    assert len(layers(spark, root, 2020)["quarantine"]) == 1
    assert checked.write_checked_year(good.limit(0), root, 2022, S.silver_rules()) == (0, 0)
    assert layers(spark, root, 2022) == {"table": None, "quarantine": None}


def test_nulls_break_no_rule_and_no_rules_reject_nothing(spark, tmp_path):
    rows = bronze_rows(spark, [cell(uf=None, name=None), cell(city=0)])
    assert checked.write_checked_year(rows, str(tmp_path / "a"), 2022, S.bronze_rules()) == (1, 1)
    assert checked.write_checked_year(rows, str(tmp_path / "b"), 2022, []) == (2, 0)


def test_plan_and_its_audit_row(spark, tmp_path):
    lake = Lake(str(tmp_path))
    tables.write_year(to_silver(bronze_rows(spark, [cell(), cell(city=0), cell()])), lake.silver, 2022)
    checked.check_silver(spark, lake, [2020, 2022])
    log = audit.latest(audit_log.read_log(spark, lake.silver_log, S.SILVER_AUDIT_SCHEMA)).collect()
    assert [(r["ano"], r["linhas_antes"], r["linhas_depois"], r["status"]) for r in log] == [(2022, 3, 2, S.STATUS_OK)]
    with pytest.raises(Exception):  # noqa: B017
        checked.check_silver_year(spark, lake, 2024)
    failed = audit_log.read_log(spark, lake.silver_log, S.SILVER_AUDIT_SCHEMA).where("ano = 2024").first()
    assert failed["status"] == S.STATUS_FAILED
