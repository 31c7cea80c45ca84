"""Value rules, consistency and gates."""

from __future__ import annotations

from urnalake import schema as S
from urnalake.checks import inputs as I
from urnalake.checks.registry import check
from urnalake.operators import quality

_BRONZE_RULES = (
    ("ANO_ELEICAO", "minimum", "ANO_ELEICAO < 2000"),
    ("ANO_ELEICAO", "maximum", "ANO_ELEICAO > 2030"),
    ("CD_MUNICIPIO", "minimum", "CD_MUNICIPIO < 1"),
    ("NM_MUNICIPIO", "not_empty", "trim(NM_MUNICIPIO) = ''"),
    ("SG_UF", "length", "length(SG_UF) <> 2"),
    ("QT_APTOS", "minimum", "QT_APTOS < 0"),
    ("QT_COMPARECIMENTO", "minimum", "QT_COMPARECIMENTO < 0"),
    ("QT_ABSTENCAO", "minimum", "QT_ABSTENCAO < 0"),
)
_SILVER_RULES = _BRONZE_RULES + (
    ("TAXA_COMPARECIMENTO_PCT", "minimum", "TAXA_COMPARECIMENTO_PCT < 0"),
    ("TAXA_COMPARECIMENTO_PCT", "maximum", "TAXA_COMPARECIMENTO_PCT > 100"),
    ("TAXA_ABSTENCAO_PCT", "minimum", "TAXA_ABSTENCAO_PCT < 0"),
    ("TAXA_ABSTENCAO_PCT", "maximum", "TAXA_ABSTENCAO_PCT > 100"),
)


def _rules_sql(source: str, rules) -> str:
    return " UNION ALL ".join(
        f"SELECT '{f}' AS field, '{r}' AS rule, count(*) FILTER (WHERE {p}) AS violations FROM {source}"
        for f, r, p in rules
    )


@check(I.with_bronze(_rules_sql("bronze", _BRONZE_RULES)))
def rule_violations(spark, sf_dir):
    return quality.rule_violations(I.bronze(spark, sf_dir), S.bronze_rules())


@check(I.with_silver(_rules_sql("silver", _SILVER_RULES), empty_cells=True))
def silver_rule_violations(spark, sf_dir):
    """A NaN rate is above the maximum of 100."""
    return quality.rule_violations(I.silver(spark, sf_dir, empty_cells=True), S.silver_rules())


_CLASSES = {"int": "inteiro", "bigint": "inteiro", "string": "texto", "double": "decimal"}


@check(
    I.with_silver(
        " UNION ALL ".join(
            f"SELECT '{f.name}' AS field, '{_CLASSES[f.dataType.simpleString()]}' AS expected_class,"
            f" '{f.dataType.simpleString()}' AS actual_type, true AS type_ok,"
            f" count(*) FILTER (WHERE {f.name} IS NULL) AS nulls FROM silver"
            for f in S.SILVER_SCHEMA
        )
    )
)
def silver_contract(spark, sf_dir):
    """Every silver column is there, of the right class and without NULL."""
    return quality.schema_contract(I.silver(spark, sf_dir))


@check(
    I.with_bronze(
        " UNION ALL ".join(
            f"SELECT '{f.name}' AS field, '{_CLASSES[f.dataType.simpleString()]}' AS expected_class,"
            + (
                f" '{f.dataType.simpleString()}' AS actual_type, true AS type_ok,"
                f" count(*) FILTER (WHERE {f.name} IS NULL) AS nulls FROM bronze"
                if f.name in S.REQUIRED_FIELDS
                else " CAST(NULL AS VARCHAR) AS actual_type, false AS type_ok, CAST(NULL AS BIGINT) AS nulls"
            )
            for f in S.SILVER_SCHEMA
        )
    )
)
def silver_contract_of_bronze(spark, sf_dir):
    """Bronze rows fail the silver contract: three columns are missing, one has NULLs."""
    return quality.schema_contract(I.bronze(spark, sf_dir))


_CONSISTENT = "count(*) FILTER (WHERE QT_COMPARECIMENTO + QT_ABSTENCAO = QT_APTOS)"


@check(
    I.with_perturbed(
        f"""SELECT ANO_ELEICAO, SG_UF, count(*) AS n_rows, {_CONSISTENT} AS n_consistent,
  {_CONSISTENT} / count(*) AS consistent_ratio FROM perturbed GROUP BY ANO_ELEICAO, SG_UF"""
    )
)
def consistency(spark, sf_dir):
    return quality.consistency_by_state(I.perturbed(spark, sf_dir))


@check(
    I.with_perturbed(
        f"""SELECT count(*) AS n_rows, {_CONSISTENT} AS n_consistent,
  {_CONSISTENT} / count(*) AS consistent_ratio, {_CONSISTENT} / count(*) >= 0.99 AS passes FROM perturbed"""
    )
)
def consistency_gate(spark, sf_dir):
    return quality.consistency_gate(I.perturbed(spark, sf_dir))


@check(I.with_bronze("SELECT DISTINCT ANO_ELEICAO FROM bronze"))
def distinct_years(spark, sf_dir):
    return quality.years_present(I.bronze(spark, sf_dir))


@check(
    I.with_bronze(
        """SELECT min(QT_APTOS) AS min_aptos, min(QT_COMPARECIMENTO) AS min_comparecimento,
  min(QT_ABSTENCAO) AS min_abstencao FROM bronze""",
        empty_cells=True,
    )
)
def min_quantities(spark, sf_dir):
    return quality.minimum_quantities(I.bronze(spark, sf_dir, empty_cells=True))
