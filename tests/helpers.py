"""Small inputs shared by the tests."""

from __future__ import annotations

from urnalake import schema as S

HEADER = ";".join(S.REQUIRED_FIELDS)
BRONZE_DDL = (
    "ANO_ELEICAO int, CD_MUNICIPIO int, NM_MUNICIPIO string, SG_UF string,"
    " QT_APTOS long, QT_COMPARECIMENTO long, QT_ABSTENCAO long"
)


def bronze_rows(spark, rows, ddl=BRONZE_DDL):
    return spark.createDataFrame(rows, ddl)


def cell(uf="SP", electorate=100, turnout=80, absent=20, year=2022, city=1, name="A"):
    return (year, city, name, uf, electorate, turnout, absent)


def write_text(path, *lines, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(("\n".join(lines) + "\n").encode(encoding))
    return str(path)
