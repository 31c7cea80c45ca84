"""Silver and the rollups against plain Python over random rows."""

import math
import random
from collections import defaultdict

import pytest
from helpers import bronze_rows
from pyspark.sql import functions as F

from urnalake import schema as S
from urnalake.operators import rollups
from urnalake.operators.silver import to_silver


def _rate(part, whole):
    if whole:
        return part / whole * 100
    return math.nan if part == 0 else math.inf


def _rows(seed):
    rng = random.Random(seed)
    codes = [*S.REGION_BY_UF, "XX", "sp", "", None]
    rows = []
    for _ in range(3000):
        # One state holds a third of all rows.
        uf = "SP" if rng.random() < 1 / 3 else rng.choice(codes)
        whole = rng.choice([0, 0, 1, 7, 100, 12345]) if rng.random() < 0.02 else rng.randint(1, 5000)
        absent = rng.randint(0, max(whole, 1))
        row = [rng.choice([2018, 2020, 2022]), rng.randint(1, 99), "C", uf, whole, max(whole - absent, 0), absent]
        if rng.random() < 0.03:
            row[rng.randrange(7)] = None
        rows.append(tuple(row))
    return rows


def _expected(rows):
    groups = defaultdict(list)
    for year, _, _, uf, whole, turnout, absent in (r for r in rows if None not in r):
        cell = (turnout, absent, _rate(turnout, whole))
        region = S.REGION_BY_UF.get(uf, S.UNKNOWN_REGION)
        groups["national", year, None, None].append(cell)
        groups["regional", year, region, None].append(cell)
        if uf != S.OVERSEAS_UF:
            groups["state", year, None, uf].append(cell)
    return {
        key: (sum(c[0] for c in cells), sum(c[1] for c in cells), sum(c[2] for c in cells) / len(cells))
        for key, cells in groups.items()
    }


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rollups_equal_brute_force(spark, seed):
    rows = _rows(seed)
    expected = _expected(rows)
    silver = to_silver(bronze_rows(spark, rows).repartition(5)).withColumn("Ano", F.col("ANO_ELEICAO"))
    got = {
        (r["level"], r["Ano"], r[S.REGION], r["SG_UF"]): (
            r["comparecimento_total"], r["abstencao_total"], r["taxa_comparecimento"],
        )
        for r in rollups.rollups_fused(silver).collect()
    }
    assert got.keys() == expected.keys()
    for key, values in expected.items():
        assert got[key] == pytest.approx(values, nan_ok=True), key
