"""Seeded random tables with every kind of dirt, every query against its oracle."""

import random

import duckdb
import pytest
from micro import values_sql
from oracle_check import compare_frames

from txrisk.plans.oracle import oracle_on
from txrisk.plans.registry import BUILDERS, run_on
from txrisk.sources.schema import TRANSACTION_SCHEMA

SIGNS = ["Credit"] * 6 + ["Debit"] * 5 + ["credit", "X", None]
COUNTRIES = ["FI", "DK", "SE"] * 4 + ["RO"] * 3 + ["RU", "PL", "CY", "NO", "ro", None]


def random_rows(seed: int, customers: int = 30, rows: int = 400):
    rng = random.Random(seed)
    ids = [None, 0] + list(range(1, customers))
    out = []
    for _ in range(rows):
        cid = rng.choice(ids)
        r = rng.random()
        if r < 0.05:
            amt = None
        elif r < 0.12:
            amt = rng.choice([0, -rng.randint(1, 500)])
        elif r < 0.25:
            amt = rng.choice([100, 500, 5000, 5100])  # round amounts and repeats
        else:
            amt = rng.randint(1, 12000)
        out.append((cid, rng.choice(SIGNS), amt, rng.choice(COUNTRIES)))
    out += out[:25]  # exact copies
    out += [(customers + 1, "Credit", 7000, "FI")]  # one-row customer
    out += [(customers + 2, "Debit", 300, "SE")] * 4  # constant group
    out += [(customers + 3, "Debit", -5, "FI")]  # no clean row at all
    return out


KEYS = sorted(k for k, (fx, _) in BUILDERS.items() if fx == "tx_lines")


@pytest.fixture(scope="module", params=[11, 23, 37])
def table(request, spark):
    rows = random_rows(request.param)
    return spark.createDataFrame(rows, TRANSACTION_SCHEMA).cache(), values_sql(rows)


@pytest.mark.parametrize("name", KEYS)
def test_random_table_matches_oracle(table, name):
    df, sql = table
    res = compare_frames(run_on(name, df), duckdb.connect().sql(oracle_on(name, sql)))
    assert res["ok"], res
