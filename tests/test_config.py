"""Every rule reads its cut from RiskConfig; the opt-in options change only what they name."""

import tempfile
from pathlib import Path

from micro import micro_df

from txrisk.config import RiskConfig
from txrisk.plans.riskrun import RiskRun
from txrisk.sources.ingest import read_transactions


def _by_id(df):
    return {r["CustomerID"]: r for r in df.collect()}


def test_sigma_multiplier(spark):
    thr = {r["TransactionSign"]: r["threshold_single_transaction"]
           for r in RiskRun(micro_df(spark), RiskConfig(sigma_multiplier=3)).thresholds.where("CustomerID = 13").collect()}
    assert thr["Credit"] == 80.0  # mean 20 + 3 * sigma 20
    alerts = _by_id(RiskRun(micro_df(spark), RiskConfig(sigma_multiplier=3)).alerts)
    assert alerts[13]["num_unusual_transactions"] == 0  # 60 no longer reaches the threshold


def test_min_group_size_silences_tiny_groups(spark):
    alerts = _by_id(RiskRun(micro_df(spark), RiskConfig(min_group_size=2)).alerts)
    assert alerts[6]["num_unusual_transactions"] == 0  # one-row group
    assert alerts[7]["num_unusual_transactions"] == 0
    assert alerts[1]["num_unusual_transactions"] == 500  # constant amounts, 500 rows: still all alert


def test_high_risk_country_is_configurable(spark):
    cfg = RiskConfig(high_risk_country="DK", high_risk_countries=("DK",))
    wide = _by_id(RiskRun(micro_df(spark), cfg).wide)
    assert wide[4]["ctry_HRC_Trnsactions_Ratio"] == 1.0  # all of customer 4 is DK
    rating = _by_id(RiskRun(micro_df(spark), cfg).rating)
    assert rating[4]["HRCFlag"] == 3


def test_normalize_strings_option(spark):
    d = Path(tempfile.mkdtemp(prefix="txrisk-norm-"))
    (d / "a.txt").write_text("1; credit ;100; fi\n2;DEBIT;5;se\n")
    plain, bad = read_transactions(spark, str(d))
    assert plain.count() == 0
    # compared as written, neither sign is one that the rules know: it would count on no side
    assert [r["load_status"] for r in bad.collect()] == ["unknown sign"] * 2
    norm, _ = read_transactions(spark, str(d), cfg=RiskConfig(normalize_strings=True))
    assert {(r["TransactionSign"], r["TransactionCountry"]) for r in norm.collect()} == {("Credit", "FI"), ("Debit", "SE")}
