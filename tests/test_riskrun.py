"""Merged periods and SQL views of a run."""

from micro import micro_df
from pyspark.sql import functions as F

from txrisk.operators import features as feat
from txrisk.plans.riskrun import RiskRun


def test_month_two_added_to_month_one_equals_the_joint_run(spark):
    tx = micro_df(spark).withColumn("month", F.col("TransactionAmount") % 2).cache()
    months = [feat.customer_profile(tx.where(F.col("month") == m)) for m in (0, 1)] + [
        feat.customer_profile(tx.where("month not in (0, 1)"))
    ]
    joint = feat.customer_profile(tx)
    merged = feat.merge_profiles(*months)
    assert merged.schema.simpleString() == joint.schema.simpleString()
    assert sorted(map(repr, merged.collect())) == sorted(map(repr, joint.collect()))
    for fn in (feat.sign_bounds, feat.customer_features):
        assert sorted(map(repr, fn(merged).collect())) == sorted(map(repr, fn(joint).collect()))


def test_views_answer_sql(spark):
    run = RiskRun(micro_df(spark))
    names = run.register_views("m_")
    assert {"m_clean_transactions", "m_risk_rating"} <= set(names)
    high = {r[0] for r in spark.sql("SELECT CustomerID FROM m_risk_rating WHERE Risk_Segment = 'High'").collect()}
    assert high == {2, 3}
    assert spark.sql("SELECT min(TransactionAmount) FROM m_clean_transactions").first()[0] > 0
    for name in names:
        spark.catalog.dropTempView(name)
