"""One rating run over a raw transaction table.

Physical shape (at any scale):

1. ``profile`` = raw rows grouped by (customer, sign): partial aggregation, then one
   shuffle of partial rows. It holds the raw row counts, the clean measures and each group's
   largest amount. It can also be given (a roll-up of a cube, or the merge of stored months).
2. ``alert_rows`` = positive rows joined once to the bounds of the groups whose largest amount
   reaches its bound: the only join of fact rows, by one exchange at most. Rows of hot groups
   meet their bounds where they are scanned.
3. ``rating`` = profile rolled up by customer LEFT JOIN alert rows counted by customer.

Tables with several consumers are written to the shared folder and read back: lineage is cut
there, so a lost executor costs a re-read, and a consumer reads only its columns. They lie in
the run's own folder, which ``close()`` (or leaving a ``with`` block) removes. Bounds and ratings
grow with the customer count, so nothing is broadcast on a guess: Spark broadcasts a side where
its known size allows, and AQE splits skewed ones.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.config import DEFAULT, RiskConfig
from txrisk.operators import features as feat
from txrisk.operators import rating as rat
from txrisk.operators import rules
from txrisk.session import Workspace
from txrisk.sources.ingest import clean
from txrisk.sources.schema import COLUMNS, ID, SIGN


class RiskRun:
    """The rating of one raw transaction table, with everything built on it.

    Constructing it runs one job: the customer profile is aggregated and kept (skip with
    ``checkpoint=False`` for tiny inputs such as one customer), unless ``profile`` is given. The
    alert rows are kept when they are first asked for. Every attribute is a DataFrame:
    ``thresholds``, ``features``, ``alert_rows``, ``alerts``, ``wide``, ``points``, ``rating``,
    ``segment_summary``, ``outliers()``, ``top_outliers()``, ``incoming``,
    ``segment_thresholds``, ``segment_limits``, ``rule_hits``, ``segment_outliers()`` and the
    per-row ``transaction_alerts``.
    """

    def __init__(self, raw: DataFrame, cfg: RiskConfig = DEFAULT, checkpoint: bool = True, profile: DataFrame | None = None):
        self.cfg = cfg
        self.raw = raw.select(*COLUMNS)
        self.clean = clean(self.raw)
        self._folder: Workspace | None = Workspace(raw.sparkSession, "run") if checkpoint else None
        self.profile = profile if profile is not None else self._keep(feat.customer_profile(self.raw, cfg))

    def _keep(self, df: DataFrame) -> DataFrame:
        return self._folder.keep(df) if self._folder else df

    def close(self) -> None:
        """Remove the run's kept tables; results not written by then cannot be read any more."""
        if self._folder:
            self._folder.drop()

    def __enter__(self) -> RiskRun:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    @cached_property
    def hot(self) -> DataFrame | None:
        """The groups that would overfill a shuffle partition (None without kept tables)."""
        return feat.hot_groups(self.profile) if self._folder else None

    @cached_property
    def _alert_rows(self) -> DataFrame:
        return feat.alert_rows(self.raw, feat.reached_bounds(self.profile, self.cfg), self.hot)

    @cached_property
    def thresholds(self) -> DataFrame:
        return feat.sign_thresholds(self.profile, self.cfg)

    @cached_property
    def features(self) -> DataFrame:
        return feat.customer_features(self.profile, self.cfg)

    @cached_property
    def alert_rows(self) -> DataFrame:
        return self._keep(self._alert_rows)

    @cached_property
    def alerts(self) -> DataFrame:
        """Alert counts; from the kept alert rows where another result has asked for those."""
        rows = self.__dict__.get("alert_rows", self._alert_rows)
        return feat.unusual_alerts(self.profile, rows)

    @cached_property
    def transaction_alerts(self) -> DataFrame:
        return feat.transaction_alerts(self.raw, self.profile, self.cfg, self.hot)

    @cached_property
    def wide(self) -> DataFrame:
        return rat.risk_features_wide(self.features, self.alerts)

    @cached_property
    def points(self) -> DataFrame:
        return rat.risk_points(self.wide, self.cfg)

    @cached_property
    def rating(self) -> DataFrame:
        return rat.risk_rating(self.points, self.cfg)

    @cached_property
    def segment_summary(self) -> DataFrame:
        return rat.segment_summary(self.rating)

    def outliers(self, order: bool = True) -> DataFrame:
        """Rows above their customer's threshold, with its rating."""
        return rules.outlier_transactions(self.alert_rows, self.rating, order=order)

    def top_outliers(self, k: int | None = None) -> DataFrame:
        """The k heaviest deviations with their customers' ratings.

        Read from the kept alert rows, without another pass over the facts. Only k customers
        need a rating: the kept k rows give a key list of at most k for the semi joins.
        """
        k = self.cfg.top_k if k is None else k
        top = self._keep(rules.top_outliers(rules.threshold_breaches(self.alert_rows), k))
        keys = F.broadcast(top.select(ID).distinct())
        profile = self.profile.join(keys, ID, "left_semi")
        alerts = feat.unusual_alerts(profile, self.alert_rows.join(keys, ID, "left_semi"))
        wide = rat.risk_features_wide(feat.customer_features(profile, self.cfg), alerts)
        rated = rules.with_rating(top, rat.risk_rating(rat.risk_points(wide, self.cfg), self.cfg))
        return rated.orderBy(*rules.OUTLIER_ORDER)  # at most k rows

    @cached_property
    def incoming(self) -> DataFrame:
        return rules.country_incoming(self.profile, self.rating, self.cfg)

    @cached_property
    def _kept_incoming(self) -> DataFrame:
        """One row a customer, kept: order statistics read their input several times."""
        return self._keep(self.incoming)

    def register_views(self, prefix: str = "") -> list[str]:
        """Temporary views of the transactions, the clean view and every result, for
        ``spark.sql``; returns their names."""
        views = {
            "transactions": self.raw,
            "clean_transactions": self.clean,
            "sign_thresholds": self.thresholds,
            "transaction_alerts": self.transaction_alerts,
            "unusual_alerts": self.alerts,
            "risk_features_wide": self.wide,
            "risk_points": self.points,
            "risk_rating": self.rating,
            "outlier_transactions": self.outliers(order=False),
            "romania_incoming": self.incoming,
            "segment_thresholds": self.segment_thresholds,
            "segment_limits": self.segment_limits,
            "segment_outliers": self.segment_outliers(order=False),
            "romania_rule_hits": self.rule_hits,
        }
        for name, df in views.items():
            df.createOrReplaceTempView(prefix + name)
        return [prefix + name for name in views]

    @cached_property
    def segment_thresholds(self) -> DataFrame:
        return rules.segment_thresholds(self._kept_incoming, self.cfg)

    @cached_property
    def segment_limits(self) -> DataFrame:
        return rules.segment_limits(self._kept_incoming, self.cfg)

    def segment_outliers(self, order: bool = True) -> DataFrame:
        """Rows above mean + 2 sigma of their customer's segment."""
        rating = self._keep(self.rating.select(ID, "Risk_Segment", "TOTAL_Score"))  # read for bounds and rows
        return rules.segment_outliers(self.raw, self.profile, rating, self.cfg, self.hot, order)

    @cached_property
    def rule_hits(self) -> DataFrame:
        return rules.rule_hits(self.incoming, self.cfg)


def country_rule_run(raw: DataFrame, cfg: RiskConfig = DEFAULT) -> RiskRun:
    """A run for Parts III and IV alone (``incoming``, ``segment_thresholds``, ``rule_hits``).

    The profile of all customers tells who has a credit from the high-risk list; a rating
    depends on the customer's own rows only, so just their groups go on to bounds and alerts.
    """
    run = RiskRun(raw, cfg)
    whole = run.profile
    concerned = whole.where((F.col(SIGN) == cfg.credit) & (F.col("n_hrc") > 0)).select(ID).distinct()
    run.profile = run._keep(whole.join(concerned, ID, "left_semi"))
    run.hot = feat.hot_groups(whole)
    run.incoming = rules.country_incoming(whole, run.rating, cfg)  # the NULL customer, which no join finds, is listed too
    return run


def rate_customers(raw: DataFrame, cfg: RiskConfig = DEFAULT, checkpoint: bool = True) -> DataFrame:
    """Risk rating of every customer of ``raw``."""
    return RiskRun(raw, cfg, checkpoint).rating


def rate_customer(raw: DataFrame, customer_id: int, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Rating of one customer. A customer's rating depends on its own rows only, so the
    filter is applied to the input and reaches the parquet scan."""
    return RiskRun(raw.where(F.col(ID) == customer_id), cfg, checkpoint=False).rating
