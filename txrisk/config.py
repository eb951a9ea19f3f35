"""Every literal of the rating, data-quality and exploration rules, in one place.

Operators take a ``RiskConfig`` and never hard-code a cut. ``DEFAULT`` holds the
values the rules were published with.
"""

from __future__ import annotations

from dataclasses import dataclass

# A band is (low, high, value): inclusive integer bounds, ``None`` for an open end.
# A value that falls in no band maps to NULL, exactly like a CASE without ELSE.
Band = tuple[int | None, int | None, object]


@dataclass(frozen=True)
class RiskConfig:
    # ---- Fixed values: these must stay equal to the published rules ----------------
    # Countries pivoted by the country features, in pivot order.
    countries: tuple[str, ...] = ("FI", "DK", "SE", "RO", "CY", "RU", "PL")
    # Nordic market, treated as one entity.
    nordics: tuple[str, ...] = ("FI", "DK", "SE")
    # High-risk country list (the one-row literal table) and the country its rules name.
    high_risk_countries: tuple[str, ...] = ("RO",)
    high_risk_country: str = "RO"
    # Sanctioned country scored on its own.
    sanctioned_country: str = "RU"
    # Countries explored as outliers.
    outlier_countries: tuple[str, ...] = ("PL", "CY", "RU")
    # Sign values: Credit is incoming, Debit is outgoing.
    credit: str = "Credit"
    debit: str = "Debit"

    # (a) frequency score: only customers whose clean amount sum is above the gate
    frequency_amount_gate: int = 10000
    # count of non-null countries -> cluster; exactly 500 matches no band (NULL)
    frequency_bands: tuple[Band, ...] = (
        (501, None, 6),
        (21, 499, 5),
        (20, 20, 4),
        (13, 19, 3),
        (4, 12, 2),
        (None, 3, 1),
    )
    # exploration histogram of the same counts, no amount gate
    histogram_bands: tuple[Band, ...] = (
        (21, None, 5),
        (20, 20, 4),
        (13, 19, 3),
        (4, 12, 2),
        (None, 3, 1),
    )
    # cluster -> points; NULL cluster scores 0
    frequency_points: tuple[tuple[int, int], ...] = ((1, 0), (2, 0), (3, 0), (4, 1), (5, 2), (6, 3))

    # (c) high-risk country share of transactions
    hrc_high_ratio: float = 0.3  # >= gives hrc_high_points
    hrc_high_points: int = 3
    hrc_low_ratio: float = 0.01  # > gives hrc_low_points
    hrc_low_points: int = 1
    russia_points: int = 3
    # (d) high outflows: credit/debit amount ratio <= this
    high_outflow_ratio: float = 0.3
    # (e) credit about equal to debit, inclusive range
    cd_ratio_low: float = 0.98
    cd_ratio_high: float = 1.02
    # (g) one-to-many / many-to-one count ratio <= this
    count_ratio_flag: float = 0.3
    # ratio value used when the divisor is 0 or missing
    ratio_sentinel: float = 10.0
    # (h) own-behaviour threshold = mean + sigma_multiplier * population stdev
    sigma_multiplier: int = 2
    # unusual-transaction count -> points; NULL stays NULL
    unusual_bands: tuple[Band, ...] = ((0, 0, 0), (1, 2, 1), (3, None, 3))

    # total score -> segment; NULL stays NULL
    segment_bands: tuple[Band, ...] = (
        (None, 0, "Low"),
        (1, 2, "Medium-Low"),
        (3, 5, "Medium-High"),
        (6, None, "High"),
    )
    # Part IV: monthly incoming amount from the high-risk country above which a rule hits.
    # "Low" is left out on purpose: a high-risk credit always scores at least 1 point.
    rule_thresholds: tuple[tuple[str, int], ...] = (
        ("High", 0),
        ("Medium-High", 19120),
        ("Medium-Low", 11646),
    )

    # data-quality and exploration parameters
    investigated_customer: int = 0
    lookup_amounts: tuple[int, ...] = (-338, -37)
    round_unit: int = 100
    round_over: int = 5000
    top_k: int = 5
    # ---- end of fixed values ------------------------------------------------------

    # Column-length limits of the declared schema, enforced at load.
    max_sign_length: int = 10
    max_country_length: int = 2
    # Percentiles reported per segment by the threshold recommendation.
    segment_percentiles: tuple[float, ...] = (0.5, 0.9, 0.95)
    # Limit proposed per segment: at most this share of its customers, or this many, may lie above.
    limit_share: float = 0.05
    limit_hits: int | None = None
    # Outliers of a segment: above its mean + this many population stdevs.
    segment_sigma: int = 2
    # Options that are off by default (the rules as published do not use them).
    min_group_size: int = 1  # groups smaller than this never alert
    normalize_strings: bool = False  # upper(trim()) country, initcap(trim()) sign at load


DEFAULT = RiskConfig()
