"""Thresholds, weights and the fixed lookup values of the pipeline."""

from __future__ import annotations

from dataclasses import dataclass, replace

# ---------------------------------------------------------------------------
# These must equal the source pipeline's values for equal
# results, so they are stated here plainly, in their natural order.
# ---------------------------------------------------------------------------
LOCATION_COUNTRY = {
    "Mumbai": "India",
    "Delhi": "India",
    "London": "UK",
    "New York": "USA",
    "Toronto": "Canada",
}
UNKNOWN = "Unknown"
COUNTRY_REGION = {
    "India": "Asia",
    "UK": "Europe",
    "USA": "Americas",
    "Canada": "Americas",
}
OTHER_REGION = "Other"
CHURN_BY_STATUS = {"Closed": "Churned", "Dormant": "High"}
CHURN_DEFAULT = "Low"
RISK_LABELS = ("Low", "Medium", "High")
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class RiskConfig:
    """All tunables of the flags and scores.

    Fixed values: the defaults of the first eleven fields are the source
    pipeline's thresholds and weights, stated plainly and in its order.
    """

    high_amount: float = 50000.0
    rapid_window_s: int = 300
    rapid_limit: int = 3
    # high amount, geo mismatch, rapid transactions
    fraud_weights: tuple[float, float, float] = (0.4, 0.3, 0.3)
    fraud_low: float = 0.3
    fraud_medium: float = 0.6
    # score, loans, defaults
    credit_weights: tuple[float, float, float] = (0.6, 0.2, 0.2)
    loans_cap: float = 10.0
    max_credit_score: float = 900.0
    credit_low: float = 0.3
    credit_medium: float = 0.6
    # Time bucket of the skew-safe rolling window; None = automatic
    # (max(4 x window, 3600) s).  Must be >= rapid_window_s.
    rapid_bucket_s: int | None = None
    # True: window partitioned by (account, time bucket) -- a hot account
    # spreads over many tasks, at the price of a second shuffle of the
    # transactions for the account join.  False: window partitioned by
    # account, whose partitioning the account join reuses (one shuffle),
    # but one account is one task.
    skew_safe_window: bool = True
    # Parity switch: rows with NULL time (or NULL account) count each other
    # like the source pipeline does; default gives them a NULL count.
    null_peers: bool = False


SOURCE = RiskConfig()
# The driver's test data never trips the source thresholds (amounts stay
# below 600, at most 3 events per 300 s), so the fixture queries use these.
FIXTURE = replace(SOURCE, high_amount=100.0, rapid_window_s=21600)

# Fixed instants of the two change batches in the fixtures.
AS_OF_1 = "2024-01-01 00:00:00"
AS_OF_2 = "2024-02-01 00:00:00"
AS_OF_3 = "2024-03-01 00:00:00"
