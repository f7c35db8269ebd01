"""Rule parameters for screening, scoring, cleaning and history.

Everything the operators treat as a business rule lives here as a frozen
dataclass, so a caller can change a threshold without touching operator code.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# These must equal the pipeline being re-implemented for its
# results to agree.  Stated plainly, in natural order, in one place.
#
#   velocity: HIGH   when txn_count > 20 or txn_total_amt > 1,000,000
#             MEDIUM when txn_count > 10 or txn_total_amt >   500,000
#             LOW    otherwise (strict ">" comparisons)
#   risk score weights: velocity HIGH +3, velocity MEDIUM +2,
#                       document EXPIRED +3, document PENDING +2,
#                       dormant Y +2, PEP Y +3  (range 0..11)
#   risk level: score >= 6 HIGH, score >= 3 MEDIUM, else LOW
#   dormancy: days_since_activity > 365
#   transaction status counted by velocity: "SUCCESS"
#   cross-border marker: "Y"
#   SSN mask prefix "***-**-" + last four characters (positions 8..11)
#   e-mail mask: first character + "***@" + domain
#   date of birth generalised to its first four characters (the year)
#   SCD2 open end: 9999-12-31 00:00:00
#   SCD2 tracked attributes: customer_segment, country, phone
#   customer 360 alerts: dormancy = dormant Y and document EXPIRED;
#                        high risk = PEP Y and cross_border_count > 0 and aml_flag
# ---------------------------------------------------------------------------

OPEN_END = "9999-12-31 00:00:00"
SSN_MASK_PREFIX = "***-**-"
EMAIL_MASK_INFIX = "***@"
SUCCESS_STATUS = "SUCCESS"
YES = "Y"


@dataclass(frozen=True)
class VelocityRules:
    high_count: int = 20
    high_amount: float = 1_000_000.0
    medium_count: int = 10
    medium_amount: float = 500_000.0
    status: str = SUCCESS_STATUS
    cross_border_value: str = YES


@dataclass(frozen=True)
class RiskWeights:
    velocity: tuple[tuple[str, int], ...] = (("HIGH", 3), ("MEDIUM", 2))
    doc_status: tuple[tuple[str, int], ...] = (("EXPIRED", 3), ("PENDING", 2))
    dormant: int = 2
    pep: int = 3
    high_level: int = 6
    medium_level: int = 3


@dataclass(frozen=True)
class AlertRules:
    dormant_value: str = YES
    expired_status: str = "EXPIRED"
    pep_value: str = YES


@dataclass(frozen=True)
class DedupKeys:
    """Natural key and recency order per silver table.

    Order entries are ``(column, ascending)``; every list ends in a unique
    column so the winner of a tie is deterministic.
    """

    keys: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "customer_onboarding": ("customer_id",),
        "transaction_feed": ("transaction_id",),
        "kyc_documents": ("customer_id",),
        "watchlist_sanctions": ("watchlist_id",),
        "account_activity": ("account_id",),
    })


@dataclass(frozen=True)
class Scd2Spec:
    keys: tuple[str, ...] = ("customer_id",)
    tracked: tuple[str, ...] = ("customer_segment", "country", "phone")


@dataclass(frozen=True)
class RiskConfig:
    velocity: VelocityRules = VelocityRules()
    weights: RiskWeights = RiskWeights()
    alerts: AlertRules = AlertRules()
    scd2: Scd2Spec = Scd2Spec()
    # derive the dormant flag from the days since the last activity instead of
    # taking the one that the source states
    derive_dormancy: bool = False
    dormancy_days: int = 365
