"""Column roles and thresholds that turn a wide customer table into features.

Operators never name a column themselves; they read it from a ``Roles`` value,
so a new table needs a new preset and no new code.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

# The labels, cut points, weights and limits that define the
# derived columns.
TENURE_BINS = (0, 6, 12, 24, 48, 72)
TENURE_LABELS = ("0-6m", "7-12m", "1-2a", "2-4a", "4-6a")
AMOUNT_LABELS = ("muito_baixo", "baixo", "medio", "alto")
IV_LABELS = ((0.02, "Irrelevante"), (0.1, "Fraco"), (0.3, "Médio"), (0.5, "Forte"))
IV_TOP_LABEL = "Muito Forte"
RISK_WEIGHTS = {
    "monthly_contract": 2.0,
    "short_tenure": 2.0,
    "fiber_no_security": 1.5,
    "low_engagement": 1.0,
    "paperless_billing": 0.5,
    "electronic_check": 1.0,
}
CHARGES_DIVERGENCE = 0.3
EARLY_CHURN_TENURE = 12
LOW_ENGAGEMENT_MAX = 2
HIGH_ENGAGEMENT_MIN = 5
RISK_SCORE_HIGH = 4
RISK_SCORE_VERY_HIGH = 6
LIFECYCLE_NEW_MAX = 3
LIFECYCLE_EARLY_MAX = 12
LIFECYCLE_MID_MAX = 36
RISK_BAND_HIGH = 0.7
RISK_BAND_MEDIUM = 0.4
PSI_BINS = 10
PSI_LEVELS = ((0.10, "none"), (0.20, "low"), (0.25, "moderate"))
PSI_TOP_LEVEL = "high"
PSI_FLOOR = 1e-6
DRIFT_ESCALATION_COUNT = 2
DRIFT_ADVICE = {
    "none": "Distributions match the reference. Keep the usual schedule.",
    "low": "Small shifts in single columns. Compare them again after the next load.",
    "moderate": "Several columns moved. Find the cause and score a recent labelled sample before relying on the model.",
    "high": "The current data no longer looks like the reference. Check the feeds, then fit the model again on recent rows.",
}
MISSING_CATEGORY = "missing"


@dataclass(frozen=True)
class Roles:
    """Which column plays which part, and which values carry meaning."""

    key: str
    target: str
    tenure: str
    monthly: str
    total: str
    contract: str
    internet: str
    payment: str
    paperless: str
    partner: str
    dependents: str
    senior: str
    services: tuple[str, ...]
    streaming: tuple[str, ...]
    security: tuple[str, ...]
    inactive_values: tuple[str, ...]
    monthly_contract: str
    long_contracts: tuple[str, ...]
    fibre: str
    no_internet: str
    electronic_check: str
    digital_pattern: str
    positive: str = "Yes"
    numeric_ranges: dict[str, tuple[float, float]] = field(default_factory=dict)
    valid_values: dict[str, tuple] = field(default_factory=dict)

    @property
    def numeric(self) -> tuple[str, ...]:
        return (self.tenure, self.monthly, self.total)

    def present(self, columns: Sequence[str]) -> Roles:
        """The same roles with the service lists cut to the columns a table has."""
        lists = {n: tuple(c for c in getattr(self, n) if c in columns) for n in ("services", "streaming", "security")}
        return replace(self, **lists)


_YES_NO = ("Yes", "No")
_NET = ("Yes", "No", "No internet service")

TELECOM = Roles(
    key="customerID",
    target="Churn",
    tenure="tenure",
    monthly="MonthlyCharges",
    total="TotalCharges",
    contract="Contract",
    internet="InternetService",
    payment="PaymentMethod",
    paperless="PaperlessBilling",
    partner="Partner",
    dependents="Dependents",
    senior="SeniorCitizen",
    services=(
        "PhoneService",
        "MultipleLines",
        "InternetService",
        "OnlineSecurity",
        "OnlineBackup",
        "DeviceProtection",
        "TechSupport",
        "StreamingTV",
        "StreamingMovies",
    ),
    streaming=("StreamingTV", "StreamingMovies"),
    security=("OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport"),
    inactive_values=("No", "No phone service", "No internet service"),
    monthly_contract="Month-to-month",
    long_contracts=("One year", "Two year"),
    fibre="Fiber optic",
    no_internet="No",
    electronic_check="Electronic check",
    digital_pattern="(?i)electronic|automatic",
    numeric_ranges={
        "tenure": (0, 72),
        "MonthlyCharges": (18.0, 120.0),
        "TotalCharges": (0.0, 10000.0),
    },
    valid_values={
        "gender": ("Male", "Female"),
        "SeniorCitizen": (0, 1),
        "Partner": _YES_NO,
        "Dependents": _YES_NO,
        "PhoneService": _YES_NO,
        "MultipleLines": ("Yes", "No", "No phone service"),
        "InternetService": ("DSL", "Fiber optic", "No"),
        "OnlineSecurity": _NET,
        "OnlineBackup": _NET,
        "DeviceProtection": _NET,
        "TechSupport": _NET,
        "StreamingTV": _NET,
        "StreamingMovies": _NET,
        "Contract": ("Month-to-month", "One year", "Two year"),
        "PaperlessBilling": _YES_NO,
        "PaymentMethod": (
            "Electronic check",
            "Mailed check",
            "Bank transfer (automatic)",
            "Credit card (automatic)",
        ),
    },
)

# The same roles read from an order history (sources/customer360.py).
ORDERS360 = Roles(
    key="customer_key",
    target="target",
    tenure="tenure",
    monthly="monthly",
    total="total",
    contract="contract",
    internet="internet",
    payment="payment",
    paperless="paperless",
    partner="partner",
    dependents="dependents",
    senior="senior",
    services=("svc_urgent", "svc_high", "svc_medium", "svc_unspecified", "svc_low", "internet"),
    streaming=("svc_urgent", "svc_high"),
    security=("svc_medium", "svc_unspecified", "svc_low"),
    inactive_values=("No", "AFRICA"),
    monthly_contract="BUILDING",
    long_contracts=("FURNITURE", "MACHINERY"),
    fibre="ASIA",
    no_internet="AFRICA",
    electronic_check="P",
    digital_pattern="(?i)^[op]$",
    numeric_ranges={"tenure": (12, 60), "monthly": (100000.0, 400000.0), "total": (0.0, 4000000.0)},
    valid_values={
        "contract": ("BUILDING", "FURNITURE", "MACHINERY"),
        "payment": ("O", "P"),
        "senior": (0, 1),
    },
)
