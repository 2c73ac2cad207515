"""Tables of the three layers: raw columns, and per column the rule that makes it clean.

A rule is data. ``operators.conform`` turns all rules of a table into two projections.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import types as T

from snapmill import fixed_values as V
from snapmill.functions.casts import AMOUNT, COUNT, DATE, TEXT


@dataclass(frozen=True)
class ColumnRule:
    """How one raw column becomes a typed, clean one. Steps apply in field order."""

    name: str
    type: str = TEXT
    strip: bool = False  # delete underscores before typing
    measured: bool = False  # type through double, so fractions truncate
    placeholders: Sequence[str] = ()
    placeholder_regex: str | None = None
    allowed: Sequence[str] = ()
    non_negative: bool = False
    bounds: tuple[float, float] | None = None  # on text, tested on its int reading


@dataclass(frozen=True)
class SnapshotTable:
    """A raw table and its cleaning rules; ``derived`` names the columns added after cleaning."""

    name: str
    rules: tuple[ColumnRule, ...]
    derived: dict[str, str] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [r.name for r in self.rules]

    @property
    def bronze_schema(self) -> T.StructType:
        """All text but for the partition column, which Spark keeps last."""
        return _struct([(c, TEXT) for c in self.columns if c != V.SNAPSHOT] + [(V.SNAPSHOT, DATE)])

    @property
    def silver_columns(self) -> list[str]:
        return self.columns + list(self.derived)

    @property
    def silver_schema(self) -> T.StructType:
        return _struct([(r.name, r.type) for r in self.rules] + list(self.derived.items()))


_SPARK_TYPES = {
    TEXT: T.StringType(),
    DATE: T.DateType(),
    AMOUNT: T.FloatType(),
    COUNT: T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
}


def _struct(fields) -> T.StructType:
    return T.StructType([T.StructField(n, _SPARK_TYPES[t]) for n, t in fields])


ATTRIBUTES = SnapshotTable(
    "attributes",
    (
        ColumnRule(V.ENTITY),
        ColumnRule("Name"),
        # Age is range-checked as a number but stays text
        ColumnRule("Age", strip=True, bounds=V.AGE_BOUNDS),
        ColumnRule("SSN"),
        ColumnRule("Occupation", placeholders=V.OCCUPATION_PLACEHOLDERS),
        ColumnRule(V.SNAPSHOT, DATE),
    ),
    {
        "SSN_is_valid": "boolean",
        "SSN_clean": TEXT,
        "age_group": TEXT,
        "occupation_category": TEXT,
    },
)

CLICKSTREAM = SnapshotTable(
    "clickstream",
    (
        *(ColumnRule(c, COUNT, measured=True) for c in V.ACTIVITY_COLUMNS),
        ColumnRule(V.ENTITY),
        ColumnRule(V.SNAPSHOT, DATE),
    ),
    {"total_activity": COUNT, "activity_intensity": COUNT, "active_features_count": COUNT},
)


def _money(name: str, **steps) -> ColumnRule:
    return ColumnRule(name, AMOUNT, strip=True, **steps)


def _tally(name: str, **steps) -> ColumnRule:
    return ColumnRule(name, COUNT, strip=True, **steps)


FINANCIALS = SnapshotTable(
    "financials",
    (
        ColumnRule(V.ENTITY),
        _money("Annual_Income", non_negative=True),
        _money("Monthly_Inhand_Salary", non_negative=True),
        _tally("Num_Bank_Accounts", non_negative=True, bounds=V.BANK_ACCOUNT_BOUNDS),
        _tally("Num_Credit_Card", non_negative=True, bounds=V.CREDIT_CARD_BOUNDS),
        _money("Interest_Rate", bounds=V.INTEREST_RATE_BOUNDS),
        _tally("Num_of_Loan", non_negative=True),
        ColumnRule("Type_of_Loan", placeholders=V.LOAN_TYPE_PLACEHOLDERS),
        _tally("Delay_from_due_date"),
        _tally("Num_of_Delayed_Payment", non_negative=True),
        _money("Changed_Credit_Limit"),
        _tally("Num_Credit_Inquiries", non_negative=True, bounds=V.CREDIT_INQUIRY_BOUNDS),
        ColumnRule("Credit_Mix", placeholders=V.CREDIT_MIX_PLACEHOLDERS),
        _money("Outstanding_Debt", non_negative=True),
        _money("Credit_Utilization_Ratio", non_negative=True),
        ColumnRule("Credit_History_Age"),
        ColumnRule("Payment_of_Min_Amount"),
        _money("Total_EMI_per_month", non_negative=True, bounds=V.TOTAL_EMI_BOUNDS),
        _money("Amount_invested_monthly", non_negative=True),
        ColumnRule("Payment_Behaviour", allowed=V.PAYMENT_BEHAVIOURS),
        _money("Monthly_Balance"),
        ColumnRule(V.SNAPSHOT, DATE),
    ),
    {
        "Credit_history_total_months": COUNT,
        "Debt_to_income_ratio": "double",
        "credit_risk_level": TEXT,
    },
)

LOANS = SnapshotTable(
    "loan_daily",
    (
        ColumnRule("loan_id"),
        ColumnRule(V.ENTITY),
        ColumnRule("loan_start_date", DATE),
        ColumnRule("tenure", COUNT, measured=True),
        ColumnRule("installment_num", COUNT, measured=True),
        # amounts are 32-bit by contract: ceil(overdue / due) depends on it
        ColumnRule("loan_amt", AMOUNT, measured=True),
        ColumnRule("due_amt", AMOUNT, measured=True),
        ColumnRule("paid_amt", AMOUNT, measured=True),
        ColumnRule("overdue_amt", AMOUNT, measured=True),
        ColumnRule("balance", AMOUNT, measured=True),
        ColumnRule(V.SNAPSHOT, DATE),
    ),
    {"mob": COUNT, "installments_missed": COUNT, "first_missed_date": DATE, "dpd": COUNT},
)

TABLES = {t.name: t for t in (CLICKSTREAM, ATTRIBUTES, FINANCIALS, LOANS)}

_FEATURE_PARTS = (ATTRIBUTES, CLICKSTREAM, FINANCIALS)

FEATURE_STORE_SCHEMA = T.StructType(
    [ATTRIBUTES.silver_schema[k] for k in V.FEATURE_KEYS]
    + [
        f
        for part in _FEATURE_PARTS
        for f in part.silver_schema
        if f.name not in V.FEATURE_KEYS and f.name not in V.PRIVATE_COLUMNS
    ]
    + [
        T.StructField("feature_completeness", T.DoubleType()),
        T.StructField("financial_health_score", T.IntegerType()),
    ]
)

LABEL_STORE_SCHEMA = _struct(
    [("loan_id", TEXT), (V.ENTITY, TEXT), ("label", COUNT), ("label_def", TEXT), (V.SNAPSHOT, DATE)]
)
