"""Raw slices to cleaned tables: ``conform`` plus the derived columns of each table.

Every expression reads one row only, so any number of months can run in one job and no
shuffle is needed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmill import fixed_values as V
from snapmill.functions import casts, clean, derive
from snapmill.operators.conform import conform, type_columns
from snapmill.schemas import ATTRIBUTES, CLICKSTREAM, FINANCIALS, LOANS
from snapmill.session import compile_wide_stages


def age_group(age: Column) -> Column:
    """Null and unreadable ages fall through to the last band, like ages of 60 and more."""
    return derive.band_below(casts.parse(age, casts.COUNT), V.AGE_BANDS, V.AGE_BAND_ELSE)


def occupation_category(occupation: Column) -> Column:
    return derive.categorise(
        occupation, V.OCCUPATION_CATEGORIES, V.OCCUPATION_MISSING, V.OCCUPATION_ELSE
    )


def credit_risk_level(utilisation: Column) -> Column:
    """Null utilisation counts as the lowest risk."""
    return derive.band_above(utilisation, V.UTILISATION_BANDS, V.UTILISATION_BAND_ELSE)


def refine_attributes(raw: DataFrame) -> DataFrame:
    people = conform(raw, ATTRIBUTES)
    valid = clean.matches(F.col("SSN"), V.SSN_PATTERN)
    return people.withColumns(
        {
            "SSN_is_valid": valid,
            "SSN_clean": clean.keep_valid(F.col("SSN"), valid),
            "age_group": age_group(F.col("Age")),
            "occupation_category": occupation_category(F.col("Occupation")),
        }
    )


def refine_clickstream(raw: DataFrame) -> DataFrame:
    clicks = conform(raw, CLICKSTREAM)
    return clicks.withColumns(
        {
            "total_activity": derive.activity_total(V.ACTIVITY_COLUMNS),
            "activity_intensity": derive.activity_intensity(V.ACTIVITY_COLUMNS),
            "active_features_count": derive.active_count(V.ACTIVITY_COLUMNS),
        }
    )


def refine_financials(raw: DataFrame) -> DataFrame:
    compile_wide_stages(raw.sparkSession)
    money = conform(raw, FINANCIALS)
    return money.withColumns(
        {
            "Credit_history_total_months": derive.history_months(
                F.col("Credit_History_Age"), V.HISTORY_YEARS_PATTERN, V.HISTORY_MONTHS_PATTERN
            ),
            "Debt_to_income_ratio": derive.ratio_when_positive(
                F.col("Outstanding_Debt"), F.col("Annual_Income")
            ),
            "credit_risk_level": credit_risk_level(F.col("Credit_Utilization_Ratio")),
        }
    )


def add_days_past_due(loans: DataFrame) -> DataFrame:
    """Installments missed, first missed date and days past due of typed loan rows.

    All numeric columns are zero-filled once the missed installments are known and before the
    dates are derived; a positive overdue amount with nothing due ends with a null ``dpd``.
    """
    counted = loans.withColumns(
        {
            "mob": F.col("installment_num"),
            "installments_missed": derive.missed_installments(F.col("overdue_amt"), F.col("due_amt")),
        }
    ).fillna(0)
    dated = counted.withColumn(
        "first_missed_date",
        derive.first_missed_date(F.col(V.SNAPSHOT), F.col("installments_missed")),
    )
    return dated.withColumn(
        "dpd",
        derive.days_past_due(F.col("overdue_amt"), F.col(V.SNAPSHOT), F.col("first_missed_date")),
    )


def refine_loans(raw: DataFrame) -> DataFrame:
    return add_days_past_due(type_columns(raw, LOANS))


REFINERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    CLICKSTREAM.name: refine_clickstream,
    ATTRIBUTES.name: refine_attributes,
    FINANCIALS.name: refine_financials,
    LOANS.name: refine_loans,
}
