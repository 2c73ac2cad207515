"""SQL with the same meaning as the queries, for the checking engine (DuckDB dialect)."""

from __future__ import annotations

from snapmill.workload.queries import (
    COHORT_CUTOFF,
    HOT_LEFT,
    HOT_RIGHT,
    LAST_LINE,
    LATER_LABELS,
    LATER_LABELS_FROM,
    LOAN_RANGE,
    SLICE_MONTH,
    SNAPSHOT_RANGE,
    STORED_MONTH,
    THINNED_MONTH,
)
from snapmill.workload.views import RAW_SQL

# Tables, columns, words and bounds are written out here, apart from the rules they check.
_CLICKS, _ATTRIBUTES, _FINANCIALS, _LOANS = "clickstream", "attributes", "financials", "loan_daily"
_KEYS = "Customer_ID, snapshot_date"


def _raw(name: str) -> str:
    return f"({RAW_SQL[name]})"


def _int(column: str) -> str:
    """Whole digits only; a plain cast would round fractions."""
    return (
        f"CASE WHEN regexp_full_match({column}, '\\s*[+-]?[0-9]+\\s*') "
        f"THEN TRY_CAST({column} AS INTEGER) END"
    )


def _measured_int(column: str) -> str:
    return f"TRY_CAST(TRUNC(TRY_CAST({column} AS DOUBLE)) AS INTEGER)"


def _bare(column: str) -> str:
    return f"replace({column}, '_', '')"


# ------------------------------------------------------------------ typed tables
_FE = [f"fe_{i}" for i in range(1, 21)]
_ATTRIBUTE_COLUMNS = ["Customer_ID", "Name", "Age", "SSN", "Occupation", "snapshot_date"]
_FINANCIAL_COLUMNS = [
    "Customer_ID",
    "Annual_Income",
    "Monthly_Inhand_Salary",
    "Num_Bank_Accounts",
    "Num_Credit_Card",
    "Interest_Rate",
    "Num_of_Loan",
    "Type_of_Loan",
    "Delay_from_due_date",
    "Num_of_Delayed_Payment",
    "Changed_Credit_Limit",
    "Num_Credit_Inquiries",
    "Credit_Mix",
    "Outstanding_Debt",
    "Credit_Utilization_Ratio",
    "Credit_History_Age",
    "Payment_of_Min_Amount",
    "Total_EMI_per_month",
    "Amount_invested_monthly",
    "Payment_Behaviour",
    "Monthly_Balance",
    "snapshot_date",
]
_LOAN_COLUMNS = [
    "loan_id",
    "Customer_ID",
    "loan_start_date",
    "tenure",
    "installment_num",
    "loan_amt",
    "due_amt",
    "paid_amt",
    "overdue_amt",
    "balance",
    "snapshot_date",
]
_COLUMNS = {
    _CLICKS: [*_FE, "Customer_ID", "snapshot_date"],
    _ATTRIBUTES: _ATTRIBUTE_COLUMNS,
    _FINANCIALS: _FINANCIAL_COLUMNS,
    _LOANS: _LOAN_COLUMNS,
}
_MONEY = [
    "Annual_Income",
    "Monthly_Inhand_Salary",
    "Interest_Rate",
    "Changed_Credit_Limit",
    "Outstanding_Debt",
    "Credit_Utilization_Ratio",
    "Total_EMI_per_month",
    "Amount_invested_monthly",
    "Monthly_Balance",
]
_TALLIES = [
    "Num_Bank_Accounts",
    "Num_Credit_Card",
    "Num_of_Loan",
    "Delay_from_due_date",
    "Num_of_Delayed_Payment",
    "Num_Credit_Inquiries",
]
_DESCRIBED = [
    "Annual_Income",
    "Monthly_Inhand_Salary",
    "Num_Bank_Accounts",
    "Num_Credit_Card",
    "Num_Credit_Inquiries",
    "Interest_Rate",
    "Outstanding_Debt",
    "Credit_Utilization_Ratio",
    "Delay_from_due_date",
    "Total_EMI_per_month",
]
_NOT_NEGATIVE = [
    "Annual_Income",
    "Monthly_Inhand_Salary",
    "Num_Bank_Accounts",
    "Num_Credit_Card",
    "Num_of_Loan",
    "Num_of_Delayed_Payment",
    "Num_Credit_Inquiries",
    "Outstanding_Debt",
    "Credit_Utilization_Ratio",
    "Total_EMI_per_month",
    "Amount_invested_monthly",
]


def _typed_sql(table: str, column: str) -> str:
    if table == _CLICKS and column in _FE or table == _LOANS and column in ("tenure", "installment_num"):
        return f"{_measured_int(column)} AS {column}"
    if table == _ATTRIBUTES and column == "Age":
        return f"{_bare(column)} AS {column}"
    if table == _FINANCIALS and column in _MONEY:
        return f"TRY_CAST({_bare(column)} AS FLOAT) AS {column}"
    if table == _FINANCIALS and column in _TALLIES:
        return f"{_int(_bare(column))} AS {column}"
    if table == _LOANS and column in ("loan_amt", "due_amt", "paid_amt", "overdue_amt", "balance"):
        return f"TRY_CAST(TRY_CAST({column} AS DOUBLE) AS FLOAT) AS {column}"
    return column


def _typed(table: str) -> str:
    return f"(SELECT {', '.join(_typed_sql(table, c) for c in _COLUMNS[table])} FROM {_raw(table)})"


# ------------------------------------------------------------------ silver tables
_AGE = _int(_bare("Age"))
_AGE_GROUP = """CASE WHEN CAST(Age AS INTEGER) < 25 THEN 'young'
    WHEN CAST(Age AS INTEGER) < 40 THEN 'middle_25_40'
    WHEN CAST(Age AS INTEGER) < 60 THEN 'mature_40_60' ELSE 'seniors' END"""
_OCCUPATION_CATEGORY = """CASE
    WHEN Occupation IN ('Doctor', 'Lawyer', 'Engineer') THEN 'professional'
    WHEN Occupation IN ('Teacher', 'Journalist') THEN 'education_media'
    WHEN Occupation IN ('Manager', 'Entrepreneur') THEN 'business'
    WHEN Occupation IN ('Mechanic', 'Accountant') THEN 'technical'
    WHEN Occupation IS NULL THEN 'None' ELSE 'other' END"""
_SSN_VALID = "regexp_matches(SSN, '^[0-9]{3}-[0-9]{2}-[0-9]{4}$')"
_OCCUPATION = "CASE WHEN Occupation NOT IN ('', '-', '^_+$') THEN Occupation END"

SILVER_ATTRIBUTES = f"""(
SELECT *, {_SSN_VALID} AS SSN_is_valid, CASE WHEN {_SSN_VALID} THEN SSN END AS SSN_clean,
    {_AGE_GROUP} AS age_group, {_OCCUPATION_CATEGORY} AS occupation_category
FROM (SELECT Customer_ID, Name,
        CASE WHEN {_AGE} BETWEEN 16 AND 100 THEN {_bare('Age')} END AS Age,
        SSN, {_OCCUPATION} AS Occupation, snapshot_date
    FROM {_raw(_ATTRIBUTES)}))"""

_ACTIVITY = f"""
    TRY_CAST({' + '.join(f'CAST({c} AS BIGINT)' for c in _FE)} AS INTEGER) AS total_activity,
    TRY_CAST({' + '.join(f'ABS(CAST({c} AS BIGINT))' for c in _FE)} AS INTEGER) AS activity_intensity,
    CAST({' + '.join(f'COALESCE(CAST({c} <> 0 AS INTEGER), 0)' for c in _FE)} AS INTEGER)
        AS active_features_count"""
SILVER_CLICKSTREAM = f"(SELECT *, {_ACTIVITY} FROM {_typed(_CLICKS)})"

_BOUNDS_SQL = {
    "Num_Bank_Accounts": "0 AND 10",
    "Num_Credit_Card": "0 AND 15",
    "Interest_Rate": "0 AND 50",
    "Num_Credit_Inquiries": "0 AND 50",
    "Total_EMI_per_month": "0 AND 10000",
}
_CREDIT_MIX = "CASE WHEN Credit_Mix NOT IN ('_', '') THEN Credit_Mix END AS Credit_Mix"
_LOAN_TYPE = (
    "CASE WHEN Type_of_Loan NOT IN ('', '_', 'Not Specified') THEN Type_of_Loan END AS Type_of_Loan"
)
_BEHAVIOUR = """CASE WHEN Payment_Behaviour IN (
    'High_spent_Large_value_payments', 'High_spent_Medium_value_payments', 'High_spent_Small_value_payments',
    'Low_spent_Large_value_payments', 'Low_spent_Medium_value_payments', 'Low_spent_Small_value_payments')
    THEN Payment_Behaviour END AS Payment_Behaviour"""


def _bounded(column: str) -> str:
    return f"CASE WHEN {column} BETWEEN {_BOUNDS_SQL[column]} THEN {column} END AS {column}"


def _at_least_zero(column: str) -> str:
    return f"CASE WHEN {column} >= 0 THEN {column} END AS {column}"


def _clean_financials() -> str:
    text = {"Credit_Mix": _CREDIT_MIX, "Type_of_Loan": _LOAN_TYPE, "Payment_Behaviour": _BEHAVIOUR}
    columns = []
    for c in _FINANCIAL_COLUMNS:
        if c in text:
            columns.append(text[c])
        elif c in _BOUNDS_SQL:
            columns.append(_bounded(c))
        elif c in _NOT_NEGATIVE:
            columns.append(_at_least_zero(c))
        else:
            columns.append(c)
    return f"(SELECT {', '.join(columns)} FROM {_typed(_FINANCIALS)})"


def _captured(pattern: str) -> str:
    """A number that 32 bits hold, ready to be multiplied in 64."""
    found = f"NULLIF(regexp_extract(Credit_History_Age, '{pattern}', 1), '')"
    return f"CAST(TRY_CAST({found} AS INTEGER) AS BIGINT)"


SILVER_FINANCIALS = f"""(
SELECT *,
    TRY_CAST({_captured('([0-9]+) Years')} * 12 + {_captured('([0-9]+) Months')} AS INTEGER)
        AS Credit_history_total_months,
    CASE WHEN Annual_Income > 0
        THEN CAST(Outstanding_Debt AS DOUBLE) / CAST(Annual_Income AS DOUBLE) END AS Debt_to_income_ratio,
    CASE WHEN Credit_Utilization_Ratio > 90 THEN 'critical'
        WHEN Credit_Utilization_Ratio > 70 THEN 'very_high'
        WHEN Credit_Utilization_Ratio > 50 THEN 'high'
        WHEN Credit_Utilization_Ratio > 30 THEN 'moderate'
        WHEN Credit_Utilization_Ratio > 10 THEN 'low' ELSE 'very_low' END AS credit_risk_level
FROM {_clean_financials()})"""

_FILLED = ["tenure", "installment_num", "loan_amt", "due_amt", "paid_amt", "overdue_amt", "balance"]


def _zero_filled() -> str:
    columns = [f"COALESCE({c}, 0) AS {c}" if c in _FILLED else c for c in _LOAN_COLUMNS]
    return f"(SELECT {', '.join(columns)} FROM {_typed(_LOANS)})"


# the missed count comes from unfilled amounts, but those nulls end at 0 either way
SILVER_LOAN = f"""(
WITH counted AS (
    SELECT *, installment_num AS mob,
        COALESCE(CAST(CEIL(CAST(overdue_amt AS DOUBLE) / NULLIF(CAST(due_amt AS DOUBLE), 0)) AS INTEGER), 0)
            AS installments_missed
    FROM {_zero_filled()}),
dated AS (
    SELECT *, CASE WHEN installments_missed > 0
        THEN CAST(snapshot_date - to_months(installments_missed) AS DATE) END AS first_missed_date
    FROM counted)
SELECT *, CASE WHEN overdue_amt > 0
    THEN CAST(date_diff('day', first_missed_date, snapshot_date) AS INTEGER) ELSE 0 END AS dpd
FROM dated)"""

_SILVER = {
    _ATTRIBUTES: SILVER_ATTRIBUTES,
    _CLICKS: SILVER_CLICKSTREAM,
    _FINANCIALS: SILVER_FINANCIALS,
    _LOANS: SILVER_LOAN,
}

# ------------------------------------------------------------------ gold tables
_PRIVATE = "Name, SSN, SSN_is_valid, SSN_clean, Occupation"


def _feature_join(attributes: str, clicks: str, money: str) -> str:
    return f"""(
SELECT * FROM (SELECT * EXCLUDE ({_PRIVATE}) FROM {attributes})
LEFT JOIN {clicks} USING ({_KEYS})
LEFT JOIN {money} USING ({_KEYS}))"""


def _scored(joined: str) -> str:
    return f"""(
SELECT *,
    (CAST(Age IS NOT NULL AS INTEGER) + CAST(Annual_Income IS NOT NULL AS INTEGER)
        + CAST(total_activity IS NOT NULL AS INTEGER)
        + CAST(Credit_Utilization_Ratio IS NOT NULL AS INTEGER)) / 4.0::DOUBLE AS feature_completeness,
    CAST(CASE WHEN Debt_to_income_ratio < 0.3::DOUBLE THEN 3
            WHEN Debt_to_income_ratio < 0.5::DOUBLE THEN 2 ELSE 1 END
        + CASE WHEN Credit_Utilization_Ratio < 30 THEN 2
            WHEN Credit_Utilization_Ratio < 70 THEN 1 ELSE 0 END AS INTEGER) AS financial_health_score
FROM {joined})"""


FEATURES = _scored(_feature_join(SILVER_ATTRIBUTES, SILVER_CLICKSTREAM, SILVER_FINANCIALS))


def _moved(silver: str, chosen: str, target: tuple[str, str]) -> str:
    entity, snapshot = target
    return f"""(SELECT * REPLACE (
    CASE WHEN {chosen} THEN '{entity}' ELSE Customer_ID END AS Customer_ID,
    CASE WHEN {chosen} THEN DATE '{snapshot}' ELSE snapshot_date END AS snapshot_date) FROM {silver})"""


def _labels(where: str = "TRUE", dpd: int = 30, mob: int = 6) -> str:
    return f"""SELECT loan_id, Customer_ID, CASE WHEN dpd >= {dpd} THEN 1 ELSE 0 END AS label,
    '{dpd}dpd_{mob}mob' AS label_def, snapshot_date FROM {SILVER_LOAN} WHERE mob = {mob} AND {where}"""


def _on_spine(bounds: tuple[str, str], column: str = "snapshot_date") -> str:
    first, last = bounds
    return f"{column} BETWEEN DATE '{first}' AND DATE '{last}' AND day({column}) = 1"


_FIRST_OF_MONTH = "day(snapshot_date) = 1"
_LATER = f"{_FIRST_OF_MONTH} AND snapshot_date >= DATE '{LATER_LABELS_FROM}'"


def _read_back(column: str) -> str:
    """An empty text does not survive CSV: it is read as null."""
    return column if column == "snapshot_date" else f"NULLIF(CAST({column} AS VARCHAR), '')"


def _bronze_report(name: str) -> str:
    cells = " + ".join(f"COUNT({_read_back(c)})" for c in _COLUMNS[name])
    return f"""SELECT '{name}' AS source, snapshot_date, COUNT(*) AS row_count,
    COUNT(DISTINCT Customer_ID) AS entities, {cells} AS cells
FROM {_raw(name)} WHERE {_FIRST_OF_MONTH} GROUP BY snapshot_date"""


def _remainder() -> str:
    return "CAST(Customer_ID AS BIGINT) % 50"


def _ingested(name: str) -> str:
    bounds = LOAN_RANGE if name == _LOANS else SNAPSHOT_RANGE
    kept = _on_spine(bounds)
    first = "day(snapshot_date) = 1"
    outside = f"snapshot_date NOT BETWEEN DATE '{bounds[0]}' AND DATE '{bounds[1]}'"
    counts = {
        "open_quote": f"{_remainder()} = 3",
        "too_few_fields": f"{_remainder()} = 2",
        "too_many_fields": f"{_remainder()} = 1",
        "undated": "snapshot_date IS NULL",
        "off_spine": f"NOT ({first})",
        "out_of_range": f"{first} AND {outside}",
    }
    # a quoted line break makes two lines with an open quote each
    columns = {r: f"COUNT(*) FILTER (WHERE {c})" for r, c in counts.items()}
    columns["open_quote"] += f" + 2 * COUNT(*) FILTER (WHERE {_remainder()} = 4)"
    listed = ", ".join(f"{c} AS {r}" for r, c in columns.items())
    return f"""SELECT *, open_quote + too_few_fields + too_many_fields + undated + off_spine + out_of_range AS dropped
FROM (SELECT '{name}' AS source, COUNT(*) FILTER (WHERE {kept}) AS kept, {listed} FROM {_raw(name)})"""


def _csv_field(column: str) -> str:
    """A value as it is written: quoted if it holds a comma or a quote, or is empty but not null."""
    text = f"CAST({column} AS VARCHAR)"
    return f"""CASE WHEN {column} IS NULL THEN '' WHEN {text} = '' THEN '""'
    WHEN contains({text}, ',') OR contains({text}, '"') THEN '"' || replace({text}, '"', '""') || '"' ELSE {text} END"""


def _quarantined() -> str:
    fields = [_csv_field(c) for c in _ATTRIBUTE_COLUMNS]
    line, rest = " || ',' || ".join(fields), " || ',' || ".join(fields[1:])
    return f"""WITH rows AS (SELECT *, {_remainder()} AS kind FROM {_raw(_ATTRIBUTES)}),
lines AS (
    SELECT 'too_many_fields' AS reason, {line} || ',x' AS line FROM rows WHERE kind = 1
    UNION ALL SELECT 'too_few_fields', Customer_ID || ',x' FROM rows WHERE kind = 2
    UNION ALL SELECT 'open_quote', '"' || {line} FROM rows WHERE kind = 3
    UNION ALL SELECT 'open_quote', '"' || Customer_ID FROM rows WHERE kind = 4
    UNION ALL SELECT 'open_quote', 'of two lines",' || {rest} FROM rows WHERE kind = 4)
SELECT reason, line, COUNT(*) AS n FROM lines GROUP BY reason, line"""


def _with_line_breaks() -> str:
    columns = ", ".join(f"{_read_back(c)} AS {c}" for c in _ATTRIBUTE_COLUMNS)
    rows = f"SELECT {columns} FROM {_raw(_ATTRIBUTES)} WHERE {_FIRST_OF_MONTH}"
    return f"""{rows} UNION ALL SELECT * REPLACE (Customer_ID || chr(10) || 'of two lines' AS Customer_ID)
FROM ({rows} AND {_remainder()} = 4)"""


# ------------------------------------------------------------------ profiles
def _missing(column: str, calendar: bool = False) -> str:
    test = f"{column} IS NULL"
    if not calendar:
        text = f"CAST({column} AS VARCHAR)"
        test += f" OR {text} = '' OR regexp_matches({text}, '^_+$')"
    return f"CAST(COUNT(*) FILTER (WHERE {test}) AS BIGINT)"


def _missing_counts(columns: dict[str, bool], source: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {_missing(c, calendar)} AS missing FROM {source}"
        for c, calendar in columns.items()
    )


def _described(column: str) -> str:
    number = f"TRY_CAST({column} AS DOUBLE)"
    return f"""SELECT '{column}' AS "column", COUNT({number}) AS count, ROUND(AVG({number}), 4) AS mean,
    ROUND(STDDEV_SAMP({number}), 4) AS stddev, MIN({number}) AS min, MAX({number}) AS max,
    COUNT(*) FILTER (WHERE {column} IS NOT NULL AND {number} IS NULL) AS unparsed
FROM {_raw(_FINANCIALS)}"""


def _project(columns: str, source: str, where: str = "TRUE") -> str:
    return f"SELECT {columns} FROM {source} WHERE {where}"


_FLAGGED = f"""(SELECT *, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS dpd_flag
FROM {SILVER_LOAN} WHERE loan_start_date < DATE '{COHORT_CUTOFF}')"""
_MONTHS = """(SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date, COUNT(*) AS n
FROM orders GROUP BY 1)"""
_RANGES = ", ".join(f"MIN({c}) AS min_{c}, MAX({c}) AS max_{c}" for c in _FE)
_DIGITS = "regexp_matches(Age, '^[0-9]+$')"

ORACLE: dict[str, str] = {
    "snapshot_slice": _project("*", _raw(_LOANS), f"snapshot_date = DATE '{SLICE_MONTH}'"),
    "month_spine": f"""SELECT snapshot_date, COALESCE(n, 0) AS row_count
FROM (SELECT CAST(UNNEST(generate_series(MIN(snapshot_date), MAX(snapshot_date), INTERVAL 1 MONTH)) AS DATE)
    AS snapshot_date FROM {_MONTHS}) LEFT JOIN {_MONTHS} USING (snapshot_date)""",
    "spine_slice": _project(
        "*",
        "(SELECT o_orderkey, CAST(o_orderdate AS DATE) AS snapshot_date FROM orders)",
        _on_spine(LOAN_RANGE),
    ),
    "strip_underscore": _project(
        f"{_KEYS}, {', '.join(f'{_bare(c)} AS {c}' for c in _MONEY + _TALLIES)}", _raw(_FINANCIALS)
    ),
    "enforce_schema": _project("*", _typed(_CLICKS)),
    "enforce_schema_attributes": _project("*", _typed(_ATTRIBUTES)),
    "enforce_schema_financials": _project("*", _typed(_FINANCIALS)),
    "enforce_schema_loans": _project("*", _typed(_LOANS)),
    "sentinel_to_null": _project(f"{_KEYS}, {_OCCUPATION} AS Occupation", _raw(_ATTRIBUTES)),
    "sentinel_pattern_to_null": _project(
        f"""{_KEYS}, CASE WHEN Occupation NOT IN ('', '-') AND NOT regexp_matches(Occupation, '^_+$')
        THEN Occupation END AS Occupation""",
        _raw(_ATTRIBUTES),
    ),
    "sentinel_to_null_financials": _project(f"{_KEYS}, {_CREDIT_MIX}, {_LOAN_TYPE}", _raw(_FINANCIALS)),
    "range_to_null": _project(
        f"{_KEYS}, {', '.join(map(_bounded, _BOUNDS_SQL))}", _typed(_FINANCIALS)
    ),
    "range_to_null_age": _project(f"{_KEYS}, Age", SILVER_ATTRIBUTES),
    "negative_to_null": _project(
        f"{_KEYS}, {', '.join(map(_at_least_zero, _NOT_NEGATIVE))}", _typed(_FINANCIALS)
    ),
    "whitelist_to_null": _project(f"{_KEYS}, {_BEHAVIOUR}", _raw(_FINANCIALS)),
    "pattern_flag_mask": _project(f"{_KEYS}, SSN, SSN_is_valid, SSN_clean", SILVER_ATTRIBUTES),
    "zero_fill": _project("*", _zero_filled()),
    "age_group": _project(f"{_KEYS}, Age, age_group", SILVER_ATTRIBUTES),
    "occupation_category": _project(f"{_KEYS}, Occupation, occupation_category", SILVER_ATTRIBUTES),
    "row_activity": _project(
        f"{_KEYS}, total_activity, activity_intensity, active_features_count", SILVER_CLICKSTREAM
    ),
    "history_months": _project(f"{_KEYS}, Credit_History_Age, Credit_history_total_months", SILVER_FINANCIALS),
    "debt_to_income": _project(
        f"{_KEYS}, Annual_Income, Outstanding_Debt, Debt_to_income_ratio", SILVER_FINANCIALS
    ),
    "risk_level": _project(f"{_KEYS}, Credit_Utilization_Ratio, credit_risk_level", SILVER_FINANCIALS),
    "days_past_due": _project(
        "loan_id, mob, snapshot_date, due_amt, overdue_amt, installments_missed, first_missed_date, dpd",
        SILVER_LOAN,
    ),
    "feature_join": _project("*", _feature_join(SILVER_ATTRIBUTES, SILVER_CLICKSTREAM, SILVER_FINANCIALS)),
    "feature_join_hot_keys": _project(
        "*",
        _feature_join(
            _moved(SILVER_ATTRIBUTES, "CAST(Customer_ID AS BIGINT) % 3 = 0", HOT_LEFT),
            _moved(SILVER_CLICKSTREAM, "fe_1 < -16", HOT_RIGHT),
            SILVER_FINANCIALS,
        ),
    ),
    "feature_completeness": _project(f"{_KEYS}, feature_completeness", FEATURES),
    "health_score": _project(f"{_KEYS}, financial_health_score", FEATURES),
    "loan_labels": _labels(),
    "cohort_filter": _project(
        "loan_id, installment_num, loan_start_date, dpd, dpd_flag", _FLAGGED, f"installment_num = {LAST_LINE}"
    ),
    "bad_rate_by_mob": f"SELECT mob, AVG(dpd_flag) AS bad_rate FROM {_FLAGGED} GROUP BY mob",
    "value_counts": f"""SELECT Occupation, COUNT(*) AS count FROM {_raw(_ATTRIBUTES)}
GROUP BY Occupation""",
    "value_counts_entities": f"""SELECT Customer_ID, COUNT(*) AS count FROM {_raw(_CLICKS)}
GROUP BY Customer_ID""",
    "value_counts_top": f"""SELECT Customer_ID, COUNT(*) AS count FROM {_raw(_CLICKS)}
GROUP BY Customer_ID ORDER BY count DESC, Customer_ID NULLS FIRST LIMIT 20""",
    "distinct_values": f"SELECT DISTINCT Occupation FROM {_raw(_ATTRIBUTES)}",
    "distinct_values_head": f"""SELECT DISTINCT Customer_ID FROM {_raw(_CLICKS)}
ORDER BY Customer_ID NULLS FIRST LIMIT 50""",
    "distinct_count": f"""SELECT COUNT(*) AS distinct_count
FROM (SELECT DISTINCT Customer_ID FROM {_raw(_CLICKS)})""",
    "distinct_count_occupations": f"""SELECT COUNT(*) AS distinct_count
FROM (SELECT DISTINCT Occupation FROM {_raw(_ATTRIBUTES)})""",
    "null_counts": "SELECT {} FROM {}".format(
        ", ".join(f"COUNT(*) - COUNT({c}) AS {c}" for c in _COLUMNS[_CLICKS]), _raw(_CLICKS)
    ),
    "missing_counts": _missing_counts(
        {c: c == "snapshot_date" for c in _ATTRIBUTE_COLUMNS}, _raw(_ATTRIBUTES)
    ),
    "missing_counts_documents": _missing_counts(
        dict.fromkeys(["doc_id", "text", "lang", "source", "n_chars"], False), "documents"
    ),
    "min_max": _project(_RANGES, _typed(_CLICKS)),
    "describe_numeric": "\nUNION ALL ".join(map(_described, _DESCRIBED)),
    "numeric_check": f"""SELECT COUNT(*) FILTER (WHERE {_DIGITS}) AS numeric_count,
    COUNT(*) FILTER (WHERE NOT {_DIGITS}) AS non_numeric_count FROM {_raw(_ATTRIBUTES)}""",
    "non_numeric_values": _project("DISTINCT Age", _raw(_ATTRIBUTES), f"NOT {_DIGITS}"),
    "row_count": "SELECT COUNT(*) AS row_count FROM lineitem",
    "duplicate_keys": f"""SELECT COUNT(*) AS repeated_keys,
    CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS surplus_rows, COALESCE(MAX(n), 0) AS rows_of_largest_key
FROM (SELECT COUNT(*) AS n FROM {_raw(_CLICKS)} GROUP BY {_KEYS} HAVING COUNT(*) > 1)""",
    "silver_attributes": _project("*", SILVER_ATTRIBUTES),
    "silver_clickstream": _project("*", SILVER_CLICKSTREAM),
    "silver_financials": _project("*", SILVER_FINANCIALS),
    "silver_loan": _project("*", SILVER_LOAN),
    "gold_features": _project("*", FEATURES),
    "bronze_roundtrip": "\nUNION ALL ".join(map(_bronze_report, _COLUMNS)),
    "bronze_attributes": _project(
        ", ".join(f"{_read_back(c)} AS {c}" for c in _ATTRIBUTE_COLUMNS),
        _raw(_ATTRIBUTES),
        _FIRST_OF_MONTH,
    ),
    "ingest_report": "\nUNION ALL ".join(map(_ingested, _COLUMNS)),
    "quarantined_lines": _quarantined(),
    "bronze_line_breaks": _with_line_breaks(),
    "silver_month": _project("*", SILVER_CLICKSTREAM, f"snapshot_date = DATE '{STORED_MONTH}'"),
    "backfill_labels": _labels(_FIRST_OF_MONTH),
    "catch_up_labels": f"""SELECT *, CASE WHEN snapshot_date = DATE '{THINNED_MONTH}' THEN 3 ELSE 1 END AS run
FROM ({_labels(_FIRST_OF_MONTH)})
WHERE NOT (snapshot_date = DATE '{THINNED_MONTH}' AND CAST(loan_id AS BIGINT) % 2 = 0)""",
    "label_definitions": "\nUNION ALL ".join(
        [_labels(_FIRST_OF_MONTH), *(_labels(_LATER, *d) for d in LATER_LABELS)]
    ),
    "backfill_features": _project("*", FEATURES, _FIRST_OF_MONTH),
    "backfill_features_bucketed": _project("*", FEATURES, _FIRST_OF_MONTH),
}
