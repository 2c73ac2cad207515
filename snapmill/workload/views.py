"""Stand-ins for the four raw tables, derived row by row from the star-schema tables.

Each stand-in is a list of SQL expressions that mean the same in Spark and in the checking
engine, so both start from equal dirty rows; what happens next is written twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmill import fixed_values as V
from snapmill.schemas import ATTRIBUTES, CLICKSTREAM, FINANCIALS, LOANS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Rounds up to 32 bits when it is rounded to 64 bits first, else down.
_TWICE_ROUNDED = "1.00000017881393432617187499"

LOAN_COLUMNS = {
    "loan_id": "concat(l_orderkey, '')",
    "Customer_ID": "concat(o_custkey, '')",
    "loan_start_date": "CAST(o_orderdate AS DATE)",
    "tenure": "CASE l_orderkey % 10 WHEN 0 THEN NULL WHEN 1 THEN '10.7' ELSE '10' END",
    "installment_num": "CASE WHEN l_orderkey % 13 = 5 THEN concat(l_linenumber, '.0') ELSE concat(l_linenumber, '') END",
    "loan_amt": f"CASE WHEN l_orderkey % 101 = 1 THEN '{_TWICE_ROUNDED}' ELSE concat(l_extendedprice, '') END",
    # nothing due on undiscounted lines: the divide-by-zero case; a tenth and three tenths are no
    # exact threefold in 32 bits
    "due_amt": f"""CASE WHEN l_orderkey % 101 = 2 THEN '{_TWICE_ROUNDED}' WHEN l_orderkey % 29 = 4 THEN '0.1'
        WHEN l_discount = 0 THEN '0' ELSE concat(l_quantity, '') END""",
    "paid_amt": f"""CASE WHEN l_orderkey % 101 = 3 THEN '{_TWICE_ROUNDED}'
        WHEN l_returnflag = 'N' THEN concat(l_quantity, '') ELSE '0' END""",
    "overdue_amt": f"""CASE WHEN l_orderkey % 101 = 4 THEN '{_TWICE_ROUNDED}' WHEN l_orderkey % 29 = 4 THEN '0.3'
        WHEN l_linenumber = 5 THEN '-150'
        WHEN l_returnflag = 'R' THEN concat(l_quantity * (1 + l_linenumber % 3), '')
        WHEN l_returnflag = 'A' THEN concat(l_quantity * 0.5, '')
        ELSE '0' END""",
    "balance": f"""CASE WHEN l_linenumber = 7 THEN NULL WHEN l_orderkey % 101 = 5 THEN '{_TWICE_ROUNDED}'
        ELSE concat(l_extendedprice, '') END""",
    # mostly first of month; some month ends, where going back months clamps, and some without a date
    "snapshot_date": """CASE WHEN l_orderkey % 97 = 50 THEN NULL
        WHEN l_orderkey % 8 = 3 THEN last_day(CAST(l_shipdate AS DATE))
        ELSE make_date(year(l_shipdate), month(l_shipdate), 1) END""",
}

ATTRIBUTE_COLUMNS = {
    "Customer_ID": "concat(c_custkey, '')",
    "Name": """CASE WHEN c_custkey % 97 = 5 THEN concat(c_name, ', "Jr"') ELSE c_name END""",
    "Age": """CASE
        WHEN c_custkey % 20 = 0 THEN concat(18 + c_custkey % 50, '_')
        WHEN c_custkey % 33 = 1 THEN '-500'
        WHEN c_custkey % 41 = 2 THEN concat(3000 + c_custkey % 900, '_')
        WHEN c_custkey % 57 = 3 THEN ''
        WHEN c_custkey % 61 = 4 THEN NULL
        ELSE concat(14 + c_custkey % 90, '') END""",
    "SSN": """CASE
        WHEN c_custkey % 17 = 0 THEN '#F%$D@*&8'
        WHEN c_custkey % 29 = 1 THEN NULL
        ELSE concat(100 + c_custkey % 900, '-', 10 + c_custkey % 90, '-', 1000 + c_custkey % 9000) END""",
    "Occupation": """CASE c_custkey % 14
        WHEN 0 THEN '_______' WHEN 1 THEN '-' WHEN 2 THEN '' WHEN 3 THEN NULL
        WHEN 4 THEN 'Doctor' WHEN 5 THEN 'Lawyer' WHEN 6 THEN 'Engineer'
        WHEN 7 THEN 'Teacher' WHEN 8 THEN 'Journalist' WHEN 9 THEN 'Manager'
        WHEN 10 THEN 'Entrepreneur' WHEN 11 THEN 'Mechanic' WHEN 12 THEN 'Accountant'
        ELSE c_mktsegment END""",
    "snapshot_date": "make_date(2024, CAST(1 + c_custkey % 12 AS INT), 1)",
}


def _activity(i: int) -> str:
    """Mostly whole numbers around zero; some null, unreadable, fractional or huge."""
    number = f"event_id * {2 * i + 1} % 101 - 50"
    special = [f"WHEN (event_id + {i}) % 397 = 0 THEN NULL"]
    if i == 3:
        special.append(f"WHEN event_id % 5 = 0 THEN concat({number}, '.7')")
    if i == 5:
        special.append("WHEN event_id % 389 = 0 THEN 'n/a'")
    if i in (7, 8):
        special.append("WHEN event_id % 113 = 0 THEN '2147483647'")
    return f"CASE {' '.join(special)} ELSE concat({number}, '') END"


CLICK_COLUMNS = {
    **{c: _activity(i) for i, c in enumerate(V.ACTIVITY_COLUMNS, 1)},
    # ten customers share a user of the event stream
    "Customer_ID": "concat(user_id * 10 + event_id % 10, '')",
    "snapshot_date": "make_date(2024, CAST(1 + FLOOR(event_id / 10) % 12 AS INT), 1)",
}

FINANCIAL_COLUMNS = {
    "Customer_ID": "concat(o_custkey, '')",
    "Annual_Income": """CASE
        WHEN o_orderkey % 11 = 0 THEN concat(o_totalprice, '_')
        WHEN o_orderkey % 23 = 1 THEN '-100'
        WHEN o_orderkey % 31 = 2 THEN '0'
        WHEN o_orderkey % 37 = 3 THEN ''
        ELSE concat(o_totalprice, '') END""",
    "Monthly_Inhand_Salary": """CASE WHEN o_orderkey % 19 = 0 THEN NULL
        ELSE concat(FLOOR(o_totalprice) / 8, '') END""",
    "Num_Bank_Accounts": """CASE WHEN o_orderkey % 19 = 0 THEN '3.0'
        ELSE concat(o_orderkey % 13 - 1, '') END""",
    "Num_Credit_Card": "concat(o_orderkey % 18 - 1, '')",
    "Interest_Rate": "concat(o_orderkey % 53 - 1, '')",
    "Num_of_Loan": """CASE
        WHEN o_orderkey % 21 = 0 THEN '-100'
        WHEN o_orderkey % 7 = 1 THEN concat(o_orderkey % 9, '_')
        ELSE concat(o_orderkey % 9, '') END""",
    "Type_of_Loan": """CASE o_orderkey % 5
        WHEN 0 THEN '' WHEN 1 THEN '_' WHEN 2 THEN 'Not Specified'
        ELSE concat(o_orderpriority, ' Loan') END""",
    "Delay_from_due_date": "concat(o_orderkey % 40 - 5, '')",
    "Num_of_Delayed_Payment": """CASE WHEN o_orderkey % 13 = 0 THEN concat(o_orderkey % 25, '_')
        ELSE concat(o_orderkey % 25 - 2, '') END""",
    "Changed_Credit_Limit": """CASE WHEN o_orderkey % 27 = 0 THEN '_'
        ELSE concat((o_orderkey % 3000) / 8 - 5, '') END""",
    "Num_Credit_Inquiries": "concat(o_orderkey % 60 - 2, '')",
    "Credit_Mix": """CASE o_orderkey % 5
        WHEN 0 THEN '_' WHEN 1 THEN '' WHEN 2 THEN 'Good' WHEN 3 THEN 'Standard' ELSE 'Bad' END""",
    "Outstanding_Debt": """CASE
        WHEN o_orderkey % 16 = 0 THEN concat((o_orderkey * 37 % 500000) / 4, '_')
        WHEN o_orderkey % 43 = 1 THEN '-12.5'
        ELSE concat((o_orderkey * 37 % 500000) / 4, '') END""",
    "Credit_Utilization_Ratio": """CASE WHEN o_orderkey % 47 = 0 THEN NULL
        ELSE concat((o_orderkey * 79 % 480) / 4 - 5, '') END""",
    "Credit_History_Age": """CASE o_orderkey % 15
        WHEN 0 THEN 'NA' WHEN 1 THEN concat(o_orderkey % 30, ' Years') WHEN 2 THEN NULL
        WHEN 3 THEN '999999999999999999 Years and 1 Months'
        ELSE concat(o_orderkey % 30, ' Years and ', o_orderkey % 12, ' Months') END""",
    "Payment_of_Min_Amount": "CASE o_orderkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'NM' END",
    "Total_EMI_per_month": "concat((o_orderkey * 7 % 20004) / 2 - 1, '')",
    "Amount_invested_monthly": """CASE WHEN o_orderkey % 20 = 0 THEN '__10000__'
        ELSE concat((o_orderkey % 4000) / 8 - 1, '') END""",
    "Payment_Behaviour": """CASE o_orderkey % 8
        WHEN 0 THEN 'High_spent_Large_value_payments' WHEN 1 THEN 'High_spent_Medium_value_payments'
        WHEN 2 THEN 'High_spent_Small_value_payments' WHEN 3 THEN 'Low_spent_Large_value_payments'
        WHEN 4 THEN 'Low_spent_Medium_value_payments' WHEN 5 THEN 'Low_spent_Small_value_payments'
        WHEN 6 THEN '!@9#%8' ELSE NULL END""",
    "Monthly_Balance": """CASE WHEN o_orderkey % 26 = 0 THEN '_'
        ELSE concat((o_orderkey % 9000) / 8 - 40, '') END""",
    "snapshot_date": "make_date(2024, CAST(1 + o_orderkey % 12 AS INT), 1)",
}


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{sql} AS {name}" for name, sql in columns.items()])


def raw_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    return _select(lines.join(orders, lines.l_orderkey == orders.o_orderkey), LOAN_COLUMNS)


def raw_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(table(spark, sf_dir, "customer"), ATTRIBUTE_COLUMNS)


def raw_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(table(spark, sf_dir, "events"), CLICK_COLUMNS)


def raw_financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(table(spark, sf_dir, "orders"), FINANCIAL_COLUMNS)


RAW = {
    CLICKSTREAM.name: raw_clicks,
    ATTRIBUTES.name: raw_attributes,
    FINANCIALS.name: raw_financials,
    LOANS.name: raw_loans,
}


#: Lines beside the good rows of the tables, by the remainder of the customer's number.
DIRTY_EVERY = 50
TOO_MANY_AT, TOO_FEW_AT, OPEN_QUOTE_AT, LINE_BREAK_AT = 1, 2, 3, 4


def dirty_lines(rows: DataFrame, line_breaks: bool) -> DataFrame:
    """Raw lines made from some rows: too many fields, too few, and open quotes.

    Open quotes are those of a quoted line break, that is two lines, and of a quote that is never
    closed; the latter are left out with ``line_breaks``.
    """
    kind = F.pmod(F.col(V.ENTITY).cast("long"), F.lit(DIRTY_EVERY))
    # before any line is made: most rows have no kind
    rows = rows.where(kind.isin(TOO_MANY_AT, TOO_FEW_AT, OPEN_QUOTE_AT, LINE_BREAK_AT))
    line = F.to_csv(F.struct(*rows.columns), {"escape": '"'})
    broken = F.to_csv(
        F.struct(*[F.concat(c, F.lit("\nof two lines")).alias(c) if c == V.ENTITY else F.col(c) for c in rows.columns]),
        {"escape": '"'},
    )
    text = F.when(kind == TOO_MANY_AT, F.concat(line, F.lit(",x")))
    text = text.when(kind == TOO_FEW_AT, F.concat_ws(",", V.ENTITY, F.lit("x")))
    text = text.when(kind == LINE_BREAK_AT, broken)
    if not line_breaks:
        text = text.when(kind == OPEN_QUOTE_AT, F.concat(F.lit('"'), line))
    return rows.select(F.explode(F.split(text, "\n")).alias("line"))


def _sql(columns: dict[str, str], source: str) -> str:
    listed = ",\n    ".join(f"{sql} AS {name}" for name, sql in columns.items())
    return f"SELECT\n    {listed}\nFROM {source}"


RAW_SQL = {
    CLICKSTREAM.name: _sql(CLICK_COLUMNS, "events"),
    ATTRIBUTES.name: _sql(ATTRIBUTE_COLUMNS, "customer"),
    FINANCIALS.name: _sql(FINANCIAL_COLUMNS, "orders"),
    LOANS.name: _sql(LOAN_COLUMNS, "lineitem JOIN orders ON l_orderkey = o_orderkey"),
}
