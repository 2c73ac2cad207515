"""Fixed values of the data model.

Names, word lists, bounds, patterns and band edges that results depend on. They are given,
not derived; the code that applies them lives in ``functions`` and ``operators``.
"""

# ---------------------------------------------------------------- keys and partitioning
ENTITY = "Customer_ID"
SNAPSHOT = "snapshot_date"
FEATURE_KEYS = (ENTITY, SNAPSHOT)

# ---------------------------------------------------------------- attributes
OCCUPATION_PLACEHOLDERS = ("", "-", "^_+$")  # all three are literals, the last one too
AGE_BOUNDS = (16, 100)
SSN_PATTERN = "^[0-9]{3}-[0-9]{2}-[0-9]{4}$"
AGE_BANDS = ((25, "young"), (40, "middle_25_40"), (60, "mature_40_60"))
AGE_BAND_ELSE = "seniors"
OCCUPATION_CATEGORIES = {
    "professional": ("Doctor", "Lawyer", "Engineer"),
    "education_media": ("Teacher", "Journalist"),
    "business": ("Manager", "Entrepreneur"),
    "technical": ("Mechanic", "Accountant"),
}
OCCUPATION_MISSING = "None"
OCCUPATION_ELSE = "other"

# ---------------------------------------------------------------- clickstream
ACTIVITY_PREFIX = "fe_"
ACTIVITY_COLUMNS = tuple(f"{ACTIVITY_PREFIX}{i}" for i in range(1, 21))

# ---------------------------------------------------------------- financials
CREDIT_MIX_PLACEHOLDERS = ("_", "")
LOAN_TYPE_PLACEHOLDERS = ("", "_", "Not Specified")
PAYMENT_BEHAVIOURS = (
    "High_spent_Large_value_payments",
    "High_spent_Medium_value_payments",
    "High_spent_Small_value_payments",
    "Low_spent_Large_value_payments",
    "Low_spent_Medium_value_payments",
    "Low_spent_Small_value_payments",
)
BANK_ACCOUNT_BOUNDS = (0, 10)
CREDIT_CARD_BOUNDS = (0, 15)
INTEREST_RATE_BOUNDS = (0, 50)
CREDIT_INQUIRY_BOUNDS = (0, 50)
TOTAL_EMI_BOUNDS = (0, 10000)
HISTORY_YEARS_PATTERN = r"(\d+) Years"
HISTORY_MONTHS_PATTERN = r"(\d+) Months"
UTILISATION_BANDS = (
    (90, "critical"),
    (70, "very_high"),
    (50, "high"),
    (30, "moderate"),
    (10, "low"),
)
UTILISATION_BAND_ELSE = "very_low"

# ---------------------------------------------------------------- feature store
PRIVATE_COLUMNS = ("Name", "SSN", "SSN_is_valid", "SSN_clean", "Occupation")
COMPLETENESS_COLUMNS = (
    "Age",
    "Annual_Income",
    "total_activity",
    "Credit_Utilization_Ratio",
)
DEBT_RATIO_POINTS = ((0.3, 3), (0.5, 2))
DEBT_RATIO_POINTS_ELSE = 1
UTILISATION_POINTS = ((30, 2), (70, 1))
UTILISATION_POINTS_ELSE = 0

# ---------------------------------------------------------------- labels
LABEL_DPD = 30
LABEL_MOB = 6
COHORT_CUTOFF = "2024-01-01"
FINAL_INSTALLMENT = 10

# ---------------------------------------------------------------- profiling
MISSING_TEXT_PATTERN = "^_+$"
DIGITS_PATTERN = "^[0-9]+$"
DESCRIBED_FINANCIALS = (
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
)
