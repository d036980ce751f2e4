"""Fixed values of the credit mart.

Everything in this module is a fixed value: a word list, a column list, a format, a bucket
edge or a default that results depend on. They are listed as plain text and nothing else.
"""

# ---- fixed values: text cleaning ---------------------------------------------------------
NULL_TOKENS = ("_", "NULL", "N/A", "NA", "")
JUNK_BEHAVIOUR = "!@9#%8"
BLANK_OCCUPATION = "_______"
HEADER_TYPOS = {"interst_rate": "interest_rate", "payement_behaviour": "payment_behaviour"}

# ---- fixed values: date formats, tried in this order (day first) ---------------------------
DATE_FORMATS = ("d/M/yy", "dd/MM/yy", "d/M/yyyy", "dd/MM/yyyy", "M/d/yyyy", "yyyy-MM-dd")

# ---- fixed values: raw sources -------------------------------------------------------------
# Known names of each data set, in the order they are looked for; the first that exists is read.
SOURCE_NAMES = {
    "loan_daily": ("lms_loan_daily",),
    "clickstream": ("feature_clickstream",),
    "attributes": ("feature_attributes", "features_attributes"),
    "financials": ("feature_financials", "features_financials"),
}
# Data sets with line breaks inside quotes; Spark reads such a file in one task.
MULTI_LINE = ("financials",)

# ---- fixed values: silver schemas ----------------------------------------------------------
LOAN_TYPES = {
    "loan_id": "string",
    "Customer_ID": "string",
    "loan_start_date": "date",
    "tenure": "int",
    "installment_num": "int",
    "loan_amt": "float",
    "due_amt": "float",
    "paid_amt": "float",
    "overdue_amt": "float",
    "balance": "float",
    "snapshot_date": "date",
}
LINEAGE = ("ingest_dt", "snap_ym", "source_file")
ATTRIBUTE_COLUMNS = ("customer_id", "occupation", "snapshot_date", *LINEAGE)
FINANCIAL_COLUMNS = (
    "customer_id", "snapshot_date", "ingest_dt", "snap_ym", "source_file",
    "annual_income", "monthly_inhand_salary", "interest_rate",
    "num_of_loan", "delay_from_due_date", "num_of_delayed_payment",
    "changed_credit_limit", "num_credit_inquiries", "credit_mix",
    "outstanding_debt", "credit_utilization_ratio", "credit_history_age",
    "payment_of_min_amount", "total_emi_per_month", "amount_invested_monthly",
    "payment_behaviour", "monthly_balance", "type_of_loan",
)
DELINQUENCY_COLUMNS = ("delay_from_due_date", "num_of_delayed_payment")

# ---- fixed values: gold features -----------------------------------------------------------
OCCUPATIONS = (
    "ACCOUNTANT", "ARCHITECT", "DEVELOPER", "DOCTOR", "ENGINEER",
    "ENTREPRENEUR", "JOURNALIST", "LAWYER", "MANAGER", "MEDIA_MANAGER",
    "MECHANIC", "MUSICIAN", "SCIENTIST", "TEACHER", "WRITER",
)
UTIL_CAP = 150.0
UTIL_EDGES = (10, 30, 50, 80)
UTIL_LABELS = ("U0:[0,10)", "U1:[10,30)", "U2:[30,50)", "U3:[50,80)", "U4:[80,+)")
HISTORY_EDGES = (12, 36, 60, 120)
HISTORY_LABELS = ("H0:<1y", "H1:1-3y", "H2:3-5y", "H3:5-10y", "H4:>=10y")
INQUIRY_LABELS = ("I0:NA", "I1:0", "I2:1-2", "I3:3-5", "I4:>5")
MIN_PAYMENT_UNKNOWN = ("NM", "NULL", "")
BEHAVIOUR_CLASSES = (
    ("late", ("LATE", "DELAY")),
    ("irregular", ("MIN", "PART", "IRREG")),
    ("regular", ("REG", "ON TIME")),
)
LOAN_LIST_RULES = (
    (r"\bAND\b", ","),
    ("NOT SPECIFIED", ""),
    (r"\s+", " "),
    (r",\s*,", ","),
    (r"(^\s*,)|(,\s*$)", ""),
)
LOAN_FLAGS = {
    "has_HOME": "HOME LOAN",
    "has_AUTO": "AUTO LOAN",
    "has_CC": "CREDIT CARD",
    "has_PERSONAL": "PERSONAL LOAN",
    "has_STUDENT": "STUDENT LOAN",
    "has_MORTGAGE": "MORTGAGE LOAN",
}
FEATURE_KEYS = ("customer_id", "snapshot_date", "snap_ym")
FINANCIAL_PASS_THROUGH = (
    "interest_rate", "num_credit_inquiries", "credit_mix", "num_of_loan",
    "credit_history_age", "credit_utilization_ratio",
)
FINANCIAL_ENGINEERED = (
    "dti", "emi_to_income", "emi_to_balance", "invest_to_income",
    "util_capped", "util_sq", "util_bucket", "util_bucket_idx", "emi_x_util",
    "interest_x_loans",
    "hist_bucket", "hist_bucket_idx", "inq_bucket", "inq_bucket_idx", "dti_x_inq",
    "minpay_flag", "pay_behav_coarse",
    "loan_types_count_unique",
    "has_HOME", "has_AUTO", "has_CC", "has_PERSONAL", "has_STUDENT", "has_MORTGAGE",
    "is_income_null", "is_outstanding_debt_null", "is_util_null", "is_hist_null",
    "is_inquiry_null", "is_minpay_null", "is_behav_null", "is_type_of_loan_null",
)

# ---- fixed values: labels, splits, windows -------------------------------------------------
DEFAULT_DPD = 30
DEFAULT_MOB = 6
MODEL_KEYS = ("customer_id", "snapshot_date", "loan_id", "label", "label_def")
SPLIT_DATES = {
    "Train": ("2023-07-01", "2024-04-30"),
    "Valid": ("2024-05-01", "2024-06-30"),
    "Test": ("2024-07-01", "2024-10-31"),
    "OOT": ("2024-11-01", "2024-12-31"),
}
# Months (or 30-day steps) back from the run month: first and last month of each window.
ROLLING_WINDOWS = {"Train": (4, 3), "Valid": (2, 2), "Test": (1, 1), "OOT": (0, 0)}

# ---- fixed values: models and monitoring ---------------------------------------------------
F1_EPSILON = 1e-9
DEFAULT_THRESHOLD = 0.5
MIN_AUC_ROWS = 10
BOOSTING = {"stepSize": 0.05, "maxDepth": 6, "subsamplingRate": 0.8,
            "featureSubsetStrategy": "0.8", "seed": 42}
MAX_TREES = 2000
KLL_SIZE = 200
THETA_BITS = 16  # 65,536 hashes a sketch; keys are dealt to slots of half as many rows, so counts are exact
PATIENCE = 50
SEARCH_DRAWS = 100
SEARCH_FOLDS = 3
TREES = {"stepSize": 0.05, "maxDepth": 6, "subsamplingRate": 0.8, "columnRate": 0.8, "seed": 42}
SEARCH_SPACE = {
    "maxIter": (25, 50),
    "maxDepth": (2, 3),
    "stepSize": (0.01, 0.1),
    "subsamplingRate": (0.6, 0.8),
    "columnRate": (0.6, 0.8),
    "minSplitLoss": (0.0, 0.1),
    "minChildWeight": (1, 3, 5),
    "l1": (0.0, 0.1, 1.0),
    "l2": (1.0, 1.5, 2.0),
}
SCORE_NAME_PATTERN = r"score_(\d{8}_\d{6})"
SCORE_NAME_FORMAT = "yyyyMMdd_HHmmss"

# ---- fixed values: quality suite -----------------------------------------------------------
NULL_RATE_COLUMNS = (
    "annual_income", "monthly_inhand_salary", "outstanding_debt",
    "interest_rate", "credit_utilization_ratio", "num_of_loan",
    "num_of_delayed_payment", "credit_history_age", "credit_mix",
    "payment_behaviour", "payment_of_min_amount",
)
TWO_DP_COLUMNS = (
    "annual_income", "monthly_inhand_salary", "outstanding_debt",
    "amount_invested_monthly", "monthly_balance",
)
TWO_DP_TOLERANCE = 1e-9
NON_NEGATIVE_COLUMNS = (
    "annual_income", "monthly_inhand_salary", "outstanding_debt",
    "total_emi_per_month", "amount_invested_monthly", "monthly_balance",
    "num_of_loan", "num_of_delayed_payment", "num_credit_inquiries",
    "credit_history_age", "credit_utilization_ratio",
)
EARLY_PAYMENT_COLUMN = "delay_from_due_date"
VALUE_RANGES = {"interest_rate": (0, 100), "credit_history_age": (0, 1200)}
SUMMARY_PERCENTILES = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)
HISTOGRAM_BINS = 30
VARIANCE_TOP = 20
PREVIEW_ROWS = 200
SAMPLE_POSITIVES = 10
