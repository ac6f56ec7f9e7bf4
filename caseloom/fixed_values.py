"""The constants that must hold exactly for results to be right.

Date formats, patterns, code names, weights and thresholds of the claims
domain, all in one place. Logic lives elsewhere.
"""

# --- parsing -----------------------------------------------------------------
DATE_FORMATS = ("yyyy-MM-dd", "MM/dd/yyyy", "yyyy/MM/dd", "dd-MM-yyyy")
EMPTY_CODE_LITERALS = ("N/A", "NA", "NULL", "NONE")
CODE_DELIMITERS = r"[;,\r\n]+"
CURRENCY_MARKS = r"[$€£\s]"
AMOUNT_DECIMAL_COMMA = r"^-?\d+,\d{2}$"
AMOUNT_THOUSANDS = r"^-?\d{1,3}(,\d{3})+(\.\d+)?$"
AMOUNT_PLAIN = r"^-?\d+(\.\d+)?$"

# --- validation --------------------------------------------------------------
MIN_CONFIDENCE = 0.75
POLICY_NUMBER_PATTERN = r"^POL-\d+$"
NPI_PATTERN = r"^\d{10}$"
PROCEDURE_CODE_PATTERN = r"^\d{5}$"
DIAGNOSIS_CODE_PATTERN = r"^[A-Z]\d[0-9A-Z](\.[0-9A-Z]{1,4})?$"
SUPPORTED_CURRENCIES = ("USD",)
SEVERAL_VALUES_PATTERN = r"[|;,/]"
HEADER_LABELS = ("POLICY_NUMBER", "PATIENT LAST NAME", "PATIENT FIRST NAME", "DATE OF SERVICE")

# --- personal data -----------------------------------------------------------
SSN_PATTERN = r"\b\d{3}-?\d{2}-?\d{4}\b"
PHONE_PATTERN = r"\b(?:\+?1[-.\s]?)?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}\b"
SSN_MASK = "[REDACTED_SSN]"
PHONE_MASK = "[REDACTED_PHONE]"

# --- canonical record --------------------------------------------------------
CONFLICT_FIELDS = (
    "policy_number_normalized",
    "member_first_name_normalized",
    "member_last_name_normalized",
    "member_dob_parsed",
    "provider_npi_normalized",
    "service_date_parsed",
    "billed_amount_parsed",
    "currency_normalized",
)

# --- identity match, in hundredths -------------------------------------------
FIRST_NAME_POINTS = 25
LAST_NAME_POINTS = 35
DOB_POINTS = 40

# --- history -----------------------------------------------------------------
HISTORY_DAYS = 365
DUPLICATE_DAYS = 30
DUPLICATE_TOLERANCE = "0.05"
RECENT_EVIDENCE = 5
RISK_DUPLICATE = 50
RISK_MANY_PRIOR, MANY_PRIOR = 20, 10
RISK_SAME_PROCEDURE, MANY_SAME_PROCEDURE = 15, 3
RISK_AMOUNT, AMOUNT_FACTOR = 15, 3
RISK_CAP = 100

# --- authorization status, worst first ---------------------------------------
AUTHORIZATION_PRIORITY = (
    "AMBIGUOUS",
    "DENIED",
    "CANCELLED",
    "PENDING",
    "EXPIRED",
    "MISSING",
    "VALID",
    "NOT_REQUIRED",
)

# --- case --------------------------------------------------------------------
RULE_ENGINE_VERSION = "1.0.0"
STATUS_REVIEW = "MANUAL_REVIEW_REQUIRED"
STATUS_COMPLETE = "ETL_COMPLETE"
REVIEW_PREFIX = "Manual review required: "
NO_REVIEW_TEXT = "Automated processing complete; no review reasons identified"
FORBIDDEN_STATUSES = ("APPROVED", "REJECTED", "DENIED")
