"""Small claims world: one document per noise case, with the codes it must raise."""

from datetime import date
from decimal import Decimal

from caseloom.sources.schemas import INPUTS, OCR_COLUMNS

CLEAN = {
    "policy_number": "POL-100001",
    "member_first_name": "Bob",
    "member_last_name": "Wilson",
    "member_dob": "1956-02-02",
    "provider_npi": "9100000008",
    "service_date": "2026-06-01",
    "diagnosis_codes": "E11.9|I25.10",
    "procedure_codes": "70002|70003",
    "billed_amount": "373.75",
    "currency": "USD",
    "ocr_confidence": "0.95",
    "extracted_notes": "Clean OCR extraction",
    "expected_quality": "GOOD",
    "noise_type": "NONE",
}

# noise label -> (changed fields, validation errors expected)
NOISE = {
    "NONE": ({}, set()),
    "HALF_FIRST_NAME": ({"member_first_name": "Bo"}, set()),
    "O_AS_ZERO": ({"member_first_name": "B0b"}, set()),
    "MISSING_POLICY": ({"policy_number": None}, {"MISSING_POLICY_NUMBER"}),
    "BLANK_POLICY": ({"policy_number": " "}, {"MISSING_POLICY_NUMBER", "INVALID_POLICY_NUMBER"}),
    "MISSING_PROVIDER_NPI": ({"provider_npi": None}, {"MISSING_PROVIDER_NPI"}),
    "NPI_WITHOUT_DIGITS": ({"provider_npi": "ABCDEFGHIJ"}, {"MISSING_PROVIDER_NPI", "INVALID_PROVIDER_NPI"}),
    "MISSING_DOB": ({"member_dob": None}, set()),
    "MISSING_PROCEDURES": ({"procedure_codes": None}, {"MISSING_PROCEDURE_CODES"}),
    "MULTIPLE_MISSING_FIELDS": (
        {"policy_number": None, "member_last_name": None, "procedure_codes": ""},
        {"MISSING_POLICY_NUMBER", "MISSING_MEMBER_NAME", "MISSING_PROCEDURE_CODES"},
    ),
    "INVALID_SERVICE_DATE": ({"service_date": "2026-19-44"}, {"INVALID_SERVICE_DATE"}),
    "IMPOSSIBLE_DATE": ({"service_date": "2026-02-30"}, {"INVALID_SERVICE_DATE"}),
    "AMBIGUOUS_DOB": ({"member_dob": "01/19/82"}, {"INVALID_MEMBER_DOB"}),
    "TRUNCATED_NPI": ({"provider_npi": "910000"}, {"INVALID_PROVIDER_NPI"}),
    "NPI_SPACES": ({"provider_npi": "910 000 0008"}, set()),
    "NPI_PUNCTUATION": ({"provider_npi": "910.000-0008"}, set()),
    "POLICY_PREFIX_DROPPED": ({"policy_number": "100001"}, {"INVALID_POLICY_NUMBER"}),
    "POLICY_CHAR_CONFUSION": ({"policy_number": "POL-I0000I"}, {"INVALID_POLICY_NUMBER"}),
    "NAME_MERGED": ({"member_first_name": "BobWilson", "member_last_name": ""}, {"MISSING_MEMBER_NAME"}),
    "BROKEN_CODE_DELIMITER": ({"procedure_codes": "70002, ; 70003"}, set()),
    "CORRUPTED_DIAGNOSIS": ({"diagnosis_codes": "K219"}, {"INVALID_DIAGNOSIS_CODE"}),
    "PARTIAL_PROCEDURE_CODE": ({"procedure_codes": "7"}, {"INVALID_PROCEDURE_CODE"}),
    "AMOUNT_WITH_CURRENCY_SYMBOL": ({"billed_amount": "$373.75"}, set()),
    "AMOUNT_COMMA_DECIMAL": ({"billed_amount": "373,75"}, set()),
    "AMOUNT_THOUSANDS": ({"billed_amount": "1,373.75"}, set()),
    "AMOUNT_MIXED_MARKS": ({"billed_amount": "1.234,56"}, {"INVALID_BILLED_AMOUNT"}),
    "AMOUNT_O_AS_ZERO": ({"billed_amount": "2392.5O"}, {"INVALID_BILLED_AMOUNT"}),
    "NEGATIVE_AMOUNT": ({"billed_amount": "-20.00"}, {"NEGATIVE_BILLED_AMOUNT"}),
    "EMPTY_DOCUMENT": (
        {k: None for k in CLEAN if k not in ("ocr_confidence", "noise_type")}
        | {"extracted_notes": "Unreadable blank scan"},
        {
            "MISSING_POLICY_NUMBER",
            "MISSING_MEMBER_NAME",
            "MISSING_PROVIDER_NPI",
            "MISSING_PROCEDURE_CODES",
            "UNREADABLE_DOCUMENT",
        },
    ),
    "LOW_CONFIDENCE": ({"ocr_confidence": "0.40"}, {"LOW_OCR_CONFIDENCE"}),
    "NO_CONFIDENCE": ({"ocr_confidence": "n/a"}, {"INVALID_OCR_CONFIDENCE"}),
    "CONFIDENCE_OVER_ONE": ({"ocr_confidence": "1.4"}, {"INVALID_OCR_CONFIDENCE"}),
    "CONFIDENCE_NEGATIVE": ({"ocr_confidence": "-0.2"}, {"INVALID_OCR_CONFIDENCE", "LOW_OCR_CONFIDENCE"}),
    "PII_IN_NOTES": (
        {"extracted_ssn": "123-45-6789", "extracted_notes": "SSN 123-45-6789 call (212) 555-0199 now"},
        set(),
    ),
    "MULTILINGUAL_NOISE": ({"extracted_notes": "Примечание 注記", "member_first_name": "B?ob"}, set()),
    "LINE_BREAK_ARTIFACT": (
        {"policy_number": "POL-\n100001", "procedure_codes": "70002\n70003"},
        {"INVALID_POLICY_NUMBER"},
    ),
    "HEADER_AS_VALUE": (
        {"member_last_name": "Patient Last Name", "service_date": "Date of Service"},
        {"HEADER_TEXT_EXTRACTED_AS_VALUE", "INVALID_SERVICE_DATE"},
    ),
    "NULL_LITERAL": (
        {"member_dob": "NULL", "procedure_codes": "N/A"},
        {"INVALID_MEMBER_DOB", "MISSING_PROCEDURE_CODES"},
    ),
    "WHITESPACE_NOISE": ({"policy_number": "\tPOL-100001 ", "member_first_name": "  Bob "}, set()),
    "UNSUPPORTED_CURRENCY": ({"currency": "eur"}, {"UNSUPPORTED_CURRENCY"}),
    "ADMISSION_AFTER_DISCHARGE": (
        {"admission_date": "2026-06-05", "discharge_date": "2026-05-30"},
        {"ADMISSION_AFTER_DISCHARGE", "SERVICE_DATE_OUTSIDE_STAY"},
    ),
    "SERVICE_OUTSIDE_STAY": (
        {"admission_date": "2026-06-02", "discharge_date": "2026-06-05"},
        {"SERVICE_DATE_OUTSIDE_STAY"},
    ),
    "EXTRA_RANDOM_CHARACTERS": ({"policy_number": "##POL-100001**"}, {"INVALID_POLICY_NUMBER"}),
    "MULTIPLE_VALUES_SAME_FIELD": (
        {"provider_npi": "9100000008/9100000009"},
        {"MULTIPLE_VALUES_EXTRACTED_IN_SINGLE_FIELD", "INVALID_PROVIDER_NPI"},
    ),
}


def document(number: int, claim: str | None, **changes) -> tuple:
    row = dict.fromkeys(OCR_COLUMNS) | CLEAN
    row |= {"source_document_id": f"DOC-{number:04d}", "claim_id": claim} | changes
    return tuple(row[c] for c in OCR_COLUMNS)


def noise_documents() -> list[tuple]:
    return [
        document(i, f"CLM-{label}", **{"noise_type": label, **changes})
        for i, (label, (changes, _)) in enumerate(NOISE.items())
    ]


def duplicate_documents() -> list[tuple]:
    return [
        document(900, "CLM-DUP", ocr_confidence="0.80"),
        document(901, "CLM-DUP", ocr_confidence="0.99"),
        document(902, "CLM-CONFLICT", ocr_confidence="0.99"),
        document(903, "CLM-CONFLICT", ocr_confidence="0.99", provider_npi="9100000009", billed_amount="400.00",
                 procedure_codes="70004"),
        document(904, None),
        document(905, None, procedure_codes="70009"),
        document(906, "CLM-TWICE-POLICY", policy_number="POL-100002"),
        document(907, "CLM-TERMINATED", policy_number="POL-100003"),
        document(908, "CLM-TWICE-NPI", provider_npi="9100000010"),
    ]


POLICIES = [
    ("P-1", "POL-100001", "M-1", "PLAN-A", date(2026, 1, 1), date(2026, 12, 31), "ACTIVE", "G"),
    ("P-2", "POL-100002", "M-1", "PLAN-A", date(2026, 1, 1), date(2026, 12, 31), "ACTIVE", "G"),
    ("P-3", "pol-100002 ", "M-2", "PLAN-B", date(2026, 1, 1), date(2026, 12, 31), "active", "G"),
    ("P-4", "POL-100003", "M-2", "PLAN-A", date(2024, 1, 1), date(2025, 12, 31), "TERMINATED", "G"),
    ("P-5", "POL-100009", "M-9", "PLAN-A", date(2026, 1, 1), date(2026, 12, 31), "ACTIVE", "G"),
    ("P-6", None, "M-1", "PLAN-A", date(2026, 1, 1), date(2026, 12, 31), "ACTIVE", "G"),
]
MEMBERS = [
    ("M-1", "Bob", "Wilson", date(1956, 2, 2), "1 Street", "NV"),
    ("M-2", "Carol", "Anderson", date(1957, 3, 3), "2 Street", "AZ"),
    ("M-2", "Carole", "Anderson", date(1957, 3, 3), "2 Street", "AZ"),
]
PROVIDERS = [
    ("PR-1", "9100000008", "Group 1", "FACILITY", "IN_NETWORK", "NV", True),
    ("PR-2", "9100000009", "Group 2", "FACILITY", "OUT_OF_NETWORK", "NV", False),
    ("PR-4", "9100000010", "Group 4", "FACILITY", "IN_NETWORK", "NV", True),
    ("PR-3", "910-000-0010", "Group 3", "FACILITY", "IN_NETWORK", "NV", True),
    ("PR-0", "9100000010", "Group 0", "FACILITY", "IN_NETWORK", "NV", False),
    ("PR-5", "ABCDEFGHIJ", "Group 5", "FACILITY", "UNKNOWN", "NV", True),
]
PLAN_COVERAGE = [
    ("PLAN-A", "70002", "LAB", 0.5, Decimal("250.00"), Decimal("10.00"), True),
    ("PLAN-A", "70002", "SURGERY", 0.9, Decimal("250.00"), Decimal("10.00"), False),
    ("PLAN-A", "70003", "LAB", 0.8, Decimal("250.00"), Decimal("20.00"), False),
]
HISTORY = [
    # id, member, provider, procedure, date, amount, approved, status; 373.75 / 2 = 186.875 per line
    ("H-1", "M-1", "PR-1", "70002", date(2026, 5, 20), Decimal("186.88"), Decimal("1.00"), "PAID"),
    ("H-2", "M-1", "PR-1", "70002", date(2025, 6, 1), Decimal("100.00"), Decimal("1.00"), "PAID"),
    ("H-3", "M-1", "PR-1", "70002", date(2025, 5, 31), Decimal("100.00"), Decimal("1.00"), "PAID"),
    ("H-4", "M-1", "PR-1", "70003", date(2026, 6, 1), Decimal("190.00"), Decimal("1.00"), "PAID"),
    ("H-5", "M-1", "PR-1", "70003", date(2026, 7, 1), Decimal("196.21"), Decimal("1.00"), "PAID"),
    ("H-6", "M-1", "PR-1", "70003", date(2026, 7, 2), Decimal("186.88"), Decimal("1.00"), "PAID"),
    ("H-7", "M-1", "PR-1", "70003", date(2026, 5, 2), Decimal("196.22"), Decimal("1.00"), "PAID"),
    ("H-8", "M-1", "PR-2", "70003", date(2026, 5, 20), Decimal("186.88"), Decimal("1.00"), "PAID"),
    ("H-8", "M-1", "PR-2", "70003", date(2026, 5, 20), Decimal("186.88"), Decimal("1.00"), "PAID"),
    ("H-9", "M-1", "PR-2", "70002", date(2025, 8, 1), Decimal("10.00"), Decimal("1.00"), "PAID"),
    ("H-9", "M-1", "PR-2", "70003", date(2025, 8, 1), Decimal("20.00"), Decimal("1.00"), "PAID"),
    (None, "M-1", "PR-2", "70003", date(2025, 7, 1), Decimal("8.00"), Decimal("1.00"), "PAID"),
]
AUTHORIZATIONS = [
    ("AUTH-1", "M-1", "PR-1", "70002", date(2026, 1, 1), date(2026, 12, 31), "approved"),
    ("AUTH-2", "M-1", "PR-2", "70002", date(2026, 1, 1), date(2026, 12, 31), "DENIED"),
]


def claim_inputs(spark, documents=None) -> dict:
    rows = {
        "ocr_documents": documents or noise_documents() + duplicate_documents(),
        "policy": POLICIES,
        "member": MEMBERS,
        "provider": PROVIDERS,
        "plan_coverage": PLAN_COVERAGE,
        "claim_history": HISTORY,
        "pre_authorization": AUTHORIZATIONS,
    }
    return {name: spark.createDataFrame(data, INPUTS[name]) for name, data in rows.items()}
