"""Codes of the source systems that results depend on."""

# Fixed value: client of the ledger flow.
LEDGER_CLIENT = "110"

# Inclusive account range of the ledger flow, compared as text.
ACCOUNT_RANGE = ("0006000000", "0009999999")

# Document types and transaction codes of relevant headers.
DOCUMENT_TYPES = ("HC", "HF")
TRANSACTION_CODES = ("/DS1/HM_C_DAILY_T", "FB08")

# Fixed value: unit of measure kept from the second-quantity table.
VOLUME_UNIT = "L15"

# Client of each general-ledger source.
SOURCE_CLIENTS = {"STN": "280", "TSAP": "480"}

# System code by environment and source.
SYSTEM_CODES = {
    "dev": {"STN": "D80", "TSAP": "D81", "GSAP": "D94"},
    "tst": {"STN": "A80", "TSAP": "T81", "GSAP": "C94"},
    "pre": {"STN": "B80", "TSAP": "Q81", "GSAP": "Z94"},
    "prd": {"STN": "P80", "TSAP": "P81", "GSAP": "P94"},
}

# Movement type to label; any other type has an empty label.
MOVEMENT_LABELS = {
    "551": "Scrapping",
    "552": "Scrapping",
    "701": "Warehouse Gains & losses",
    "702": "Warehouse Gains & losses",
    "951": "InTransit Gains & losses",
    "952": "InTransit Gains & losses",
    "Y51": "Tank Level Gains & losses",
    "Y52": "Tank Level Gains & losses",
}

# Debit indicator, delete action, update action.
DEBIT = "S"
DELETED = "D"
UPDATED = "U"


def system_code(environment: str, source: str) -> str:
    """System code of a source in an environment; unknown names are an error."""
    try:
        return SYSTEM_CODES[environment][source]
    except KeyError:
        raise ValueError(f"no system code for {source!r} in environment {environment!r}") from None
