"""The five source tables."""

from __future__ import annotations

# Tables, their files and the columns each must have.
RAW_FILES = {
    "train": "train.csv",
    "stores": "stores.csv",
    "transactions": "transactions.csv",
    "oil": "oil.csv",
    "holidays": "holidays_events.csv",
}
EXPECTED_TYPES = {
    "train": {
        "id": "bigint",
        "date": "date",
        "store_nbr": "int",
        "family": "string",
        "sales": "double",
        "onpromotion": "int",
    },
    "stores": {
        "store_nbr": "int",
        "city": "string",
        "state": "string",
        "type": "string",
        "cluster": "int",
    },
    "transactions": {"date": "date", "store_nbr": "int", "transactions": "bigint"},
    "oil": {"date": "date", "dcoilwtico": "double"},
    "holidays": {
        "date": "date",
        "type": "string",
        "locale": "string",
        "locale_name": "string",
        "description": "string",
        "transferred": "boolean",
    },
}

# Technical keys that do not count when rows are compared.
TECHNICAL_KEYS = {"train": ("id",)}
