"""The edge rows of the two feeds, as JSON lines, with their models and suites."""

from __future__ import annotations

import json

from feedquality.model import TableModel
from feedquality.plans.queries import PURCHASE_MODEL, USER_MODEL, purchase_suite, user_suite


def _address(city, state):
    return {"city": city, "state": state}


USERS = [
    {"user_id": "U01", "user_name": "Ann", "user_phno": "555", "user_address": _address("Pune", "MH")},
    {"user_id": "U02", "user_name": "Bo", "user_phno": None, "user_address": _address("Pune", "MH")},
    {"user_id": "U03", "user_name": "Cy", "user_phno": "556", "user_address": _address("Goa", "GA")},
    {"user_id": "U04", "user_name": "Di", "user_phno": "557", "user_address": None},
    {"user_id": None, "user_name": "Ed", "user_phno": "558", "user_address": _address("Goa", "GA")},
    {"user_id": "U0005", "user_name": "Fay", "user_phno": "559", "user_address": _address("Goa", "GA")},
    {"user_id": "U06", "user_name": "Gil", "user_phno": "560", "user_address": _address(None, "GA")},
]


def _purchase(date, user, product, quantity):
    return {"Date": date, "user_id": user, "Product_Name": product, "Quantity": quantity,
            "Unit_Price": "10.5", "Total_Sale_Amount": "21.0"}


PURCHASES = [
    _purchase("2024-11-01", "U01", "pen", 2),
    _purchase("2024-11-01", "U01", "ink", 3),
    _purchase("2024-11-02", "U02", "pen", 5),
    _purchase("2024-11-02", "U99", "pen", 7),
    _purchase("2024-11-03", None, "pen", 1),
    _purchase("2024-11-03", "U02", "pen", None),
    _purchase("2024-11-03", "U0005", "pen", 4),
]


def write_lines(path, rows) -> str:
    path.write_text("".join(json.dumps(r) + "\n" for r in rows), encoding="utf-8")
    return str(path)


def models() -> tuple[TableModel, TableModel]:
    return TableModel.from_json(USER_MODEL, "users"), TableModel.from_json(PURCHASE_MODEL, "purchase")


def suites():
    return user_suite(3), purchase_suite(3)


def frame(spark, rows, model):
    """Rows as a table of ``model``'s type."""
    return spark.createDataFrame(rows, model.schema)
