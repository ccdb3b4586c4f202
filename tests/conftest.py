from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from compare import session  # noqa: E402

from tidemark.roles import TELECOM, Roles  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return session()


def _customer(key, tenure, monthly, total, churn, **other):
    row = dict(
        customerID=key, gender="Male", SeniorCitizen=0, Partner="No", Dependents="No", tenure=tenure,
        PhoneService="Yes", MultipleLines="No", InternetService="DSL", OnlineSecurity="No", OnlineBackup="No",
        DeviceProtection="No", TechSupport="No", StreamingTV="No", StreamingMovies="No", Contract="Month-to-month",
        PaperlessBilling="Yes", PaymentMethod="Electronic check", MonthlyCharges=monthly, TotalCharges=total, Churn=churn,
    )
    row.update(other)
    return row


_FIBRE = dict(InternetService="Fiber optic")
_NO_NET = dict(
    InternetService="No",
    **{c: "No internet service" for c in ("OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies")},
)

EIGHT = [
    _customer("A", 2, 31.0, "62.0", "Yes"),
    _customer("B", 3, 96.0, "288.0", "Yes", **_FIBRE, StreamingTV="Yes", SeniorCitizen=1),
    _customer("C", 10, 48.0, "480.0", "No", Contract="One year", PaymentMethod="Mailed check", PaperlessBilling="No", Partner="Yes", OnlineSecurity="Yes"),
    _customer("D", 20, 22.0, "440.0", "No", **_NO_NET, Contract="Two year", PaymentMethod="Bank transfer (automatic)", Partner="Yes", Dependents="Yes"),
    _customer("E", 30, 76.0, "2280.0", "Yes", Contract="One year", OnlineSecurity="Yes", TechSupport="Yes", StreamingTV="Yes", StreamingMovies="Yes", PaymentMethod="Credit card (automatic)"),
    _customer("F", 44, 88.0, "3872.0", "Yes", **_FIBRE, MultipleLines="Yes", OnlineBackup="Yes"),
    _customer("G", 58, 104.0, "6032.0", "No", **_FIBRE, Contract="Two year", MultipleLines="Yes", OnlineSecurity="Yes", DeviceProtection="Yes", TechSupport="Yes", StreamingTV="Yes", StreamingMovies="Yes"),
    _customer("H", 70, 37.0, "2590.0", "No", Contract="Two year", Dependents="Yes", PaymentMethod="Mailed check"),
]
EDGES = [
    _customer("I", 0, 40.0, " ", "No"),
    _customer("J", 5, 40.0, " ", "No"),
    _customer("K", 80, 40.0, "3200.0", "No"),
    _customer("L", 10, 40.0, "900.0", "No", Contract=None, InternetService=None, PaymentMethod=None, OnlineSecurity=None, StreamingTV=None),
    _customer("M", 10, 40.0, "400.0", "No", Contract="Five year", InternetService="Cable", PaymentMethod="Coins"),
]


@pytest.fixture(scope="session")
def roles() -> Roles:
    return TELECOM


def _frame(spark, rows):
    types = {"SeniorCitizen": "int", "tenure": "int", "MonthlyCharges": "double"}
    schema = ", ".join(f"{c} {types.get(c, 'string')}" for c in rows[0])
    return spark.createDataFrame([tuple(r.values()) for r in rows], schema)


@pytest.fixture(scope="session")
def eight(spark):
    return _frame(spark, EIGHT)


@pytest.fixture(scope="session")
def edges(spark):
    return _frame(spark, EDGES)
