"""Canonical schemas of the five sources and the two reports.

Names follow the source DDL; keys are INT at the source and BIGINT in the
reports, money is DECIMAL(15,2) at the source and DOUBLE in the summary.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

MONEY = DecimalType(15, 2)


def _struct(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


CUSTOMER = _struct(
    ("CUSTOMER_ID", IntegerType()),
    ("NAME", StringType()),
    ("EMAIL", StringType()),
    ("PHONE", StringType()),
    ("ADDRESS", StringType()),
    ("CREATED_DATE", DateType()),
)

BRANCH = _struct(
    ("BRANCH_ID", IntegerType()),
    ("BRANCH_NAME", StringType()),
    ("BRANCH_CODE", StringType()),
    ("CITY", StringType()),
    ("STATE", StringType()),
    ("COUNTRY", StringType()),
)

ACCOUNT = _struct(
    ("ACCOUNT_ID", IntegerType()),
    ("CUSTOMER_ID", IntegerType()),
    ("BRANCH_ID", IntegerType()),
    ("ACCOUNT_NUMBER", StringType()),
    ("ACCOUNT_TYPE", StringType()),
    ("BALANCE", MONEY),
    ("OPENED_DATE", DateType()),
)

TRANSACTION = _struct(
    ("TRANSACTION_ID", IntegerType()),
    ("ACCOUNT_ID", IntegerType()),
    ("TRANSACTION_TYPE", StringType()),
    ("AMOUNT", MONEY),
    ("TRANSACTION_DATE", DateType()),
    ("DESCRIPTION", StringType()),
)

BRANCH_OPERATIONAL_DETAILS = _struct(
    ("BRANCH_ID", IntegerType()),
    ("REGION", StringType()),
    ("MANAGER_NAME", StringType()),
    ("LAST_AUDIT_DATE", DateType()),
    ("IS_ACTIVE", StringType()),
)

# Report layouts, in output order.
AML_COLUMNS = [
    "CUSTOMER_ID",
    "NAME",
    "ACCOUNT_ID",
    "TRANSACTION_ID",
    "AMOUNT",
    "TRANSACTION_TYPE",
    "TRANSACTION_DATE",
]

BRANCH_SUMMARY_V1 = _struct(
    ("BRANCH_ID", LongType()),
    ("BRANCH_NAME", StringType()),
    ("TOTAL_TRANSACTIONS", LongType()),
    ("TOTAL_AMOUNT", DoubleType()),
)

BRANCH_SUMMARY_V2 = StructType(
    BRANCH_SUMMARY_V1.fields
    + [
        StructField("REGION", StringType(), True),
        StructField("LAST_AUDIT_DATE", StringType(), True),
    ]
)

# NOT NULL columns of the source DDL (Q13).
REQUIRED_COLUMNS = {
    "CUSTOMER": ["NAME"],
    "BRANCH": ["BRANCH_NAME"],
    "TRANSACTION": ["TRANSACTION_TYPE", "AMOUNT"],
    "BRANCH_OPERATIONAL_DETAILS": ["REGION"],
}

SOURCES = {
    "CUSTOMER": CUSTOMER,
    "BRANCH": BRANCH,
    "ACCOUNT": ACCOUNT,
    "TRANSACTION": TRANSACTION,
    "BRANCH_OPERATIONAL_DETAILS": BRANCH_OPERATIONAL_DETAILS,
}

# Defaults of the source DDL.
DEFAULTS = {
    "CUSTOMER": {"CREATED_DATE": "CURRENT_DATE"},
    "ACCOUNT": {"BALANCE": "0", "OPENED_DATE": "CURRENT_DATE"},
    "TRANSACTION": {"TRANSACTION_DATE": "CURRENT_DATE"},
    "BRANCH_OPERATIONAL_DETAILS": {"IS_ACTIVE": "'Y'"},
}

# Value rules of the specification (Q7), as conditions that rows must not fail.
CHECKS = {"BRANCH_OPERATIONAL_DETAILS": {"IS_ACTIVE_domain": "IS_ACTIVE IN ('Y', 'N')"}}


def ddl(schema: StructType) -> str:
    """Column list of ``schema`` as SQL DDL text: ``A BIGINT, B STRING``."""
    return ", ".join(f"{f.name} {f.dataType.simpleString().upper()}" for f in schema.fields)
