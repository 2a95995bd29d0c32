"""Declared layout of a usage record file."""

from __future__ import annotations

from pyspark.sql.types import DoubleType, StringType, StructField, StructType

# The 16 input columns in file order. Files are bound by position.
CDR_COLUMNS = [
    "ROAMSTATE_519",
    "CUST_LOCAL_START_DATE_15",
    "CDR_ID_1",
    "CDR_SUB_ID_2",
    "CDR_TYPE_3",
    "SPLIT_CDR_REASON_4",
    "RECORD_DATE",
    "PAYTYPE_515",
    "DEBIT_AMOUNT_42",
    "SERVICEFLOW_498",
    "EVENTSOURCE_CATE_17",
    "USAGE_SERVICE_TYPE_19",
    "SPECIALNUMBERINDICATOR_534",
    "BE_ID_30",
    "CALLEDPARTYIMSI_495",
    "CALLINGPARTYIMSI_494",
]
DOUBLE_COLUMNS = {"DEBIT_AMOUNT_42", "SPECIALNUMBERINDICATOR_534", "BE_ID_30"}

CDR_SCHEMA = StructType(
    [StructField(name, DoubleType() if name in DOUBLE_COLUMNS else StringType()) for name in CDR_COLUMNS]
)
