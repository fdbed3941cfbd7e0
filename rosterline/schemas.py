"""Declared schemas. Every field is nullable."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# The external column names and types of the stored tables.
MAX_STRIKES = 10
STRIKE_FACTOR = "0.9"
FLAG_DAYS = 30
ACTIVE = "ACTIVE"
INACTIVE = "INACTIVE"
CANCELLED = "CANCELLED"


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


EMPLOYEE = _struct(name=StringType(), age=IntegerType(), emp_id=LongType())

TIMEFRAME_RAW = _struct(
    emp_id=StringType(),
    designation=StringType(),
    start_date=DoubleType(),
    end_date=DoubleType(),
    salary=DoubleType(),
)

TIMEFRAME = _struct(
    emp_id=StringType(),
    designation=StringType(),
    start_date=DateType(),
    end_date=DateType(),
    salary=DoubleType(),
    status=StringType(),
)

STRUCK_OUT = _struct(employee_id=StringType())

CALENDAR = _struct(reason=StringType(), date=TimestampType())

LEAVE_RAW = _struct(emp_id=StringType(), date=DateType(), status=StringType())

LEAVE = _struct(
    emp_id=StringType(),
    date=DateType(),
    status=StringType(),
    ingest_date=StringType(),
    ingest_timestamp=TimestampType(),
)

QUOTA = _struct(emp_id=IntegerType(), leave_quota=IntegerType(), year=IntegerType())

ALERTED = _struct(emp_id=StringType())

FLAGGED = _struct(employee_id=StringType(), start_date=TimestampType())

MESSAGE = _struct(sender=StringType(), receiver=StringType(), message=StringType())


def rung_names(n: int = MAX_STRIKES) -> list[str]:
    return [f"strike_{i}" for i in range(1, n + 1)]


def strikes(n: int = MAX_STRIKES) -> StructType:
    """employee_id, salary, strike_1 .. strike_n, no_of_strikes."""
    fields = {"employee_id": StringType(), "salary": DoubleType()}
    fields.update({name: FloatType() for name in rung_names(n)})
    fields["no_of_strikes"] = IntegerType()
    return _struct(**fields)
