"""Date expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

A_MONDAY = date(1970, 1, 5)


def parse_date(column: str) -> Column:
    """Date of a text, date or timestamp column; NULL where the text is no date."""
    return F.expr(f"try_cast(`{column}` AS date)")


def monday_number(day: Column) -> Column:
    """Count of Mondays up to ``day``; equal for the days of one ISO week."""
    return F.floor(F.datediff(day, F.lit(A_MONDAY)) / 7).cast("int")

