"""Closed-form encodings: the label sets are part of the data contract."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ordinal positions of closed label sets.
GRADES = {"A": 1, "B": 2, "C": 3, "D": 4, "E": 5, "F": 6, "G": 7}
VERIFICATION = {"Not Verified": 0, "Source Verified": 1, "Verified": 2}
HOME_OWNERSHIP = {"MORTGAGE": 3, "OWN": 2, "RENT": 1, "OTHER": 0, "NONE": 0, "ANY": 0}

# What scoring uses when a label is not in its set.
SERVING_FALLBACK = {"grade": 4, "sub_grade": 18, "verification_status": 0, "home_ownership": 0}

# Label that turns each binary flag on.
FLAG_VALUES = {
    "initial_list_status": ("initial_list_status_enc", "w"),
    "application_type": ("application_type_joint", "Joint App"),
    "disbursement_method": ("disbursement_direct", "DirectPay"),
}


def label_value(cell: Column, table: dict[str, int], fallback: float | None = None) -> Column:
    """Look a label up in a closed set; an unknown label gives ``fallback``."""
    pairs = [F.lit(part) for item in table.items() for part in item]
    found = F.try_element_at(F.create_map(*pairs), cell).cast("double")
    return found if fallback is None else F.coalesce(found, F.lit(float(fallback)))


def grade_value(cell: Column, fallback: float | None = None) -> Column:
    return label_value(cell, GRADES, fallback)


def sub_grade_value(cell: Column, fallback: float | None = None) -> Column:
    """A1..G5 -> 1..35, computed from the two characters."""
    letter = F.ascii(F.substring(cell, 1, 1)) - F.lit(ord("A"))
    digit = F.substring(cell, 2, 1).try_cast("int")
    found = F.when(cell.rlike("^[A-G][1-5]$"), letter * 5 + digit).cast("double")
    return found if fallback is None else F.coalesce(found, F.lit(float(fallback)))


def verification_value(cell: Column, fallback: float | None = None) -> Column:
    return label_value(cell, VERIFICATION, fallback)


def home_ownership_value(cell: Column) -> Column:
    return label_value(cell, HOME_OWNERSHIP, 0)


def flag(cell: Column, value: str | float) -> Column:
    """1.0 when equal, else 0.0; a missing cell counts as not equal."""
    return F.coalesce(cell == F.lit(value), F.lit(False)).cast("double")
