"""Per-field cleaning rules: station key, gender, age, age group, percentages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import AGE_BANDS, AGE_TOP, AGE_UNDER, AGE_UNKNOWN, GENDER_CODES, GENDER_UNKNOWN
from .text import try_cast, col_of, py_strip

INT_MIN = -(2**31)
INT_MAX = 2**31 - 1


def station_key(c: str | Column) -> Column:
    """Normalised station number used for every station match.

    null -> ""; strip; drop one trailing ".0"; all ASCII digits -> leading zeros removed
    (``000`` -> ``0``); anything else unchanged (``390-391``).
    """
    t = F.regexp_replace(py_strip(F.coalesce(col_of(c), F.lit(""))), r"\.0$", "")
    return F.when(t.rlike(r"^[0-9]+$"), F.regexp_replace(t, r"^0+(?=[0-9])", "")).otherwise(t)


def gender(c: str | Column) -> Column:
    """null -> ?; strip + upper; keep M F O ?; anything else -> ?."""
    g = F.upper(py_strip(col_of(c)))
    return F.when(g.isin(GENDER_CODES), g).otherwise(F.lit(GENDER_UNKNOWN))


def raw_gender(c: str | Column) -> Column:
    """Gender as the validation report counts it: missing -> ?, stripped, case kept."""
    return py_strip(F.coalesce(col_of(c), F.lit(GENDER_UNKNOWN)))


# Numbers as text readers accept them: no type suffixes such as 34d or 34f.
NUMBER_RE = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def age(c: str | Column) -> Column:
    """Numeric coercion to a nullable int: ``34``, ``34.0``, `` 34 ``, ``1e2`` parse.

    Text that is not a number is null. Non-integral, infinite or out-of-int-range numbers are
    also null (deliberate: the source aborts the whole load on them).
    """
    text = col_of(c)
    d = F.when(text.cast("string").rlike(NUMBER_RE), try_cast(text, "double"))
    return F.when(d.between(float(INT_MIN), float(INT_MAX)) & (d == F.rint(d)), d.cast("int"))


def age_group(c: str | Column) -> Column:
    """Age band label; null -> Unknown."""
    a = col_of(c)
    label = F.when(a.isNull(), F.lit(AGE_UNKNOWN)).when(a < AGE_UNDER[1], F.lit(AGE_UNDER[0]))
    for name, lo, hi in AGE_BANDS:
        label = label.when(a.between(lo, hi), F.lit(name))
    return label.otherwise(F.lit(AGE_TOP))


def percentage(part: str | Column, whole: str | Column) -> Column:
    """part / whole * 100, and 0 when whole is 0."""
    return F.coalesce(F.try_divide(col_of(part), col_of(whole)) * F.lit(100.0), F.lit(0.0))
