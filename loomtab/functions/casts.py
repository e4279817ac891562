"""Casts from text that never fail, with one meaning in every engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The five kinds of columns, and the texts of true and false.
KINDS: dict[str, T.DataType] = {"int64": T.LongType(), "float64": T.DoubleType(), "datetime64": T.TimestampNTZType(), "bool": T.BooleanType(), "string": T.StringType()}
TRUE_TEXTS, FALSE_TEXTS = ["true", "1", "yes"], ["false", "0", "no"]

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_SUFFIX = r"[dDfF]$"
_INFINITE = r"(?i)^[+-]?inf$"
#: All that the engine can read as a whole number, and as a double. A cast of a text of another form was measured to be slow (an exception inside, as it seems), so none is tried.
_WHOLE = r"^[\x00-\x20\x7f]*[+-]?[0-9]+[\x00-\x20\x7f]*$"
_DOUBLE = r"(?i)^[\x00-\x20]*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|0x[0-9a-f]*\.?[0-9a-f]*p[+-]?\d+|nan|inf(inity)?)[df]?[\x00-\x20]*$"
_DATE = r"^\d{4}[-/]\d{1,2}[-/]\d{1,2}([ T]\d{1,2}:\d{1,2}.*)?$"


def kind_type(kind: str | None) -> T.DataType:
    """An unknown or missing kind is text."""
    return KINDS.get(kind or "string", KINDS["string"])


def null_strings(c: Column, texts: list[str] | None = None) -> Column:
    """The trimmed text, or NULL if it is empty or one of `texts`."""
    t = F.trim(c.cast("string"))
    return F.when(~t.isin([*(texts or []), ""]), t)


def to_int64(t: Column) -> Column:
    rounded = F.round(t.try_cast(T.DecimalType(38, 10)), 0).try_cast("bigint")
    return F.coalesce(F.when(t.rlike(_WHOLE), t.try_cast("bigint")), F.when(t.rlike(_NUMBER), rounded))


def to_float64(t: Column) -> Column:
    return F.when(t.rlike(_DOUBLE) & (~t.rlike(_SUFFIX) | t.rlike(_INFINITE)), t.try_cast("double"))


def to_datetime64(t: Column) -> Column:
    return F.when(t.rlike(_DATE), F.replace(t, F.lit("/"), F.lit("-")).try_cast("timestamp_ntz"))


def to_bool(t: Column) -> Column:
    low = F.lower(t)
    return F.when(low.isin(TRUE_TEXTS), True).when(low.isin(FALSE_TEXTS), False)


def try_cast(c: Column, kind: str | None, texts: list[str] | None = None) -> Column:
    """The value as `kind`, NULL where it cannot be read as such. Text is neither trimmed nor mapped to NULL."""
    if kind not in ("int64", "float64", "datetime64", "bool"):
        return c.cast("string")
    return {"int64": to_int64, "float64": to_float64, "datetime64": to_datetime64, "bool": to_bool}[kind](null_strings(c, texts))
