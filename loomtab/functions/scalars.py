"""Column helpers: text normalising, safe arithmetic, dates by boundaries, URLs, distances, keys.

All lower to built-in expressions, so they stay inside generated code.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts that mean a missing title.
MISSING_TEXTS = ["", "NULL", "null", "N/A", "n/a"]
#: What a surrogate key writes for NULL, the earth's radius in miles, and kilometres in a mile.
KEY_NULL = "_dbt_utils_surrogate_key_null_"
EARTH_MILES, KM_IN_MILE = 3961, 1.60934
#: What a URL's host may be preceded by.
SCHEMES = ["android-app://", "http://", "https://"]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# text


def trim_lower(c: Column | str) -> Column:
    return F.lower(F.trim(_col(c).cast("string")))


def collapse_spaces(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), r"\s+", " ")


def missing_to_null(c: Column | str, texts: list[str] = MISSING_TEXTS) -> Column:
    """NULL where the trimmed text is one of `texts`; otherwise the text as it was."""
    return F.when(~F.trim(_col(c)).isin(texts), _col(c))


def upper_domain(c: Column | str) -> Column:
    """DOMAIN\\login with the part before the first backslash in upper case; a third part is lost."""
    c = _col(c)
    two = F.concat(F.upper(F.split_part(c, F.lit("\\"), F.lit(1))), F.lit("\\"), F.split_part(c, F.lit("\\"), F.lit(2)))
    return F.when(F.instr(c, "\\") > 0, two).otherwise(c)


def snake_case(c: Column | str) -> Column:
    """Runs of other characters become one underscore; none at either end."""
    return F.lower(F.trim(F.regexp_replace(_col(c), "[^A-Za-z0-9]+", "_"), F.lit("_")))


# arithmetic


def safe_add(*columns: Column | str) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(_col(c), F.lit(0)) for c in columns])


def safe_subtract(*columns: Column | str) -> Column:
    return reduce(lambda a, b: a - b, [F.coalesce(_col(c), F.lit(0)) for c in columns])


def safe_divide(n: Column | str, d: Column | str) -> Column:
    return F.try_divide(_col(n), _col(d))


def width_bucket(x: Column | str, low: float, high: float, n: int, legacy: bool = False) -> Column:
    """The built-in, or with legacy=True the older rule: on a multiple of the bin width one more, and no lower limit."""
    x = _col(x)
    if not legacy:
        return F.width_bucket(x, F.lit(float(low)), F.lit(float(high)), F.lit(n))
    size = (high - low) / n
    return (F.when(x % size == 0, 1).otherwise(0) + F.least(F.ceil((x - low) / size), F.lit(n + 1))).cast("long")



def mean(total: Column, count: Column, digits: int, unit: int = 1) -> Column:
    """A mean from whole sums, total / count / unit, that no order of addition can change."""
    scale = float(10**digits)
    return F.floor(total * F.lit(scale) / (F.nullif(count, F.lit(0)) * unit) + F.lit(0.5)) / F.lit(scale)


def avg_hours(minutes: Column, digits: int = 2) -> Column:
    """The mean of whole minutes, in hours."""
    return mean(F.sum(minutes), F.count(minutes), digits, 60)


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return mean(part * 100, whole, digits)


# dates


def date_diff(part: str, a: Column | str, b: Column | str) -> Column:
    """How many boundaries of `part` lie between a and b (00:59 to 01:01 is one hour)."""
    a, b = _col(a), _col(b)
    if part == "day":
        return F.datediff(b, a).cast("long")
    return F.timestamp_diff(part.upper(), F.date_trunc(part, a), F.date_trunc(part, b))


def hours_of(minutes: Column) -> Column:
    return F.round(minutes / F.lit(60.0), 2)


# URLs


def url_host(u: Column | str) -> Column:
    rest = reduce(lambda c, s: F.replace(c, F.lit(s), F.lit("")), SCHEMES, _col(u))
    return F.split_part(F.split_part(rest, F.lit("/"), F.lit(1)), F.lit("?"), F.lit(1))


def url_path(u: Column | str) -> Column:
    """From after the first slash (or to the end where there is none but a question mark) up to the question mark."""
    rest = reduce(lambda c, s: F.replace(c, F.lit(s), F.lit("")), SCHEMES[1:], _col(u))
    slash = F.coalesce(F.nullif(F.instr(rest, "/"), F.lit(0)), F.instr(rest, "?") - 1)
    tail = F.when(F.length(rest) - slash == 0, "").otherwise(F.right(rest, F.length(rest) - slash))
    return F.split_part(tail, F.lit("?"), F.lit(1))


def url_parameter(u: Column | str, name: str) -> Column:
    return F.nullif(F.split_part(F.split_part(_col(u), F.lit(f"{name}="), F.lit(2)), F.lit("&"), F.lit(1)), F.lit(""))


# geography and keys


def haversine(lat1: Column | str, lon1: Column | str, lat2: Column | str, lon2: Column | str, unit: str = "mi") -> Column:
    if unit not in ("mi", "km"):
        raise ValueError(f"unit is mi or km, not {unit!r}")
    a, b, c, d = (F.radians(_col(x)) for x in (lat1, lon1, lat2, lon2))
    h = F.pow(F.sin((c - a) / 2), 2) + F.cos(a) * F.cos(c) * F.pow(F.sin((d - b) / 2), 2)
    return 2 * EARTH_MILES * F.asin(F.sqrt(h)) * (KM_IN_MILE if unit == "km" else 1)


def surrogate_key(*columns: Column | str, nulls_as_empty: bool = False) -> Column:
    none = F.lit("" if nulls_as_empty else KEY_NULL)
    return F.md5(F.concat_ws("-", *[F.coalesce(_col(c).cast("string"), none) for c in columns]))
