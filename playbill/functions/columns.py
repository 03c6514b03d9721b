"""Column expressions used by the cleaners and marts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from playbill.schemas import UNKNOWN


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_int(col: Column | str, truncate: bool = False) -> Column:
    """Text to int; unreadable text becomes NULL instead of failing the job.

    With ``truncate`` a decimal such as ``12.7`` reads as 12, as it does when
    ANSI mode is off; without it such text is unreadable.
    """
    text = _col(col)
    if truncate:
        text = F.regexp_replace(text, r"^(\s*[+-]?\d+)\.\d*\s*$", "$1")
    return text.try_cast("int")


def decade(year: Column | str) -> Column:
    """First year of the decade as text, ``unknown`` for a NULL year."""
    y = _col(year).cast("bigint")
    return F.coalesce((y - F.pmod(y, F.lit(10))).cast("string"), F.lit(UNKNOWN))


def split_list(col: Column | str, sep: str = ",") -> Column:
    """Text list to array; NULL gives an empty array. ``sep`` is a regex."""
    return F.coalesce(F.split(_col(col), sep), F.array().cast("array<string>"))


def first_of(array: Column | str) -> Column:
    """First element, or NULL for an empty array."""
    return F.try_element_at(_col(array), F.lit(1))


def first_known(
    *cols: Column | str, missing: str | None = None, default: str = UNKNOWN
) -> Column:
    """First non-NULL of ``cols``, else ``default``.

    Values equal to ``missing`` count as NULL too.
    """
    known = [_col(c) for c in cols]
    if missing is not None:
        known = [F.nullif(c, F.lit(missing)) for c in known]
    return F.coalesce(*known, F.lit(default))
