"""Reading of text tokens as numbers; a bad token gives NULL, not a failed job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank(name: str) -> Column:
    return F.coalesce(F.trim(F.col(name)) == "", F.lit(True))


def parse_token(name: str, kind: str) -> Column:
    """``kind`` is ``port`` (decimal, or hexadecimal after ``0x``), ``int``, ``bigint`` or ``double``."""
    token = F.trim(F.col(name))
    if kind != "port":
        return token.try_cast(kind)
    hexadecimal = F.lower(token)
    digits = F.regexp_replace(hexadecimal, "^0x0*", "")
    # more than 16 hexadecimal digits do not fit a bigint and would overflow conv
    value = F.when(F.length(digits) == 0, F.lit(0).cast("bigint")).when(
        F.length(digits) <= 16, F.conv(digits, 16, 10).try_cast("bigint")
    )
    return F.when(hexadecimal.rlike("^0x[0-9a-f]+$"), value).otherwise(token.try_cast("bigint"))


def plain_text(name: str) -> Column:
    """Trimmed lower-case text with blank as NULL."""
    return F.nullif(F.lower(F.trim(F.col(name))), F.lit(""))
