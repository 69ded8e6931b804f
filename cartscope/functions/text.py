"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every code point Python's str.strip() removes (str.isspace()), derived by rule.
PY_WHITESPACE = "".join(ch for ch in map(chr, range(0x110000)) if ch.isspace())


def clean_text(c: Column | str) -> Column:
    """Strip Unicode whitespace at both ends, as Python ``str.strip()`` does.

    Spark's ``trim()`` removes spaces only, so the character set is explicit.
    """
    col = F.col(c) if isinstance(c, str) else c
    return F.btrim(col, F.lit(PY_WHITESPACE))


def clean_field(c: Column | str) -> Column:
    """``clean_text`` of a column at hand, which is read several times.

    ``btrim`` compares both ends with each character of the set, so it is left out where
    the first and the last character lie from ``!`` to U+007F, where no whitespace is.
    """
    col = F.col(c) if isinstance(c, str) else c
    last = F.substring(col, -1, 1)
    plain = (col >= "!") & (col < "\u0080") & (last >= "!") & (last < "\u0080")
    return F.when(plain, col).otherwise(clean_text(col))
