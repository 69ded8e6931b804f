"""Day-of-week naming."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartscope.schema import DOW_NAMES, UNKNOWN_DAY


def dow_name(dow: Column | str) -> Column:
    """Day index (0 = Sunday) -> English name; a null or unknown index -> ``Unknown``."""
    c = F.col(dow) if isinstance(dow, str) else dow
    pairs = []
    for i, name in enumerate(DOW_NAMES):
        pairs += [F.lit(i), F.lit(name)]
    names = F.create_map(*pairs)
    return F.coalesce(F.try_element_at(names, c.cast("int")), F.lit(UNKNOWN_DAY))
