"""Column-expression helpers. All return native Spark ``Column`` objects, so
they stay inside whole-stage codegen; none is a Python UDF."""

from cartscope.functions.calendar import dow_name
from cartscope.functions.coerce import (
    safe_float, safe_int, strict_int, strict_float, variant_field, json_text,
)
from cartscope.functions.rounding import half_even, rate_pct, ratio_pct
from cartscope.functions.text import clean_field, clean_text

__all__ = [
    "dow_name", "safe_float", "safe_int", "strict_int", "strict_float", "variant_field",
    "json_text", "half_even", "rate_pct", "ratio_pct", "clean_field", "clean_text",
]
