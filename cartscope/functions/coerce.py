"""Typed extraction from VARIANT payload fields.

Two coercion regimes, one per flatten mode:

* lenient (``safe_int`` / ``safe_float``) behaves like Python ``int()`` /
  ``float()`` with a default: ``12``, ``"12"``, ``" 12 "`` -> 12; ``1.7`` -> 1;
  ``true`` -> 1; ``"1.7"``, ``"x"``, null, missing -> default. NaN becomes NULL.
* strict (``strict_int`` / ``strict_float``) accepts only values that are an
  integer (resp. a number) in their JSON text: ``"2"`` -> 2, but ``1.7``,
  ``"1.7"`` and ``true`` are invalid. The caller routes invalid rows to rejects.

All of these are native expressions over the VARIANT binary; no Python runs
per row. They are the column-level API (one path lookup each); the flatten
operator applies the same rules in bulk, casting each document's orders once
to a struct type (``operators.normalize``), which is the same conversion.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def variant_field(v: Column, path: str) -> Column:
    """Sub-variant at ``path`` (NULL when the key is missing)."""
    return F.try_variant_get(v, path, "variant")


def is_missing(v: Column, path: str) -> Column:
    return variant_field(v, path).isNull()


def is_json_null(v: Column, path: str) -> Column:
    return F.coalesce(F.is_variant_null(variant_field(v, path)), F.lit(False))


def is_absent(v: Column, path: str) -> Column:
    """Missing key or explicit JSON null."""
    f = variant_field(v, path)
    return f.isNull() | F.is_variant_null(f)


def json_text(v: Column, path: str) -> Column:
    """The field rendered as a string (numbers/booleans as their JSON text)."""
    return F.try_variant_get(v, path, "string")


def safe_int(v: Column, path: str, default: int | None = 0) -> Column:
    """Python ``int(value)`` with a default on failure."""
    typed = F.try_variant_get(v, path, "bigint")
    return typed if default is None else F.coalesce(typed, F.lit(default).cast("bigint"))


def safe_float(v: Column, path: str) -> Column:
    """Python ``float(value)``; None/unparsable -> NULL, and NaN -> NULL too."""
    d = F.try_variant_get(v, path, "double")
    return F.when(F.isnan(d), F.lit(None).cast("double")).otherwise(d)


def strict_int(v: Column, path: str) -> Column:
    """Integer only if the JSON text is an integer: ``2``/``"2"`` yes, ``1.7``/``true`` no."""
    return _try_cast(json_text(v, path), "bigint")


def strict_float(v: Column, path: str) -> Column:
    """Number only if the JSON text parses as one; NaN -> NULL."""
    d = _try_cast(json_text(v, path), "double")
    return F.when(F.isnan(d), F.lit(None).cast("double")).otherwise(d)


def _try_cast(c: Column, to: str) -> Column:
    return c.try_cast(to)


def invalid(v: Column, path: str, typed: Column) -> Column:
    """Present, not JSON null, yet not convertible."""
    f = variant_field(v, path)
    return f.isNotNull() & ~F.is_variant_null(f) & typed.isNull()
