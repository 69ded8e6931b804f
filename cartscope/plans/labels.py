"""Verbatim dashboard labels for the KPI cards and dashboard series."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cartscope.schema import LABELS, snake


def with_labels(df: DataFrame, query_id: str) -> DataFrame:
    """Rename snake_case columns to the labels the dashboard shows."""
    labels = LABELS[query_id]
    mapping = {snake(lab): lab for lab in labels}
    return df.toDF(*[mapping.get(c, c) for c in df.columns])
