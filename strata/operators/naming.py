"""Column-name normalisation for raw headers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def clean_name(name: str) -> str:
    """Space and hyphen become underscore; nothing else changes."""
    return name.replace(" ", "_").replace("-", "_")


def clean_column_names(df: DataFrame) -> DataFrame:
    """Rename every column with ``clean_name`` in one projection.

    Two raw names that clean to the same name ('a b' and 'a-b') would give a
    frame with an ambiguous column, so that is refused up front.
    """
    new = [clean_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, cleaned in zip(df.columns, new):
        key = cleaned.lower()  # Spark resolves names case-insensitively by default
        if key in seen:
            raise ValueError(
                f"column names {seen[key]!r} and {old!r} both clean to {cleaned!r}")
        seen[key] = old
    if new == df.columns:
        return df
    return df.toDF(*new)
