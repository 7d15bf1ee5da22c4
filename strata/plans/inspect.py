"""Read a DataFrame's physical plan as text (for tests and tuning)."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def physical_plan(df: DataFrame) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def operator_count(plan: str, operator: str) -> int:
    """Occurrences of ``operator`` as a node in the plan tree (header part)."""
    tree = plan.split("\n\n", 1)[0]
    return len(re.findall(rf"\b{re.escape(operator)}\b", tree))


def read_schemas(plan: str) -> list[str]:
    return re.findall(r"ReadSchema: (struct<.*?>)\n", plan)
