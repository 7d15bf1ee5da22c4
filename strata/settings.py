"""Pipeline settings: where each layer's tables live and where sources are.

A frozen record passed into the pipeline functions instead of module-level
globals, so two pipelines can run in one session with different names.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class LayerNames:
    """Three-part table names of the bronze, silver and gold layers."""

    catalog: str = "spark_catalog"
    bronze_schema: str = "bronze"
    silver_schema: str = "silver"
    gold_schema: str = "gold"
    bronze_orders: str = "bronze_orders"
    bronze_customer: str = "bronze_customer"
    bronze_products: str = "bronze_products"
    silver_orders: str = "silver_orders"
    silver_customer: str = "silver_customer"
    silver_products: str = "silver_products"
    gold_profit: str = "profit"

    def qualified(self, schema: str, table: str) -> str:
        return f"{self.catalog}.{schema}.{table}"

    def bronze(self, table: str) -> str:
        return self.qualified(self.bronze_schema, table)

    def silver(self, table: str) -> str:
        return self.qualified(self.silver_schema, table)

    def gold(self, table: str) -> str:
        return self.qualified(self.gold_schema, table)


@dataclass(frozen=True)
class SourceSpec:
    """One raw input: a file path (csv / json) or a catalogue table (table)."""

    path: str
    kind: str
    schema: str | None = None  # optional DDL string; skips the inference pass
    # arguments of the reader: header, delimiter, multi_line, bad_records ...
    options: Mapping[str, object] = field(default_factory=dict)
