"""Quality checks that ride on the writes.

Row rules, row counts and profit totals are counted while a layer is written
(``DataFrame.observe``: accumulated in the writing tasks, no scan and no job of
their own).  Only what needs rows side by side is left to scan the stored tables:
keys, groups and categories (``observed_report``), in seven scans.

The metrics stand directly below the write, after de-duplication and rebalancing,
so they belong to the tasks of the result stage: Spark counts each of them once,
also when a task runs again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.functions.money import has_more_than_2_decimals, round_money
from strata.functions.text import is_not_letters_only
from strata.operators import quality as Q

ROWS, TOTAL = "rows", "total"

#: The row rules of each watched layer: (check, column, violation).
RULES: dict[str, list[tuple[str, str, Callable[[], Column]]]] = {
    "bronze_orders": [("date_unparsed", "Order_Date", lambda: Q.unparsed_date("Order_Date")),
                      ("decimal_places", "Profit", lambda: has_more_than_2_decimals("Profit")),
                      ("bad_number", "Profit", lambda: Q.bad_number("Profit"))],
    "silver_customer": [("pk_null", "customer_id", lambda: F.col("customer_id").isNull()),
                        ("name_format", "customer_name", lambda: is_not_letters_only("customer_name")),
                        ("null_name", "customer_name", lambda: F.col("customer_name").isNull())],
    "silver_products": [("pk_null", "Product_ID", lambda: F.col("Product_ID").isNull())],
    "silver_orders": [("decimal_places", "Profit", lambda: has_more_than_2_decimals("Profit"))],
    "gold": [("year_range", "Year", lambda: Q.year_out_of_range("Year"))],
}
#: Layers whose profit total is compared, and the column that is summed up.
PROFIT: dict[str, Callable[[], Column]] = {
    "bronze_orders": lambda: round_money("Profit"), "silver_orders": lambda: F.col("Profit"), "gold": lambda: F.col("Profit")}
#: Layers that must not be empty.
NON_EMPTY = ("silver_customer", "silver_products", "silver_orders")


class WriteChecks:
    """The metrics of one run's writes."""

    def __init__(self) -> None:
        self._seen: dict[str, Observation] = {}

    def watch(self, layer: str) -> Callable[[DataFrame], DataFrame]:
        """What to apply to the layer's frame directly before its write; layers without rules pass unchanged."""
        if layer not in RULES:
            return lambda df: df

        def observed(df: DataFrame) -> DataFrame:
            self._seen[layer] = seen = Observation(f"{layer}-{uuid.uuid4().hex}")
            metrics = [F.count(F.lit(1)).alias(ROWS)]
            metrics += [F.count_if(rule()).alias(f"{check}:{column}") for check, column, rule in RULES[layer]]
            if layer in PROFIT:
                metrics.append(F.round(F.sum(PROFIT[layer]()), 2).cast("decimal(38,2)").alias(TOTAL))
            return df.observe(seen, *metrics)

        return observed

    def metrics(self, layer: str) -> dict:
        """The counts of the layer's last write; it must have run."""
        if layer not in self._seen:
            raise ValueError(f"{layer} has not been written under these checks")
        return self._seen[layer].get

    def rows(self) -> list[tuple[str, str, str | None, int]]:
        """(check, table, column, violations) of all that was counted."""
        out = []
        for layer, rules in RULES.items():
            seen = self.metrics(layer)
            out += [(check, layer, column, seen[f"{check}:{column}"]) for check, column, _ in rules]
            if layer in NON_EMPTY:
                out.append(("non_empty", layer, None, int(seen[ROWS] == 0)))
        totals = [self.metrics(layer)[TOTAL] for layer in PROFIT]
        out.append(("profit_layers", "gold", "Profit", int(any(t != totals[0] for t in totals))))
        return out


@dataclass(frozen=True)
class KeyedDimension:
    table: str
    key: str
    check: str  # of the fact's keys against it
    fact_key: str
    rows: DataFrame


def key_counts(fact: DataFrame, dims: Sequence[KeyedDimension]) -> DataFrame:
    """Uniqueness of the dimensions' keys and the fact's missing keys, from one scan of each table.

    Every table sends its keys with a tag, partially counted; per key it is then
    known how many rows hold it on either side (null is a key, as in K2 and K13).
    """
    types = [fact.schema[d.fact_key].dataType for d in dims]

    def tagged(i: int, key: Column, side: int) -> Column:
        return F.struct(F.lit(dims[i].check).alias("check"), *[(key if j == i else F.lit(None)).cast(t).alias(f"k{j}")
                                                              for j, t in enumerate(types)], F.lit(side).alias("dim"))

    rows = fact.select(F.inline(F.array(*[tagged(i, F.col(d.fact_key), 0) for i, d in enumerate(dims)])))
    for i, d in enumerate(dims):
        rows = rows.unionByName(d.rows.select(F.inline(F.array(tagged(i, F.col(d.key), 1)))))
    keys = rows.groupBy("check", *[f"k{j}" for j in range(len(dims))]).agg(F.sum("dim").alias("held"), F.count("*").alias("n"))
    wide = keys.groupBy().agg(*[a for i, d in enumerate(dims) for a in (
        F.count_if((F.col("check") == d.check) & (F.col("held") == 0)).alias(f"missing{i}"),
        F.count_if((F.col("check") == d.check) & (F.col("held") > 1)).alias(f"repeated{i}"))])
    return wide.select(F.inline(F.array(*[e for i, d in enumerate(dims) for e in (
        _entry(d.check, "silver_orders", d.fact_key, f"missing{i}"), _entry("pk_unique", d.table, d.key, f"repeated{i}"))])))


def _entry(check: str, table: str, column: str | None, violations: str) -> Column:
    return F.struct(F.lit(check).alias("check_name"), F.lit(table).alias("table_name"), F.lit(column).cast("string").alias("column_name"),
                    F.col(violations).cast("long").alias("violations"))


def observed_report(spark: SparkSession, t: Q.LayerFrames, checks: WriteChecks) -> DataFrame:
    """The rows of ``quality_report`` for the tables that were written under ``checks``."""
    counted = Q.metadata_rows(spark, Q.schema_rows(t) + checks.rows())
    keys = key_counts(t.silver_orders, [
        KeyedDimension("silver_customer", "customer_id", "fk_customer", "Customer_ID", t.silver_customer),
        KeyedDimension("silver_products", "Product_ID", "fk_product", "Product_ID", t.silver_products)])
    groups = Q.gold_group_counts(t.silver_orders, t.gold).select("check_name", F.lit("gold").alias("table_name"), "column_name", "violations")
    scanned = keys.unionByName(groups).withColumn("passed", F.col("violations") == 0)
    return counted.unionByName(scanned).unionByName(
        Q.count_rows(Q.category_counts(t.silver_products, t.bronze_products).filter(~F.col("passed")),
                     "category_sets", "silver_products", "Category,Sub_Category"))
