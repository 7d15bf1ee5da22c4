"""Silver that takes late dimension rows in, in a versioned store."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from strata.operators.deltas import signed_rows
from strata.operators.late import YEAR, arrived, joined_again, unresolved_keys, with_year
from strata.plans.incremental import in_years
from strata.plans.publish import Run
from strata.settings import LayerNames
from strata.sources.sinks import staged

#: Suffix of a dimension's index of keys that have orders but no row.
UNRESOLVED = "_unresolved"


def _dimensions(names: LayerNames) -> list[tuple[str, str, str]]:
    """(table, its key, the orders' key)."""
    return [(f"{names.silver_schema}.{names.silver_customer}", "customer_id", "Customer_ID"),
            (f"{names.silver_schema}.{names.silver_products}", "Product_ID", "Product_ID")]


def write_orders_and_index(run: Run, silver_orders: DataFrame, names: LayerNames = LayerNames()) -> DataFrame:
    """Silver orders by year, and for each dimension (staged or current) the index of unresolved keys.

    The orders are stored before they are dealt out by year, which moves all of them once more (``sources.sinks.staged``).
    """
    with staged(run.store.spark) as stage:
        orders = run.write(stage(with_year(silver_orders)), f"{names.silver_schema}.{names.silver_orders}", dedup=False,
                           partition_by=YEAR)
    for table, key, order_key in _dimensions(names):
        run.write(unresolved_keys(orders, order_key, run.read(table), key), table + UNRESOLVED, dedup=False)
    return orders


def resolve_late(run: Run, customers: DataFrame, products: DataFrame, names: LayerNames = LayerNames()) -> tuple[list, DataFrame | None]:
    """Stages new dimension tables and joins the orders of keys that arrived with them.

    ``customers`` and ``products`` are whole silver tables with one row per key,
    the old rows unchanged (a changed row of a known key needs a rebuild of
    silver). Returns the years written again, as many as the table has
    partitions at most, and the signed rows for ``refresh_gold`` (None without
    such years). The other years' files stay as they are.
    """
    orders_table = f"{names.silver_schema}.{names.silver_orders}"
    frames = [run.write(df, table, dedup=False) for df, (table, _, _) in zip((customers, products), _dimensions(names))]
    found = []
    for df, (table, key, order_key) in zip(frames, _dimensions(names)):
        index = run.read(table + UNRESOLVED)
        found.append(arrived(index, order_key, df, key).select(YEAR))
        still = index.join(df.select(df[key].alias(order_key)), order_key, "left_anti")
        run.write(still, table + UNRESOLVED, dedup=False)
    years = [r[YEAR] for r in reduce(DataFrame.union, found).distinct().collect()]
    years.sort(key=lambda y: (y is None, y))
    if not years:
        return [], None
    old = run.read(orders_table).where(in_years(years, YEAR))
    with staged(run.store.spark) as stage:
        again = stage(joined_again(old, *frames, columns=old.columns, stage=stage))
        new = run.replace_partitions(again, orders_table, years)
    return years, signed_rows(old, new.where(in_years(years, YEAR)))
