"""Late-arriving dimension rows: orders whose customer or product came after them.

Left joins keep an order whose key has no dimension row, with null attributes.
``unresolved_keys`` lists those keys with the years in which they have orders; when
rows for some of them arrive, only the partitions of those years are joined again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.silver import CUSTOMER_COLUMNS, PRODUCT_COLUMNS, join_dimensions
from strata.sources.sinks import Stage

YEAR = "Order_Year"


def with_year(silver_orders: DataFrame) -> DataFrame:
    """Silver orders with the column they are partitioned by."""
    return silver_orders.withColumn(YEAR, F.year("Order_Date"))


def unresolved_keys(orders: DataFrame, key: str, dimension: DataFrame, dimension_key: str) -> DataFrame:
    """(key, Order_Year): the distinct non-null keys without a dimension row, by year.

    Keys are reduced before they move (partial aggregation), so a hot key costs a row a task and year.
    """
    keys = orders.where(F.col(key).isNotNull()).select(key, YEAR).distinct()
    return keys.join(dimension.select(F.col(dimension_key).alias(key)), key, "left_anti")


def arrived(index: DataFrame, key: str, dimension: DataFrame, dimension_key: str) -> DataFrame:
    """The index rows whose key has a dimension row now."""
    return index.join(dimension.select(F.col(dimension_key).alias(key)), key, "left_semi")


def joined_again(orders: DataFrame, customers: DataFrame, products: DataFrame, columns: Sequence[str],
                 stage: Stage | None = None) -> DataFrame:
    """Orders with their attributes looked up anew, one dimension row a key given (``stage``: see ``join_dimensions``)."""
    attributes = [c for c in (*CUSTOMER_COLUMNS[1:], *PRODUCT_COLUMNS[1:]) if c in orders.columns]
    return join_dimensions(orders.drop(*attributes), customers, products, stage=stage).select(*columns)
