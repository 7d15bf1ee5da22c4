"""In-memory layer frames built from the test tables (no writes).

Used by the registered queries: each query is one lazy plan from the given
parquet tables to its result, so Catalyst optimises it end to end.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import gold, silver
from strata.sources.adapters import Bronze, load_bronze
from strata.sources.sinks import materialize


@dataclass(frozen=True)
class Layers:
    bronze: Bronze
    silver_customer: DataFrame
    silver_products: DataFrame
    silver_orders: DataFrame
    gold: DataFrame


STORABLE = ("bronze_orders", "silver_customer", "silver_products", "silver_orders", "gold")


#: What gold and its checks read of silver orders.
GOLD_INPUTS = ("Order_Date", "Category", "Sub_Category", "Customer_ID", "customer_name", "Profit")


def build_layers(spark: SparkSession, sf_dir: str,
                 store: Mapping[str, Sequence[str] | None] | Sequence[str] = ()) -> Layers:
    """All layers as lazy plans over the given tables.

    ``store`` names layers (of ``STORABLE``) to write once to the shared
    scratch folder and read back, for callers that consume them several
    times; as a mapping it also names the columns to keep of each (None: all),
    since a write cannot be pruned to what its readers need later.  Store only what is read more than once: each stored layer costs
    one full write, and a layer read once is cheaper recomputed in the plan
    of its single consumer.
    """
    unknown = set(store) - set(STORABLE)
    if unknown:
        raise ValueError(f"cannot store {sorted(unknown)}; storable layers are {STORABLE}")
    columns = store if isinstance(store, Mapping) else dict.fromkeys(store)

    def stored(df: DataFrame, name: str) -> DataFrame:
        return materialize(df.select(*columns[name]) if columns[name] else df, name.replace("_", "-"))

    b = load_bronze(spark, sf_dir)
    if "bronze_orders" in store:
        b = Bronze(orders=stored(b.orders, "bronze_orders"), customer=b.customer,
                   products=b.products)
    sc = silver.enrich_customers(b.customer)
    if "silver_customer" in store:
        sc = stored(sc, "silver_customer")
    sp = silver.enrich_products(b.products)
    if "silver_products" in store:
        sp = stored(sp, "silver_products")
    so = silver.enrich_orders(b.orders, sc, sp, dimensions_distinct=True)
    if "silver_orders" in store:
        so = stored(so, "silver_orders")
    g = gold.gold_profit(so)
    if "gold" in store:
        g = stored(g, "gold")
    return Layers(bronze=b, silver_customer=sc, silver_products=sp, silver_orders=so, gold=g)


def decimals_as_double(df: DataFrame) -> DataFrame:
    """Present exact decimal money as DOUBLE at the query boundary."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
        else F.col(f.name)
        for f in df.schema.fields
    ])
