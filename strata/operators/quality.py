"""Data-quality checks (K1-K15) as Spark computations.

Each check has a *violations* form that returns the offending rows or keys
as a DataFrame (so it can be inspected, counted or written) and contributes
rows to ``quality_report``: ``(check, table_name, column_name, violations,
passed)``.  Unlike assert-on-the-driver checks, every one of these can fail.

Scale notes:
* Row rules over one table are fused into a single ``agg(count_if ...)``
  pass (``row_rule_counts``) instead of one job per rule.
* Key checks are hash aggregations with map-side partial counts, so a key
  holding a third of all rows still ships one partial row per map task.
* Foreign-key and set-difference checks de-duplicate keys first (partial
  aggregation), then ``subtract`` (EXCEPT DISTINCT: a null-safe left-anti
  join), so nothing is collected to the driver.  In the report, all foreign
  keys of one fact share a single scan (``missing_key_counts``).
* The gold accuracy check unions both sides and aggregates once, instead of
  a full outer join on five nullable keys.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.dates import DAY_FIRST_FORMATS, parse_day_first_date, year_of
from strata.functions.money import has_more_than_2_decimals, round_money
from strata.functions.text import is_not_letters_only
from strata.operators.gold import GOLD_KEYS

# The accepted year range of the year check (inclusive).
YEAR_MIN = 1990
YEAR_MAX = 2026

REPORT_SCHEMA = T.StructType([
    T.StructField("check_name", T.StringType(), False),
    T.StructField("table_name", T.StringType(), False),
    T.StructField("column_name", T.StringType(), True),
    T.StructField("violations", T.LongType(), False),
    T.StructField("passed", T.BooleanType(), False),
])


# ---------------------------------------------------------------- row rules

def pk_null_rows(df: DataFrame, pk: str) -> DataFrame:
    """K1: rows whose primary key is null."""
    return df.filter(F.col(pk).isNull())


def name_format_rows(df: DataFrame, column: str = "customer_name") -> DataFrame:
    """K11: non-null names that are not one or more ASCII letters ('' included)."""
    return df.filter(is_not_letters_only(column))


def null_name_rows(df: DataFrame, column: str = "customer_name") -> DataFrame:
    """Names that are null: K11 lets them through, so they are reported apart."""
    return df.filter(F.col(column).isNull())


def bad_number(column: str = "Profit") -> Column:
    """A value that is no finite number: rounding to a decimal would lose it silently."""
    x = F.col(column).cast("double")
    return F.isnan(x) | (F.abs(x) == float("inf"))


def bad_number_rows(df: DataFrame, column: str = "Profit") -> DataFrame:
    """Rows whose value is NaN or infinite.  Silver money is DECIMAL, which has
    neither, so such a profit becomes null there; this check is where it shows."""
    return df.filter(bad_number(column))


def excess_decimal_rows(df: DataFrame, column: str = "Profit") -> DataFrame:
    """K5: values with more than two decimal places (numeric test)."""
    return df.filter(has_more_than_2_decimals(column))


def year_out_of_range(column: str = "Year", lo: int = YEAR_MIN, hi: int = YEAR_MAX) -> Column:
    y = F.col(column)
    return (y.isNull() | (y < lo) | (y > hi) | (F.length(y.cast("string")) != 4))


def year_range_rows(df: DataFrame, column: str = "Year",
                    lo: int = YEAR_MIN, hi: int = YEAR_MAX) -> DataFrame:
    """K12: year null, outside [lo, hi], or not written with four digits."""
    return df.filter(year_out_of_range(column, lo, hi))


def unparsed_date(raw: str = "Order_Date",
                  formats: Sequence[str] = DAY_FIRST_FORMATS) -> Column:
    return F.col(raw).isNotNull() & parse_day_first_date(raw, formats).isNull()


def unparsed_date_rows(raw_orders: DataFrame, column: str = "Order_Date",
                       formats: Sequence[str] = DAY_FIRST_FORMATS) -> DataFrame:
    """K4 (data side): source dates present but not parseable -> null in silver."""
    return raw_orders.filter(unparsed_date(column, formats))


# ----------------------------------------------------------------- key rules

def duplicate_keys(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """K2 / K10: key tuples that occur more than once (null is a key value)."""
    cols = [keys] if isinstance(keys, str) else list(keys)
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


def gold_grouping_violations(gold: DataFrame) -> DataFrame:
    """K10: gold rows sharing all five group keys."""
    return duplicate_keys(gold, GOLD_KEYS)


def missing_keys(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """K13 / K14: distinct fact keys absent from the dimension (null-safe).

    ``subtract`` is EXCEPT DISTINCT, planned as a left-anti join on ``<=>``
    after both sides are reduced to distinct keys; a null fact key with no
    null dimension key is reported.
    """
    return (fact.select(F.col(fact_key).alias(fact_key)).distinct()
            .subtract(dim.select(F.col(dim_key).alias(fact_key))))


@dataclass(frozen=True)
class ForeignKey:
    name: str      # the check's name in the report
    fact_key: str
    dim: DataFrame
    dim_key: str


def missing_key_counts(fact: DataFrame, fks: Sequence[ForeignKey]) -> DataFrame:
    """K13 and K14 together: per foreign key, the number of distinct fact keys
    absent from its dimension (null-safe, as ``missing_keys``), one row each.

    The fact is scanned once for all keys: every fact row yields one tagged
    row per foreign key, ``(check, k0, k1, ...)`` with only its own slot set
    (each of its own type), and partial aggregation reduces them to distinct
    tuples before the one shuffle.  The dimensions are tagged the same way,
    each key in its own type, and one EXCEPT DISTINCT removes the present
    keys; the set operation widens a slot's fact and dimension types to a
    common type, as ``missing_keys`` does.
    """
    if not fks:
        raise ValueError("missing_key_counts needs at least one foreign key")
    types = [fact.schema[fk.fact_key].dataType for fk in fks]

    def tagged(i: int, key: Column) -> Column:
        return F.struct(F.lit(fks[i].name).alias("check"), *[
            (key if j == i else F.lit(None).cast(t)).alias(f"k{j}")
            for j, t in enumerate(types)])

    fact_keys = (fact.select(F.explode(F.array(*[tagged(i, F.col(fk.fact_key))
                                                for i, fk in enumerate(fks)])).alias("r"))
                 .select("r.*").distinct())
    dim_keys = None
    for i, fk in enumerate(fks):
        d = fk.dim.select(tagged(i, F.col(fk.dim_key)).alias("r")).select("r.*")
        dim_keys = d if dim_keys is None else dim_keys.unionByName(d)
    missing = fact_keys.subtract(dim_keys)
    counts = missing.agg(*[F.count_if(F.col("check") == fk.name).alias(f"n{i}")
                           for i, fk in enumerate(fks)])
    per_check = F.array(*[F.struct(F.lit(fk.name).alias("check_name"),
                                   F.lit(fk.fact_key).alias("column_name"),
                                   F.col(f"n{i}").cast("long").alias("violations"))
                          for i, fk in enumerate(fks)])
    return counts.select(F.inline(per_check))


# ----------------------------------------------------------- reconciliations

def _rounded_sum(value: Column) -> Column:
    return F.round(F.sum(value), 2).cast("decimal(38,2)")


def _same_profit(bronze: str) -> Column:
    return (F.col(bronze).eqNullSafe(F.col("silver_profit"))
            & F.col("silver_profit").eqNullSafe(F.col("gold_profit")))


def profit_totals(bronze_orders: DataFrame, silver_orders: DataFrame, gold: DataFrame,
                  layers_distinct: bool = False, bronze_distinct: bool | None = None) -> DataFrame:
    """K8: rounded profit totals of each layer (each de-duplicated first), one row.

    ``layers_distinct=True`` says that the layers hold distinct rows, as this
    library's writers store them: then no layer is de-duplicated (a shuffle of
    all its columns) and partial sums are all that moves.  ``bronze_distinct``
    says otherwise for bronze alone (raw orders that no writer has stored).

    ``bronze_profit`` sums the raw values as the reference does; because
    silver rounds every row to cents first, ``round(sum(x)) <> sum(round(x))``
    in general, so ``passed`` compares the per-row-rounded bronze total with
    silver and gold.  ``passed_raw`` is the reference's comparison.  Each
    layer is aggregated once (both bronze totals in the same pass); the three
    one-row results are stacked and folded into one row, with no cross join.
    """
    if bronze_distinct is None:
        bronze_distinct = layers_distinct

    def rows(df: DataFrame, distinct: bool = layers_distinct) -> DataFrame:
        return df if distinct else df.dropDuplicates()

    null = F.lit(None).cast("decimal(38,2)")
    b = rows(bronze_orders, bronze_distinct).agg(
        _rounded_sum(F.col("Profit")).alias("bronze_profit"),
        _rounded_sum(round_money("Profit")).alias("bronze_rounded_profit"),
        null.alias("silver_profit"), null.alias("gold_profit"))
    s = rows(silver_orders).agg(
        null.alias("bronze_profit"), null.alias("bronze_rounded_profit"),
        _rounded_sum(F.col("Profit")).alias("silver_profit"), null.alias("gold_profit"))
    g = rows(gold).agg(
        null.alias("bronze_profit"), null.alias("bronze_rounded_profit"),
        null.alias("silver_profit"), _rounded_sum(F.col("Profit")).alias("gold_profit"))
    names = ("bronze_profit", "bronze_rounded_profit", "silver_profit", "gold_profit")
    wide = b.unionByName(s).unionByName(g).agg(*[F.max(n).alias(n) for n in names])
    return wide.select(*names, _same_profit("bronze_rounded_profit").alias("passed"),
                       _same_profit("bronze_profit").alias("passed_raw"))


def category_counts(silver_products: DataFrame, bronze_products: DataFrame,
                    columns: Sequence[str] = ("Category", "Sub_Category")) -> DataFrame:
    """K9: distinct-value counts per column in both layers (null counts as a value).

    Each side is first reduced to its distinct column tuples (a tiny
    partially aggregated shuffle), then counted per column.
    """
    def counts(df: DataFrame, side: str) -> DataFrame:
        distinct = df.select(*columns).distinct()
        aggs = [(F.count_distinct(c) + (F.count_if(F.col(c).isNull()) > 0).cast("int")).alias(c)
                for c in columns]
        wide = distinct.agg(*aggs)
        return wide.unpivot([], list(columns), "column_name", side)

    s = counts(silver_products, "silver_distinct")
    b = counts(bronze_products, "bronze_distinct")
    out = s.join(b, "column_name")
    return out.withColumn("passed", F.col("silver_distinct") == F.col("bronze_distinct"))


def category_value_differences(silver_products: DataFrame, bronze_products: DataFrame,
                               column: str) -> DataFrame:
    """K9, stronger form: values present in one layer but not the other."""
    s = silver_products.select(column).distinct()
    b = bronze_products.select(column).distinct()
    return (b.subtract(s).withColumn("missing_from", F.lit("silver"))
            .unionByName(s.subtract(b).withColumn("missing_from", F.lit("bronze"))))


def gold_group_totals(silver_orders: DataFrame, gold: DataFrame,
                      extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Per five-key group: profit recomputed from silver, profit stored in
    gold, and the number of gold rows; ``extra`` adds aggregates over the
    tagged rows (g: 1 for a gold row, excess: a silver profit with more than
    two decimals).

    Both sides are tagged and unioned, then aggregated once on the five keys
    (nulls group together, like the gold aggregation itself), with partial
    aggregation before the shuffle; no full outer join on nullable keys.
    """
    extra = extra or {}
    expected = silver_orders.select(
        year_of("Order_Date").alias("Year"),
        F.col("Category").alias("Product_Category"),
        F.col("Sub_Category").alias("Product_Sub_Category"),
        "Customer_ID", "customer_name",
        F.col("Profit").cast("decimal(38,2)").alias("e"),
        F.lit(None).cast("decimal(38,2)").alias("a"),
        F.lit(0).alias("g"),
        F.coalesce(has_more_than_2_decimals("Profit"), F.lit(False)).alias("excess"))
    actual = gold.select(*GOLD_KEYS,
                         F.lit(None).cast("decimal(38,2)").alias("e"),
                         F.col("Profit").cast("decimal(38,2)").alias("a"),
                         F.lit(1).alias("g"), F.lit(False).alias("excess"))
    return expected.unionByName(actual).groupBy(*GOLD_KEYS).agg(
        F.round(F.sum("e"), 2).alias("expected_profit"),
        F.sum("a").alias("actual_profit"),
        F.sum("g").alias("gold_rows"), *[a.alias(n) for n, a in extra.items()])


def _mismatch() -> Column:
    return (~F.col("expected_profit").eqNullSafe(F.col("actual_profit"))
            | (F.col("gold_rows") != 1))


def gold_mismatches(silver_orders: DataFrame, gold: DataFrame) -> DataFrame:
    """K15 at gold's own grain: groups whose stored profit differs from a
    recomputation, that appear on one side only, or that the stored gold
    holds more than once."""
    return gold_group_totals(silver_orders, gold).filter(_mismatch())


def gold_group_counts(silver_orders: DataFrame, gold: DataFrame) -> DataFrame:
    """K10 and K15 from one aggregation: a gold group stored more than once
    has ``gold_rows > 1`` in the same per-group totals the accuracy check
    uses, so gold is shuffled once for both.  Two rows:
    (check_name, column_name, violations)."""
    wide = gold_group_totals(silver_orders, gold).agg(
        F.count_if(F.col("gold_rows") > 1).alias("grouping"),
        F.count_if(_mismatch()).alias("accuracy"))
    return wide.select(F.inline(F.array(
        F.struct(F.lit("gold_grouping").alias("check_name"),
                 F.lit(None).cast("string").alias("column_name"),
                 F.col("grouping").cast("long").alias("violations")),
        F.struct(F.lit("gold_accuracy").alias("check_name"),
                 F.lit("Profit").alias("column_name"),
                 F.col("accuracy").cast("long").alias("violations")))))


def gold_total_accuracy(silver_orders: DataFrame, gold: DataFrame) -> DataFrame:
    """K15 as the reference states it: sum of per-(category, sub-category,
    customer) rounded totals vs the sum of gold.  One row."""
    per_group = (silver_orders
                 .groupBy("Category", "Sub_Category", "Customer_ID")
                 .agg(F.round(F.sum("Profit"), 2).alias("p")))
    e = per_group.agg(F.sum("p").cast("decimal(38,2)").alias("t")).select(
        F.lit("expected").alias("side"), "t")
    a = gold.agg(F.sum("Profit").cast("decimal(38,2)").alias("t")).select(
        F.lit("actual").alias("side"), "t")
    wide = e.unionByName(a).agg(
        F.max(F.when(F.col("side") == "expected", F.col("t"))).alias("expected_profit"),
        F.max(F.when(F.col("side") == "actual", F.col("t"))).alias("actual_profit"))
    return wide.withColumn("passed", F.col("expected_profit").eqNullSafe(F.col("actual_profit")))


# ------------------------------------------------------------ schema checks

def _field(df: DataFrame, column: str) -> T.StructField | None:
    lc = column.lower()
    for f in df.schema.fields:
        if f.name.lower() == lc:
            return f
    return None


def is_string_column(df: DataFrame, column: str) -> bool:
    """K3 (metadata only, no job)."""
    f = _field(df, column)
    return f is not None and isinstance(f.dataType, T.StringType)


def is_date_column(df: DataFrame, column: str) -> bool:
    """K4 type side (metadata only): DATE or TIMESTAMP (with or without zone)."""
    f = _field(df, column)
    return f is not None and isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    """K6: required names absent from the frame (exact case)."""
    have = set(df.columns)
    return [c for c in required if c not in have]


def is_non_empty(df: DataFrame) -> bool:
    """K7: reads at most one row."""
    return not df.isEmpty()


def type_violations(df: DataFrame, table_name: str, column: str, allowed: Sequence[str]) -> DataFrame:
    """K3 / K4 over the rows: (table_name, column_name, rows_checked, violations,
    passed), a row whose value is not of an allowed type being a violation."""
    wrong = ~F.typeof(F.col(column)).isin(list(allowed))
    return df.agg(F.count(F.lit(1)).alias("rows_checked"), F.count_if(wrong).alias("violations")).select(
        F.lit(table_name).alias("table_name"), F.lit(column).alias("column_name"), "rows_checked",
        "violations", (F.col("violations") == 0).alias("passed"))


def missing_column_rows(df: DataFrame, table_name: str, required: Iterable[str]) -> DataFrame:
    """K6 as rows: (table_name, column_name, n_rows) of every required column
    that the frame lacks, with the rows that lack it."""
    missing = F.array(*[F.lit(c) for c in missing_columns(df, required)]).cast("array<string>")
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(table_name).alias("table_name"), F.explode(missing).alias("column_name"), "n_rows")


# ------------------------------------------------------------------ report

@dataclass(frozen=True)
class RowRule:
    check: str
    column: str | None
    violation: Column  # true on a violating row; null counts as no violation


def row_rule_counts(df: DataFrame, table_name: str, rules: Sequence[RowRule],
                    non_empty: bool = False) -> DataFrame:
    """All row rules of one table in one scan: ``agg(count_if ...)``, then the
    one-row result is unfolded into a row per rule (a generator on one row,
    so the table is scanned once whatever the number of rules).

    ``non_empty=True`` adds the non-empty check (K7) to the same pass: the
    row count comes free with the scan the rules make anyway.
    """
    if not rules and not non_empty:
        raise ValueError("row_rule_counts needs at least one rule or non_empty=True")
    aggs = [F.count_if(r.violation).alias(f"r{i}") for i, r in enumerate(rules)]
    entries = [
        F.struct(F.lit(r.check).alias("check_name"),
                 F.lit(r.column).cast("string").alias("column_name"),
                 F.col(f"r{i}").cast("long").alias("violations"))
        for i, r in enumerate(rules)
    ]
    if non_empty:
        aggs.append(F.count(F.lit(1)).alias("row_count"))
        entries.append(F.struct(F.lit("non_empty").alias("check_name"),
                                F.lit(None).cast("string").alias("column_name"),
                                (F.col("row_count") == 0).cast("long").alias("violations")))
    return df.agg(*aggs).select(F.inline(F.array(*entries))).select(
        "check_name", F.lit(table_name).alias("table_name"), "column_name", "violations",
        (F.col("violations") == 0).alias("passed"))


def count_rows(df: DataFrame, check: str, table_name: str, column: str | None) -> DataFrame:
    """A violations DataFrame reduced to one report row."""
    return df.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(check).alias("check_name"), F.lit(table_name).alias("table_name"),
        F.lit(column).cast("string").alias("column_name"),
        F.col("violations").cast("long").alias("violations"),
        (F.col("violations") == 0).alias("passed"))


def empty_table_row(df: DataFrame, table_name: str) -> DataFrame:
    """K7 as a report row: reads at most one row of ``df``."""
    return count_rows(df.limit(1), "non_empty", table_name, None).select(
        "check_name", "table_name", "column_name",
        (F.col("violations") == 0).cast("long").alias("violations"),
        (F.col("violations") > 0).alias("passed"))


def metadata_rows(spark: SparkSession, rows: Sequence[tuple[str, str, str | None, int]]) -> DataFrame:
    """Schema-check results (computed on the driver from schemas) as report rows."""
    return spark.createDataFrame(
        [(c, t, col, int(v), v == 0) for c, t, col, v in rows], REPORT_SCHEMA)


@dataclass(frozen=True)
class LayerFrames:
    bronze_orders: DataFrame
    bronze_customer: DataFrame
    bronze_products: DataFrame
    silver_customer: DataFrame
    silver_products: DataFrame
    silver_orders: DataFrame
    gold: DataFrame


# The exact column names that the column check asks for.
SILVER_CUSTOMER_COLUMNS = ("customer_id", "customer_name", "country")
SILVER_PRODUCT_COLUMNS = ("Product_ID", "Category", "Sub_Category")
SILVER_ORDER_COLUMNS = ("Product_ID", "Customer_ID", "Discount", "Order_ID", "Price", "Profit",
                        "Quantity", "Row_ID", "Ship_Date", "Ship_Mode", "Order_Date",
                        "customer_name", "country", "Category", "Sub_Category")


def _entry(check: str, table_name: str, column: str | None, violations: Column) -> Column:
    return F.struct(F.lit(check).alias("check_name"), F.lit(table_name).alias("table_name"),
                    F.lit(column).cast("string").alias("column_name"),
                    F.coalesce(violations, F.lit(0)).cast("long").alias("violations"))


def keyed_rule_counts(df: DataFrame, table_name: str, key: str, rules: Sequence[RowRule]) -> DataFrame:
    """K1, K2, K7 and the row rules of one table in one scan, a report row each.

    Everything is first counted per key value (partial counts before the one
    shuffle, which the uniqueness check needs anyway) and then added up.
    """
    per_key = df.groupBy(F.col(key).alias("k")).agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(r.violation).alias(f"r{i}") for i, r in enumerate(rules)])
    wide = per_key.agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("k").isNull(), F.col("n"))).alias("nulls"),
        F.count_if(F.col("n") > 1).alias("repeated"), *[F.sum(f"r{i}").alias(f"r{i}") for i in range(len(rules))])
    entries = [_entry("pk_null", table_name, key, F.col("nulls")), _entry("pk_unique", table_name, key, F.col("repeated")),
               _entry("non_empty", table_name, None, F.col("n").isNull().cast("long")),
               *[_entry(r.check, table_name, r.column, F.col(f"r{i}")) for i, r in enumerate(rules)]]
    return wide.select(F.inline(F.array(*entries))).withColumn("passed", F.col("violations") == 0)


def fact_counts(bronze_orders: DataFrame, silver_orders: DataFrame, gold: DataFrame,
                profit_layers: bool, bronze_distinct: bool = True) -> DataFrame:
    """All counting checks of the fact's three layers, one scan of each layer.

    Bronze gives its row rules and both profit totals; silver and gold meet in
    the per-group totals of the accuracy check, from which the row rules, the
    grouping, the year range and their profit totals come as well.  The two
    one-row results are stacked, so that the totals can be compared
    (``profit_layers``, for layers of distinct rows), and unfolded.  Without
    ``bronze_distinct`` equal bronze rows become one row that knows how many
    they were: the row rules count them all, the total counts them once.
    """
    money = "decimal(38,2)"
    if bronze_distinct:
        counted = F.count_if
    else:
        bronze_orders = bronze_orders.groupBy(*bronze_orders.columns).agg(F.count("*").alias("_copies"))

        def counted(rule: Column) -> Column:
            return F.coalesce(F.sum(F.when(rule, F.col("_copies"))), F.lit(0))

    b = bronze_orders.agg(
        counted(unparsed_date("Order_Date")).alias("dates"),
        counted(has_more_than_2_decimals("Profit")).alias("decimals"),
        counted(bad_number("Profit")).alias("numbers"),
        _rounded_sum(round_money("Profit")).alias("total"))
    b = b.select(
        F.array(_entry("date_unparsed", "bronze_orders", "Order_Date", F.col("dates")),
                _entry("decimal_places", "bronze_orders", "Profit", F.col("decimals")),
                _entry("bad_number", "bronze_orders", "Profit", F.col("numbers"))).alias("entries"),
        F.col("total").alias("bronze_profit"), F.lit(None).cast(money).alias("silver_profit"),
        F.lit(None).cast(money).alias("gold_profit"))
    groups = gold_group_totals(silver_orders, gold, {
        "silver_rows": F.sum(1 - F.col("g")), "excess": F.count_if(F.col("excess"))})
    g = groups.agg(
        F.sum("silver_rows").alias("silver_rows"), F.sum("excess").alias("excess"),
        F.sum(F.when(year_out_of_range("Year"), F.col("gold_rows"))).alias("years"),
        F.count_if(F.col("gold_rows") > 1).alias("grouping"), F.count_if(_mismatch()).alias("accuracy"),
        F.sum("expected_profit").cast(money).alias("silver_profit"),
        F.sum("actual_profit").cast(money).alias("gold_profit"))
    g = g.select(
        F.array(_entry("decimal_places", "silver_orders", "Profit", F.col("excess")),
                _entry("non_empty", "silver_orders", None, (F.coalesce("silver_rows", F.lit(0)) == 0).cast("long")),
                _entry("year_range", "gold", "Year", F.col("years")),
                _entry("gold_grouping", "gold", None, F.col("grouping")),
                _entry("gold_accuracy", "gold", "Profit", F.col("accuracy"))).alias("entries"),
        F.lit(None).cast(money).alias("bronze_profit"), "silver_profit", "gold_profit")
    both = b.unionByName(g).agg(
        F.flatten(F.collect_list("entries")).alias("entries"),
        *[F.max(c).alias(c) for c in ("bronze_profit", "silver_profit", "gold_profit")])
    entries = F.col("entries")
    if profit_layers:
        differs = (~_same_profit("bronze_profit")).cast("long")
        entries = F.concat(entries, F.array(_entry("profit_layers", "gold", "Profit", differs)))
    return both.select(F.inline(entries)).withColumn("passed", F.col("violations") == 0)


def schema_rows(t: LayerFrames) -> list[tuple[str, str, str | None, int]]:
    """The schema checks (K3, K4, K6): (check, table, column, violations), without a job."""
    return [
        ("date_type", "silver_orders", "Order_Date", 0 if is_date_column(t.silver_orders, "Order_Date") else 1),
        ("string_type", "bronze_customer", "customer_name",
         0 if is_string_column(t.bronze_customer, "customer_name") else 1),
        ("string_type", "bronze_customer", "country", 0 if is_string_column(t.bronze_customer, "country") else 1),
        ("columns", "silver_customer", None, len(missing_columns(t.silver_customer, SILVER_CUSTOMER_COLUMNS))),
        ("columns", "silver_products", None, len(missing_columns(t.silver_products, SILVER_PRODUCT_COLUMNS))),
        ("columns", "silver_orders", None, len(missing_columns(t.silver_orders, SILVER_ORDER_COLUMNS))),
    ]


def quality_report(spark: SparkSession, t: LayerFrames, layers_distinct: bool = False,
                   bronze_distinct: bool | None = None) -> DataFrame:
    """All fifteen checks (plus the null-name and bad-number counts) as one DataFrame.

    One action evaluates everything, in ten scans: of each dimension one for
    its own rules and one as the foreign keys' target, of the fact's layers one
    for all counting checks, and of silver orders one for its foreign keys.
    ``layers_distinct=True`` (see ``profit_totals``) takes the profit totals
    from the same scans; for layers that may hold repeated rows they are a pass
    of their own, which de-duplicates each layer.  ``bronze_distinct=False``
    de-duplicates bronze orders alone, in their one scan.
    """
    if bronze_distinct is None:
        bronze_distinct = layers_distinct
    meta = metadata_rows(spark, schema_rows(t))
    parts = [
        keyed_rule_counts(t.silver_customer, "silver_customer", "customer_id", [
            RowRule("name_format", "customer_name", is_not_letters_only("customer_name")),
            RowRule("null_name", "customer_name", F.col("customer_name").isNull()),
        ]),
        keyed_rule_counts(t.silver_products, "silver_products", "Product_ID", []),
        fact_counts(t.bronze_orders, t.silver_orders, t.gold, profit_layers=layers_distinct,
                    bronze_distinct=bronze_distinct or not layers_distinct),
        missing_key_counts(t.silver_orders, [
            ForeignKey("fk_customer", "Customer_ID", t.silver_customer, "customer_id"),
            ForeignKey("fk_product", "Product_ID", t.silver_products, "Product_ID"),
        ]).select("check_name", F.lit("silver_orders").alias("table_name"), "column_name",
                  "violations", (F.col("violations") == 0).alias("passed")),
        count_rows(category_counts(t.silver_products, t.bronze_products).filter(~F.col("passed")),
                   "category_sets", "silver_products", "Category,Sub_Category"),
    ]
    if not layers_distinct:
        totals = profit_totals(t.bronze_orders, t.silver_orders, t.gold, bronze_distinct=bronze_distinct)
        parts.append(count_rows(totals.filter(~F.col("passed")), "profit_layers", "gold", "Profit"))
    out = meta
    for p in parts:
        out = out.unionByName(p)
    return out
