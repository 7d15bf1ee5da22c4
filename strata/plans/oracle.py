"""DuckDB SQL twins of the registered queries (the correctness oracle).

The tables ``lineitem orders customer nation part`` are views over the same
parquet files.  Shared CTEs rebuild the bronze/silver/gold layers in SQL, so
each oracle query is self-contained.  Money is DECIMAL inside and DOUBLE on
output, years are INTEGER (DuckDB's year() is BIGINT).
"""

from __future__ import annotations

# Order matters: each CTE may use the ones above it.
_CTES: dict[str, str] = {
    "bronze_orders": r"""
SELECT l_orderkey * 10 + l_linenumber AS Row_ID,
       l_orderkey AS Order_ID,
       CASE WHEN l_orderkey % 97 = 0 THEN 'n/a'
            WHEN l_orderkey % 4 = 0 THEN strftime(o_orderdate, '%d/%m/%Y')
            WHEN l_orderkey % 4 = 1 THEN strftime(o_orderdate, '%d/%-m/%Y')
            ELSE strftime(o_orderdate, '%-d/%-m/%Y') END AS Order_Date,
       strftime(l_shipdate, '%-d/%-m/%Y') AS Ship_Date,
       l_linestatus AS Ship_Mode,
       CASE WHEN l_orderkey % 101 = 0 THEN o_custkey + 1000000000000000 ELSE o_custkey END AS Customer_ID,
       CASE WHEN l_orderkey % 103 = 0 THEN l_partkey + 1000000000000000 ELSE l_partkey END AS Product_ID,
       l_quantity AS Quantity, l_extendedprice AS Price, l_discount AS Discount,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2))
            * (CAST(0.05 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS Profit
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "bronze_customer": r"""
SELECT c_custkey AS customer_id,
       CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_name || ' ' || c_mktsegment END AS customer_name,
       lower(c_mktsegment) || '.' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
       n_name AS country
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "bronze_products": r"""
SELECT p_partkey AS Product_ID, p_type AS Category, p_brand AS Sub_Category,
       p_name AS Product_Name, p_retailprice AS Price_per_product
FROM part""",
    "silver_customer": r"""
SELECT DISTINCT customer_id, regexp_replace(customer_name, '[^A-Za-z]', '', 'g') AS customer_name, country
FROM bronze_customer""",
    "silver_products": r"""
SELECT DISTINCT Product_ID, Category, Sub_Category FROM bronze_products""",
    "orders_parsed": r"""
SELECT Row_ID, Order_ID, Ship_Date, Ship_Mode, Customer_ID, Product_ID, Quantity, Price, Discount,
       CAST(round(Profit, 2) AS DECIMAL(18,2)) AS Profit,
       CAST(CASE WHEN regexp_full_match(Order_Date, '\d{1,2}/\d{1,2}/\d{4}')
                 THEN try_strptime(Order_Date, '%d/%m/%Y') END AS DATE) AS Order_Date
FROM bronze_orders""",
    "silver_orders": r"""
SELECT o.*, c.customer_name, c.country, p.Category, p.Sub_Category
FROM (SELECT DISTINCT * FROM orders_parsed) o
LEFT JOIN silver_customer c ON o.Customer_ID = c.customer_id
LEFT JOIN silver_products p ON o.Product_ID = p.Product_ID""",
    "gold": r"""
SELECT CAST(year(Order_Date) AS INTEGER) AS Year, Category AS Product_Category,
       Sub_Category AS Product_Sub_Category, Customer_ID, customer_name,
       round(sum(Profit), 2) AS Profit
FROM silver_orders
GROUP BY ALL""",
}


def with_layers(select: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``select`` with the layer CTEs it (transitively) needs."""
    ctes = dict(_CTES)
    if extra:
        ctes.update(extra)
    body = "WITH " + ",\n".join(f"{name} AS ({sql}\n)" for name, sql in ctes.items())
    return f"{body}\n{select}"


_SILVER_ORDERS_OUT = """
SELECT Row_ID, Order_ID, Ship_Date, Ship_Mode, Customer_ID, Product_ID, Quantity, Price, Discount,
       CAST(Profit AS DOUBLE) AS Profit, Order_Date, customer_name, country, Category, Sub_Category
FROM silver_orders"""

ORACLE: dict[str, str] = {
    "silver_customer": with_layers("SELECT * FROM silver_customer"),
    "silver_customer_email_fallback": with_layers(r"""
SELECT DISTINCT customer_id,
       regexp_replace(coalesce(customer_name, split_part(email, '@', 1)), '[^A-Za-z]', '', 'g')
         AS customer_name,
       country
FROM bronze_customer"""),
    "silver_products": with_layers("SELECT * FROM silver_products"),
    "orders_date_parse": with_layers("""
SELECT Row_ID, Order_ID, Ship_Date, Ship_Mode, Customer_ID, Product_ID, Quantity, Price, Discount,
       CAST(Profit AS DOUBLE) AS Profit, Order_Date
FROM orders_parsed"""),
    "silver_orders": with_layers(_SILVER_ORDERS_OUT),
    "gold_profit": with_layers("""
SELECT Year, Product_Category, Product_Sub_Category, Customer_ID, customer_name,
       CAST(Profit AS DOUBLE) AS Profit
FROM gold"""),
    "report_year": with_layers("""
SELECT Year, CAST(round(sum(Profit), 2) AS DOUBLE) AS total_profit_by_year
FROM gold GROUP BY Year ORDER BY Year DESC"""),
    "report_year_category": with_layers("""
SELECT Year, Product_Category, CAST(round(sum(Profit), 2) AS DOUBLE) AS total_profit_by_year
FROM gold GROUP BY Year, Product_Category ORDER BY Year DESC"""),
    "report_customer": with_layers("""
SELECT Customer_ID, customer_name, CAST(round(sum(Profit), 2) AS DOUBLE) AS total_profit_by_year
FROM gold GROUP BY Customer_ID, customer_name ORDER BY total_profit_by_year DESC"""),
    "report_customer_year": with_layers("""
SELECT Year, Customer_ID, CAST(round(sum(Profit), 2) AS DOUBLE) AS total_profit_by_year
FROM gold GROUP BY Year, Customer_ID ORDER BY Year DESC"""),
    "report_silver_category": with_layers("""
SELECT CAST(sum(Profit) AS DOUBLE) AS profit, CAST(year(Order_Date) AS INTEGER) AS order_year,
       Category, Sub_Category
FROM silver_orders GROUP BY ALL"""),
}

# Day-first parse, as used by the orders_parsed CTE.
_PARSE = (r"CAST(CASE WHEN regexp_full_match({c}, '\d{{1,2}}/\d{{1,2}}/\d{{4}}') "
          r"THEN try_strptime({c}, '%d/%m/%Y') END AS DATE)")

_GOLD_DUP = {"gold_dup": "SELECT * FROM gold UNION ALL SELECT * FROM gold WHERE Customer_ID % 97 = 0"}


def _non_empty(table: str) -> str:
    return (f"SELECT 'non_empty' AS check_name, '{table}' AS table_name, "
            f"CAST(NULL AS VARCHAR) AS column_name, "
            f"CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT) AS violations, "
            f"count(*) > 0 AS passed FROM (SELECT 1 FROM {table} LIMIT 1)")


def _types(table: str, column: str, allowed: str, shown: str | None = None) -> str:
    wrong = f"count(*) FILTER (WHERE typeof({column}) NOT IN ({allowed}))"
    return (f"SELECT '{shown or table}' AS table_name, '{column}' AS column_name, count(*) AS rows_checked, "
            f"{wrong} AS violations, {wrong} = 0 AS passed FROM {table}")


def _lacking(table: str, required: tuple[str, ...]) -> str:
    """Required names that no column of the table has, by the table's own description."""
    names = ", ".join(f"('{c}')" for c in required)
    return (f"SELECT '{table}' AS table_name, r.column_name, (SELECT count(*) FROM {table}) AS n_rows "
            f"FROM (VALUES {names}) r(column_name) "
            f"WHERE r.column_name NOT IN (SELECT unnest(json_keys(to_json(t))) FROM (SELECT * FROM {table} LIMIT 1) t)")


def _distinct_counts(table: str, alias: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) "
        f"+ CASE WHEN count(*) FILTER (WHERE {c} IS NULL) > 0 THEN 1 ELSE 0 END AS {alias} FROM {table}"
        for c in ("Category", "Sub_Category"))


_PROFIT_TOTALS = """
SELECT CAST(b.bronze_profit AS DOUBLE) AS bronze_profit,
       CAST(b.bronze_rounded_profit AS DOUBLE) AS bronze_rounded_profit,
       CAST(s.t AS DOUBLE) AS silver_profit, CAST(g.t AS DOUBLE) AS gold_profit,
       (b.bronze_rounded_profit IS NOT DISTINCT FROM s.t AND s.t IS NOT DISTINCT FROM g.t) AS passed,
       (b.bronze_profit IS NOT DISTINCT FROM s.t AND s.t IS NOT DISTINCT FROM g.t) AS passed_raw
FROM (SELECT round(sum(Profit), 2) AS bronze_profit,
             round(sum(CAST(round(Profit, 2) AS DECIMAL(18,2))), 2) AS bronze_rounded_profit
      FROM (SELECT DISTINCT * FROM bronze_orders)) b,
     (SELECT round(sum(Profit), 2) AS t FROM (SELECT DISTINCT * FROM silver_orders)) s,
     (SELECT round(sum(Profit), 2) AS t FROM (SELECT DISTINCT * FROM gold)) g"""

_GOLD_MISMATCH = """
u AS (
  SELECT CAST(year(Order_Date) AS INTEGER) AS Year, Category AS Product_Category,
         Sub_Category AS Product_Sub_Category, Customer_ID, customer_name,
         CAST(Profit AS DECIMAL(38,2)) AS e, CAST(NULL AS DECIMAL(38,2)) AS a, 0 AS g
  FROM silver_orders
  UNION ALL
  SELECT Year, Product_Category, Product_Sub_Category, Customer_ID, customer_name,
         CAST(NULL AS DECIMAL(38,2)), CAST(Profit AS DECIMAL(38,2)), 1
  FROM {gold})
SELECT Year, Product_Category, Product_Sub_Category, Customer_ID, customer_name,
       CAST(round(sum(e), 2) AS DOUBLE) AS expected_profit, CAST(sum(a) AS DOUBLE) AS actual_profit,
       CAST(sum(g) AS BIGINT) AS gold_rows
FROM u GROUP BY Year, Product_Category, Product_Sub_Category, Customer_ID, customer_name
HAVING round(sum(e), 2) IS DISTINCT FROM sum(a) OR sum(g) <> 1"""


def _count_rows(check: str, table: str, column: str | None, violations_sql: str) -> str:
    col = "CAST(NULL AS VARCHAR)" if column is None else f"'{column}'"
    return (f"SELECT '{check}' AS check_name, '{table}' AS table_name, {col} AS column_name, "
            f"CAST(count(*) AS BIGINT) AS violations, count(*) = 0 AS passed FROM ({violations_sql})")


def _rule(check: str, table: str, column: str, predicate: str) -> str:
    return (f"SELECT '{check}' AS check_name, '{table}' AS table_name, '{column}' AS column_name, "
            f"CAST(count(*) FILTER (WHERE {predicate}) AS BIGINT) AS violations, "
            f"count(*) FILTER (WHERE {predicate}) = 0 AS passed FROM {table}")


_NOT_LETTERS = "NOT regexp_matches(customer_name, '^[A-Za-z]+$')"
_BAD_YEAR = "Year IS NULL OR Year < 1990 OR Year > 2026 OR length(CAST(Year AS VARCHAR)) <> 4"

_REPORT = "\nUNION ALL\n".join([
    # schema checks: literal rows in the SQL, computed from schemas in Spark
    "SELECT 'date_type' AS check_name, 'silver_orders' AS table_name, 'Order_Date' AS column_name, "
    "CAST(0 AS BIGINT) AS violations, true AS passed",
    "SELECT 'string_type', 'bronze_customer', 'customer_name', CAST(0 AS BIGINT), true",
    "SELECT 'string_type', 'bronze_customer', 'country', CAST(0 AS BIGINT), true",
    "SELECT 'columns', 'silver_customer', NULL, CAST(0 AS BIGINT), true",
    "SELECT 'columns', 'silver_products', NULL, CAST(0 AS BIGINT), true",
    "SELECT 'columns', 'silver_orders', NULL, CAST(0 AS BIGINT), true",
    _rule("pk_null", "silver_customer", "customer_id", "customer_id IS NULL"),
    _rule("name_format", "silver_customer", "customer_name", _NOT_LETTERS),
    _rule("null_name", "silver_customer", "customer_name", "customer_name IS NULL"),
    _rule("pk_null", "silver_products", "Product_ID", "Product_ID IS NULL"),
    _rule("date_unparsed", "bronze_orders", "Order_Date",
          "Order_Date IS NOT NULL AND " + _PARSE.format(c="Order_Date") + " IS NULL"),
    _rule("decimal_places", "bronze_orders", "Profit", "round(Profit, 2) <> Profit"),
    _rule("bad_number", "bronze_orders", "Profit", "NOT isfinite(CAST(Profit AS DOUBLE))"),
    _rule("decimal_places", "silver_orders", "Profit", "round(Profit, 2) <> Profit"),
    _rule("year_range", "gold", "Year", _BAD_YEAR),
    _count_rows("pk_unique", "silver_customer", "customer_id",
                "SELECT customer_id FROM silver_customer GROUP BY customer_id HAVING count(*) > 1"),
    _count_rows("pk_unique", "silver_products", "Product_ID",
                "SELECT Product_ID FROM silver_products GROUP BY Product_ID HAVING count(*) > 1"),
    _count_rows("fk_customer", "silver_orders", "Customer_ID",
                "SELECT DISTINCT Customer_ID FROM silver_orders EXCEPT SELECT customer_id FROM silver_customer"),
    _count_rows("fk_product", "silver_orders", "Product_ID",
                "SELECT DISTINCT Product_ID FROM silver_orders EXCEPT SELECT Product_ID FROM silver_products"),
    _count_rows("gold_grouping", "gold", None,
                "SELECT 1 FROM gold GROUP BY Year, Product_Category, Product_Sub_Category, Customer_ID, "
                "customer_name HAVING count(*) > 1"),
    _count_rows("gold_accuracy", "gold", "Profit", "WITH " + _GOLD_MISMATCH.format(gold="gold")),
    _count_rows("category_sets", "silver_products", "Category,Sub_Category",
                "SELECT * FROM (" + _distinct_counts("silver_products", "s") + ") s JOIN ("
                + _distinct_counts("bronze_products", "b") + ") b USING (column_name) WHERE s <> b"),
    _count_rows("profit_layers", "gold", "Profit",
                "SELECT * FROM (" + _PROFIT_TOTALS + ") WHERE NOT passed"),
    _non_empty("silver_customer"),
    _non_empty("silver_products"),
    _non_empty("silver_orders"),
])

ORACLE.update({
    "dq_pk_null": with_layers("SELECT * FROM v WHERE customer_id IS NULL", {
        "v": "SELECT CASE WHEN customer_id % 300 = 0 THEN NULL ELSE customer_id END AS customer_id, "
             "customer_name, country FROM silver_customer"}),
    "dq_pk_unique": with_layers(
        "SELECT customer_id, count(*) AS n FROM v GROUP BY customer_id HAVING count(*) > 1", {
            "v": "SELECT * FROM silver_customer UNION ALL "
                 "SELECT customer_id, customer_name, 'X' AS country FROM silver_customer "
                 "WHERE customer_id % 200 = 0"}),
    "dq_date_type": with_layers(
        "SELECT Row_ID, Order_ID, Order_Date, Ship_Date, Ship_Mode, Customer_ID, Product_ID, Quantity, "
        "Price, Discount, CAST(Profit AS DOUBLE) AS Profit FROM bronze_orders "
        "WHERE Order_Date IS NOT NULL AND " + _PARSE.format(c="Order_Date") + " IS NULL"),
    "dq_decimal_places": with_layers(
        "SELECT Row_ID, Order_ID, CAST(Profit AS DOUBLE) AS Profit FROM bronze_orders "
        "WHERE round(Profit, 2) <> Profit"),
    "dq_non_empty": with_layers("\nUNION ALL\n".join(
        _non_empty(t) for t in ("silver_customer", "silver_products", "silver_orders"))),
    "dq_non_empty_planted": with_layers("\nUNION ALL\n".join(
        _non_empty(t) for t in ("no_products", "no_customers", "one_customer")), {
            "no_products": "SELECT * FROM bronze_products WHERE Category = 'none such'",
            "no_customers": "SELECT * FROM bronze_customer WHERE customer_id < 0",
            "one_customer": "SELECT * FROM bronze_customer WHERE customer_id = 1"}),
    "dq_string_type": with_layers("\nUNION ALL\n".join([
        _types("bronze_customer", "customer_name", "'VARCHAR'"),
        _types("bronze_customer", "country", "'VARCHAR'"),
        _types("customer_typed", "customer_name", "'VARCHAR'")]), {
            "customer_typed": "SELECT customer_id, customer_id * 2 AS customer_name FROM bronze_customer"}),
    "dq_date_type_schema": with_layers("\nUNION ALL\n".join([
        _types("orders_parsed", "Order_Date", "'DATE', 'TIMESTAMP'", "silver_orders"),
        _types("bronze_orders", "Order_Date", "'DATE', 'TIMESTAMP'")])),
    "dq_columns": with_layers("\nUNION ALL\n".join([
        _lacking("silver_customer", ("customer_id", "customer_name", "country")),
        _lacking("customer_lost", ("customer_id", "customer_name", "country")),
        _lacking("products_renamed", ("Product_ID", "Category", "Sub_Category"))]), {
            "customer_lost": "SELECT customer_id FROM silver_customer",
            "products_renamed": "SELECT Product_ID, Category AS category, Sub_Category FROM silver_products"}),
    "dq_bad_number": with_layers(
        "SELECT Row_ID, Order_ID, CASE WHEN Order_ID % 251 = 0 THEN 'NaN' ELSE 'Infinity' END AS profit_text "
        "FROM bronze_orders WHERE Order_ID % 251 = 0 OR Order_ID % 257 = 0"),
    "dq_profit_layers": with_layers(_PROFIT_TOTALS),
    "dq_category_sets": with_layers(
        "SELECT column_name, silver_distinct, bronze_distinct, silver_distinct = bronze_distinct AS passed "
        "FROM (" + _distinct_counts("v", "silver_distinct") + ") s JOIN ("
        + _distinct_counts("bronze_products", "bronze_distinct") + ") b USING (column_name)",
        {"v": "SELECT * FROM silver_products WHERE Category <> 'ECONOMY'"}),
    "dq_category_values": with_layers(
        "SELECT Category, 'silver' AS missing_from FROM "
        "(SELECT Category FROM bronze_products EXCEPT SELECT Category FROM v) "
        "UNION ALL SELECT Category, 'bronze' AS missing_from FROM "
        "(SELECT Category FROM v EXCEPT SELECT Category FROM bronze_products)",
        {"v": "SELECT * FROM silver_products WHERE Category <> 'ECONOMY'"}),
    "silver_orders_dup_customers": with_layers("""
SELECT o.Row_ID, o.Order_ID, o.Ship_Date, o.Ship_Mode, o.Customer_ID, o.Product_ID, o.Quantity, o.Price,
       o.Discount, CAST(o.Profit AS DOUBLE) AS Profit, o.Order_Date, c.customer_name, c.country,
       p.Category, p.Sub_Category
FROM (SELECT DISTINCT * FROM orders_parsed) o
LEFT JOIN cust_dup c ON o.Customer_ID = c.customer_id
LEFT JOIN silver_products p ON o.Product_ID = p.Product_ID""", {
        "cust_dup": "SELECT * FROM silver_customer UNION ALL "
                    "SELECT customer_id, customer_name, 'X' AS country FROM silver_customer "
                    "WHERE customer_id % 200 = 0"}),
    "dq_gold_grouping": with_layers(
        "SELECT Year, Product_Category, Product_Sub_Category, Customer_ID, customer_name, count(*) AS n "
        "FROM gold_dup GROUP BY ALL HAVING count(*) > 1", _GOLD_DUP),
    "dq_name_format": with_layers(
        "SELECT customer_id, customer_name FROM bronze_customer WHERE " + _NOT_LETTERS),
    "dq_null_names": with_layers("SELECT * FROM silver_customer WHERE customer_name IS NULL"),
    "dq_year_range": with_layers(
        "SELECT Year, Product_Category, Product_Sub_Category, Customer_ID, customer_name, "
        "CAST(Profit AS DOUBLE) AS Profit FROM v WHERE " + _BAD_YEAR, {
            "v": "SELECT CASE WHEN Customer_ID < 30 THEN (CASE WHEN Customer_ID % 3 = 0 THEN NULL "
                 "WHEN Customer_ID % 3 = 1 THEN 1989 ELSE 12000 END) ELSE Year END AS Year, "
                 "Product_Category, Product_Sub_Category, Customer_ID, customer_name, Profit FROM gold"}),
    "dq_fk_customer": with_layers(
        "SELECT DISTINCT Customer_ID FROM silver_orders EXCEPT SELECT customer_id FROM silver_customer"),
    "dq_fk_product": with_layers(
        "SELECT DISTINCT Product_ID FROM silver_orders EXCEPT SELECT Product_ID FROM silver_products"),
    "dq_gold_accuracy": with_layers(
        "SELECT * FROM mismatch",
        {**_GOLD_DUP, "mismatch": "WITH " + _GOLD_MISMATCH.format(gold="gold_dup")}),
    "dq_gold_total": with_layers("""
SELECT CAST(e.t AS DOUBLE) AS expected_profit, CAST(a.t AS DOUBLE) AS actual_profit,
       e.t IS NOT DISTINCT FROM a.t AS passed
FROM (SELECT CAST(sum(p) AS DECIMAL(38,2)) AS t
      FROM (SELECT round(sum(Profit), 2) AS p FROM silver_orders
            GROUP BY Category, Sub_Category, Customer_ID)) e,
     (SELECT CAST(sum(Profit) AS DECIMAL(38,2)) AS t FROM gold) a"""),
    "dq_report": with_layers(_REPORT),
})

_PRODUCTS_OUT = ("SELECT Product_ID, Category, Sub_Category, Product_Name, Price_per_product "
                 "FROM bronze_products")
_BRONZE_ORDERS_DISTINCT = (
    "SELECT DISTINCT Row_ID, Order_ID, Order_Date, Ship_Date, Ship_Mode, Customer_ID, Product_ID, "
    "Quantity, Price, Discount, CAST(Profit AS DOUBLE) AS Profit FROM bronze_orders")

ORACLE.update({
    "clean_names": with_layers(_PRODUCTS_OUT),
    "csv_roundtrip": with_layers(_PRODUCTS_OUT),
    "json_roundtrip": with_layers(_BRONZE_ORDERS_DISTINCT),
    "table_copy": with_layers("SELECT DISTINCT * FROM bronze_customer"),
    "dedup_overwrite": with_layers(_BRONZE_ORDERS_DISTINCT),
    "stream_ingest": with_layers(_BRONZE_ORDERS_DISTINCT),
    "medallion_run": ORACLE["gold_profit"],
    "stream_medallion": ORACLE["gold_profit"],
    "json_multiline_roundtrip": with_layers(_BRONZE_ORDERS_DISTINCT),
    "medallion_multiline": ORACLE["gold_profit"],
    "medallion_report": ORACLE["dq_report"],
    "medallion_observed": ORACLE["dq_report"],
    "silver_orders_salted": ORACLE["silver_orders"],
    "silver_orders_broadcast": ORACLE["silver_orders"],
})


# ------------------------------------------------------- versioned layers

_UNIQUE = {
    "hot_customer": """
SELECT * FROM silver_customer
UNION ALL SELECT customer_id, customer_name, 'X' FROM silver_customer WHERE customer_id % 200 = 0
UNION ALL SELECT 7, customer_name, 'Z' || CAST(customer_id AS VARCHAR) FROM silver_customer WHERE customer_id % 3 = 0
UNION ALL SELECT NULL, customer_name, country FROM silver_customer WHERE customer_id % 300 = 0""",
    "one_customer": """
SELECT customer_id, customer_name, country FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY customer_name IS NOT NULL DESC, country IS NOT NULL DESC,
    customer_name DESC NULLS LAST, country DESC NULLS LAST) AS place FROM hot_customer WHERE customer_id IS NOT NULL)
WHERE place = 1""",
}

_GOLD_OUT = "Year, Product_Category, Product_Sub_Category, Customer_ID, customer_name, CAST(Profit AS DOUBLE) AS Profit"

ORACLE.update({
    "silver_orders_survivors": with_layers("""
SELECT o.Row_ID, o.Order_ID, o.Ship_Date, o.Ship_Mode, o.Customer_ID, o.Product_ID, o.Quantity, o.Price, o.Discount,
       CAST(o.Profit AS DOUBLE) AS Profit, o.Order_Date, c.customer_name, c.country, p.Category, p.Sub_Category
FROM (SELECT DISTINCT * FROM orders_parsed) o
LEFT JOIN one_customer c ON o.Customer_ID = c.customer_id
LEFT JOIN silver_products p ON o.Product_ID = p.Product_ID""", _UNIQUE),
    "dimension_rejects": with_layers("""
SELECT *, 'lost_to_survivor' AS reason FROM
  (SELECT DISTINCT * FROM hot_customer WHERE customer_id IS NOT NULL EXCEPT SELECT * FROM one_customer)
UNION ALL SELECT DISTINCT *, 'null_key' FROM hot_customer WHERE customer_id IS NULL""", _UNIQUE),
    "published_medallion": with_layers(f"""
SELECT 1 AS version, {_GOLD_OUT} FROM gold
UNION ALL SELECT 2, {_GOLD_OUT} FROM even_gold""", {"even_gold": """
SELECT CAST(year(Order_Date) AS INTEGER) AS Year, Category AS Product_Category, Sub_Category AS Product_Sub_Category,
       Customer_ID, customer_name, round(sum(Profit), 2) AS Profit
FROM silver_orders WHERE Order_ID % 2 = 0 GROUP BY ALL"""}),
    "gold_incremental": with_layers(f"SELECT {_GOLD_OUT}, coalesce(Year IN (1996, 1997), false) AS rewritten FROM gold"),
})


# ------------------------------------------------------------- quarantine

_QUARANTINED_ORDERS = with_layers("""
SELECT Row_ID, Order_ID, Order_Date, CAST(Profit AS DOUBLE) AS Profit,
       CAST(NULL AS VARCHAR) AS raw, CAST(NULL AS VARCHAR) AS reason
FROM (SELECT DISTINCT * FROM bronze_orders) WHERE Order_ID % 17 <> 0 AND Order_ID % 19 <> 0
UNION ALL
SELECT NULL, NULL, NULL, NULL,
       '{"Row_ID":' || Row_ID || CASE WHEN Order_ID % 17 = 0 THEN ',"Order_' ELSE ',"Quantity":"many","Profit":"much"}' END,
       CASE WHEN Order_ID % 17 = 0 THEN 'malformed' ELSE 'bad value: Quantity, Profit' END
FROM bronze_orders WHERE Order_ID % 17 = 0 OR Order_ID % 19 = 0""")

ORACLE.update({
    "quarantine_json": _QUARANTINED_ORDERS,
    "stream_quarantine": _QUARANTINED_ORDERS,
    "quarantine_csv": with_layers("""
SELECT *, CAST(NULL AS VARCHAR) AS raw, CAST(NULL AS VARCHAR) AS reason
FROM bronze_products WHERE Product_ID % 13 <> 0 AND Product_ID % 29 <> 0
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL,
       Product_ID || ',' || Category || ',' || Sub_Category || CASE WHEN Product_ID % 13 = 0 THEN '' ELSE ',' || Product_Name || ',free' END,
       CASE WHEN Product_ID % 13 = 0 THEN 'malformed' ELSE 'bad value: Price per product' END
FROM bronze_products WHERE Product_ID % 13 = 0 OR Product_ID % 29 = 0"""),
})

ORACLE["report_lattice"] = with_layers("\nUNION ALL\n".join(
    f"SELECT '{report}' AS report, "
    + ", ".join(k if k in keys else f"CAST(NULL AS {kind}) AS {k}" for k, kind in (
        ("Year", "INTEGER"), ("Product_Category", "VARCHAR"), ("Customer_ID", "BIGINT"), ("customer_name", "VARCHAR")))
    + f", CAST(round(sum(Profit), 2) AS DOUBLE) AS total_profit_by_year FROM gold GROUP BY {', '.join(keys)}"
    for report, keys in (("year", ("Year",)), ("year_category", ("Year", "Product_Category")),
                         ("customer", ("Customer_ID", "customer_name")), ("customer_year", ("Year", "Customer_ID")))))
ORACLE["late_dimensions"] = ORACLE["silver_orders"]
