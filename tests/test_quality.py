"""Every check with a passing and a failing input."""

from decimal import Decimal

from strata.operators import quality as Q


def test_pk_null(rows):
    ok = rows([(1,), (2,)], "k bigint")
    bad = rows([(1,), (None,)], "k bigint")
    assert Q.pk_null_rows(ok, "k").count() == 0
    assert Q.pk_null_rows(bad, "k").count() == 1


def test_pk_unique_counts_null_as_a_key(rows):
    ok = rows([(1,), (2,), (None,)], "k bigint")
    bad = rows([(1,), (1,), (None,), (None,)], "k bigint")
    assert Q.duplicate_keys(ok, "k").count() == 0
    assert sorted(map(tuple, Q.duplicate_keys(bad, "k").collect()), key=str) == [(1, 2), (None, 2)]


def test_string_and_date_types(rows):
    df = rows([("a", 1, None)], "s string, i int, d date")
    assert Q.is_string_column(df, "s") and not Q.is_string_column(df, "i")
    assert Q.is_date_column(df, "d") and not Q.is_date_column(df, "s")
    assert not Q.is_string_column(df, "missing")


def test_unparsed_dates(rows):
    df = rows([("3/1/2016",), ("n/a",), (None,)], "Order_Date string")
    assert [r[0] for r in Q.unparsed_date_rows(df).collect()] == ["n/a"]
    assert Q.unparsed_date_rows(rows([("1/1/2020",)], "Order_Date string")).count() == 0


def test_excess_decimals(rows):
    assert Q.excess_decimal_rows(rows([(1.25,), (3.0,)], "Profit double")).count() == 0
    assert Q.excess_decimal_rows(rows([(1.255,)], "Profit double")).count() == 1


def test_missing_columns_exact_case(rows):
    df = rows([(1,)], "Product_ID int")
    assert Q.missing_columns(df, ["Product_ID"]) == []
    assert Q.missing_columns(df, ["product_id", "Category"]) == ["product_id", "Category"]


def test_non_empty(rows, spark):
    assert Q.is_non_empty(rows([(1,)], "a int"))
    assert not Q.is_non_empty(spark.range(0))
    r = Q.empty_table_row(spark.range(0), "t").first()
    assert (r["violations"], r["passed"]) == (1, False)
    r = Q.empty_table_row(spark.range(5), "t").first()
    assert (r["violations"], r["passed"]) == (0, True)


GOLD = "Year int, Product_Category string, Product_Sub_Category string, Customer_ID bigint, " \
       "customer_name string, Profit decimal(28,2)"
SILVER = "Order_Date date, Category string, Sub_Category string, Customer_ID bigint, " \
         "customer_name string, Profit decimal(18,2)"


def _silver(rows):
    import datetime as dt
    return rows([(dt.date(2016, 1, 3), "C", "S", 1, "Ann", Decimal("0.13")),
                 (dt.date(2016, 2, 3), "C", "S", 1, "Ann", Decimal("0.13")),
                 (None, None, None, 2, None, Decimal("1.00"))], SILVER)


def _good_gold(rows):
    return rows([(2016, "C", "S", 1, "Ann", Decimal("0.26")),
                 (None, None, None, 2, None, Decimal("1.00"))], GOLD)


def test_gold_grouping(rows):
    assert Q.gold_grouping_violations(_good_gold(rows)).count() == 0
    dup = _good_gold(rows).unionByName(_good_gold(rows).limit(1))
    assert Q.gold_grouping_violations(dup).count() == 1


def test_gold_mismatches(rows):
    assert Q.gold_mismatches(_silver(rows), _good_gold(rows)).count() == 0
    wrong = rows([(2016, "C", "S", 1, "Ann", Decimal("0.25")),
                  (None, None, None, 2, None, Decimal("1.00")),
                  (2020, "C", "S", 3, "Zed", Decimal("5.00"))], GOLD)
    # one wrong total, one group that silver does not have
    assert Q.gold_mismatches(_silver(rows), wrong).count() == 2


def test_gold_group_counts_match_the_separate_checks(rows):
    def counts(gold):
        return {r["check_name"]: r["violations"]
                for r in Q.gold_group_counts(_silver(rows), gold).collect()}

    good = _good_gold(rows)
    assert counts(good) == {"gold_grouping": 0, "gold_accuracy": 0}
    doubled = good.unionByName(good.limit(1))
    assert counts(doubled) == {
        "gold_grouping": Q.gold_grouping_violations(doubled).count(),
        "gold_accuracy": Q.gold_mismatches(_silver(rows), doubled).count()} == {
        "gold_grouping": 1, "gold_accuracy": 1}


def test_gold_total_accuracy(rows):
    assert Q.gold_total_accuracy(_silver(rows), _good_gold(rows)).first()["passed"]
    wrong = rows([(2016, "C", "S", 1, "Ann", Decimal("0.25"))], GOLD)
    assert not Q.gold_total_accuracy(_silver(rows), wrong).first()["passed"]


def test_name_format(rows):
    assert Q.name_format_rows(rows([("Ann",), (None,)], "customer_name string")).count() == 0
    assert Q.name_format_rows(rows([("Ann 1",), ("",)], "customer_name string")).count() == 2


def test_year_range(rows):
    ok = rows([(1999,), (2026,), (1990,)], "Year int")
    bad = rows([(None,), (1989,), (12000,), (2027,)], "Year int")
    assert Q.year_range_rows(ok).count() == 0
    assert Q.year_range_rows(bad).count() == 4


def test_missing_keys_null_safe(rows):
    fact = rows([(1,), (None,), (3,), (3,)], "k bigint")
    dim = rows([(1,)], "id bigint")
    got = sorted((r[0] for r in Q.missing_keys(fact, "k", dim, "id").collect()), key=str)
    assert got == [3, None]
    assert Q.missing_keys(rows([(1,)], "k bigint"), "k", dim, "id").count() == 0


def test_missing_key_counts_match_one_check_per_key(rows):
    fact = rows([(1, "a"), (None, "a"), (3, None), (3, "b"), (None, None)], "c bigint, p string")
    cust = rows([(1,), (2,)], "id bigint")
    prod = rows([("a",), (None,)], "pid string")
    fks = [Q.ForeignKey("fk_c", "c", cust, "id"), Q.ForeignKey("fk_p", "p", prod, "pid")]
    got = {r["check_name"]: (r["column_name"], r["violations"])
           for r in Q.missing_key_counts(fact, fks).collect()}
    assert got == {"fk_c": ("c", Q.missing_keys(fact, "c", cust, "id").count()),
                   "fk_p": ("p", Q.missing_keys(fact, "p", prod, "pid").count())}
    assert got == {"fk_c": ("c", 2), "fk_p": ("p", 1)}  # c: 3 and null; p: "b" (null is in prod)
    clean = Q.missing_key_counts(rows([(1, "a")], "c bigint, p string"), fks).collect()
    assert {r["violations"] for r in clean} == {0}

    # a dimension key wider than the fact key: compared in the wider type
    wide = rows([(1,), (2**40,)], "id bigint")
    narrow = rows([(1,), (2,)], "c int")
    (r,) = Q.missing_key_counts(narrow, [Q.ForeignKey("fk", "c", wide, "id")]).collect()
    assert r["violations"] == 1 == Q.missing_keys(narrow, "c", wide, "id").count()


def test_category_counts(rows):
    bronze = rows([(1, "A", "x"), (2, "B", "y"), (3, None, "y")], "Product_ID int, Category string, Sub_Category string")
    same = Q.category_counts(bronze, bronze)
    assert all(r["passed"] for r in same.collect())
    lost = bronze.filter("Category = 'A'")
    by_col = {r["column_name"]: r for r in Q.category_counts(lost, bronze).collect()}
    assert by_col["Category"]["bronze_distinct"] == 3  # null counts as a value
    assert not by_col["Category"]["passed"]
    diff = Q.category_value_differences(lost, bronze, "Category")
    assert {(r[0], r[1]) for r in diff.collect()} == {("B", "silver"), (None, "silver")}


def test_category_counts_empty_silver_fails(rows):
    bronze = rows([(1, "A", "x")], "Product_ID int, Category string, Sub_Category string")
    out = Q.category_counts(bronze.filter("false"), bronze).collect()
    assert {r["silver_distinct"] for r in out} == {0}
    assert all(r["passed"] is False for r in out)


def test_profit_totals_rounding_grain(rows):
    bronze = rows([(1, Decimal("0.125")), (2, Decimal("0.125")), (3, Decimal("0.125"))],
                  "Row_ID int, Profit decimal(18,4)")
    silver = rows([(1, Decimal("0.13")), (2, Decimal("0.13")), (3, Decimal("0.13"))],
                  "Row_ID int, Profit decimal(18,2)")
    gold = rows([(Decimal("0.39"),)], "Profit decimal(28,2)")
    r = Q.profit_totals(bronze, silver, gold).first()
    assert r["bronze_profit"] == Decimal("0.38") and r["bronze_rounded_profit"] == Decimal("0.39")
    assert r["passed"] and not r["passed_raw"]
    wrong_gold = rows([(Decimal("0.40"),)], "Profit decimal(28,2)")
    assert not Q.profit_totals(bronze, silver, wrong_gold).first()["passed"]


def test_quality_report_flags_planted_defects(spark):
    """The fused report over the sf0.001 layers: clean layers fail only the
    checks the adapter noise trips; planted defects fail their own checks."""
    from conftest import SF_SMALL
    from strata.plans.layers import build_layers
    from strata.sources import variants as V

    L = build_layers(spark, SF_SMALL)

    def failed(**overrides):
        frames = dict(bronze_orders=L.bronze.orders, bronze_customer=L.bronze.customer,
                      bronze_products=L.bronze.products, silver_customer=L.silver_customer,
                      silver_products=L.silver_products, silver_orders=L.silver_orders, gold=L.gold)
        frames.update(overrides)
        rep = Q.quality_report(spark, Q.LayerFrames(**frames))
        return {(r["check_name"], r["table_name"]) for r in rep.filter("not passed").collect()}

    # adapter noise: unparseable dates, 4-decimal bronze profit, orphan keys, null names, null years
    base = {("date_unparsed", "bronze_orders"), ("decimal_places", "bronze_orders"),
            ("fk_customer", "silver_orders"), ("fk_product", "silver_orders"),
            ("null_name", "silver_customer"), ("year_range", "gold")}
    assert failed() == base
    assert failed(silver_customer=V.customers_dup_key(L.silver_customer)) >= base | {
        ("pk_unique", "silver_customer")}
    assert ("pk_null", "silver_customer") in failed(silver_customer=V.customers_null_key(L.silver_customer))
    assert ("category_sets", "silver_products") in failed(silver_products=V.products_lost(L.silver_products))
    dup = failed(gold=V.gold_dup(L.gold))
    assert {("gold_grouping", "gold"), ("gold_accuracy", "gold")} <= dup
    # the layer totals de-duplicate each layer first, so exact copies of gold
    # rows leave them equal: only the grouping and accuracy checks see copies
    assert ("profit_layers", "gold") not in dup


def test_row_rules_carry_the_non_empty_check(rows):
    df = rows([(1,), (None,)], "k bigint")
    out = {r["check_name"]: (r["violations"], r["passed"])
           for r in Q.row_rule_counts(df, "t", [Q.RowRule("pk_null", "k", df.k.isNull())],
                                      non_empty=True).collect()}
    assert out == {"pk_null": (1, False), "non_empty": (0, True)}
    empty = {r["check_name"]: (r["violations"], r["passed"])
             for r in Q.row_rule_counts(df.filter("false"), "t", [], non_empty=True).collect()}
    assert empty == {"non_empty": (1, False)}


def test_bad_numbers(rows):
    df = rows([(1.5,), (float("nan"),), (float("-inf"),), (None,)], "Profit double")
    assert Q.bad_number_rows(df).count() == 2
    assert Q.bad_number_rows(rows([(Decimal("1.5"),)], "Profit decimal(18,4)")).count() == 0


def test_type_violations_and_missing_columns_as_rows(rows):
    df = rows([("a", 1), ("b", 2)], "s string, i int")
    assert tuple(Q.type_violations(df, "t", "s", ("string",)).first()) == ("t", "s", 2, 0, True)
    assert tuple(Q.type_violations(df, "t", "i", ("string",)).first()) == ("t", "i", 2, 2, False)
    assert [tuple(r) for r in Q.missing_column_rows(df, "t", ("s", "S", "x")).collect()] == [("t", "S", 2), ("t", "x", 2)]
    assert Q.missing_column_rows(df, "t", ("s",)).count() == 0


def test_keyed_rule_counts(rows):
    df = rows([(1, "a"), (1, None), (None, "b1"), (2, None)], "k bigint, name string")
    rules = [Q.RowRule("null_name", "name", df.name.isNull())]
    got = {r["check_name"]: r["violations"] for r in Q.keyed_rule_counts(df, "t", "k", rules).collect()}
    assert got == {"pk_null": 1, "pk_unique": 1, "non_empty": 0, "null_name": 2}
    empty = {r["check_name"]: (r["violations"], r["passed"]) for r in Q.keyed_rule_counts(df.limit(0), "t", "k", rules).collect()}
    assert empty == {"pk_null": (0, True), "pk_unique": (0, True), "non_empty": (1, False), "null_name": (0, True)}


def test_report_is_the_same_for_distinct_layers(spark):
    from strata.plans.layers import build_layers

    L = build_layers(spark, "/root/testdata/sf0.001")
    frames = Q.LayerFrames(
        bronze_orders=L.bronze.orders, bronze_customer=L.bronze.customer, bronze_products=L.bronze.products,
        silver_customer=L.silver_customer, silver_products=L.silver_products, silver_orders=L.silver_orders, gold=L.gold)
    plain, distinct = (sorted(map(tuple, Q.quality_report(spark, frames, layers_distinct=d).collect()), key=str) for d in (False, True))
    assert plain == distinct and len(plain) == 26


def test_profit_layers_with_repeated_lineitem_rows(spark, tmp_path):
    """Both queries against their SQL twins on raw orders that hold repeated rows."""
    import os

    import duckdb

    from strata.plans.catalog import QUERIES
    from strata.plans.oracle import ORACLE

    source = "/root/testdata/sf0.001"
    for name in os.listdir(source):
        if name != "lineitem.parquet":
            os.symlink(f"{source}/{name}", tmp_path / name)
    lines = spark.read.parquet(f"{source}/lineitem.parquet")
    extra = lines.where("l_orderkey % 3 = 0")
    lines.unionByName(extra).unionByName(extra).coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        files = f"{tmp_path}/{t}.parquet" + ("/*.parquet" if t == "lineitem" else "")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{files}')")
    for query in ("dq_profit_layers", "dq_report"):
        rel = con.sql(ORACLE[query])
        got = QUERIES[query](spark, str(tmp_path)).select(*rel.columns).collect()
        rows = lambda found: sorted(str(tuple(round(v, 6) if isinstance(v, float) else v for v in r)) for r in found)
        assert rows(got) == rows(rel.fetchall())
    assert QUERIES["dq_profit_layers"](spark, str(tmp_path)).first()["passed"]
