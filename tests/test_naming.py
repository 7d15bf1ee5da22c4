import pytest

from strata.operators.naming import clean_column_names, clean_name


def test_clean_name():
    assert clean_name("Sub-Category") == "Sub_Category"
    assert clean_name("Product Name") == "Product_Name"
    assert clean_name("a.b") == "a.b"


def test_clean_column_names(rows):
    df = rows([(1, "x")], "`Product ID` int, `Sub-Category` string")
    assert clean_column_names(df).columns == ["Product_ID", "Sub_Category"]


def test_clean_column_names_refuses_collision(rows):
    df = rows([(1, 2)], "`a b` int, `a-b` int")
    with pytest.raises(ValueError, match="both clean to"):
        clean_column_names(df)


def test_clean_column_names_noop_returns_same_frame(rows):
    df = rows([(1,)], "ok int")
    assert clean_column_names(df) is df
