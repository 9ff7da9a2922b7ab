import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordwise.functions import dates, nested, values

pytestmark = pytest.mark.literal


def one(spark, column, **cells):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in cells.items())
    df = spark.createDataFrame([tuple(v for _, v in cells.values())], schema)
    return df.select(column().alias("x")).first()[0]


@pytest.mark.parametrize("budget, expected", [(0.5, "Micro"), (1.0, "Low"), (99.9, "High"), (100.0, "Top"), (None, "Top")])
def test_bucket_sends_null_to_the_last_label(spark, budget, expected):
    made = lambda: values.bucket("b", (1, 10, 50, 100), ("Micro", "Low", "Medium", "High", "Top"))
    assert one(spark, made, b=("double", budget)) == expected


def test_bucket_null_label_and_downward_edges(spark):
    assert one(spark, lambda: values.bucket("b", (1,), ("a", "z"), "none"), b=("double", None)) == "none"
    for value, band in ((150.0, "green"), (100.0, "orange"), (0.0, "red"), (-3.0, "red")):
        made = lambda: values.bucket("b", (100, 0), ("green", "orange", "red"), above=True)
        assert one(spark, made, b=("double", value)) == band
    with pytest.raises(ValueError):
        values.bucket("b", (1, 2), ("only", "two"))


@pytest.mark.parametrize("n, d, expected", [(1.0, 4.0, 0.25), (1.0, 0.0, 9.0), (1.0, None, 9.0), (None, 4.0, None)])
def test_divide_or(spark, n, d, expected):
    assert one(spark, lambda: values.divide_or("n", "d", 9.0), n=("double", n), d=("double", d)) == expected


@pytest.mark.parametrize("rev, bud, ratio, gain", [(3.0, 1.5, 2.0, 100.0), (3.0, 0.0, None, None), (None, 1.0, None, None), (1.0, -2.0, None, None)])
def test_three_definitions_of_return(spark, rev, bud, ratio, gain):
    cells = {"r": ("double", rev), "b": ("double", bud)}
    assert one(spark, lambda: values.ratio_of_positive("r", "b"), **cells) == ratio
    assert one(spark, lambda: values.percent_gain_of_positive("r", "b"), **cells) == gain
    if bud == 0.0:  # division by zero gives NULL under ANSI mode too
        assert one(spark, lambda: values.percent_gain("r", "b"), **cells) is None


def test_score_needs_every_input(spark):
    full = {"a": ("double", 5.0), "v": ("int", 0), "p": ("double", 10.0)}
    assert one(spark, lambda: values.blended_score("a", "v", "p"), **full) == pytest.approx(0.15 + 0.04)
    for missing in full:
        cells = {**full, missing: (full[missing][0], None)}
        assert one(spark, lambda: values.blended_score("a", "v", "p"), **cells) is None


def test_texts(spark):
    assert one(spark, lambda: values.money_text("x"), x=("double", 1234.5)) == "$1,234.50M"
    assert one(spark, lambda: values.percent_text("x", 1), x=("double", 12.34)) == "12.3%"
    assert one(spark, lambda: values.money_text("x"), x=("double", None)) is None
    assert one(spark, lambda: values.shorten("x", 3), x=("string", "abcd")) == "abc..."
    assert one(spark, lambda: values.shorten("x", 4), x=("string", "abcd")) == "abcd"


@pytest.mark.parametrize("text, year", [("1987-11-30", 1987), ("", None), ("30 Nov 1987", None), ("1987-02-30", None), (None, None)])
def test_bad_dates_are_null(spark, text, year):
    assert one(spark, lambda: dates.year_of("d"), d=("string", text)) == year


def test_decade(spark):
    assert [one(spark, lambda: dates.decade_of("y"), y=("int", y)) for y in (1999, 2000, None)] == [1990, 2000, None]


def test_joined_names(spark):
    kind = "array<struct<name:string,english_name:string>>"
    names = lambda: nested.joined("a", "english_name")
    assert one(spark, names, a=(kind, [("x", "X"), ("y", None), ("z", "Z")])) == "X|Z"
    assert one(spark, names, a=(kind, [("x", None)])) == ""
    assert one(spark, names, a=(kind, [])) is None
    assert one(spark, names, a=(kind, None)) is None
    assert one(spark, lambda: nested.joined("a"), a=("array<string>", ["p", "q"])) == "p|q"


def test_tokens_and_json(spark):
    assert one(spark, lambda: nested.tokens("t"), t=("string", "a|b.c|")) == ["a", "b.c", ""]
    assert one(spark, lambda: nested.first_token("t"), t=("string", "a|b")) == "a"
    assert one(spark, lambda: nested.first_token("t"), t=("string", None)) is None
    text = '[{"name": "Opera", "rank": 2}, {"rank": 3}, {"name": "Silent Film", "rank": null}]'
    assert one(spark, lambda: nested.names_in_json("t"), t=("string", text)) == "Opera|Silent Film"
    assert one(spark, lambda: nested.names_in_json("t"), t=("string", "{broken")) is None


def test_leaf_columns(spark):
    schema = T.StructType.fromDDL("id int, a struct<b: int, c: struct<d: string>>, l array<int>")
    df = spark.createDataFrame([(1, (2, ("x",)), [3])], schema)
    flat = df.select(*nested.leaf_columns(df.schema))
    assert flat.columns == ["id", "a_b", "a_c_d", "l"]
    assert tuple(flat.first()) == (1, 2, "x", [3])
    assert df.select(*nested.leaf_columns(df.schema, ".")).columns[1] == "a.b"


def test_first_token_of_empty_text(spark):
    assert one(spark, lambda: F.coalesce(nested.first_token("t"), F.lit("?")), t=("string", "")) == ""
