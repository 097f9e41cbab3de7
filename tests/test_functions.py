import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ludolens import functions as fn
from ludolens.operators import currency
from ludolens.sources import rate_table

PRICES = {
    "$9.99": ("$", 9.99),
    "R$ 37,99": ("R$", 37.99),
    "A$ 12.50": ("A$", 12.5),
    "€9.99": ("€", 9.99),
    "£7": ("£", 7.0),
    "₹ 1.299": ("₹", 1.299),
    "9,99€": ("", 9.99),
    "CDN$ 5.00": ("CDN$", 5.0),
    "$1,234.56": ("$", None),
    "9.99": ("", 9.99),
    "12,--€": ("", 12.0),
    "Free": ("Free", None),
    ".": (".", None),
    "": ("", None),
    None: (None, None),
}

YEARS = {
    "12/1/2023": 2023,
    "13/1/2023": 2023,
    "31/31/2023": None,
    "30/2/2023": None,
    "Dec 1, 2023": 2023,
    "12 Jan, 2023": 2023,
    "Q1 2025": 2025,
    "maybe Q3 2026": 2026,
    "Q5 2026": None,
    "2025": 2025,
    "20255": None,
    "Coming Soon": None,
    "Not Announced": None,
    "2023-12-01": None,
    "December 1, 2023": None,
    "Foo 1, 2023": None,
    "Feb 30, 2023": None,
    "": None,
    None: None,
}


def _texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "t string")


def test_price_shapes(spark):
    parsed = currency.parse_price(_texts(spark, PRICES), "t")
    assert {r["t"]: (r["symbol"], r["amount"]) for r in parsed.collect()} == PRICES


def test_first_comma_only(spark):
    out = _texts(spark, ["1,2,3", "1.2"]).select(
        fn.dot_decimals(F.col("t"), first_only=True), fn.dot_decimals(F.col("t"))
    )
    assert [tuple(r) for r in out.collect()] == [("1.2,3", "1.2.3"), ("1.2", "1.2")]


def test_release_year_shapes(spark):
    out = _texts(spark, YEARS).select("t", fn.release_year(F.col("t")).alias("y"))
    assert {r["t"]: r["y"] for r in out.collect()} == YEARS


def test_year_label_and_prefix(spark):
    out = _texts(spark, ["2020-05-06", None]).select(
        fn.year_prefix(F.col("t")), fn.year_label(fn.year_prefix(F.col("t")).cast("int"))
    )
    assert [tuple(r) for r in out.collect()] == [("2020", "2020"), (None, "Unknown")]


@pytest.mark.parametrize(
    "text,number",
    [("9.99", 9.99), ("9.9", 9.9), ("10", 10.0), ("9.999", None), ("$9", None), ("9.", None), (None, None)],
)
def test_valid_price(spark, text, number):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(fn.valid_price(F.col("t"))).first()[0] == number


def test_price_category(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (None,)], "p double")
    out = [r[0] for r in df.select(fn.price_category(F.col("p"))).collect()]
    assert out == ["Free", "Paid", "Paid"]


def test_arrays(spark):
    df = spark.createDataFrame([([" a ", None],), ([],), (None,)], "g array<string>")
    out = [r[0] for r in df.select(fn.trim_array(fn.default_array(F.col("g")))).collect()]
    assert out == [["a", None], [], ["Unknown"]]


def test_half_cents_round_up(spark):
    df = spark.createDataFrame(
        [(1.005, 1.0, 1.01), (2.675, 1.0, 2.68), (1e15, 2.0, 2e15), (0.0, 3.0, 0.0), (None, 1.0, None)],
        "a double, r double, usd double",
    )
    out = df.select("usd", fn.dollars(F.col("a"), F.col("r")).alias("got")).collect()
    assert [r["got"] for r in out] == [r["usd"] for r in out]


def test_function_equals_join(spark):
    rates = rate_table(spark, {"USD": 1.0, "EUR": 1.0842, "INR": 0.011963, "XXX": 123456.789})
    df = spark.range(20000).select(
        "id",
        (F.col("id") * 0.355).alias("amount"),
        F.element_at(F.array(*[F.lit(c) for c in ("USD", "EUR", "INR", "XXX", "ABC")]), (F.col("id") % 5 + 1).cast("int")).alias("currency_code"),
    )
    df = df.withColumn("currency_code", F.when(F.col("id") % 7 > 0, F.col("currency_code")))
    df = df.withColumn("amount", F.when(F.col("id") % 11 > 0, F.col("amount")))
    convert = currency.to_usd_udf(rates)
    both = currency.to_usd(df, rates).withColumn("udf", convert("amount", "currency_code"))
    assert both.where(~F.col("udf").eqNullSafe(F.col("price_usd"))).count() == 0
    assert both.where("price_usd is not null").count() > 8000


def test_repeated_rate_is_an_error(spark):
    rates = spark.createDataFrame([("USD", 1.0), ("USD", 2.0)], "currency_code string, usd_per_unit double")
    with pytest.raises(ValueError):
        currency.checked_rates(rates)


def test_passthrough(spark):
    df = spark.createDataFrame([("$",), ("USD",), ("",), (None,)], "symbol string")
    plain = {r["symbol"]: r["currency_code"] for r in currency.with_currency(df).collect()}
    passed = {r["symbol"]: r["currency_code"] for r in currency.with_currency(df, passthrough=True).collect()}
    assert plain == {"$": "USD", "USD": None, "": None, None: None}
    assert passed == {"$": "USD", "USD": "USD", "": "", None: None}


GAMES = [
    {"appid": 1, "name": "plain", "tags": ["a", "b"], "at": {"d": "x", "n": None}},
    {"appid": 2, "name": 'quote " back \\ slash / tab \t', "tags": [], "at": None},
    {"appid": 3, "name": "€ ₹ é 日本 😀", "tags": None, "at": {"d": "ü", "n": 4}},
    {"appid": None, "name": None, "tags": [None, "z,:"], "at": {"d": None, "n": None}},
]


def test_json_bytes_equal_a_json_writer(spark):
    schema = "appid bigint, name string, tags array<string>, at struct<d:string,n:int>"
    df = spark.createDataFrame([T.Row(**g) for g in GAMES], schema)
    sizes = [r[0] for r in df.select(fn.json_bytes(df)).collect()]
    assert sizes == [len(json.dumps(g).encode()) for g in GAMES]
