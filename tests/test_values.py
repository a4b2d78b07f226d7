import datetime as dt
from html import unescape

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shelfmark.functions import dates, html, keys, text, values
from shelfmark.operators import relational as R
from shelfmark.operators.catalog import TYPE_RULES


def apply(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(fn("x").alias("y")).first().y


@pytest.mark.parametrize(
    "value, whole", [("2.5", 2), ("3.5", 4), ("-0.5", 0), (" 7 ", 7), (None, 0), ("x", None), ("NaN", 0)]
)
def test_to_int(spark, value, whole):
    assert apply(spark, value, values.to_int) == whole


def test_cleaners(spark):
    assert apply(spark, None, values.valid_float) == 0.0
    assert apply(spark, "x", values.valid_float) == 0.0
    assert apply(spark, None, values.valid_text) == "null"
    assert apply(spark, "DASHBOARD", values.report_type) == "dashboard"
    assert apply(spark, None, values.report_type) == "simple"
    assert apply(spark, "id", lambda c: values.valid_external_id(c, c)) == "id"


@pytest.mark.parametrize(
    "key, otype, parsed",
    [
        ("1.s", "schema", (1, "s", None, None)),
        ("1.c.s", "schema", (1, "c.s", None, None)),
        ("1.s.t", "table", (1, "s", "t", None)),
        ("1.c.s.t", "table", (1, "c.s", "t", None)),
        ("1.s.t.c", "column", (1, "s", "t", "c")),
        ("1.d.s.t.c", "attribute", (1, "d.s", "t", "c")),
        ("7", "data", (7, None, None, None)),
        ("1.s", "table", None),
        ("1.a.b.c.d", "table", None),
        ("x.s.t", "table", None),
    ],
)
def test_parse_key(spark, key, otype, parsed):
    got = apply(spark, key, lambda c: keys.fqn_parse(c, otype))
    assert (tuple(got) if got else None) == parsed


def test_build_key(spark):
    assert apply(spark, "A.b", lambda c: keys.fqn_build(F.lit(1), F.lit("S"), leaf=c)) == "1.s.a_b"
    assert apply(spark, None, lambda c: keys.fqn_build(F.lit(1), c)) is None


def test_paths(spark):
    assert apply(spark, "a//b//c", keys.parent_path) == "a//b"
    assert apply(spark, "a", keys.parent_path) is None
    assert apply(spark, "a//b", keys.leaf) == "b"


@pytest.mark.parametrize("algo", ["sha224", "sha256"])
def test_hash(spark, algo):
    import hashlib

    assert apply(spark, "é", lambda c: keys.hash_id(c, algo, 6)) == hashlib.new(algo, "é".encode()).hexdigest()[:6]


@pytest.mark.parametrize(
    "source, mapped",
    [
        ("SmallDateTime", "timestamp"), ("timestamp_ltz(9)", "timestamp with time zone"),
        ("VARCHAR(max)", "text"), ("nvarchar(10)", "text"), ("int8", "integer"), ("bytes", "text"),
        ("bytes2", "bytes2"), ("big_integer", "integer[]"), ("date", "date"), ("varbinary", "bytea"),
        ("number(3)", "numeric"), ("_integer", "integer[]"), ("identity", "text"),
    ],
)
def test_type_rules(spark, source, mapped):
    assert apply(spark, source, lambda c: text.regex_map(c, TYPE_RULES)) == mapped


@pytest.mark.parametrize(
    "mode, value, hit",
    [
        ("exact", "Crypto_1", True), ("iexact", "CRYPTO_1", True), ("contains", "YPT", True),
        ("startswith", "Cry", True), ("startswith", "cry", False), ("glob", "crypt*", True),
        ("glob", "crypto?1", True), ("glob", "c%", False), ("glob", "crypto-1", False),
    ],
)
def test_match_modes(spark, mode, value, hit):
    assert apply(spark, "Crypto_1", lambda c: text.match_modes(c, value, mode)) is hit


def test_text(spark):
    assert apply(spark, "End.  Next  word’s.  A", text.text_clean) == "End. Next  word's. A"
    assert apply(spark, "&lt;b&gt; &amp;amp; &eacute;&#39;", text.html_unescape) == "<b> &amp; é'"
    assert apply(spark, None, text.html_unescape) is None
    assert apply(spark, "x" * 40, lambda c: text.truncate_label(c, 25, "ab")) == "ab" + "x" * 23
    assert apply(spark, 12345, text.seq_label, "int") == "12345"
    assert apply(spark, 7, text.seq_label, "int") == "0007"
    assert apply(spark, "AROA:me:x", lambda c: text.substr_after(c, ":")) == "me:x"
    assert apply(spark, "me", lambda c: text.substr_after(c, ":")) == "me"


@pytest.mark.parametrize("value", ["a b/c+d", "ü?&=%", "~x*(y)"])
def test_url(spark, value):
    from urllib.parse import quote

    assert apply(spark, value, html.url_enc).replace("%28", "(").replace("%29", ")") == quote(value, safe="/()")
    assert apply(spark, value, lambda c: html.url_dec(html.url_enc(c))) == value


def test_dates(spark):
    df = spark.createDataFrame([(1709251199,)], "t bigint").select("t", *[
        c.alias(n) for n, c in dates.date_parts("t").items()
    ])
    assert df.select("year", "month", "day").first() == (2024, 2, 29)
    assert df.select(dates.to_unix("full_date")).first()[0] == 1709251199
    assert df.select(dates.iso_format("full_date")).first()[0] == "2024-02-29T23:59:59Z"
    parts = spark.createDataFrame([("2023", "12", "31"), ("2024", "01", "01")], "y string, m string, d string")
    wanted = dates.relative_date_filter("y", "m", "d", dt.date(2024, 1, 1))
    assert rows(parts.where(wanted)) == [("2023", "12", "31")]


def test_select_existing_walks_nested_schema(spark):
    df = spark.createDataFrame([([(1,)], (2,))], "posts array<struct<no: int>>, u struct<name: int>")
    found, missing = R.select_existing(df, ["posts.no", "posts.sub", "u.name", "u.x.y", "v"])
    assert found.columns == ["no", "name"] and missing == ["posts.sub", "u.x.y", "v"]


def test_buckets_fall_back_to_the_default(spark):
    steps = [(10, "huge"), (9, "big")]
    assert apply(spark, 9.5, lambda c: values.case_bucket(F.col(c), steps, None), "double") == "big"
    assert apply(spark, 1.0, lambda c: values.case_bucket(F.col(c), steps, None), "double") is None


def test_token_search_modes(spark):
    df = spark.createDataFrame([(1, "Gold ring", "a"), (2, "gold", "b"), (3, "golden", "a")], "id int, t string, otype string")
    assert rows(R.token_search(df, "t", "GOLD ring"), "id") == [(1,), (2,)]
    assert rows(R.token_search(df, "t", "gold ring", mode="all"), "id") == [(1,)]
    assert rows(R.token_search(df, "t", "gold", otypes=["b"]), "id") == [(2,)]


def test_entities_are_resolved_as_browsers_do(spark):
    texts = [
        "Caf&eacute; &#233; &#xE9; &nbsp;&amp;lt; &ampx &notit; &notin; &unknown; & alone &;",
        "&#128; &#0; &#x110000; &#xD800; &#99999999999999999999; &#00065; &#x1F600; &#11; &#127;",
        "&lt;&gt;&quot;&#39;&copy &CounterClockwiseContourIntegral; &NotEqualTilde;", "", "plain", None,
    ]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, t string")
    got = {r.i: r.u for r in df.select("i", text.html_unescape("t").alias("u")).collect()}
    assert got == {i: None if x is None else unescape(x) for i, x in enumerate(texts)}
