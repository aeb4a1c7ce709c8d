import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlark.functions import calendar as cal
from ledgerlark.functions import documents as docs
from ledgerlark.functions import money, text
from ledgerlark.functions.buckets import bucket_right, year_starts
from ledgerlark.session import prepare


def one(spark, column):
    return spark.range(1).select(column).head()[0]


def day(text_value):
    return F.lit(dt.date.fromisoformat(text_value))


def test_calendar_attributes(spark):
    d = day("2015-05-31")
    assert one(spark, cal.day_first(d)) == "31.05.2015"
    assert one(spark, cal.month_name(d)) == "May"
    assert one(spark, cal.month_name_ru(d)) == "Май"
    assert one(spark, cal.month_number(d)) == 201505
    assert one(spark, cal.month_start(d)) == dt.date(2015, 5, 1)
    assert one(spark, cal.quarter_text(d)) == "2"


@pytest.mark.parametrize("month", range(1, 13))
def test_parts_of_year(spark, month):
    d = F.lit(dt.date(2015, month, 1))
    quarter, third, case = spark.range(1).select(cal.part_of_year(d, 3), cal.part_of_year(d, 4), cal.third_by_case(d)).head()
    assert quarter == (month - 1) // 3 + 1
    assert third == case == (month - 1) // 4 + 1


def test_day_gap_counts_boundaries(spark):
    late = F.lit("2015-01-01 23:59:00").cast("timestamp")
    early = F.lit("2015-01-02 00:01:00").cast("timestamp")
    assert one(spark, cal.day_gap(late, early)) == 1
    assert one(spark, cal.day_gap(early, late)) == -1


def test_parse_day_first(spark):
    assert one(spark, cal.parse_day_first(F.lit("25.12.2019"))) == dt.date(2019, 12, 25)
    assert one(spark, cal.parse_day_first(F.lit("2019-12-25"))) is None


def test_day_range_reaches_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = orders.filter(cal.days_from_to(F.col("o_orderdate"), "1998-01-01", "1998-01-31"))
    physical = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in physical and "LessThan(o_orderdate" in physical


def test_day_range_includes_both_days(spark):
    stamps = [dt.datetime(2015, 1, 1), dt.datetime(2015, 1, 31, 23, 59), dt.datetime(2015, 2, 1), None]
    df = spark.createDataFrame([(s,) for s in stamps], "at timestamp_ntz")
    assert df.filter(cal.days_from_to(F.col("at"), "2015-01-01", "2015-01-31")).count() == 2
    assert df.filter(cal.days_from_until(F.col("at"), "2015-01-01", "2015-02-01")).count() == 2


def test_text_ignores_case(spark):
    df = spark.createDataFrame([("Urgent box",), ("animal toy",), ("Toy Animal",), (None,)], "name string")
    found = df.filter(text.contains(F.col("name"), "URGENT") | text.begins(F.col("name"), "ANIMAL"))
    assert {r[0] for r in found.collect()} == {"Urgent box", "animal toy"}
    assert one(spark, text.any_case(F.lit("abc")) == "ABC")
    assert one(spark, text.any_case_padded(F.lit("abc  ")) == "ABC")
    grouped = spark.createDataFrame([("a1",), ("A1",), ("b",)], "n string").groupBy(text.any_case(F.col("n"))).count()
    assert sorted(r[1] for r in grouped.collect()) == [1, 2]


def test_wildcards_stand_for_themselves(spark):
    df = spark.createDataFrame([("a_b",), ("axb",), ("50%",), ("50 pct",)], "name string")
    assert [r[0] for r in df.filter(text.contains(F.col("name"), "A_B")).collect()] == ["a_b"]
    assert [r[0] for r in df.filter(text.begins(F.col("name"), "50%")).collect()] == ["50%"]


def test_money_keeps_or_refuses_decimals(spark):
    values = spark.createDataFrame([(0.07,), (1.1,), (-3.33,), (None,)], "v double")
    assert values.agg(money.total("v")).head()[0] == -216
    small = spark.createDataFrame([(0.004,)] * 1000, "v double")
    assert small.agg(money.total("v", 3)).head()[0] == 4000
    with pytest.raises(Exception, match="more than 2 decimals"):
        small.agg(money.total("v")).collect()
    price = spark.createDataFrame([(5_000_000, 2_000_000_000_000)], "p long, n long")
    assert price.select(money.wide("p") * F.col("n")).head()[0] == 10**19


def test_overflow_is_an_error_even_if_ansi_was_off(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    large = prepare(spark).createDataFrame([(9e16,), (9e16,)], "v double")
    with pytest.raises(Exception, match="(?i)overflow"):
        large.agg(money.total("v")).collect()


def test_text_functions(spark):
    assert one(spark, text.strip_chars(F.lit("(Gasport, NY)"), "()")) == "Gasport, NY"
    assert one(spark, text.length_unpadded(F.lit("ab  "))) == 2
    assert one(spark, text.replace_at(F.lit(", a, b"), 1, 2, "")) == "a, b"
    assert one(spark, text.first_letter(F.lit("Été"))) == "É"
    assert text.quoted("a`b") == "`a``b`"


@pytest.mark.parametrize(
    ("value", "delimiter", "wanted"),
    [
        ("aa/bb/cc", "/", ["aa", "bb", "cc"]),
        ("a//b/", "/", ["a", "b"]),
        ("a/ /b", "/", ["a", "", "b"]),
        (" a \t/ b", "/", ["a", "b"]),
        ("plain", "/", ["plain"]),
        ("", "/", []),
        (None, "/", None),
        ("a.b", ".", ["a", "b"]),
        ("a/b|c", "/|", ["a", "b", "c"]),
        ("a]b^c", "]^", ["a", "b", "c"]),
        ("a  b", "", ["a", "b"]),
        ("\u00a0a\v/b", "/", ["a", "b"]),
    ],
)
def test_parts(spark, value, delimiter, wanted):
    assert one(spark, text.parts(F.lit(value).cast("string"), delimiter)) == wanted


def test_bucket_right(spark):
    bounds = year_starts(2012, 2027)
    days = ["2011-12-31", "2012-01-01", "2012-12-31", "2013-01-01", "2027-01-01", "2030-06-01"]
    found = [one(spark, bucket_right(day(d), bounds)) for d in days]
    assert found == [1, 2, 2, 3, 17, 17]
    assert one(spark, bucket_right(F.lit(None).cast("date"), bounds)) == 1


def test_json(spark):
    df = spark.createDataFrame(
        [
            (1, '{"CountryOfManufacture":"China","Tags":["USB Powered","Vintage"]}'),
            (2, '{"CountryOfManufacture":"Japan","Tags":[]}'),
            (3, '{"CountryOfManufacture":'),
            (4, None),
            (5, '{"Tags":["Vintage","Vintage"]}'),
        ],
        "id int, fields string",
    )
    shape = "CountryOfManufacture string, Tags array<string>"
    read = df.select("id", docs.json_struct(F.col("fields"), shape).alias("j"), docs.json_tags(F.col("fields")).alias("t"))
    got = {r.id: (r.j and r.j.CountryOfManufacture, r.t) for r in read.collect()}
    assert got[1] == ("China", ["USB Powered", "Vintage"])
    assert got[2] == ("Japan", [])
    assert got[3][1] is None and got[4] == (None, None)
    assert got[5] == (None, ["Vintage", "Vintage"])


def test_tag_forms_agree(spark, rows):
    from ledgerlark.plans.documents import tagged_by_grouping, tagged_in_place

    items = spark.createDataFrame(
        [
            (1, "a", '{"Tags":["x","Vintage","y"]}'),
            (2, "b", '{"Tags":["x"]}'),
            (3, "c", '{"Tags":["Vintage","Vintage"]}'),
            (4, "d", None),
            (5, "e", '{"Tags":[]}'),
            (6, "f", "{broken"),
        ],
        "p_partkey int, p_name string, fields string",
    )
    wanted = [(1, "a", "x, Vintage, y"), (3, "c", "Vintage, Vintage")]
    assert rows(tagged_by_grouping(items, "Vintage")) == wanted
    assert rows(tagged_in_place(items, "Vintage")) == wanted


@settings(max_examples=25, deadline=None)
@given(st.integers(1, 200), st.integers(1, 40))
def test_tile_deals_evenly(total, tiles):
    """The arithmetic of ``tile`` on plain numbers."""
    size, extra = divmod(total, tiles)
    edge = extra * (size + 1)

    def group(p):
        if p <= edge:
            return (p - 1) // (size + 1) + 1
        return extra + (p - 1 - edge) // max(size, 1) + 1

    sizes = [sum(group(p) == t for p in range(1, total + 1)) for t in range(1, tiles + 1)]
    assert sizes == [size + 1] * extra + [size] * (tiles - extra)
