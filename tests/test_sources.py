import datetime as dt
import glob
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.functions import documents as docs
from ledgerlark.functions.buckets import year_starts
from ledgerlark.sources import catalog, delimited, partitioned, xmlfiles

SCHEMA = T.StructType().add("id", "integer").add("name", "string").add("note", "string")
VALUES = [
    (1, "Чашка", "a|b"),
    (2, "", None),
    (3, None, ""),
    (4, " padded ", 'quote " inside'),
    (5, "ends@eu&$here", "\\N is text"),
    (6, "\\", "tab\there"),
    (7, "\\N", "\\\\N"),
    (8, "two\nlines", "\"\n"),
    (9, "ਊ਀Ā", "\r"),
]


@pytest.mark.parametrize("separator", ["|", "@eu&$"])
@pytest.mark.parametrize("encoding", ["UTF-16LE", "UTF-8"])
def test_delimited_roundtrip(spark, tmp_path, rows, separator, encoding):
    path = str(tmp_path / "out")
    df = spark.createDataFrame(VALUES, SCHEMA)
    delimited.export(df.repartition(2), path, separator, encoding)
    assert rows(delimited.load(spark, path, SCHEMA, separator, encoding)) == rows(df)


def test_export_is_utf16(spark, tmp_path):
    path = str(tmp_path / "out")
    delimited.export(spark.createDataFrame([(1, "Чашка", "x")], SCHEMA).coalesce(1), path)
    content = b"".join(open(f, "rb").read() for f in glob.glob(path + "/part-*"))
    assert content.decode("utf-16-le") == "1|Чашка|x\n"


def test_files_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(delimited, "ROWS_PER_FILE", 10)
    path = str(tmp_path / "out")
    df = spark.range(35).select(F.col("id").cast("int"), F.lit("n").alias("name"), F.lit("x").alias("note"))
    delimited.export(df.coalesce(1), path)
    assert len(glob.glob(path + "/part-*")) == 4
    assert delimited.load(spark, path, SCHEMA).count() == 35


def test_quarantine(spark, tmp_path, rows):
    path = str(tmp_path / "out")
    texts = spark.createDataFrame([("1", "a", "x"), ("one", "b", "y"), ("3", None, "")], "id string, name string, note string")
    delimited.export(texts, path)
    extra = str(tmp_path / "out" / "part-extra.csv")
    with open(extra, "wb") as file:
        file.write("7|too|many|fields\n".encode("utf-16-le"))
    good, bad = delimited.load_with_quarantine(spark, path, SCHEMA)
    assert rows(good) == [(1, "a", "x"), (3, None, "")]
    assert rows(bad) == [("7|too|many|fields",), ("one|b|y",)]


def test_strict_load_stops(spark, tmp_path):
    path = str(tmp_path / "out")
    delimited.export(spark.createDataFrame([("one", "b", "y")], "id string, name string, note string"), path)
    with pytest.raises(Exception):
        delimited.load(spark, path, SCHEMA).collect()


def test_load_errors_are_reported(spark, tmp_path, rows):
    df, error = delimited.try_load(spark, str(tmp_path / "none"), SCHEMA, str(tmp_path / "t1"))
    assert df is None and error.code == "PATH_NOT_FOUND"

    wrong = str(tmp_path / "wrong")
    delimited.export(spark.createDataFrame([("one", "b", "y")], "id string, name string, note string"), wrong)
    df, error = delimited.try_load(spark, wrong, SCHEMA, str(tmp_path / "t2"))
    assert df is None and error.code.isupper() and error.message

    right = str(tmp_path / "right")
    delimited.export(spark.createDataFrame(VALUES, SCHEMA), right)
    df, error = delimited.try_load(spark, right, SCHEMA, str(tmp_path / "t3"))
    assert error is None and rows(df) == rows(spark.createDataFrame(VALUES, SCHEMA))


def test_large_narrow_file_is_shared_by_tasks(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(20_000).select(F.col("id").cast("int"), F.lit("name").alias("name"), F.lit("").alias("note"))
    delimited.export(df.coalesce(1), path, encoding="UTF-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50KB")
    try:
        whole = delimited.load(spark, path, SCHEMA, encoding="UTF-8")
        cut = delimited.load(spark, path, SCHEMA, encoding="UTF-8", cut_files=True)
        assert whole.rdd.getNumPartitions() == 1 < cut.rdd.getNumPartitions()
        assert cut.count() == whole.count() == 20_000
        assert cut.agg(F.sum("id")).head()[0] == 19_999 * 10_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.fixture
def small_ranges(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3001")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("encoding", ["UTF-16LE", "UTF-16BE"])
def test_wide_file_is_shared_by_tasks(spark, tmp_path, rows, small_ranges, encoding):
    """Values with line ends, quotes, separators and long texts, cut anywhere."""
    draw = random.Random(1)
    notes = ["", None, "a\nb", '"', 'x"\n"y', "|", "\\N", "\n\n\n", " Чашка 😀 ", "long \n" * 700, "plain"]
    data = [(i, draw.choice(notes), draw.choice(notes)) for i in range(700)]
    df = spark.createDataFrame(data, SCHEMA)
    path = str(tmp_path / "out")
    delimited.export(df.coalesce(1), path, encoding=encoding)
    cut = delimited.load(spark, path, SCHEMA, encoding=encoding, cut_files=True)
    lines = spark.read.option("encoding", encoding).option("lineSep", "\n").text(path)
    assert lines.rdd.getNumPartitions() > 8
    assert rows(cut) == rows(df) == rows(delimited.load(spark, path, SCHEMA, encoding=encoding))


def test_quarantine_of_a_cut_file_is_that_of_a_whole_one(spark, tmp_path, rows, small_ranges):
    path = tmp_path / "in.txt"
    lines = [f"{i}|name {i}|note" for i in range(600)]
    for at, bad in ((50, "x|not a number|n"), (300, "1|too|many|parts"), (301, ""), (450, "77"), (599, '5|"open value|n')):
        lines[at] = bad
    lines[200] = '200|"two\nlines ""quoted"""|n'
    path.write_bytes(("\ufeff" + "\n".join(lines) + "\n").encode("utf-16-le"))
    whole = delimited.load_with_quarantine(spark, str(path), SCHEMA)
    cut = delimited.load_with_quarantine(spark, str(path), SCHEMA, cut_files=True)
    # A whole file keeps the mark of the byte order in its first value; a cut one drops it.
    good = [r for r in rows(cut[0]) if r[0] != 0]
    assert good == [r for r in rows(whole[0]) if r[0] != 0] and len(good) == 594
    assert (0, "name 0", "note") in rows(cut[0])
    named = sorted(r[0].rstrip("\n") for r in rows(cut[1]))
    assert named == sorted(r[0].rstrip("\n") for r in rows(whole[1]) if "name 0" not in r[0])


def test_line_ends_inside_characters_are_refused(spark, tmp_path, small_ranges):
    path = tmp_path / "in.txt"
    path.write_bytes("".join(f"{i}|\u0a05\u0100|n\n" for i in range(300)).encode("utf-16-le"))
    with pytest.raises(ValueError):
        delimited.load(spark, str(path), SCHEMA, cut_files=True)
    with pytest.raises(ValueError):
        delimited.load(spark, str(path), SCHEMA, encoding="UTF-16", cut_files=True)
    empty = tmp_path / "empty.txt"
    empty.write_bytes(b"")
    assert delimited.load(spark, str(empty), SCHEMA, cut_files=True).count() == 0


def test_reconcile(spark, rows):
    both = {"a": (spark.range(5), spark.range(3)), "b": (spark.range(2), spark.range(2))}
    assert rows(delimited.reconcile(both)) == [("a", 5, 3, 2), ("b", 2, 2, 0)]


ITEMS = """<StockItems>
  <Item Name="Chocolate frogs 250g">
    <SupplierID>1</SupplierID>
    <Package><UnitPackageID>1</UnitPackageID><TypicalWeightPerUnit>0.250</TypicalWeightPerUnit></Package>
    <LeadTimeDays>3</LeadTimeDays><IsChillerStock>true</IsChillerStock><UnitPrice>8.55</UnitPrice>
  </Item>
  <Item Name="Cup &amp; saucer"><SupplierID>4</SupplierID></Item>
</StockItems>"""


def test_shred_column(spark):
    df = spark.createDataFrame([(1, ITEMS), (2, "<StockItems>"), (3, None)], "id int, body string")
    got = {r.item_name: r for r in xmlfiles.shred_items(df, "body").collect()}
    assert set(got) == {"Chocolate frogs 250g", "Cup & saucer"}
    first = got["Chocolate frogs 250g"]
    assert (first.supplier_id, first.unit_package_id, str(first.typical_weight)) == (1, 1, "0.250")
    assert (first.is_chiller_stock, str(first.unit_price)) == (True, "8.55")
    assert got["Cup & saucer"].unit_package_id is None


def test_files_and_column_agree(spark, tmp_path, rows):
    (tmp_path / "items.xml").write_text(ITEMS)
    files = xmlfiles.read_items(spark, str(tmp_path / "items.xml"))
    column = xmlfiles.shred_items(spark.createDataFrame([(ITEMS,)], "body string"), "body")
    assert rows(files) == rows(column)


def test_export_has_attribute_root_and_order(spark, tmp_path, rows):
    items = xmlfiles.shred_items(spark.createDataFrame([(ITEMS,)], "body string"), "body")
    path = str(tmp_path / "xml")
    xmlfiles.write_items(items.coalesce(1), path)
    text = "".join(open(f, encoding="utf8").read() for f in sorted(glob.glob(path + "/part-*")))
    assert "<StockItems>" in text and '<Item Name="Cup &amp; saucer">' in text
    assert text.index("Chocolate") < text.index("saucer")
    assert rows(xmlfiles.read_items(spark, path)) == rows(items)


def test_whole_file_in_one_value(spark, tmp_path):
    (tmp_path / "items.xml").write_text(ITEMS)
    whole = spark.read.text(str(tmp_path / "items.xml"), wholetext=True)
    assert xmlfiles.shred_items(whole, "value").count() == 2


def test_nested_struct(spark):
    column = docs.nested({"A": F.lit(1), "P/x": F.lit("u"), "P/y": F.lit("v")})
    assert spark.range(1).select(column.alias("s")).head().s.asDict(True) == {"A": 1, "P": {"x": "u", "y": "v"}}


BOUNDS = year_starts(2012, 2014)


def test_partitioned_table(spark, tmp_path):
    days = [dt.date(2011, 12, 31), dt.date(2012, 1, 1), dt.date(2013, 6, 1), dt.date(2014, 1, 1), dt.date(2020, 1, 1)]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "id int, day date")
    path = str(tmp_path / "table")
    partitioned.write_by_range(df, "day", BOUNDS, path)
    table = partitioned.read_by_range(spark, path)
    assert {r.id: r.part_id for r in table.collect()} == {0: 1, 1: 2, 2: 3, 3: 4, 4: 4}
    plan = table.filter("part_id = 4")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part_id" in plan
    found = {r.part_id: (r.qty, r.min_day, r.max_day) for r in partitioned.distribution(df, "day", BOUNDS).collect()}
    assert found[4] == (2, days[3], days[4]) and len(found) == 4


def test_boundaries(spark, rows):
    assert rows(partitioned.boundary_table(spark, BOUNDS))[0] == (1, 2, dt.date(2012, 1, 1))


def test_catalog_helpers(spark):
    df = spark.createDataFrame(VALUES, SCHEMA)
    empty = catalog.empty_like(df)
    assert empty.schema == df.schema and empty.count() == 0
    catalog.ensure_table(spark, "copy_of_values", SCHEMA)
    catalog.ensure_table(spark, "copy_of_values", SCHEMA)
    assert spark.table("copy_of_values").count() == 0
    spark.sql("DROP TABLE copy_of_values")
