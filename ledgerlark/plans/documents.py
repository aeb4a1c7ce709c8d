"""JSON and XML values, and split text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions import documents as docs
from ledgerlark.functions import text
from ledgerlark.functions.money import money, number
from ledgerlark.plans.registry import plan
from ledgerlark.session import scratch
from ledgerlark.sources import xmlfiles
from ledgerlark.tables import Warehouse

JSON_SQL = """
    SELECT p_partkey, p_name, CASE WHEN p_type <> 'PROMO' THEN
        '{"CountryOfManufacture":"' || p_brand || '","Tags":["' || replace(p_name, ' ', '","') || '"]}' END AS fields
    FROM part
"""


def items_with_fields(w: Warehouse) -> DataFrame:
    """Items with a JSON text column; promotional items have none."""
    fields = F.to_json(
        F.struct(F.col("p_brand").alias("CountryOfManufacture"), F.split("p_name", " ").alias("Tags"))
    )
    return w.part.select("p_partkey", "p_name", F.when(F.col("p_type") != "PROMO", fields).alias("fields"))


@plan(
    "json_extract_fields",
    f"""
    SELECT p_partkey, p_name, fields, json_extract_string(fields, '$.CountryOfManufacture') AS country,
           json_extract_string(fields, '$.Tags[0]') AS first_tag
    FROM ({JSON_SQL})
    """,
)
def json_extract_fields(w: Warehouse) -> DataFrame:
    """Every item, with NULLs where it has no JSON."""
    shape = "CountryOfManufacture string, Tags array<string>"
    return (
        items_with_fields(w)
        .withColumn("j", docs.json_struct(F.col("fields"), shape))
        .select(
            "p_partkey",
            "p_name",
            "fields",
            F.col("j.CountryOfManufacture").alias("country"),
            F.get("j.Tags", F.lit(0)).alias("first_tag"),
        )
    )


TAGGED_SQL = f"""
    SELECT p_partkey, p_name, replace(p_name, ' ', ', ') AS tags
    FROM ({JSON_SQL}) WHERE fields IS NOT NULL AND list_contains(string_split(p_name, ' '), 'red')
"""


def tagged_by_grouping(items: DataFrame, tag: str) -> DataFrame:
    """Tags as rows, grouped again; groups without the tag are dropped and the
    tags of the others joined in document order."""
    rows = items.select("p_partkey", "p_name", F.posexplode(docs.json_tags(F.col("fields"))).alias("at", "tag"))
    return (
        rows.groupBy("p_partkey", "p_name")
        .agg(
            F.max(F.when(F.col("tag") == tag, 1).otherwise(0)).alias("hit"),
            F.expr("listagg(tag, ', ') WITHIN GROUP (ORDER BY at)").alias("tags"),
        )
        .filter("hit = 1")
        .drop("hit")
    )


def tagged_in_place(items: DataFrame, tag: str) -> DataFrame:
    """The same rows without expanding or shuffling: the tag array stays an
    array."""
    tags = docs.json_tags(F.col("fields"))
    return (
        items.withColumn("__tags", tags)
        .filter(F.array_contains("__tags", tag))
        .select("p_partkey", "p_name", F.array_join("__tags", ", ").alias("tags"))
    )


@plan("json_tags_filter_agg", TAGGED_SQL)
def json_tags_filter_agg(w: Warehouse) -> DataFrame:
    return tagged_by_grouping(items_with_fields(w), "red")


@plan("json_tags_concat", TAGGED_SQL)
def json_tags_concat(w: Warehouse) -> DataFrame:
    return tagged_in_place(items_with_fields(w), "red")


@plan(
    "json_event_property",
    """
    SELECT event_type, count(*) AS events, sum(CAST(json_extract(props, '$.k') AS BIGINT))::BIGINT AS total_k,
           max(CAST(json_extract(props, '$.k') AS BIGINT)) AS max_k
    FROM events GROUP BY event_type
    """,
)
def json_event_property(w: Warehouse) -> DataFrame:
    k = docs.json_struct(F.col("props"), "k bigint")["k"]
    return (
        w.events.select("event_type", k.alias("k"))
        .groupBy("event_type")
        .agg(F.count("*").alias("events"), F.sum("k").alias("total_k"), F.max("k").alias("max_k"))
    )


def stock_items(w: Warehouse) -> DataFrame:
    """Parts in the shape of the item XML; names made unique by the key."""
    return w.part.select(
        F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("item_name"),
        F.col("p_partkey").alias("supplier_id"),
        F.col("p_size").alias("unit_package_id"),
        (F.col("p_size") + 1).alias("outer_package_id"),
        (F.col("p_size") % 12 + 1).alias("quantity_per_outer"),
        (money("p_retailprice") / 4).cast("decimal(18,3)").alias("typical_weight"),
        F.length("p_name").alias("lead_time_days"),
        (F.col("p_type") == "PROMO").alias("is_chiller_stock"),
        F.when(F.col("p_type") == "PROMO", F.lit("7.125")).otherwise("15").cast("decimal(18,3)").alias("tax_rate"),
        money("p_retailprice").alias("unit_price"),
    )


ITEMS_SQL = """
    SELECT p_name || ' ' || p_partkey AS item_name, p_partkey AS supplier_id, p_size AS unit_package_id,
           CAST(p_size + 1 AS INTEGER) AS outer_package_id, CAST(p_size % 12 + 1 AS INTEGER) AS quantity_per_outer,
           CASE WHEN p_type = 'PROMO' THEN CAST(7.125 AS DOUBLE) ELSE CAST(15 AS DOUBLE) END AS tax_rate,
           CAST(CAST(CAST(p_retailprice AS DECIMAL(18,2)) * 250 AS DECIMAL(18,0)) / 1000 AS DOUBLE) AS typical_weight,
           CAST(length(p_name) AS INTEGER) AS lead_time_days, p_type = 'PROMO' AS is_chiller_stock,
           CAST(p_retailprice AS DOUBLE) AS unit_price
    FROM part
"""


def item_report(items: DataFrame) -> DataFrame:
    return items.withColumns({name: number(name) for name in ("typical_weight", "tax_rate", "unit_price")})


@plan("xml_shred_items", ITEMS_SQL)
def xml_shred_items(w: Warehouse) -> DataFrame:
    """XML documents in a column, shredded by typed paths."""
    one = F.struct(*xmlfiles.item_elements(stock_items(w)).columns)
    messages = xmlfiles.item_elements(stock_items(w)).select(
        docs.xml_text(F.struct(one.alias("Item")), "StockItems").alias("body")
    )
    return item_report(xmlfiles.shred_items(messages, "body"))


@plan("xml_export_roundtrip", ITEMS_SQL)
def xml_export_roundtrip(w: Warehouse) -> DataFrame:
    """Items to XML files, sorted by name, and back."""
    path = scratch(w.spark, "items-xml")
    xmlfiles.write_items(stock_items(w), path)
    return item_report(xmlfiles.read_items(w.spark, path))


# Split at sentence ends and line ends.
DELIMITERS = ".\n"


@plan(
    "split_text_rows",
    r"""
    SELECT doc_id, CAST(part_number AS INTEGER) AS part_number, trim(part, ' ' || chr(9) || chr(10) || chr(13)) AS part
    FROM (SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS part_number
          FROM (SELECT doc_id, [x FOR x IN string_split_regex(text, '[.\n]') IF x <> ''] AS parts FROM documents))
    """,
)
def split_text_rows(w: Warehouse) -> DataFrame:
    """Whole texts as numbered parts."""
    return w.documents.select("doc_id", F.posexplode(text.parts(F.col("text"), DELIMITERS)).alias("at", "part")).select(
        "doc_id", (F.col("at") + 1).alias("part_number"), "part"
    )


@plan(
    "names_unpadded_and_overlaid",
    """
    SELECT p_partkey, CAST(length(rtrim(p_name || '  ')) AS INTEGER) AS name_length,
           left(p_name, 1) || 'XY' || substr(p_name, 5) AS overlaid
    FROM part
    """,
)
def names_unpadded_and_overlaid(w: Warehouse) -> DataFrame:
    """Lengths without trailing blanks, and three characters of the name replaced by two others."""
    return w.part.select(
        "p_partkey",
        text.length_unpadded(F.concat("p_name", F.lit("  "))).alias("name_length"),
        text.replace_at(F.col("p_name"), 2, 3, "XY").alias("overlaid"),
    )
