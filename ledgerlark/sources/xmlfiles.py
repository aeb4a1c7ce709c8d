"""XML files of repeated row elements, and XML text in a column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.functions.documents import nested

ITEM_SHAPE = (
    "_Name string, SupplierID bigint, "
    "Package struct<UnitPackageID: int, OuterPackageID: int, QuantityPerOuter: int, TypicalWeightPerUnit: decimal(18,3)>, "
    "LeadTimeDays int, IsChillerStock boolean, TaxRate decimal(18,3), UnitPrice decimal(18,2)"
)

# Element path (a leading underscore marks an attribute) of
# every item column.
ITEM_PATHS = {
    "item_name": "_Name",
    "supplier_id": "SupplierID",
    "unit_package_id": "Package/UnitPackageID",
    "outer_package_id": "Package/OuterPackageID",
    "quantity_per_outer": "Package/QuantityPerOuter",
    "typical_weight": "Package/TypicalWeightPerUnit",
    "lead_time_days": "LeadTimeDays",
    "is_chiller_stock": "IsChillerStock",
    "tax_rate": "TaxRate",
    "unit_price": "UnitPrice",
}


# One task reads one file, so files are cut to a bounded length.
ROWS_PER_FILE = 500_000


def item_elements(items: DataFrame) -> DataFrame:
    """Item columns in the nested form of an item element."""
    return items.select(nested({path: F.col(name) for name, path in ITEM_PATHS.items()}).alias("item")).select("item.*")


def item_columns(elements: DataFrame) -> DataFrame:
    """The flat table of item elements."""
    return elements.select(*[F.col(path.replace("/", ".")).alias(name) for name, path in ITEM_PATHS.items()])


def write_items(items: DataFrame, path: str) -> None:
    """Indented XML files below ``path``, items sorted by name over all files.

    The hash as second key lets items of one name fill several files.
    """
    elements = item_elements(items)
    (
        elements.orderBy("_Name", F.xxhash64(*elements.columns))
        .write.format("xml")
        .option("rootTag", "StockItems")
        .option("rowTag", "Item")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .save(path)
    )


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """Items of XML files, one task per file."""
    return item_columns(
        spark.read.format("xml").schema(ITEM_SHAPE).option("rowTag", "Item").option("mode", "FAILFAST").load(path)
    )


def shred_items(df: DataFrame, body: str) -> DataFrame:
    """Items of an XML text column whose root holds any number of ``Item``
    elements; text that does not parse gives no rows."""
    parsed = df.select(F.from_xml(body, f"Item array<struct<{_as_struct(ITEM_SHAPE)}>>").alias("doc"))
    return item_columns(parsed.select(F.explode("doc.Item").alias("item")).select("item.*"))


def _as_struct(shape: str) -> str:
    """Column list 'a int, b string' in struct form 'a: int, b: string'."""
    import pyspark.sql.types as T

    return T.StructType.fromDDL(shape).simpleString()[len("struct<") : -1]
