"""The input tables with their declared schemas."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ledgerlark.session import prepare

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}

class Warehouse:
    """Lazy access to one folder of parquet tables.

    Columns keep their stored type, so that plain comparisons reach the
    parquet scan; sums and calendar work convert where they need to.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = prepare(spark)
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def region(self) -> DataFrame:
        return self.table("region")

    @cached_property
    def nation(self) -> DataFrame:
        return self.table("nation")

    @cached_property
    def customer(self) -> DataFrame:
        return self.table("customer")

    @cached_property
    def supplier(self) -> DataFrame:
        return self.table("supplier")

    @cached_property
    def part(self) -> DataFrame:
        return self.table("part")

    @cached_property
    def orders(self) -> DataFrame:
        return self.table("orders")

    @cached_property
    def lineitem(self) -> DataFrame:
        return self.table("lineitem")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    @cached_property
    def documents(self) -> DataFrame:
        return self.table("documents")
