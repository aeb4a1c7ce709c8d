"""Tables and parameterised queries for use from SQL text."""

from __future__ import annotations

from ledgerlark.functions.text import BLANKS
from ledgerlark.tables import SCHEMAS, Warehouse

# The body of a table function is merged into the query that calls it. A LIMIT
# in such a body would apply to all calls together, so "the last two" is a row
# number.
_BLANKS = "".join(f"\\u{ord(c):04x}" for c in BLANKS)

FUNCTIONS = [
    rf"""
    split_string(value STRING, delimiters STRING) RETURNS TABLE (part_number INT, part STRING)
    RETURN SELECT pos + 1, trim(BOTH '{_BLANKS}' FROM col) FROM posexplode(filter(
        split(value, concat('[', regexp_replace(if(delimiters = '', '{_BLANKS}', delimiters),
              '([\\[\\]^\\-\\\\&])', '\\\\$1'), ']')), p -> p <> ''))
    """,
    """
    purchases() RETURNS TABLE (custkey BIGINT, hundredths BIGINT)
    RETURN SELECT o_custkey, sum(amount) FROM orders JOIN (
        SELECT l_orderkey, sum(CASE
            WHEN abs(l_extendedprice * 100 - rint(l_extendedprice * 100)) > 1e-5 + abs(l_extendedprice * 100) * 1e-15
            THEN CAST(raise_error('a value has more than 2 decimals') AS BIGINT)
            ELSE CAST(rint(l_extendedprice * 100) AS BIGINT) END) AS amount
        FROM lineitem GROUP BY l_orderkey)
        ON l_orderkey = o_orderkey GROUP BY o_custkey
    """,
    """
    best_customer() RETURNS BIGINT
    RETURN SELECT min(custkey) FROM purchases() WHERE hundredths = (SELECT max(hundredths) FROM purchases())
    """,
    """
    best_customers() RETURNS TABLE (custkey BIGINT, total DOUBLE)
    RETURN SELECT custkey, hundredths / 100.0D FROM purchases()
    WHERE hundredths = (SELECT max(hundredths) FROM purchases())
    """,
    """
    purchase_total(wanted BIGINT) RETURNS DOUBLE
    RETURN CASE WHEN (SELECT count(*) FROM customer WHERE c_custkey = wanted) = 0
        THEN CAST(raise_error('customer was not found') AS DOUBLE)
        ELSE coalesce((SELECT max(hundredths) FROM purchases() WHERE custkey = wanted), 0) / 100.0D END
    """,
    """
    last_orders_of(wanted BIGINT) RETURNS TABLE (orderkey BIGINT, orderdate TIMESTAMP_NTZ)
    RETURN SELECT o_orderkey, o_orderdate FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS place
        FROM orders) WHERE o_custkey = wanted AND place <= 2
    """,
]


def register(w: Warehouse) -> None:
    """Make the tables temporary views and the functions temporary functions."""
    for name in SCHEMAS:
        w.table(name).createOrReplaceTempView(name)
    for function in FUNCTIONS:
        w.spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {function}")
