import pytest

from ledgerlark.functions.sql import register
from ledgerlark.plans import REGISTRY, customers
from ledgerlark.tables import Warehouse


@pytest.fixture(scope="module")
def w(spark):
    warehouse = Warehouse(spark, "/root/testdata/sf0.001")
    register(warehouse)
    return warehouse


@pytest.mark.parametrize(
    ("value", "delimiters", "wanted"),
    [
        ("aa/bb/cc", "/", ["aa", "bb", "cc"]),
        ("a/ /b", "/", ["a", "", "b"]),
        ("//", "/", []),
        ("a.b]c^d", ".]^", ["a", "b", "c", "d"]),
        (r"a\b-c", "\\-", ["a", "b", "c"]),
        ("a  b", "", ["a", "b"]),
        ("\u00a0a\v/b", "/", ["a", "b"]),
    ],
)
def test_split_string(w, value, delimiters, wanted):
    got = w.spark.sql("SELECT * FROM split_string(:v, :d)", args={"v": value, "d": delimiters}).collect()
    assert [(r.part_number, r.part) for r in got] == list(enumerate(wanted, start=1))


def test_split_per_row(w, rows):
    called = w.spark.sql("SELECT doc_id, s.* FROM documents, LATERAL split_string(text, '.\n') s")
    assert rows(called) == rows(REGISTRY["split_text_rows"].build(w))


def test_best_customer(w):
    best = REGISTRY["top_customer_with_ties"].build(w).collect()
    assert w.spark.sql("SELECT best_customer()").head()[0] == min(r.c_custkey for r in best)
    found = {(r.custkey, r.total) for r in w.spark.sql("SELECT * FROM best_customers()").collect()}
    assert found == {(r.c_custkey, r.total) for r in best}


def test_purchase_total(w):
    row = customers.purchase_sum(w, 7).head()
    assert w.spark.sql("SELECT purchase_total(7)").head()[0] == row.total
    with pytest.raises(Exception, match="customer was not found"):
        w.spark.sql("SELECT purchase_total(-1)").collect()


def test_last_orders_per_row(w, rows):
    called = w.spark.sql(
        "SELECT c_custkey, f.orderkey FROM customer LEFT JOIN LATERAL last_orders_of(c_custkey) f ON true"
    )
    wanted = customers.last_orders(w.customer, w.orders, 2).select("c_custkey", "o_orderkey")
    assert rows(called) == rows(wanted)
    plan = called._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "NestedLoop" not in plan
