"""Registered queries against their SQL, and the contracts of their results."""

import zlib

import pytest

from check import compare, connect
from ledgerlark.llm import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


def test_every_operator_has_a_query():
    assert [n for n in range(1, 14) if not any(name.startswith(f"op{n}_") for name in QUERIES)] == []


@pytest.mark.parametrize("name", list(SQL))
def test_query_and_sql_agree(spark, name):
    assert compare(spark, connect(FOLDER), FOLDER, name).startswith("same")


COLUMNS = {
    "op1_capture_index": "page_id payload_bytes payload_digest record_type refers_to",
    "op2_mix_sources": "doc_id size source_size target taken",
    "op4_quality_classifier": "doc_id held_out score predicted",
    "op5_decontaminate": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op6_context_tree": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op7_main_text": "page_id url text n_chars",
    "op9_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op11_personal_data": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
}


@pytest.mark.parametrize("name", list(COLUMNS))
def test_columns_and_rows(spark, name):
    found = QUERIES[name](spark, FOLDER)
    wanted = COLUMNS[name].split()
    assert found.columns[: len(wanted)] == wanted or set(wanted) <= set(found.columns)
    source = "pages" if wanted[0] == "page_id" else "documents"
    keys = [r[0] for r in spark.read.parquet(f"{FOLDER}/{source}.parquet").select(wanted[0]).collect()]
    assert sorted(r[0] for r in found.select(wanted[0]).collect()) == sorted(keys)


def test_held_out_folds(spark):
    four = QUERIES["op4_quality_classifier"](spark, FOLDER).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in four)
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in four)
    six = QUERIES["op6_context_tree"](spark, FOLDER).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0) for r in six)
