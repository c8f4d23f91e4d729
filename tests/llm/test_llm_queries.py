"""The registered queries of the subpackage over the smallest tables."""

from __future__ import annotations

import re

import pytest
from oracle import compare, connect

import __spark_entry__ as entry
from rookery.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"

# The columns that each query must return.
CONTRACT = {
    "op1": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op2": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op3": {
        "doc_id": "bigint", "n_words": "bigint", "n_base": "bigint", "first_word": "bigint", "last_word": "bigint",
        "base_labels": "string", "labels": "string", "score": "double",
    },
    "op4": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op5": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op6": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op7": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op8": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op9": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
    "op10": {
        "doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint",
        "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean",
    },
    "op11": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op12": {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"},
    "op13": {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
        "explained": "double", "identity_error": "double",
    },
}


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in QUERIES) == list(range(1, 14))
    assert QUERIES.items() <= entry.queries().items() and ORACLE.items() <= entry.oracle_sql().items()
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("key", list(QUERIES))
def test_query(spark, key):
    frame = QUERIES[key](spark, SF_DIR)
    kinds = dict(frame.dtypes)
    assert {c: kinds.get(c) for c in CONTRACT[key.split("_")[0]]} == CONTRACT[key.split("_")[0]]
    if key in ORACLE:
        assert compare(frame, connect(SF_DIR), ORACLE[key]) is None
    elif "doc_id" in kinds:
        documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
        ids = [r.doc_id for r in frame.select("doc_id").collect()]
        assert sorted(ids) == sorted(r.doc_id for r in documents.select("doc_id").collect())
