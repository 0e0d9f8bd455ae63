"""The corpus queries that SQL can express give what DuckDB gives; all keep to their columns."""

import glob
import os

import duckdb
import pytest

from loomwright.llm.queries import ORACLE, QUERIES

COLUMNS = {
    "op1_piece_codec": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op2_exact_dedup": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op3_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op5_fingerprints": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op6_token_counts": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    "op8_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op10_best_fit_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op11_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op12_token_alignment": ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
    "op13_lexical_search": ["item_id", "rank", "doc_id", "score"],
}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, sf, name):
    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    want = con.sql(ORACLE[name])
    got = QUERIES[name](spark, sf)
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = sorted(tuple(map(str, r)) for r in got.select(*columns).collect())
    assert rows == sorted(tuple(map(str, r)) for r in want.project(", ".join(columns)).fetchall())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, sf, name):
    assert set(COLUMNS[name]) <= set(QUERIES[name](spark, sf).columns)
