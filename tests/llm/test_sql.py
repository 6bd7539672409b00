"""Every corpus query that has DuckDB SQL against it, and the names and columns that all queries have."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tests.oracle import compare, duck
from tidemark.llm import suite

COLUMNS = {
    "op1_decontaminate": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op3_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op4_toxicity": "doc_id held_out score predicted",
    "op6_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op7_near_dedup": "doc_id n_shingles component_id kept",
    "op8_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op10_exact_dedup": "doc_id keep_id group_size kept text_sha256",
    "op11_divergence": "lang source part item value rank",
    "op12_whitening": "vec_id component n deviation whitened explained identity_error",
    "op13_html_text": "page_id url text n_chars",
}


@pytest.mark.parametrize("name", list(suite.SQL))
def test_query_matches_sql(spark, name):
    r = compare(spark, SF_SMALL, name, suite.QUERIES[name], suite.SQL[name], duck(SF_SMALL))
    assert r["match"], r


@pytest.mark.parametrize("name", list(COLUMNS))
def test_query_columns(spark, name):
    assert set(COLUMNS[name].split()) <= set(suite.QUERIES[name](spark, SF_SMALL).columns)


def test_registered():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} <= {n.split("_")[0] for n in names} and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)
