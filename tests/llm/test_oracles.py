"""Queries that SQL can express against DuckDB, and the shapes that the others promise."""

import pytest

from tests.oracle import compare, connect
from weftline.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_oracle(spark, name):
    assert compare(spark, connect(SF), name, registry.QUERIES[name], registry.ORACLES[name], SF) == 200


SHAPES = {
    "op1_html_text": "page_id:bigint url:string text:string n_chars:bigint",
    "op3_token_file": "doc_id:bigint start:bigint n_tokens:bigint ids_crc32:bigint",
    "op4_language_id": "doc_id:bigint held_out:boolean lang_pred:string score:double",
    "op5_exact_dedup": "doc_id:bigint keep_id:bigint group_size:bigint kept:boolean text_sha256:string",
    "op6_packing": "doc_id:bigint start:bigint length:bigint ids_crc32:bigint doc_tokens:bigint sequence_id:bigint offset:bigint",
    "op7_toxicity": "doc_id:bigint held_out:boolean score:double predicted:int",
    "op8_simhash": "doc_id:bigint fingerprint:string component_id:bigint",
    "op9_repeated_strings": "doc_id:bigint n_bytes:bigint n_removed:bigint n_spans:bigint kept_sha256:string",
    "op10_decontamination": "doc_id:bigint n_words:bigint n_hit:bigint n_items:bigint items_sha256:string contaminated:boolean",
}


@pytest.mark.parametrize("name", sorted(SHAPES))
def test_shape(spark, name):
    df = registry.QUERIES[name](spark, SF)
    assert " ".join(f"{c}:{t}" for c, t in df.dtypes) == SHAPES[name]
    rows = df.count()
    assert rows == (50 if name == "op1_html_text" else 200) or name == "op6_packing" and rows >= 200
