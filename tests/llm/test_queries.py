"""Each registered query: its contract's columns, one row per input row where that is asked, its SQL."""

import pytest

import __spark_entry__ as driver
from checks.run import difference, oracle_connection
from marketlake.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_page_differencing": "page_id url text n_chars",
    "op2_pii_surrogates": "doc_id text",
    "op3_toxicity_trees": "doc_id held_out score predicted",
    "op4_pack_best_fit": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op5_closed_syncmers": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op6_co_training": "doc_id quality good",
    "op7_maxent_scores": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op8_maxscore_topk": "query_id rank vec_id score",
    "op9_minhash_tensored": "doc_id n_shingles component_id kept",
    "op10_bpe_round_trip": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op11_pair_bound_search": "item_id rank doc_id score",
    "op12_qdwh_whitening": "vec_id component n deviation whitened explained identity_error",
    "op13_bounded_ring": "doc_id size text_crc32 law shard slot grown_shard",
}
LONGS = "page_id n_chars start length ids_crc32 doc_tokens sequence_id offset n_tokens n_known train_tokens query_id vec_id n_shingles component_id size text_crc32 slot deviation n item_id doc_id".split()


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    assert set(COLUMNS[name].split()) <= set(df.columns)
    kinds = dict(df.dtypes)
    assert all(kinds[c] == "bigint" for c in LONGS if c in kinds)
    found = [tuple(r) for r in df.collect()]
    if name in ORACLES:
        assert difference(df.columns, found, oracle_connection(SF), ORACLES[name]) is None
    elif name != "op4_pack_best_fit":
        table = {"page_id": "pages", "vec_id": "embeddings"}.get(df.columns[0], "documents")
        per_row = 16 if table == "embeddings" else 1
        assert len(found) == per_row * spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_registered():
    assert set(COLUMNS) == set(QUERIES)
    assert {*COLUMNS, "pipeline"} <= set(driver.queries())
    assert set(ORACLES) <= set(driver.oracle_sql())
