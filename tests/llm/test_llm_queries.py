"""Published queries against their SQL, and their result columns."""

import pytest
from oracle import compare, connect

from sparrowmill.llm.queries import ORACLES, QUERIES


class Published:
    def __init__(self, name):
        self.build, self.oracle = QUERIES[name], ORACLES[name]

    def __call__(self, spark, directory):
        return self.build(spark, directory)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(name, spark, small):
    rows, problem = compare(Published(name), spark, small, connect(small))
    assert problem is None, problem
    assert rows > 0


COLUMNS = {
    "op11_conversation_trie": "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string",
    "op13_secret_scan": "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string",
    "op12_token_alignment": "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
    "count_sum long, groups_sha256 string",
    "op1_line_dedup": "doc_id long, n_lines long, n_dropped long, kept_sha256 string",
    "op2_byte_bpe": "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    "op3_hilbert_shards": "doc_id long, size long, text_crc32 long, law string, shard int, slot long, "
    "cell long, grown_shard int",
    "op4_quality_classifier": "doc_id long, held_out boolean, score double, predicted int",
    "op5_best_fit_packing": "doc_id long, piece int, start long, length long, ids_crc32 long, "
    "sequence_id long, offset long",
    "op6_exact_topk": "query_id long, rank int, vec_id long, score long",
    "op7_url_filters": "page_id long, host string, path string, rule string, verdict string",
    "op8_phrase_fingerprints": "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double",
    "op9_license_scan": "doc_id long, license string, containment double",
    "op10_jaccard_join": "doc_id long, class_id long, n_links long",
}


def test_every_operator_has_a_query():
    assert set(QUERIES) == set(COLUMNS)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_result_columns(name, spark, tiny):
    got = QUERIES[name](spark, tiny)
    want = [tuple(c.split()) for c in COLUMNS[name].split(", ")]
    names = {"long": "bigint"}
    assert sorted(got.dtypes) == sorted((n, names.get(t, t)) for n, t in want)
