"""The registered queries against their DuckDB twins, and what the contracts fix."""

import re

import pytest

import __spark_entry__ as contract
from velomart.llm import queries


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(columns), sorted((tuple(row[k] for k in order) for row in rows), key=str)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_twin(spark, duck, sf_dir, name):
    df = contract.queries()[name](spark, sf_dir)
    result = duck.execute(contract.oracle_sql()[name])
    assert table(df.columns, [tuple(r) for r in df.collect()]) == table([c[0] for c in result.description], result.fetchall())


def test_one_query_for_each_operator():
    names = [m[1] for n in contract.queries() if (m := re.match(r"op(\d+)_", n))]
    assert sorted(map(int, names)) == list(range(1, 14)) and "pipeline" in contract.queries()


COLUMNS = {
    "op1_line_dedup": "doc_id bigint, n_lines bigint, n_removed bigint, removed string, kept_sha256 string",
    "op3_chat": "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    "op4_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op5_url_filter": "page_id bigint, host string, path string, rule string, verdict string, score double",
    "op6_topk": "query_id bigint, rank int, vec_id bigint, score bigint",
    "op7_mix": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op8_token_counts": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean, kept_bytes bigint",
    "op9_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op10_licenses": "doc_id bigint, sentences string, matches bigint, licenses string",
    "op11_byte_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op12_collocations": "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint",
    "op13_conversation_repair": "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, "
    "illegal bigint, cost bigint, audit string, repaired_sha256 string",
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, sf_dir, name):
    df = contract.queries()[name](spark, sf_dir)
    assert ", ".join(f"{c} {t}" for c, t in df.dtypes) == COLUMNS[name]
    tables = {"op3_chat": ("conversations", "conv_id", 1), "op5_url_filter": ("pages", None, 0), "op6_topk": None}
    tables |= {"op12_collocations": None, "op13_conversation_repair": ("conversations", "conv_id", 0)}
    expected = tables.get(name, ("documents", None, 0))
    if expected:
        source = spark.read.parquet(f"{sf_dir}/{expected[0]}.parquet")
        source = source.select(expected[1]).distinct() if expected[1] else source
        assert df.count() == source.count() + expected[2]
