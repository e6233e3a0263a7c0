"""Extra columns named like internal ones change no operator and no stage."""

import shutil

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from velomart.llm import byte_bpe, collocations, decontaminate, licenses, line_dedup, mixing, quality, simhash, token_counts

NAMES = [
    "vm_spans_found", "vm_copies", "vm_file", "vm_row", "vm_n", "vm_range", "vm_key0", "vm_of", "vm_source", "vm_place",
    "id", "file", "row", "fp", "kept", "root", "node", "least", "x", "label", "score", "size", "copies", "copy", "taken",
    "target", "source_size", "block", "words", "ids", "kept_text", "deleted_spans", "item", "item_id", "Key", "n", "rank",
    "phrase", "sentences", "licenses", "n_bytes", "held_out", "_metadata", "a.b",
]


@pytest.fixture(scope="module")
def tables(spark, sf_dir, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("clash"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs.select("*", *[F.lit(k).alias(name) for k, name in enumerate(NAMES)]).write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        shutil.copy(f"{sf_dir}/{name}.parquet", folder)
    return spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{folder}/documents.parquet"), folder


OPERATORS = {
    "line_dedup": lambda d, b, q: line_dedup.dedup_lines(d).select("doc_id", F.col(line_dedup.dedup_lines(d).columns[-2]).alias("kept")),
    "decontaminate": lambda d, b, q: decontaminate.contaminated(d, b),
    "simhash": lambda d, b, q: simhash.near_duplicates(d),
    "mixing": lambda d, b, q: mixing.mix_plan(d),
    "mix": lambda d, b, q: mixing.mix(d).select("doc_id", "text"),
    "token_counts": lambda d, b, q: token_counts.token_counts(d),
    "quality": lambda d, b, q: quality.score_quality(d, q),
    "licenses": lambda d, b, q: licenses.scan(d),
    "byte_bpe": lambda d, b, q: byte_bpe.decode(byte_bpe.encode(d, "byte_bpe_50k.tiktoken"), "byte_bpe_50k.tiktoken"),
    "collocations": lambda d, b, q: collocations.collocations(d, least=30),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_operators(spark, tables, name):
    plain, clashing, folder = tables
    others = [spark.read.parquet(f"{folder}/{t}.parquet") for t in ("benchmark", "labels")]
    results = [OPERATORS[name](d, *others) for d in (plain, clashing)]
    kept = [c for c in results[0].columns if c in results[1].columns]
    assert kept
    assert len({tuple(sorted(str(tuple(r)) for r in d.select(*kept).collect())) for d in results}) == 1


def test_stages(spark, tables, sf_dir):
    plain, clashing, folder = tables
    for _, stage in corpus_pipeline.STAGES:
        plain, clashing = stage(spark, plain, sf_dir), stage(spark, clashing, folder)
        assert set(NAMES) <= set(clashing.columns)
        same = [[tuple(r) for r in d.select("doc_id", "text").collect()] for d in (plain, clashing)]
        assert sorted(map(str, same[0])) == sorted(map(str, same[1])) and same[0]
        assert clashing.select([F.col(f"`{n}`") for n in NAMES]).distinct().collect() == [tuple(range(len(NAMES)))]
        plain, clashing = (corpus_pipeline.materialize(d, "stage") for d in (plain, clashing))
