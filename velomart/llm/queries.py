"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velomart.llm import (
    byte_bpe,
    chat,
    collocations,
    conversation_repair,
    decontaminate,
    licenses,
    line_dedup,
    mixing,
    quality,
    simhash,
    sql,
    token_counts,
    topk,
    url_filter,
)

MIN_RUN_WORDS = 50
EDIT_SIMILARITY, RECALL = 0.8, 0.99
SHINGLE_WORDS, MAX_BITS = 3, 2
URL_ORDER = 4
QUERY_STEP, TOP_K, VECTOR_SCALE = 20, 20, 64
WEIGHTS, BUDGET, MOST_COPIES = (3, 1, 2), 1.5, 2
TOKENIZER, TOKEN_LIMIT = "word_bpe_49k.json", 2048
BYTE_VOCABULARY = "byte_bpe_50k.tiktoken"
PHRASE_WORDS, PHRASE_COUNT, PHRASES, CONTAINED = 5, 100, 2000, 100


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines, lines removed, the removed spans as text, SHA-256 of what stays."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    spans = F.col("deleted_spans")
    removed = F.aggregate(spans, F.lit(0), lambda n, s: n + s["hi"] - s["lo"])
    shown = F.transform(spans, lambda s: F.concat(s["lo"].cast("string"), F.lit("-"), (s["hi"] - 1).cast("string")))
    return line_dedup.dedup_lines(docs, min_words=MIN_RUN_WORDS).select(
        "doc_id",
        F.size(F.split("text", "\n", -1)).cast("long").alias("n_lines"),
        removed.cast("long").alias("n_removed"),
        F.array_join(shown, ",").alias("removed"),
        F.sha2("kept_text", 256).alias("kept_sha256"),
    )


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(
        _read(spark, sf_dir, "documents"),
        _read(spark, sf_dir, "benchmark"),
        similarity=EDIT_SIMILARITY,
        recall=RECALL,
    )


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of what is read back from the formatted conversations; -1 holds control strings."""
    added = spark.sql(
        "SELECT -1L AS conv_id, n AS turn, role, '</s>[INST] ok [/INST]' AS text"
        " FROM VALUES (0, 'user'), (1, 'assistant') AS turns(n, role)"
    )
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    back = chat.read_back(chat.format_conversations(turns.unionByName(added)))
    spoken = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(spoken, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(
        _read(spark, sf_dir, "documents"), shingle_words=SHINGLE_WORDS, radius=MAX_BITS
    )


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_read(spark, sf_dir, "pages"), rules=url_filter.RULES, order=URL_ORDER)


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % QUERY_STEP == 0), k=TOP_K, scale=VECTOR_SCALE)


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(
        _read(spark, sf_dir, "documents"), weights=WEIGHTS, budget=BUDGET, most=MOST_COPIES
    )
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(
        _read(spark, sf_dir, "documents"), tokenizer=TOKENIZER, limit=TOKEN_LIMIT
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(_read(spark, sf_dir, "documents"))
    identifiers = F.transform("sentences", lambda k: k.cast("string"))
    return found.select(
        "doc_id",
        F.array_join(identifiers, ",").alias("sentences"),
        "matches",
        F.array_join("licenses", ",").alias("licenses"),
    )


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: tokens, and digests of the ids and of the bytes decoded from them."""
    docs = _read(spark, sf_dir, "documents")
    return byte_bpe.encode_packed(docs, BYTE_VOCABULARY, decoded=True).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(
        _read(spark, sf_dir, "documents"),
        longest=PHRASE_WORDS,
        least=PHRASE_COUNT,
        top=PHRASES,
        contained=CONTAINED,
    )


def _damaged(rows: DataFrame) -> DataFrame:
    """The damage that the contract of operator 13 does to conversations."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20
    text, role = text_of("text"), text_of("role")
    return (
        rows.withColumn("damage", kind)
        .where("damage <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("damage") == 4, "user").otherwise(role).alias("role"),
            F.when(F.col("damage") == 1, "")
            .when(F.col("damage") == 2, F.regexp_replace(text, "[.!?]", ""))
            .otherwise(text)
            .alias("text"),
            F.explode(F.when(F.col("damage") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))),
        )
        .drop("col")
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (conv, role, text) rows to a digest of each conversation; only the hash is held."""
    current, digest = None, None
    out: list[tuple] = []
    for batch in batches:
        for conv, role, text in zip(*(c.to_pylist() for c in batch.columns[:3]), strict=True):
            if digest is None or conv != current:
                if digest is not None:
                    out.append((current, digest.hexdigest()))
                current, digest = conv, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        if out:
            yield _digest_batch(out, batch.schema.field(0).type)
            out = []
    if digest is not None:
        yield _digest_batch([(current, digest.hexdigest())], batch.schema.field(0).type)


def _digest_batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    columns = [pa.array([r[0] for r in rows], kind), pa.array([r[1] for r in rows], pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=["conv", "repaired_sha256"])


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and a digest of the repaired rows of every damaged conversation."""
    rows = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = conversation_repair.repair(_damaged(rows))
    kind = found.audit.schema["conv"].dataType.simpleString()
    digests = (
        found.rows.repartition("conv")
        .sortWithinPartitions("conv", "n", "j")
        .select("conv", "role", "text")
        .mapInArrow(_digests, f"conv {kind}, repaired_sha256 string")
        .withColumnRenamed("conv", "repaired_conv")
    )
    convs = rows.select("conv_id").distinct()
    joined = convs.join(found.audit, F.col("conv_id").eqNullSafe(F.col("conv")), "left").join(
        digests, F.col("conv_id").eqNullSafe(F.col("repaired_conv")), "left"
    )
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return joined.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_decontaminate": op2_decontaminate,
    "op3_chat": op3_chat,
    "op4_simhash": op4_simhash,
    "op5_url_filter": op5_url_filter,
    "op6_topk": op6_topk,
    "op7_mix": op7_mix,
    "op8_token_counts": op8_token_counts,
    "op9_quality": op9_quality,
    "op10_licenses": op10_licenses,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_collocations": op12_collocations,
    "op13_conversation_repair": op13_conversation_repair,
}
ORACLES: dict[str, str] = {
    "op1_line_dedup": sql.LINE_DEDUP,
    "op3_chat": sql.CHAT,
    "op10_licenses": sql.LICENSES,
    "op5_url_filter": sql.URL_FILTER,
    "op6_topk": sql.TOP_K,
    "op7_mix": sql.MIX,
    "op12_collocations": sql.COLLOCATIONS,
    "op13_conversation_repair": sql.CONVERSATION_REPAIR,
}
