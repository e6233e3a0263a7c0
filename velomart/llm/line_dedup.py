"""Line deduplication: repeated runs of lines, found in a suffix array over line ids.

Every document is a sequence of line ids. A run counts when its lines hold at least
``min_words`` words together and the same lines stand earlier, in the order of (id, line); the
later copy is deleted. The longest runs are unions of runs that just reach ``min_words``: from
each line forwards, and back from each line. So the suffixes need ordering only as deep as the
longest of those runs.

The order comes from prefix doubling. Rank 0 sorts the lines, and rank k + 1 sorts the pairs of
rank k at a line and at 2**k lines on, each by one distributed sort of the distinct pairs.
Suffixes with a prefix that occurs once share no run and leave early. Two overlapping ranks
name the first n lines of a suffix, so equal names are one longest-common-prefix interval of
the array at depth n; its earliest suffix stays and the runs of the others go.

Lines and pairs are counted before the shuffle, a line that is a large part of the corpus is one
key of joins that adaptive execution splits, and windows never span more than a document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velomart.llm.common import n_words, unused, with_row_key
from velomart.workspace import materialize

_DOC = ("file", "row")


def _lines(keyed: DataFrame, id_col: str, text_col: str, file: str, row: str) -> DataFrame:
    """One row per line: its document, place, 128-bit hash and number of words."""
    split = F.posexplode(F.split(F.col(f"`{text_col}`").cast("string"), "\n", -1))
    return keyed.select(
        F.col(file).alias("file"), F.col(row).alias("row"), F.col(f"`{id_col}`").alias("id"), split.alias("at", "line")
    ).select(
        "file",
        "row",
        "id",
        "at",
        F.xxhash64("line").alias("h1"),
        F.xxhash64(F.lit(1), "line").alias("h2"),
        n_words(F.col("line")).alias("words"),
    )


def _ranked(keys: DataFrame, by: list[str], name: str, kept: str) -> DataFrame:
    """Distinct ``keys`` that occur twice or more, with a rank in their sort order.

    The range sort puts partition and place in ascending order, so the stored id is a rank.
    """
    repeated = keys.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*by)
    # no fixed number of ranges: adaptive execution sizes them
    ordered = repeated.repartitionByRange(*by).sortWithinPartitions(*by)
    return materialize(ordered.withColumn(kept, F.monotonically_increasing_id()), name)


def _runs(active: DataFrame, min_words: int) -> DataFrame:
    """The shortest runs of ``min_words`` from and up to each line, inside repeated stretches."""
    stretch = [*_DOC, "stretch"]
    in_order = Window.partitionBy(*_DOC).orderBy("at")
    rows = active.withColumn("stretch", F.col("at") - F.row_number().over(in_order))
    to_here = Window.partitionBy(*stretch).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("upto", F.sum("words").over(to_here))
    rows = rows.withColumn("before", F.col("upto") - F.col("words"))
    whole = Window.partitionBy(*stretch)
    forward = (
        Window.partitionBy(*stretch)
        .orderBy(F.col("before").desc())
        .rangeBetween(Window.unboundedPreceding, -min_words)
    )
    backward = (
        Window.partitionBy(*stretch)
        .orderBy("upto")
        .rangeBetween(Window.unboundedPreceding, -min_words)
    )
    rows = rows.select(
        "*",
        F.min("at").over(forward).alias("next"),
        F.max("at").over(backward).alias("previous"),
        F.min("at").over(whole).alias("low"),
        F.max("at").over(whole).alias("high"),
        F.max("upto").over(whole).alias("total"),
    )
    last = F.coalesce(F.col("next") - 1, F.when(F.col("total") - F.col("before") >= min_words, F.col("high")))
    first = F.coalesce(F.col("previous") + 1, F.when(F.col("upto") >= min_words, F.col("low")))
    ahead = F.struct(F.col("at").alias("start"), (last - F.col("at") + 1).alias("n"))
    behind = F.struct(first.alias("start"), (F.col("at") - first + 1).alias("n"))
    return (
        rows.select(*_DOC, "id", F.explode(F.array(ahead, behind)).alias("run"))
        .select(*_DOC, "id", "run.start", F.col("run.n").cast("int").alias("n"))
        .where("n is not null and start is not null")
        .distinct()
    )


def _doubled(ranks: DataFrame, k: int) -> DataFrame:
    """Rank k + 1 of every suffix whose first 2**(k + 1) lines occur again."""
    step = 2**k
    on = Window.partitionBy(*_DOC).orderBy("at").rangeBetween(step, step)
    pairs = materialize(
        ranks.select(*_DOC, "at", F.col("rank").alias("a"), F.first("rank").over(on).alias("b")).where(
            "b is not null"
        ),
        "suffix_pairs",
    )
    names = _ranked(pairs, ["a", "b"], "suffix_ranks", "rank")
    return materialize(pairs.join(names, ["a", "b"]).select(*_DOC, "at", "rank"), "suffixes")


def _intervals(runs: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """``runs`` named by the ranks of their two overlapping halves; runs that occur once go."""
    array = None
    for k, level in enumerate(levels):
        level = level.withColumn("k", F.lit(k))
        array = level if array is None else array.unionByName(level)
    depth = F.floor(F.log2(F.col("n") + F.lit(0.5))).cast("int")
    runs = runs.withColumn("k", depth)
    runs = runs.withColumn("half", F.col("start") + F.col("n") - F.expr("shiftleft(1, k)"))
    head = array.select(*_DOC, "k", F.col("at").alias("start"), F.col("rank").alias("a"))
    tail = array.select(*_DOC, "k", F.col("at").alias("half"), F.col("rank").alias("b"))
    return runs.join(head, [*_DOC, "k", "start"]).join(tail, [*_DOC, "k", "half"]).select(
        *_DOC, "id", "start", "n", "a", "b"
    )


def deleted_spans(keyed: DataFrame, id_col: str, text_col: str, file: str, row: str, min_words: int) -> DataFrame:
    """(file, row, spans): for documents that lose lines, the spans [from, to) in order."""
    lines = materialize(_lines(keyed, id_col, text_col, file, row), "lines")
    names = _ranked(lines, ["h1", "h2"], "line_ranks", "rank")
    active = materialize(lines.join(names, ["h1", "h2"]).drop("h1", "h2"), "repeated_lines")
    runs = materialize(_runs(active, min_words), "runs")
    longest = runs.agg(F.max("n")).first()[0] or 0
    levels = [active.select(*_DOC, "at", "rank")]
    while 2 ** len(levels) <= longest:
        levels.append(_doubled(levels[-1], len(levels) - 1))
    named = materialize(_intervals(runs, levels), "named_runs")
    place = F.struct(F.col("id").isNull().alias("none"), "id", *_DOC, "start")
    first = named.groupBy("n", "a", "b").agg(F.count(F.lit(1)).alias("copies"), F.min(place).alias("first"))
    # stored, so that both sides of the join are plain exchanges and a run in very many
    # documents is split
    first = materialize(first.where("copies > 1"), "first_copies")
    later = (
        named.join(first, ["n", "a", "b"])
        .where(F.col("first") != place)
        .select(*_DOC, F.col("start").alias("lo"), (F.col("start") + F.col("n")).alias("hi"))
    )
    in_order = Window.partitionBy(*_DOC).orderBy("lo", "hi")
    reach = F.max("hi").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reach.isNull() | (F.col("lo") > reach), 1).otherwise(0)
    spans = (
        later.withColumn("opens", opens)
        .withColumn("span", F.sum("opens").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*_DOC, "span")
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    )
    return materialize(
        spans.groupBy(*_DOC).agg(F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("spans")), "deleted_spans"
    )


def _kept_lines(lines: Column, spans: Column) -> Column:
    """``lines`` without the spans, as the stretches between them."""
    starts = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["hi"]))
    ends = F.concat(F.transform(spans, lambda s: s["lo"]), F.array(F.size(lines)))
    between = F.arrays_zip(starts.alias("s"), ends.alias("e"))
    return F.flatten(F.transform(between, lambda x: F.slice(lines, x["s"] + 1, x["e"] - x["s"])))


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = 50,
    kept_col: str = "kept_text",
    spans_col: str = "deleted_spans",
) -> DataFrame:
    """Every row of ``docs`` with its remaining text and the deleted spans of lines.

    Lines end at a line feed. The earliest copy of a run stays: least id, null ids last, then
    file order; copies inside one document count too. Null texts stay null and empty texts empty,
    with no spans. Repeated rows are copies of each other: the first stays. Lines without words
    belong to the runs around them. ``kept_text`` is empty when every line went. An empty table
    gives no rows; other columns pass through, and the two new ones are lengthened if taken.
    """
    file, row = unused("vm_file", docs.columns), unused("vm_row", docs.columns)
    keyed = with_row_key(docs, file, row)
    spans = deleted_spans(keyed, id_col, text_col, file, row, min_words)
    found = unused("vm_spans_found", docs.columns)
    spans = spans.select(F.col("file").alias(file), F.col("row").alias(row), F.col("spans").alias(found))
    text = F.col(f"`{text_col}`").cast("string")
    kept = _kept_lines(F.split(text, "\n", -1), F.col(found))
    return keyed.join(spans, [file, row], "left").select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.when(F.col(found).isNull(), text)
        .otherwise(F.array_join(kept, "\n"))
        .alias(unused(kept_col, docs.columns)),
        F.coalesce(found, F.expr("cast(array() as array<struct<lo:int,hi:int>>)")).alias(
            unused(spans_col, docs.columns)
        ),
    )
