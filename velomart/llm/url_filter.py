"""URL filter: listed rules first, then a character language-model ratio.

Urls that a rule allows or blocks teach two variable-order Markov models of characters. Both
are smoothed by interpolation from order 0 to ``order``: after a context seen n times with t
different characters, a character seen k times has the chance ``(k + t * lower) / (n + t)``, where
``lower`` is its chance after the context without its first character. The score of a url is the
difference of its two log-likelihoods per character. A fifth of the ruled urls is kept from the
models and sets the cut: the one with the least mean error over both classes.

Everything is an expression. Each distinct url is counted once with its number of rows, cut
into windows of ``order + 1`` characters, and equal windows are counted before the shuffle.
The chances are then worked out once per distinct window; the shorter contexts are suffixes of
the window. Scores are sums of whole billionths, so they do not depend on the order of rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velomart.llm.common import ASCII_LOWER, ASCII_UPPER
from velomart.workspace import materialize

#: Stands before a url, so that its first characters have a context.
START = "\x02"
#: The chance of a character that was never seen is at most one in this many.
CHARACTERS = 1 << 16
UNIT = 1_000_000_000
#: Steps of the cut, and the least and largest cut, in nats per character.
STEP, WIDEST = 0.005, 5.0
CLASSES = ("allow", "block")


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: Fixed values of the contract.
RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)


def host_of(url: Column) -> Column:
    found = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(found, ASCII_UPPER, ASCII_LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _fits(host: Column, path: Column, rule: Rule) -> Column:
    on_host = (host == rule.host) | host.endswith("." + rule.host)
    return on_host & path.startswith(rule.path)


def _first_fit(host: Column, path: Column, rules: tuple[Rule, ...], value) -> Column:
    """``value`` of the longest rule that fits, or null; equal lengths by text."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        found = F.when(_fits(host, path, rule), F.lit(value(rule))).otherwise(found)
    return found


def _windows(urls: DataFrame, order: int) -> DataFrame:
    """(url, window): each character of a url with the ``order`` characters before it."""
    padded = F.concat(F.lit(START * order), F.col("url"))
    ends = F.sequence(F.lit(1), F.length("url"))
    return urls.where(F.length("url") > 0).select(
        "*", F.explode(F.transform(ends, lambda e: F.substring(padded, e, F.lit(order + 1)))).alias("window")
    )


def _chances(windows: DataFrame, order: int) -> DataFrame:
    """(window, ratio): the log ratio of the two models in billionths, per distinct window."""
    lower: DataFrame | None = None
    for k in range(order + 1):
        grams = windows.groupBy(F.expr(f"right(window, {k + 1})").alias("gram")).agg(
            *[F.sum(c).alias(c) for c in CLASSES]
        )
        context = Window.partitionBy(F.expr(f"left(gram, {k})"))
        for c in CLASSES:
            grams = grams.withColumn(f"n_{c}", F.sum(c).over(context)).withColumn(
                f"t_{c}", F.count(F.when(F.col(c) > 0, 1)).over(context)
            )
        if lower is not None:
            grams = grams.withColumn("shorter", F.expr(f"right(gram, {k})")).join(lower, "shorter")
        chances = []
        for c in CLASSES:
            below = F.lit(1.0 / CHARACTERS) if lower is None else F.col(f"p_{c}")
            seen = F.col(f"n_{c}") + F.col(f"t_{c}")
            own = (F.col(c) + F.col(f"t_{c}") * below) / seen.cast("double")
            chances.append(F.when(seen > 0, own).otherwise(below).alias(f"p_{c}"))
        last = k == order
        lower = materialize(grams.select(F.col("gram").alias("window" if last else "shorter"), *chances), f"order_{k}")
    ratio = F.round((F.ln("p_allow") - F.ln("p_block")) * UNIT).cast("long")
    return lower.select("window", ratio.alias("ratio"))


def _cut(scored: DataFrame) -> float:
    """The score from which a url counts as allowed, from the ruled urls outside the models."""
    slot = F.floor(F.least(F.greatest(F.col("score"), F.lit(-WIDEST)), F.lit(WIDEST)) / STEP).cast("long")
    held = scored.where("held").groupBy(slot.alias("slot")).agg(
        *[F.sum(F.when(F.col("ruled") == c, F.col("rows")).otherwise(0)).alias(c) for c in CLASSES]
    )
    below = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    rows = held.select(
        "slot",
        F.coalesce(F.sum("allow").over(below), F.lit(0)).alias("refused"),
        (F.sum("block").over(everything) - F.coalesce(F.sum("block").over(below), F.lit(0))).alias("passed"),
        F.sum("allow").over(everything).alias("n_allow"),
        F.sum("block").over(everything).alias("n_block"),
    ).where("n_allow > 0 and n_block > 0")
    error = F.col("refused") / F.col("n_allow") + F.col("passed") / F.col("n_block")
    best = rows.orderBy(error, F.abs("slot"), "slot").first()
    return 0.0 if best is None else best.slot * STEP


def judge(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: tuple[Rule, ...] = RULES,
    order: int = 4,
) -> DataFrame:
    """(id, host, path, rule, verdict, score) of every row.

    A null url, or one without ``://``, has an empty host and path, fits no rule, and is judged by
    its characters; null and empty urls have score 0. Without ruled urls of both verdicts outside the
    models the cut is 0; a score on the cut is allowed. Repeated rows and ids, null ids included,
    are all kept; equal urls are judged alike. An empty table gives no rows. Other columns are
    not read.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    text = F.coalesce(F.col(f"`{url_col}`").cast("string"), F.lit(""))
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), text.alias("url"))
    urls = rows.groupBy("url").agg(F.count(F.lit(1)).alias("rows"))
    urls = urls.withColumn("ruled", _first_fit(host, path, rules, lambda r: r.verdict))
    fifth = F.pmod(F.crc32(F.col("url").cast("binary")), F.lit(5)) == 0
    urls = materialize(urls.withColumn("held", F.col("ruled").isNotNull() & fifth), "urls")
    # a url is many windows, so the few stored urls are dealt to all tasks before they are cut up
    tasks = int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = _windows(urls.repartition(tasks, "url"), order)
    counted = [
        F.sum(F.when((F.col("ruled") == c) & ~F.col("held"), F.col("rows")).otherwise(0)).alias(c) for c in CLASSES
    ]
    chances = _chances(materialize(parts.groupBy("window").agg(*counted), "windows"), order)
    summed = parts.select("url", "window").join(chances, "window").groupBy("url").agg(
        F.sum("ratio").alias("total"), F.count(F.lit(1)).alias("n")
    )
    score = F.coalesce(F.col("total") / F.col("n") / F.lit(float(UNIT)), F.lit(0.0))
    scored = materialize(urls.join(summed, "url", "left").withColumn("score", score).drop("total", "n"), "scored_urls")
    cut = _cut(scored)
    by_model = F.when(F.col("score") >= cut, "allow").otherwise("block")
    return rows.join(scored.select("url", "ruled", "score"), "url").select(
        F.col("id").alias(id_col),
        host.alias("host"),
        path.alias("path"),
        _first_fit(host, path, rules, lambda r: r.text).alias("rule"),
        F.coalesce("ruled", by_model).alias("verdict"),
        F.round("score", 9).alias("score"),
    )
