"""URL filter by a character language-model ratio, with DataFrame operations only.

Rules decide what they fit. Their verdicts are the training data of two variable-order
Markov models over characters, one of accepted and one of rejected URLs, with Witten-Bell
smoothing: the chance of a character after up to ``ORDER - 1`` others interpolates the
counts of all shorter contexts, down to equal chances. A URL's score is the difference of
its log likelihoods divided by its length, and the threshold is the score that best splits
the URLs under rules, over a histogram of fixed size.

Models read what follows ``://``, in lower case, with digits taken as one. Counts are of
distinct texts times their occurrences, so that a host with a third of all URLs costs no
more than others. All counts cover all URLs, whole.

Defined results: a null URL, or one without ``://``, has an empty host and path, fits no
rule, and is scored by all its text (a null one scores 0). Without rejected and accepted
URLs both, the score is 0 for all and they are allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .scratch import stored

#: (verdict, host, path): what a rule fits, and what it says.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
ORDER, SYMBOLS, BINS, SPAN = 5, 256, 400, 4.0
#: Characters of a text that are cut into grams at once.
STRETCH = 64
_START, _STOP = "\x02", "\x03"


def _after(url: Column, group: int) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", group), F.lit(""))


def split(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` and ``path``."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return pages.withColumn("host", F.translate(_after(F.col(url), 1), upper, lower)).withColumn(
        "path", _after(F.col(url), 2)
    )


def _ruled(rules) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith("path", F.lit(path))
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _model(grams: DataFrame) -> DataFrame:
    """``gram`` and ``ratio``: the log of accepted over rejected chance of its last character
    after the others. ``grams``: ``gram`` of ``ORDER`` characters, ``a`` and ``b`` times."""
    chances = None
    for k in range(1, ORDER + 1):
        counts = grams.groupBy(F.right("gram", F.lit(k)).alias("gram")).agg(
            F.sum("a").alias("a"), F.sum("b").alias("b")
        )
        counts = counts.withColumn("context", F.expr(f"left(gram, {k - 1})"))
        contexts = counts.groupBy("context").agg(
            F.sum("a").alias("n_a"),
            F.sum("b").alias("n_b"),
            F.count_if(F.col("a") > 0).alias("t_a"),
            F.count_if(F.col("b") > 0).alias("t_b"),
        )
        counts = counts.join(contexts, "context")
        if chances is None:
            counts = counts.withColumn("q_a", F.lit(1 / SYMBOLS)).withColumn("q_b", F.lit(1 / SYMBOLS))
        else:
            counts = counts.withColumn("shorter", F.right("gram", F.lit(k - 1))).join(chances, "shorter")

        def chance(side: str) -> Column:
            seen = F.col(f"n_{side}") + F.col(f"t_{side}")
            mixed = (F.col(side) + F.col(f"t_{side}") * F.col(f"q_{side}")) / seen
            return F.when(seen > 0, mixed).otherwise(F.col(f"q_{side}"))

        counts = counts.select("gram", chance("a").alias("p_a"), chance("b").alias("p_b"))
        chances = counts.select(
            F.col("gram").alias("shorter"), F.col("p_a").alias("q_a"), F.col("p_b").alias("q_b")
        )
    return counts.select("gram", F.log(F.col("p_a") / F.col("p_b")).alias("ratio"))


def _places(texts: DataFrame) -> DataFrame:
    """``key``, ``a``, ``b`` and ``gram`` for each character and the end of each text.

    A long text is first cut, in one pass, into short stretches that overlap by a gram less
    one character, so that work and memory grow with its length.
    """
    padded = F.concat(F.lit(_START * (ORDER - 1)), "text", F.lit(_STOP))
    pattern = f"(?s)(?=(.{{1,{STRETCH + ORDER - 1}}})).{{1,{STRETCH}}}"
    stretches = texts.select(
        "key", "a", "b", F.explode(F.regexp_extract_all(padded, F.lit(pattern), 1)).alias("stretch")
    ).filter(F.length("stretch") >= ORDER)
    at = F.explode(F.sequence(F.lit(1), F.length("stretch") - (ORDER - 1))).alias("at")
    gram = F.substr("stretch", F.col("at"), F.lit(ORDER)).alias("gram")
    return stretches.select("key", "a", "b", "stretch", at).select("key", "a", "b", gram)


def _threshold(scored: DataFrame) -> DataFrame:
    """One row: the bin whose lower edge best splits accepted from rejected."""
    bins = scored.filter("a + b > 0").groupBy("bin").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    # At most BINS rows.
    up = Window.orderBy("bin").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    down = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    right = F.sum("a").over(up) / F.sum("a").over(every)
    right += F.coalesce(F.sum("b").over(down), F.lit(0)) / F.sum("b").over(every)
    best = bins.select("bin", right.alias("right")).groupBy().agg(
        F.max(F.when(F.col("right").isNotNull(), F.struct("right", (-F.col("bin")).alias("least")))).alias("best")
    )
    return best.select((-F.col("best.least")).alias("edge"))


def filter_urls(pages: DataFrame, id: str = "page_id", url: str = "url", rules=RULES) -> DataFrame:
    """``id``, ``host``, ``path``, ``rule``, ``verdict`` and ``score``."""
    rule, said = _ruled(rules)
    judged = split(pages.select(F.col(id).alias("id"), F.col(url).alias("url")), "url")
    text = F.coalesce(F.regexp_extract("url", r"(?s)^.*?://(.*)$", 1), F.lit(""))
    text = F.when(text == "", F.coalesce("url", F.lit(""))).otherwise(text)
    judged = judged.select(
        "id", "host", "path", rule.alias("rule"), said.alias("said"),
        F.regexp_replace(F.lower(text), "[0-9]", "0").alias("text"),
    )
    judged = stored(judged, "urls")
    texts = judged.groupBy("text").agg(
        F.count_if(F.col("said") == "allow").alias("a"), F.count_if(F.col("said") == "block").alias("b")
    )
    texts = stored(texts.withColumn("key", F.monotonically_increasing_id()), "url-texts")
    places = _places(texts)
    grams = stored(places.groupBy("gram").agg(F.sum("a").alias("a"), F.sum("b").alias("b")), "url-grams")
    totals = grams.groupBy().agg((F.sum("a") > 0).alias("some_a"), (F.sum("b") > 0).alias("some_b")).first()
    known = bool(totals.some_a and totals.some_b)
    ratio = F.sum("ratio") / F.count(F.lit(1))
    scored = places.select("key", "gram").join(_model(grams), "gram").groupBy("key").agg(
        (F.round(ratio, 9) if known else F.lit(0.0)).alias("score")
    )
    scored = texts.join(scored, "key").withColumn(
        "bin", F.floor(F.greatest(F.lit(-SPAN), F.least(F.lit(SPAN - 1e-6), "score")) * (BINS / 2 / SPAN))
    )
    scored = stored(scored.select("text", "score", "bin", "a", "b"), "url-scores")
    edge = _threshold(scored).first()
    edge = edge.edge if edge is not None and edge.edge is not None and known else -BINS
    verdict = F.coalesce("said", F.when(F.col("bin") >= F.lit(edge), "allow").otherwise("block"))
    return judged.join(scored.select("text", "score", "bin"), "text").select(
        "id", "host", "path", "rule", verdict.alias("verdict"), "score"
    )
