"""URL filter: rules first, then the likelihood ratio of two character models.

Two Markov models of characters are counted, one over the URLs that rules allow and one over
those that rules block. Each mixes contexts of all lengths up to ``ORDER`` by Witten-Bell
smoothing: a longer context counts the more, the oftener it was seen and the fewer characters
followed it. A URL's score is the mean difference of its characters' log-likelihoods; the level
from which on it is allowed is the one that tells the ruled URLs apart best.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.graph import kept

#: (verdict, host and path), fixed by the task.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
ORDER = 3
#: A gram with at least this share of all places is joined by broadcast; there are at most as many as its inverse.
HOT_SHARE = 1 / 2000
#: Scores are summed as whole numbers of this fraction, so that every run adds up to the same.
UNIT = 1 << 20
#: Levels that are tried, for each unit of the score.
LEVELS = 64
#: One in so many URLs is kept from the models.
HELD_OUT = 5
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for null and without ``://``."""
    text = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(text, _URL, 1), _UPPER, _UPPER.lower()), F.regexp_extract(text, _URL, 2)


def _fits(rule: str, host: Column, path: Column) -> Column:
    name, _, rest = rule.partition("/")
    return ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")


def _ruled(pages: DataFrame, rules: tuple[tuple[str, str], ...]) -> DataFrame:
    longest = sorted(rules, key=lambda r: -len(r[1]))

    def first(value: int) -> Column:
        found = F.lit(None).cast("string")
        for r in reversed(longest):
            found = F.when(_fits(r[1], F.col("host"), F.col("path")), F.lit(r[value])).otherwise(found)
        return found

    return pages.withColumn("rule", first(1)).withColumn("ruled", first(0))


def _grams(texts: DataFrame, order: int) -> DataFrame:
    """A row for each place of each text with the characters up to it."""
    padded = F.concat(F.lit("\u0002" * order), "text", F.lit("\u0003"))
    return (
        texts.withColumn("_padded", padded)
        .withColumn("_at", F.explode(F.sequence(F.lit(1), F.length("_padded") - order)))
        .withColumn("gram", F.col("_padded").substr(F.col("_at"), F.lit(order + 1)))
        .drop("_padded", "_at")
    )


def _model(grams: DataFrame, order: int) -> DataFrame:
    """(gram, llr): the log-likelihood difference of the last character after the others, in units.

    ``grams`` (gram, n_allow, n_block) has every gram that is to be scored. A context is followed by
    one row per character at most, and a suffix is that of as many grams: no hot group.
    """
    before = None
    for k in range(1, order + 2):
        level = grams.groupBy(F.substring("gram", -k, k).alias("gram")).agg(
            *[F.sum(f"n_{c}").alias(f"n_{c}") for c in ("allow", "block")]
        )
        same = Window.partitionBy(F.substring("gram", 1, k - 1))
        for c in ("allow", "block"):
            level = level.withColumn(f"all_{c}", F.sum(f"n_{c}").over(same)).withColumn(
                f"kinds_{c}", F.sum((F.col(f"n_{c}") > 0).cast("long")).over(same)
            )
        if before is None:
            level = level.withColumn("p_allow", F.lit(1 / 256)).withColumn("p_block", F.lit(1 / 256))
        else:
            level = level.withColumn("_suffix", F.substring("gram", 2, k - 1)).join(before, "_suffix")
        for c in ("allow", "block"):
            weight = F.col(f"all_{c}") + F.col(f"kinds_{c}")
            level = level.withColumn(
                f"p_{c}",
                F.when(weight == 0, F.col(f"p_{c}")).otherwise(
                    (F.col(f"n_{c}") + F.col(f"kinds_{c}") * F.col(f"p_{c}")) / weight
                ),
            )
        before = level.select(F.col("gram").alias("_suffix"), "p_allow", "p_block")
    llr = F.round((F.log("p_allow") - F.log("p_block")) * UNIT).cast("long")
    return before.select(F.col("_suffix").alias("gram"), llr.alias("llr"))


def _scores(texts: DataFrame, model: DataFrame, places: int, order: int, hot_share: float) -> DataFrame:
    """(h1, h2, total, places) by text. Grams that are everywhere are joined by broadcast, the rest by a shuffle."""
    rows = _grams(texts.select("h1", "h2", "text"), order).select("h1", "h2", "gram")
    hot = F.broadcast(model.where(F.col("n") >= places * hot_share).select("gram", "llr"))
    cold = model.where(F.col("n") < places * hot_share).select("gram", "llr")
    found = rows.join(hot, "gram").groupBy("h1", "h2").agg(F.sum("llr").alias("total"), F.count("*").alias("places"))
    rest = rows.join(hot, "gram", "left_anti").join(cold, "gram")
    rest = rest.groupBy("h1", "h2").agg(F.sum("llr").alias("total"), F.count("*").alias("places"))
    return found.unionByName(rest).groupBy("h1", "h2").agg(F.sum("total").alias("total"), F.sum("places").alias("places"))


def _level(scores: DataFrame) -> float:
    """The least score of an allowed URL: where the shares of wrong verdicts among ruled URLs add up to least."""
    step = F.floor(F.col("total") * LEVELS / (F.col("places") * UNIT))
    bins = scores.where("allow + block > 0").groupBy(step.alias("step")).agg(
        F.sum("allow").alias("allow"), F.sum("block").alias("block")
    )
    below = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def share(kind: str) -> Column:
        return F.try_divide(F.coalesce(F.sum(kind).over(below), F.lit(0)), F.sum(kind).over(everything))

    wrong = share("allow") + 1 - share("block")
    best = bins.withColumn("wrong", wrong).where("wrong IS NOT NULL").orderBy("wrong", F.abs("step"), "step").first()
    return best["step"] / LEVELS if best else 0.0


def held_out(text: Column) -> Column:
    """Whether a URL is kept from the models, to find the level on: one in ``HELD_OUT`` by its hash."""
    return F.pmod(F.xxhash64(text, F.lit(HELD_OUT)), F.lit(HELD_OUT)) == 0


def judged_urls(
    pages: DataFrame,
    id: str = "page_id",
    url: str = "url",
    rules: tuple[tuple[str, str], ...] = RULES,
    order: int = ORDER,
    hot_share: float = HOT_SHARE,
    whole: bool = False,
) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, and score, null where a rule decided.

    The longest rule that fits wins; where none does, the models decide. Both models are counted
    over four fifths of the ruled pages, a repeated page as often as it is there; the level is found on the URLs of the other fifth
    (:func:`held_out`), or, if that lacks allowed or blocked ones, on all ruled pages. Of levels that are equally good the one nearest to 0
    counts, and a score at the level is allowed. Without allowed or without
    blocked pages the models say nothing and everything else is allowed. An empty table gives no rows; a URL is scored whole, a
    row for each of its characters, however long it is. A null URL, or one
    without ``://``, has an empty host and path and is judged by the models like any other: by
    host and path, or, if ``whole``, by all of the URL as it is written.
    """
    host, path = host_and_path(F.col(url))
    named = pages.select(F.col(id).alias("id"), host.alias("host"), path.alias("path"), F.coalesce(F.col(url), F.lit("")).alias("url"))
    text = F.col("url") if whole else F.concat("host", "path")
    parsed = _ruled(named, rules)
    hashes = [F.xxhash64(text).alias("h1"), F.xxhash64(text, F.lit(1)).alias("h2")]
    texts = kept(
        parsed.groupBy(text.alias("text")).agg(
            *[F.sum((F.col("ruled").eqNullSafe(c)).cast("long")).alias(c) for c in ("allow", "block")]
        ).select(
            "text", "allow", "block", F.xxhash64("text").alias("h1"), F.xxhash64("text", F.lit(1)).alias("h2"), held_out(F.col("text")).alias("held")
        ),
        "urls",
    )
    counted = [F.when(F.col("held"), 0).otherwise(F.col(c)).cast("long").alias(c) for c in ("allow", "block")]
    grams = kept(
        _grams(texts.select("text", *counted), order)
        .groupBy("gram")
        .agg(F.sum("allow").alias("n_allow"), F.sum("block").alias("n_block"), F.count("*").alias("n")),
        "grams",
    )
    places = grams.agg(F.sum("n")).first()[0] or 0
    model = kept(_model(grams, order).join(grams.select("gram", "n"), "gram"), "model")
    scores = _scores(texts, model, places, order, hot_share)
    scores = kept(scores.join(texts.select("h1", "h2", "allow", "block", "held"), ["h1", "h2"]), "scores")
    both = scores.where("held").agg(F.sum("allow"), F.sum("block")).first()
    level = _level(scores.where("held") if both[0] and both[1] else scores)
    score = F.col("total") / (F.col("places") * UNIT)
    method = F.when(score >= level, "allow").otherwise("block")
    return (
        parsed.select("*", *hashes)
        .join(scores.select("h1", "h2", "total", "places"), ["h1", "h2"], "left")
        .select(
            "id",
            "host",
            "path",
            "rule",
            F.coalesce("ruled", method).alias("verdict"),
            F.when(F.col("rule").isNull(), score).alias("score"),
        )
    )
