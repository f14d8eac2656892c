"""URL filters: a rule list first, a logistic regression for the rest.

Rules are (host, path prefix, verdict); a rule fits its host and all subdomains if the
path starts with the rule's path, and the longest fitting rule wins. URLs that no rule
fits are judged by a logistic regression on hashed character n-grams of host and path,
trained from a small labelled URL table. Everything runs in the JVM: the features are
``HashingTF`` over arrays of n-grams, the model is Spark ML's.

The labelled table is a parameter. ``seed_urls`` is the default: every unwanted and every
ordinary site name of the two lists below under some hosts and paths, a few hundred rows.
Every URL of the input is judged.

Defined results: a null URL, or one without ``://``, has an empty host and path and no
rule, and is judged by the model like any other; without labelled URLs of both verdicts
there is nothing to learn and the verdict is the only one seen, else ``allow``. Repeated rows
are judged one by one, an empty table gives an empty result, other columns are not read.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import UPPER


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)

SIZES = (3, 4)
FEATURES = 1 << 12
#: Site names of the labelled URLs, unwanted and ordinary ones.
UNWANTED = (
    "adult-videos adult-chat xxx-clips spam-site spam-mail link-farm cheap-meds buy-pills online-pharmacy "
    "ads-server ad-tracker track-clicks casino-bonus casino-online win-cash free-poker sports-bets bets-online"
).split()
ORDINARY = (
    "library museum weather recipes gardening history university science the-daily-post nature-trail "
    "townhall theatre railways astronomy literature mathematics translation northern-herald thornton "
    "red-river winter-sports freedom-press address-book trackside adsworth"
).split()
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host with ``A``-``Z`` lower-cased, and path."""
    whole = F.coalesce(url.cast("string"), F.lit(""))
    host = F.translate(F.regexp_extract(whole, _PARTS, 1), UPPER, UPPER.lower())
    return host, F.regexp_extract(whole, _PARTS, 2)


def fitting(rules: tuple[Rule, ...], host: Column, path: Column) -> Column:
    """The longest fitting rule as struct(text, verdict), or null. Of two of one length the
    one with the longer host wins, then a block."""
    order = sorted(rules, key=lambda r: (-len(r.text), -len(r.host), r.verdict != "block"))
    found = F.lit(None).cast("struct<text:string,verdict:string>")
    for r in reversed(order):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.text).alias("text"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def grams(text: Column, size: int, mark: str) -> Column:
    """Character n-grams of ``^text$``, each with the mark of its field."""
    framed = F.concat(F.lit("^"), text, F.lit("$"))
    starts = F.when(F.length(framed) >= size, F.sequence(F.lit(1), F.length(framed) - size + 1)).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(starts, lambda i: F.concat(F.lit(mark), F.substring(framed, i, F.lit(size))))


def features(rows: DataFrame) -> DataFrame:
    """``rows`` (with host and path) with the hashed n-gram counts as ``__features``."""
    every = F.concat(*(grams(F.col(c), n, c[0]) for c in ("host", "path") for n in SIZES))
    return HashingTF(numFeatures=FEATURES, inputCol="__grams", outputCol="__features").transform(
        rows.withColumn("__grams", every)
    )


def seed_urls(spark: SparkSession) -> DataFrame:
    """The default labelled table: (url, label), label 1.0 for block."""
    hosts = [("", "com"), ("www.", "org"), ("blog.", "net"), ("m.", "org")]
    paths = ["/en/12", "/fr/345.html", "/de/6789/", "/es/24", ""]
    rows = [
        (f"https://{front}{name}.example.{end}{paths[(i + k) % len(paths)]}", label)
        for names, label in ((UNWANTED, 1.0), (ORDINARY, 0.0))
        for i, name in enumerate(names)
        for k, (front, end) in enumerate(hosts)
    ]
    return spark.createDataFrame(rows, "url string, label double")


def train(labelled: DataFrame):
    """The model, or the one label there is, or None."""
    rows = features(labelled).select("label", "__features").repartition(1).cache()
    try:
        seen = [r[0] for r in rows.select("label").distinct().collect()]
        if len(seen) < 2:
            return seen[0] if seen else None
        return LogisticRegression(
            featuresCol="__features", labelCol="label", regParam=0.001, maxIter=40, standardization=False
        ).fit(rows)
    finally:
        rows.unpersist()


def blocked_chance(rows: DataFrame, model) -> DataFrame:
    """``rows`` (with host and path) with the model's chance of ``block`` as ``chance``."""
    if not hasattr(model, "transform"):
        return rows.withColumn("chance", F.lit(float(model or 0.0)))
    scored = model.setProbabilityCol("__probability").transform(features(rows))
    return scored.select(*rows.columns, vector_to_array("__probability")[1].alias("chance"))


def judge_urls(
    pages: DataFrame, rules: tuple[Rule, ...] = RULES, labelled: DataFrame | None = None,
    id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """Per row: id, host, path, rule, verdict, and the model's ``chance`` of a block where no
    rule fits. ``labelled``: (url, label 1.0 for block); None takes ``seed_urls``."""
    host, path = split_url(F.col(url_col))
    parts = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    fit = fitting(rules, F.col("host"), F.col("path"))
    ruled = parts.withColumn("__fit", fit).select(
        "*", F.col("__fit.text").alias("rule"), F.col("__fit.verdict").alias("verdict")
    ).drop("__fit")
    table = (seed_urls(pages.sparkSession) if labelled is None else labelled).select(
        *(c.alias(n) for c, n in zip(split_url(F.col("url")), ("host", "path"), strict=True)), "label"
    )
    scored = blocked_chance(ruled, train(table))
    return scored.select(
        id_col, "host", "path", "rule",
        F.coalesce(F.col("verdict"), F.when(F.col("chance") >= 0.5, "block").otherwise("allow")).alias("verdict"),
        F.when(F.col("rule").isNull(), F.col("chance")).alias("chance"),
    )
