"""URL filter: rules first, then gradient-boosted trees on lexical features.

A rule ``host/path`` fits its host and all subdomains when the URL's path starts with the
rule's path; the longest fitting rule decides.  URLs without a rule get the verdict of
gradient-boosted trees over length, depth, digit ratio, character entropy, parameter counts
and suffix statistics (share of blocked URLs and number of URLs per host suffix among the
labelled ones), trained from labelled URLs: those that rules decide, or a table given.
Everything runs as DataFrame functions and Spark ML.

The suffix statistics count all distinct labelled URLs, with partial aggregates; their
tables grow with the hosts and are joined, not broadcast by order.  Bound of the fit: the
trees learn from ``SAMPLE`` distinct labelled URLs of each verdict, by hash order.  Every
URL is judged.

Cases: a null URL, or one without ``://``, has an empty host and path and no rule; without
labelled URLs of both verdicts the trees' verdict is ``allow`` with score 0; repeated rows
and null ids give a row each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import store

SAMPLE = 20_000  # of each verdict
TREES = 20
DEPTH = 4
SMOOTHING = 5.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"

FEATURES = [
    "length", "host_length", "path_length", "query_length", "labels", "depth", "digits", "entropy", "parameters", "pairs",
    "hyphens", "dots", "escapes", "capitals", "fragment", "longest", "suffix_share", "suffix_count", "domain_share", "domain_count",
]


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _PARTS, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """Struct (verdict, rule) of the longest fitting rule, or null."""
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r)):  # the last, longest one is asked first
        at, slash, rest = rule.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(found)
    return found


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def _with_domain(urls: DataFrame) -> DataFrame:
    labels = F.split("host", r"\.")
    return urls.withColumns({
        "suffix": F.element_at(labels, -1),
        "domain": F.array_join(F.slice(labels, F.greatest(F.lit(1), F.size(labels) - 1), F.lit(2)), "."),
    })


def features(urls: DataFrame) -> DataFrame:
    """Adds the lexical features to rows with url, host and path."""
    url = F.coalesce(F.col("url"), F.lit(""))
    n = F.length(url)
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    chars = F.array_distinct(F.split(url, ""))
    share = lambda c: (n - F.length(F.replace(url, c, F.lit("")))) / n
    entropy = F.aggregate(F.transform(F.filter(chars, lambda c: c != ""), share), F.lit(0.0), lambda s, p: s - p * F.log2(p))
    words = F.split(url, "[^A-Za-z]+")
    safe = F.greatest(n, F.lit(1))
    labels = F.split("host", r"\.")
    return _with_domain(urls).withColumns({
        "length": n.cast("double"),
        "host_length": F.length("host").cast("double"),
        "path_length": F.length("path").cast("double"),
        "query_length": F.length(query).cast("double"),
        "labels": F.size(labels).cast("double"),
        "depth": _count(F.col("path"), "/[^/]"),
        "digits": _count(url, "[0-9]") / safe,
        "entropy": F.when(n > 0, entropy).otherwise(0.0),
        "parameters": _count(query, "[^&]+"),
        "pairs": _count(query, "="),
        "hyphens": _count(F.col("host"), "-"),
        "dots": _count(F.col("path"), r"\."),
        "escapes": _count(url, "%"),
        "capitals": _count(url, "[A-Z]") / safe,
        "fragment": url.contains("#").cast("double"),
        "longest": F.aggregate(words, F.lit(0), lambda s, w: F.greatest(s, F.length(w))).cast("double"),
    })


def _with_statistics(rows: DataFrame, statistics: tuple[DataFrame, DataFrame]) -> DataFrame:
    for name, table in zip(("suffix", "domain"), statistics, strict=True):
        rows = rows.join(table, name, "left").na.fill({f"{name}_share": 0.5, f"{name}_count": 0.0})
    return rows


def _statistics(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Share blocked (smoothed) and log count per suffix: of half 0, of half 1, of all."""
    sums = store(rows.groupBy(name, "half").agg(F.sum("label").alias("s"), F.count("*").alias("n")), f"{name}-sums")

    def table(own: DataFrame, part: str) -> DataFrame:
        share = (F.sum("s") + SMOOTHING / 2) / (F.sum("n") + SMOOTHING)
        count = F.log1p(F.sum("n").cast("double"))
        return store(own.groupBy(name).agg(share.alias(f"{name}_share"), count.alias(f"{name}_count")), f"{name}-statistics-{part}")

    return table(sums.where("half = 0"), "0"), table(sums.where("half = 1"), "1"), table(sums, "all")


class UrlModel:
    """Trees and suffix statistics fitted to rows (url, label), label 1 for block."""

    def __init__(self, labelled: DataFrame, sample: int = SAMPLE, trees: int = TREES, depth: int = DEPTH):
        rows = labelled.where("url IS NOT NULL").groupBy("url").agg(F.max("label").cast("double").alias("label"))
        rows = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url")), "half": F.pmod(F.xxhash64("url"), F.lit(2))})
        rows = store(_with_domain(rows), "labelled-urls")
        chosen = [rows.where(F.col("label") == label).orderBy(F.xxhash64("url"), "url").limit(sample) for label in (0, 1)]
        parts = store(features(chosen[0].unionByName(chosen[1])), "url-features")
        counts = {r.label: r.n for r in parts.groupBy("label").agg(F.count("*").alias("n")).collect()}
        self.model = None
        if len(counts) < 2:
            return
        # Statistics of one half describe the other, so that no row describes itself.
        found = [_statistics(rows, s) for s in ("suffix", "domain")]
        halves = [_with_statistics(parts.where(f"half = {own}"), (found[0][1 - own], found[1][1 - own])) for own in (0, 1)]
        self.statistics = (found[0][2], found[1][2])
        self.assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
        train = store(halves[0].unionByName(halves[1]).select("label", *FEATURES).orderBy(F.xxhash64(*FEATURES)), "url-training")
        weight = F.when(F.col("label") == 1, 0.5 / counts[1.0]).otherwise(0.5 / counts[0.0]) * sum(counts.values())
        trees_ = GBTClassifier(labelCol="label", weightCol="weight", maxIter=trees, maxDepth=depth, stepSize=0.2, seed=7, cacheNodeIds=False)
        self.model = trees_.fit(self.assembler.transform(train.withColumn("weight", weight)))

    def score(self, rows: DataFrame) -> DataFrame:
        """Rows (url, host, path, ...) with ``block_score``, the probability of block."""
        if self.model is None:
            return rows.withColumn("block_score", F.lit(0.0))
        keep = rows.columns
        out = self.model.transform(self.assembler.transform(_with_statistics(features(rows), self.statistics)))
        return out.select(*keep, vector_to_array("probability")[1].alias("block_score"))


def judge(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    labelled: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """(id, url, host, path, rule, verdict, block_score) of every page."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    rows = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rows = rows.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    if labelled is None:
        labelled = rows.where("found IS NOT NULL").select("url", (F.col("found.verdict") == "block").cast("int").alias("label"))
    scored = UrlModel(labelled).score(rows)
    verdict = F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")
    return scored.select(
        "id", "url", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", verdict).alias("verdict"), "block_score",
    )
