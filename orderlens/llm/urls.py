"""URL filter: host and path rules, and gradient-boosted trees on lexical features for what no rule decides.

A rule names a host and a path prefix. It fits the host and its subdomains if the path starts with the prefix; the
longest fitting rule decides. Urls that a rule decides are the labelled ones. From a bounded sample of them
(``SAMPLE`` rows, chosen by a hash of the url) gradient-boosted trees learn length, depth, digit ratio, entropy of the
host, parameter count and block rates of the host's suffixes, and judge all other urls.

Defined cases: a null url and one without ``://`` have empty host and path and go to the trees; without labelled urls
the verdict is allow, with labels of one kind that kind; equal rules cannot fit twice, of equally long ones the first
by name decides; repeated rows are judged each; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

ALLOW, BLOCK = "allow", "block"
SAMPLE = 10_000
TREES = 12
DEPTH = 4
SUFFIX_PRIOR = 8.0  # urls that the overall rate counts for in a suffix's rate


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the query.
RULES = [
    Rule("net", "/", BLOCK),
    Rule("example.net", "/en/", ALLOW),
    Rule("example.com", "/de/", BLOCK),
    Rule("org", "/fr/", ALLOW),
]

FEATURES = [
    "url_length", "host_length", "path_length", "depth", "host_depth", "digit_ratio", "host_entropy", "parameters",
    "hyphens", "has_fragment", "is_secure", "top_rate", "site_rate",
]


def split_url(pages: DataFrame) -> DataFrame:
    """``page_id`` and ``url`` with host (A-Z folded) and path."""
    url = F.coalesce("url", F.lit(""))
    rest = F.when(F.contains(url, F.lit("://")), F.substr(url, F.locate("://", url) + 3)).otherwise(F.lit(""))
    raw = F.regexp_extract("rest", r"^[^/?#]*", 0)
    return (
        pages.select("page_id", url.alias("url"))
        .withColumn("rest", rest)
        .withColumn("raw", raw)
        .select(
            "page_id", "url", ascii_lower(F.col("raw")).alias("host"),
            F.regexp_extract(F.substr("rest", F.length("raw") + 1), r"^[^?#]*", 0).alias("path"),
        )
    )


def rule_column(rules: list[Rule], value) -> Column:
    """``value(rule)`` of the longest rule that fits (host, path), null if none does."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        host = (F.col("host") == rule.host) | F.endswith(F.col("host"), F.lit(f".{rule.host}"))
        out = F.when(host & F.startswith(F.col("path"), F.lit(rule.path)), F.lit(value(rule))).otherwise(out)
    return out


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def lexical_features(urls: DataFrame) -> DataFrame:
    """``urls`` (url, host, path) with the lexical features and the host's suffixes top and site."""
    host, url = F.col("host"), F.col("url")
    symbols = F.filter(F.split(host, ""), lambda c: c != "")
    entropy = F.aggregate(
        F.array_distinct(symbols), F.lit(0.0),
        lambda s, c: s - (F.size(F.filter(symbols, lambda x: x == c)) / F.length(host))
        * F.log2(F.size(F.filter(symbols, lambda x: x == c)) / F.length(host)),
    )
    query = F.when(F.contains(url, F.lit("?")), F.substring_index(F.substring_index(url, "#", 1), "?", -1)).otherwise(F.lit(""))
    return urls.select(
        "*",
        F.length(url).cast("double").alias("url_length"),
        F.length(host).cast("double").alias("host_length"),
        F.length("path").cast("double").alias("path_length"),
        _count(F.col("path"), "/").alias("depth"),
        _count(host, r"\.").alias("host_depth"),
        (_count(url, "[0-9]") / F.greatest(F.length(url), F.lit(1))).alias("digit_ratio"),
        F.when(F.length(F.substr(host, F.lit(1), F.lit(256))) > 0, entropy).otherwise(F.lit(0.0)).alias("host_entropy"),
        F.when(query == "", F.lit(0.0)).otherwise(_count(query, "&") + 1).alias("parameters"),
        _count(url, "[-_]").alias("hyphens"),
        F.contains(url, F.lit("#")).cast("double").alias("has_fragment"),
        F.startswith(F.lower(F.substr(url, F.lit(1), F.lit(8))), F.lit("https://")).cast("double").alias("is_secure"),
        F.substring_index(host, ".", -1).alias("top"),
        F.substring_index(host, ".", -2).alias("site"),
    )


def _rates(labelled: DataFrame, key: str, overall: float) -> DataFrame:
    return labelled.groupBy(key).agg(
        ((F.sum("label") + SUFFIX_PRIOR * overall) / (F.count("*") + SUFFIX_PRIOR)).alias(f"{key}_rate")
    )


def judge_urls(pages: DataFrame, rules: list[Rule] = RULES, sample: int = SAMPLE) -> DataFrame:
    """page_id, host, path, rule, verdict and block_probability of every row of ``pages`` (page_id, url).

    Trains when called, if a rule decides any url.
    """
    urls = lexical_features(split_url(pages))
    urls = urls.withColumn("rule", rule_column(rules, lambda r: r.text)).withColumn("decided", rule_column(rules, lambda r: r.verdict))
    labelled = urls.filter(F.col("decided").isNotNull()).withColumn("label", (F.col("decided") == BLOCK).cast("double"))
    n, blocked = labelled.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    columns = ["page_id", "host", "path", "rule"]
    if not n or blocked in (0, n):
        known = F.lit(BLOCK if n and blocked else ALLOW)
        probability = F.lit(1.0 if n and blocked else 0.0)
        return urls.select(*columns, F.coalesce("decided", known).alias("verdict"), probability.alias("block_probability"))
    top, site = (_rates(labelled, key, blocked / n) for key in ("top", "site"))
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")

    def vectors(rows: DataFrame) -> DataFrame:
        rows = rows.join(top, "top", "left").join(site, "site", "left")
        return assembler.transform(rows.fillna(blocked / n, ["top_rate", "site_rate"]))

    chosen = labelled.orderBy(F.xxhash64("url", "page_id"), "page_id").limit(sample)
    training = vectors(chosen).select("features", "label").cache()
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=11).fit(training)
    training.unpersist()
    judged = model.transform(vectors(urls))
    probability = vector_to_array("probability")[1]
    method = F.when(probability >= 0.5, BLOCK).otherwise(ALLOW)
    return judged.select(*columns, F.coalesce("decided", method).alias("verdict"), probability.alias("block_probability"))
