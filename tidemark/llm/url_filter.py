"""URL filters (operator 13): rules first, gradient-boosted trees on lexical features for the rest.

A rule holds a host, a path prefix and a verdict. It fits its host and all subdomains if the URL's
path begins with its path; the longest rule (host plus path) wins, of equally long ones that with the
longer host, then the blocking one. URLs that a rule fits are also the labelled examples: boosted
trees learn from them how a blocked URL looks and judge the URLs that no rule fits. More examples
may be passed in.

The features are lexical: lengths, depth, labels of the host, digit and capital ratio, runs, entropy of
the characters, parameters, and statistics of four suffixes and segments (last label and last two labels of the
host, first path segment, extension): how many URLs have them, and how many of the labelled ones are
blocked. Values are hashed to ``BUCKETS`` buckets a kind, so these statistics are a table of at most
four times that many rows whatever the corpus, counted over all URLs by partial aggregation and
broadcast. A labelled URL sees the shares without its own fifth of the examples, so
the trees do not learn their own labels back. The trees are Spark ML's: each level is one pass of
histograms summed over the cluster.

``MAX_EXAMPLES`` bounds the examples that the trees are fitted on: beyond it, a share of the distinct
labelled URLs by hash. Statistics and rules always cover all rows.

Defined results: without ``://`` (or with a null URL) host and path are empty, which no rule fits; the
trees judge such a URL by its other features. Rows are judged alone, so repeated rows get equal
results; a repeated URL is one example. Without examples every other URL is allowed with score 0; with
examples of one verdict only, all get that verdict. A score of exactly one half blocks. URLs of any length
are looked at whole. An empty table gives an empty result. Extra columns stay; the results replace columns of
their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage

#: The capitals that are lower-cased.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"
BUCKETS = 4096
KINDS = ("top", "domain", "head", "extension")
FOLDS = 5
#: A share is drawn to the overall one as if by so many more examples.
PRIOR_WEIGHT = 10.0
MAX_EXAMPLES = 1_000_000
#: Rules are one expression; more of them than this are refused.
MAX_RULES = 2_000
TREES, DEPTH, STEP, SEED = 20, 4, 0.3, 13
RESULTS = ("host", "path", "rule", "verdict", "score")


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class UrlModel:
    """Suffix statistics (a bounded table), the overall share of blocked examples, and the trees
    (None where the examples have one verdict only, or there are none)."""
    statistics: DataFrame
    share: float
    trees: GBTClassificationModel | None


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``, else an empty string."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(after_scheme(url), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def by_rank(rules: Sequence[Rule]) -> list[Rule]:
    """The order in which rules win."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules, more than {MAX_RULES}")
    if any(r.verdict not in (ALLOW, BLOCK) for r in rules):
        raise ValueError(f"a rule's verdict is {ALLOW} or {BLOCK}")
    return sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r.verdict != BLOCK, r.name))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the rule that wins, or nulls."""
    def first(value) -> Column:
        picks = [F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path), F.lit(value(r))) for r in by_rank(rules)]
        return F.coalesce(*picks) if picks else F.lit(None).cast("string")
    return first(lambda r: r.name), first(lambda r: r.verdict)


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def _longest(url: Column, pattern: str) -> Column:
    return F.coalesce(F.array_max(F.transform(F.regexp_extract_all(url, F.lit(pattern), F.lit(0)), F.length)), F.lit(0))


def entropy(text: Column) -> Column:
    """Bits per character of the characters' distribution."""
    size = F.length(text)

    def bits(c: Column) -> Column:
        p = (size - F.length(F.replace(text, c, F.lit("")))) / size
        return -p * F.log2(p)
    letters = F.filter(F.array_distinct(F.split(text, "")), lambda c: c != "")
    return F.aggregate(F.transform(letters, bits), F.lit(0.0), lambda a, x: a + x)


def lexical(url: Column, host: Column, path: Column) -> list[Column]:
    """The features that need nothing but the URL."""
    size, query = F.length(url), F.regexp_extract(url, r"\?([^#]*)", 1)
    return [size, F.length(host), F.length(path), F.length(query),
            F.regexp_count(path, F.lit("/[^/]")), F.when(host == "", 0).otherwise(F.regexp_count(host, F.lit(r"\.")) + 1),
            _longest(host, r"[^.]+"), _longest(path, r"[^/]+"), _longest(url, "[0-9]+"),
            _ratio(F.regexp_count(url, F.lit("[0-9]")), size), _ratio(F.regexp_count(url, F.lit("[A-Z]")), size),
            F.regexp_count(url, F.lit("[-_]")), F.regexp_count(url, F.lit("%")), F.regexp_count(query, F.lit("[^&]+")),
            entropy(url), url.startswith("https:").cast("int"), url.contains("#").cast("int"), path.endswith("/").cast("int")]


def keys(host: Column, path: Column) -> list[Column]:
    """Bucket of each of the KINDS."""
    values = [F.regexp_extract(host, r"[^.]*$", 0), F.regexp_extract(host, r"[^.]*\.?[^.]*$", 0),
              F.regexp_extract(path, "^/+([^/]*)", 1), F.regexp_extract(path, r"(\.[^./]*|/)$", 1)]
    return [F.pmod(F.xxhash64(F.lit(kind), v), F.lit(BUCKETS)).cast("int") for kind, v in zip(KINDS, values)]


def features(urls: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``urls`` plus host, path, rule, ``__verdict`` (the rule's), ``__keys``, ``__own`` and ``__fold``."""
    url = F.coalesce(F.col("url"), F.lit(""))
    parts = urls.withColumns({"host": host_of(url), "path": path_of(url)})
    host, path = F.col("host"), F.col("path")
    name, verdict = rule_of(host, path, rules)
    return parts.withColumns({
        "rule": name, "__verdict": verdict, "__keys": F.array(*keys(host, path)), "__fold": F.pmod(F.xxhash64(url), F.lit(FOLDS)).cast("int"),
        "__own": F.array(*(x.cast("double") for x in lexical(url, host, path)))})


def suffix_statistics(rows: DataFrame) -> DataFrame:
    """``(kind, bucket, n, blocked, labelled)``: rows, and blocked and labelled ones by fold; at most
    ``BUCKETS`` rows a kind."""
    pairs = rows.select(F.posexplode("__keys").alias("kind", "bucket"), "__fold", "__verdict")
    by_fold = [(F.count_if((F.col("__fold") == k) & (F.col("__verdict") == BLOCK)), F.count_if((F.col("__fold") == k) & F.col("__verdict").isNotNull()))
               for k in range(FOLDS)]
    return pairs.groupBy("kind", "bucket").agg(F.count("*").alias("n"), F.array(*(b for b, _ in by_fold)).alias("blocked"),
                                               F.array(*(a for _, a in by_fold)).alias("labelled"))


def with_vector(rows: DataFrame, statistics: DataFrame, share: float) -> DataFrame:
    """``rows`` plus ``__vector``. The statistics are bounded, so each kind is joined by broadcast."""
    def total(values: str, labelled: Column) -> Column:
        whole = F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)
        return whole - F.when(labelled, F.get(values, F.col("__fold"))).otherwise(0)

    found = []
    for k, kind in enumerate(KINDS):
        own = F.col("__verdict").isNotNull()
        table = statistics.filter(F.col("kind") == k).select(F.col("bucket").alias(f"__b_{kind}"), F.col("n").alias(f"__n_{kind}"),
                                                             F.col("blocked").alias(f"__y_{kind}"), F.col("labelled").alias(f"__l_{kind}"))
        rows = rows.withColumn(f"__k_{kind}", F.get("__keys", F.lit(k))).join(F.broadcast(table), F.col(f"__k_{kind}") == F.col(f"__b_{kind}"), "left")
        found += [F.log2(1.0 + F.coalesce(f"__n_{kind}", F.lit(0))),
                  F.coalesce((total(f"__y_{kind}", own) + share * PRIOR_WEIGHT) / (total(f"__l_{kind}", own) + PRIOR_WEIGHT), F.lit(share))]
    vector = array_to_vector(F.concat("__own", F.array(*(x.cast("double") for x in found))))
    made = [f"__{x}_{kind}" for kind in KINDS for x in "bnylk"]
    return rows.withColumn("__vector", vector).drop(*made)


def fit(rows: DataFrame, max_examples: int = MAX_EXAMPLES) -> UrlModel:
    """The statistics of all ``rows`` (of ``features``, staged) and the trees of their labelled URLs."""
    statistics = stage(suffix_statistics(rows), "url-statistics")
    examples = rows.filter(F.col("__verdict").isNotNull())
    n, blocked = examples.agg(F.count("*"), F.count_if(F.col("__verdict") == BLOCK)).first()
    share = blocked / n if n else 0.0
    if not 0 < blocked < n:
        return UrlModel(statistics, share, None)
    distinct = examples.dropDuplicates(["url"])
    n_urls = distinct.count()
    if n_urls > max_examples:     # distinct URLs, so the hash keeps near the bound however often one repeats
        distinct = distinct.filter(F.pmod(F.xxhash64(F.lit(SEED), "url"), F.lit(1 << 30)) < int((1 << 30) * max_examples / n_urls))
    table = stage(with_vector(distinct, statistics, share).select("__vector", (F.col("__verdict") == BLOCK).cast("double").alias("__label")), "url-examples")
    trees = GBTClassifier(featuresCol="__vector", labelCol="__label", predictionCol="__prediction", maxIter=TREES, maxDepth=DEPTH,
                          stepSize=STEP, seed=SEED).setRawPredictionCol("__raw").setProbabilityCol("__probability").fit(table)
    return UrlModel(statistics, share, trees)


def with_score(rows: DataFrame, model: UrlModel) -> DataFrame:
    """``rows`` plus score, the probability that the URL is one to block."""
    if model.trees is None:
        return rows.withColumn("score", F.lit(model.share))
    made = model.trees.transform(with_vector(rows, model.statistics, model.share))
    return (made.withColumn("score", F.get(vector_to_array("__probability"), F.lit(1)))
            .drop("__vector", "__raw", "__probability", "__prediction"))


def url_filter(pages: DataFrame, rules: Sequence[Rule], labelled: DataFrame | None = None, max_examples: int = MAX_EXAMPLES) -> DataFrame:
    """``pages(url, ...)`` plus host, path, rule, verdict and score (the trees' probability of
    blocking, also where a rule decides). ``labelled(url, verdict)`` are examples beside the URLs that rules fit."""
    rows = stage(features(pages.drop(*RESULTS), rules), "url-features")
    learned = rows.select("url", "__verdict", "__keys", "__own", "__fold")
    if labelled is not None:
        more = features(labelled.select("url", F.col("verdict").alias("__given")), ())
        learned = learned.unionByName(stage(more.withColumn("__verdict", F.col("__given")).select(learned.columns), "url-labelled"))
    judged = with_score(rows, fit(learned, max_examples))
    verdict = F.coalesce("__verdict", F.when(F.col("score") >= 0.5, BLOCK).otherwise(ALLOW))
    return judged.withColumn("verdict", verdict).drop("__verdict", "__keys", "__own", "__fold")
