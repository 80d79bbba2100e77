"""URL filters: parts, rules, features and statistics against plain Python, the trees by held-out accuracy."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm.queries import URL_RULES
from tidemark.llm.url_filter import (
    ALLOW, BLOCK, BUCKETS, FOLDS, KINDS, Rule, by_rank, entropy, features, fit, lexical, suffix_statistics, url_filter, with_score,
)

URLS = [None, "", "no scheme", "http://", "://Host/P", "HTTP://EXAMPLE.ORG", "http://example.org/", "https://a.Example.org/es/1?x=/de/#y",
        "http://notexample.org/es/", "http://example.org/es", "http://b.com/fr/x#/de/", "http://com/de/", "ftp://x.com:80/de/", "http://É.org/É",
        "http://a.org?/es/", "http://a.org#x", "http://xorg/", "a://b://c/d", "http://a.b.com/de/%20A-b_c/12345.html?a=1&&b=2", "http://example.org/en/1",
        "http://www.example.org/en/19/x", "http://example.org/en/2", "http://a.com/DE/", "x" * 300_000, "http://" + "a." * 50_000 + "com/de/" + "z/" * 50_000,
        "http://line\nbreak.com/de/\nx", "http://user@b.com/fr/", "http://.com/fr/", "http://example.org./es/"]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule_for(url, rules=URL_RULES):
    host, path = parts(url)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: (len(r.host + r.path), len(r.host), r.verdict == BLOCK), default=None)


def check(df, rules=URL_RULES):
    rows = url_filter(df, rules).collect()
    assert sorted(str(r["url"]) for r in rows) == sorted(str(r["url"]) for r in df.collect())
    for r in rows:
        rule = rule_for(r["url"], rules)
        assert (r["host"], r["path"]) == parts(r["url"])
        assert r["rule"] == (rule and rule.host + rule.path) and 0 <= r["score"] <= 1
        assert r["verdict"] == (rule.verdict if rule else BLOCK if r["score"] >= 0.5 else ALLOW)
    return rows


def test_parts_and_rules_match_brute_force(spark):
    random.seed(3)
    made = ["".join(random.choice(["http://", "/", "?", "#", ".", "org", "com", "example", "es", "fr", "de", "en", "1", "A"]) for _ in range(12)) for _ in range(400)]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS + made + ["http://x.com/de/1"] * 50)], "page_id bigint, url string")
    check(df.withColumns({c: F.lit(1) for c in ("host", "verdict", "score", "n", "kind", "bucket", "features", "label")}))
    tied = (Rule("b.com", "/x", ALLOW), Rule("com", "/xxx", BLOCK), Rule("com", "/yy", BLOCK), Rule("com", "/yy", ALLOW))
    rows = check(spark.createDataFrame([("http://b.com/xxx",), ("http://b.com/yy",), ("http://q/",)], "url string"), tied)
    assert {r["url"]: (r["rule"], r["verdict"]) for r in rows if r["rule"]} == {"http://b.com/xxx": ("b.com/x", ALLOW), "http://b.com/yy": ("com/yy", BLOCK)}


def test_pages_match_brute_force(spark):
    rows = check(spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url"))
    assert {r["verdict"] for r in rows if r["rule"] is None} == {ALLOW, BLOCK}


def test_few_examples(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "url string")
    assert check(df.limit(0)) == []
    assert {(r["verdict"], r["score"]) for r in check(df, ())} == {(ALLOW, 0.0)}
    assert {(r["verdict"], r["score"]) for r in check(df, (Rule("com", "/de/", BLOCK),))} == {(BLOCK, 1.0)}
    assert {(r["verdict"], r["score"]) for r in check(df, (Rule("com", "/de/", ALLOW),))} == {(ALLOW, 0.0)}
    with pytest.raises(ValueError):
        by_rank([Rule("a", "/", "maybe")])


def test_lexical_features_match_brute_force(spark):
    urls = [u for u in URLS if u is not None]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    rows = features(df, URL_RULES).select("url", "__own").collect()

    def longest(found):
        return max(map(len, found), default=0)

    for r in rows:
        u = r["url"]
        host, path = parts(u)
        query = (re.search(r"\?([^#]*)", u) or [None, ""])[1]
        n = len(u)
        counts = Counter(u)
        bits = -sum(c / n * math.log2(c / n) for c in counts.values())
        want = [n, len(host), len(path), len(query), len(re.findall("/[^/]", path)), host.count(".") + 1 if host else 0,
                longest(re.findall(r"[^.]+", host)), longest(re.findall("[^/]+", path)), longest(re.findall("[0-9]+", u)),
                len(re.findall("[0-9]", u)) / n if n else 0, len(re.findall("[A-Z]", u)) / n if n else 0, len(re.findall("[-_]", u)), u.count("%"),
                len([p for p in query.split("&") if p]), bits, u.startswith("https:"), "#" in u, path.endswith("/")]
        assert r["__own"] == pytest.approx([float(x) for x in want], abs=1e-9), u[:80]
    assert len(lexical(F.lit(""), F.lit(""), F.lit(""))) == len(rows[0]["__own"])
    assert spark.range(1).select(entropy(F.lit("aabb"))).first()[0] == pytest.approx(1.0)


def test_statistics_match_brute_force(spark):
    rows = features(spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("url"), URL_RULES).select("__keys", "__fold", "__verdict")
    want = {}
    for r in rows.collect():
        for kind, bucket in enumerate(r["__keys"]):
            n, blocked, labelled = want.setdefault((kind, bucket), [0, [0] * FOLDS, [0] * FOLDS])
            want[kind, bucket][0] = n + 1
            blocked[r["__fold"]] += r["__verdict"] == BLOCK
            labelled[r["__fold"]] += r["__verdict"] is not None
    got = {(r["kind"], r["bucket"]): [r["n"], r["blocked"], r["labelled"]] for r in suffix_statistics(rows).collect()}
    assert got == want and len(got) <= len(KINDS) * BUCKETS


def test_trees_judge_held_out_urls(spark):
    """Examples are four fifths of the URLs of four sections, two of them blocked; the rest is judged."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("url")
    section = F.regexp_extract("url", r"://[^/]*/(\w+)/", 1)
    truth = pages.withColumn("verdict", F.when(section.isin("es", "de"), BLOCK).when(section.isin("en", "fr"), ALLOW)).dropDuplicates(["url"])
    held = F.pmod(F.xxhash64("url"), F.lit(5)) == 4
    judged = url_filter(truth.filter(held).withColumnRenamed("verdict", "truth"), (), truth.filter(~held))
    n, right = judged.agg(F.count("*"), F.count_if(F.col("verdict") == F.col("truth"))).first()
    assert n > 300 and right / n > 0.97


def test_examples_are_bounded_by_distinct_urls(spark):
    df = spark.range(3_000).select(F.concat(F.lit("http://h"), F.when(F.col("id") < 1_000, 0).otherwise(F.col("id")).cast("string"), F.lit(".com/"),
                                            F.when(F.col("id") % 2 == 0, "de").otherwise("fr"), F.lit("/")).alias("url"))
    rows = features(df, URL_RULES)
    model = fit(rows, max_examples=200)
    scored = with_score(rows, model)
    assert scored.count() == 3_000 and model.statistics.agg(F.sum("n")).first()[0] == 12_000
    assert scored.filter((F.col("score") >= 0.5) == (F.col("__verdict") == BLOCK)).count() > 2_900
