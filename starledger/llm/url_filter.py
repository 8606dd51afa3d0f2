"""Operator 1: URL filter.

Rules on host and path decide first; every other URL gets the verdict of a
logistic regression on hashed character 3-grams of host and path, trained
from a small labelled URL table. Only DataFrame and SQL functions are used,
in training too: each step of gradient descent is one aggregation of the
labelled table, whose size is the only thing the training cost depends on.
Judging a URL needs no shuffle; the weights are one array literal of
``buckets`` numbers.

Defined cases: a null URL, or one without ``://``, has an empty host and path
and is judged by the method (its score is the bias). Repeated rows are judged
one by one. An empty labelled table, or one with a single label, gives zero
weights and the verdict allow. Extra columns of the input are not returned.
"""

from __future__ import annotations

import json
import math
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.llm.common import keep, local_rows

BUCKETS = 16384
EPOCHS = 30
L2 = 0.00001
#: Block when the probability of a bad URL is above this: 99 % of the good
#: labelled URLs stay below it when their word or pattern is held out.
THRESHOLD = 0.86

#: The contract's rules: (verdict, host + path prefix).
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/")]

# The labelled table: words a list keeper would call bad or good, written down
# without the URLs that are to be judged, each put into hosts and into paths.
BAD_WORDS = ("casino slots poker bets betting gambling jackpot roulette blackjack bingo wager lottery sweepstakes pills "
             "viagra cialis pharma meds steroids diet-pills weight-loss adult xxx porn sex nude escort cams webcams hookup hentai "
             "spam link-farm seo-links backlinks doorway ads ad-server adserver tracker tracking-pixel clicks clickbait popup "
             "banner loans payday-loans replica counterfeit crack cracked keygen serials warez torrent torrents malware miner "
             "phish phishing").split()
GOOD_WORDS = ("news times daily journal magazine science physics chemistry biology mathematics astronomy geology history "
              "philosophy language literature library museum school college university education students research wiki "
              "encyclopedia dictionary reference recipes kitchen cooking food garden home family kids parents travel hotel "
              "weather maps regional world europe africa asia america health medicine clinic hospital nursing dentist city "
              "council government parliament law court police military society people religion church community charity music "
              "theatre dance film movies television radio comics books poetry review arts gallery painting sports football "
              "cricket tennis cycling running swimming chess games toys hobbies chess-club code software hardware internet linux "
              "programming databases security forum photo design architecture engineering nature forest river mountain ocean "
              "animals birds dogs fish plants flowers farming agriculture energy transport railway aviation cars boats business "
              "jobs finance market company industry shopping clothing jewelry electronics furniture tools about contact archive "
              "article blog post story events calendar guide help support projects team open-source annual-report").split()
HOSTS = ("{w}.example.com", "www.{w}.example.net", "blog.{w}.example.org", "m.{w}.example.com", "my-{w}.example", "{w}-online.example.net")
PATHS = ("/{n}", "/en/{n}", "/p/{n}.html", "/{n}/", "/a/{n}")
#: Patterns of paths with a word; the host beside them is one of NEUTRAL for both labels.
WORD_PATHS = ("/{w}/{n}", "/en/{w}", "/en/best-{w}-online.html", "/{n}/{w}/", "/c/{w}-{n}", "/top/free-{w}")
NEUTRAL = ("site", "page", "web", "host", "server", "domain", "portal", "main", "zone", "hub", "net", "example")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The default labelled table: ``url``, ``bad`` (1 or 0), ``word`` and
    ``pattern``. Every word stands in every pattern, with the same numbers and
    neighbours, so that only words tell the labels apart."""
    rows = []
    for bad, words in ((1, BAD_WORDS), (0, GOOD_WORDS)):
        for w in words:
            for k, host in enumerate(HOSTS):
                rows.append((f"{host.format(w=w)}{PATHS[k % len(PATHS)].format(n=k * 2977 + 131)}", bad, w, k))
            for k, path in enumerate(WORD_PATHS):
                host = HOSTS[k % len(HOSTS)].format(w=NEUTRAL[k % len(NEUTRAL)])
                rows.append((f"{host}{path.format(w=w, n=k * 2977 + 131)}", bad, w, len(HOSTS) + k))
    rows = [{"url": f"https://{u}", "bad": bad, "word": w, "pattern": k} for u, bad, w, k in rows]
    return local_rows(spark, json.dumps(rows), "url string, bad int, word string, pattern int")


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL."""
    at = F.locate("://", url)
    rest = F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _buckets(tag: str, text: Column, buckets: int) -> Column:
    """Buckets of the 3-grams of ``^text$``; none for an empty text."""
    marked = F.concat(F.lit("^"), text, F.lit("$"))
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.length(marked) - 2, F.lit(1))),
                        lambda i: F.pmod(F.xxhash64(F.lit(tag), F.substring(marked, i, 3)), F.lit(buckets)).cast("int"))
    return F.when(F.length(text) > 0, grams).otherwise(F.array().cast("array<int>"))


def _with_features(df: DataFrame, buckets: int) -> DataFrame:
    return (df.withColumn("h", _buckets("host", F.col("host"), buckets))
            .withColumn("p", _buckets("path", F.col("path"), buckets)))


def _margin(weights: list[float], bias: float) -> Column:
    """Bias + mean-scaled sums of the host's and the path's weights."""
    w = F.split(F.lit(",".join(f"{x:.9g}" for x in weights)), ",").cast("array<double>")

    def part(name):
        total = F.aggregate(name, F.lit(0.0), lambda acc, b: acc + F.get(w, b))
        return total / F.sqrt(F.greatest(F.size(name), F.lit(1)).cast("double"))

    return F.lit(bias) + part("h") + part("p")


def train(labelled: DataFrame, buckets: int = BUCKETS, epochs: int = EPOCHS, l2: float = L2) -> tuple[list[float], float]:
    """Weights and bias by full-batch Adagrad; each epoch is one aggregation.
    The labelled table must be small: it is read once an epoch."""
    host, path = host_path(F.col("url"))
    x = _with_features(labelled.select("url", F.col("bad").cast("double").alias("y")).where("y is not null")
                       .select(host.alias("host"), path.alias("path"), "y"), buckets).select("y", "h", "p")
    x = keep(x.coalesce(1))  # small: the grams are made once
    n, positive = x.agg(F.count("*"), F.sum("y")).first()
    weights, bias = [0.0] * buckets, 0.0
    if not n or not 0 < positive < n:
        return weights, bias
    seen, seen_bias = [1e-8] * buckets, 1e-8
    # both labels weigh the same
    weight = F.when(F.col("y") > 0.5, F.lit(0.5 / positive)).otherwise(F.lit(0.5 / (n - positive)))
    for _ in range(epochs):
        g = x.select("h", "p", ((F.lit(1.0) / (F.lit(1.0) + F.exp(-_margin(weights, bias))) - F.col("y")) * weight).alias("g"))
        scale = lambda c: F.col("g") / F.sqrt(F.greatest(F.size(c), F.lit(1)).cast("double"))
        terms = g.select(F.explode(F.concat(
            F.transform("h", lambda b: F.struct(b.alias("b"), scale("h").alias("g"))),
            F.transform("p", lambda b: F.struct(b.alias("b"), scale("p").alias("g"))),
            F.array(F.struct(F.lit(-1).alias("b"), F.col("g").alias("g"))))).alias("t"))
        for row in terms.groupBy("t.b").agg(F.sum("t.g").alias("g")).collect():  # at most buckets + 1 rows
            grad = round(row.g + (l2 * weights[row.b] if row.b >= 0 else 0.0), 9)
            if row.b < 0:
                seen_bias += grad * grad
                bias = round(bias - 0.7 * grad / math.sqrt(seen_bias), 9)
            else:
                seen[row.b] += grad * grad
                weights[row.b] = round(weights[row.b] - 0.7 * grad / math.sqrt(seen[row.b]), 9)
    return weights, bias


def held_out(labelled: DataFrame, by: str = "word", folds: int = 4) -> DataFrame:
    """url, bad, score of the labelled URLs, each judged by weights trained
    without any URL of its word (or pattern). ``THRESHOLD`` is set on this."""
    part, out = F.pmod(F.xxhash64(by), F.lit(folds)), None
    for i in range(folds):
        weights, bias = train(labelled.where(part != i))
        host, path = host_path(F.col("url"))
        df = _with_features(labelled.where(part == i).select("url", "bad", host.alias("host"), path.alias("path")), BUCKETS)
        df = df.select("url", "bad", (F.lit(1.0) / (F.lit(1.0) + F.exp(-_margin(weights, bias)))).alias("score"))
        out = df if out is None else out.union(df)
    return out


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits, as struct(rule, verdict); null if none.
    A rule fits its host and the host's subdomains if the path starts with
    the rule's path. Of rules of equal length that with the longer host wins."""
    out = None
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), -r[1].find("/"), r[1])):
        name, slash, prefix = rule.partition("/")
        name = name.lower()
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + prefix)
        value = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return F.lit(None).cast("struct<rule:string,verdict:string>") if out is None else out


def judge_urls(pages: DataFrame, labelled: DataFrame, rules=RULES, buckets: int = BUCKETS,
               threshold: float = THRESHOLD, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per input row: id, host, path, rule, verdict, score (the
    method's probability of a bad URL)."""
    weights, bias = train(labelled, buckets)
    url = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    host, path = host_path(F.col("url"))
    df = _with_features(url.select("page_id", host.alias("host"), path.alias("path")), buckets)
    df = df.withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-_margin(weights, bias))))
    df = df.withColumn("r", rule_of(F.col("host"), F.col("path"), rules))
    own = F.when(F.col("score") > threshold, F.lit("block")).otherwise(F.lit("allow"))
    return df.select("page_id", "host", "path", F.col("r.rule").alias("rule"),
                     F.coalesce(F.col("r.verdict"), own).alias("verdict"), F.round("score", 6).alias("score"))
