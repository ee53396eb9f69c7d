"""URL filter: host and path rules first, then boosted trees on lexical features.

The trees are Spark ML's gradient-boosted classifier. They are trained on URLs that the rules label,
or on labels given apart, and judge the URLs that no rule fits. Features come from the URL alone:
lengths, depth, shares of digits, capitals and marks, entropy of its characters, numbers of parameters,
and statistics of its parts (last label and last two labels of the host, first folder and file extension
of the path): how often a part occurs among all rows, and the smoothed share of blocked ones among its
labelled rows on other hosts. Hosts are dealt by hash into FOLDS, and a row sees the shares of the other
folds only, so that neither its own label nor its host's has a part in them.

Where rules name a suffix for one verdict only, labels can be read off the suffix and say nothing about
its other URLs. Such suffixes have no statistics, and the trees are trained on labelled rows whose last
label has both verdicts; only where there are none, on all labelled rows. All rows count for the
statistics; at most about TRAINING_URLS labelled rows, chosen by hash, grow the trees.

A null URL, or one without ``://``, has an empty host and path and fits no rule. Rows stay as they are.
Where the labelled rows are all of one verdict, that verdict goes to the rest; without any, ``allow``.
Repeated rows are judged alike. URLs may have any length. Other columns are not read, whatever their
names. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import stored

TRAINING_URLS = 20_000
TREES, DEPTH = 20, 4
FOLDS = 5
SMOOTHING = 10  # rows at the overall share that are added to each part's
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """Fits the host, all its subdomains, and paths that begin with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the registered query.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path without query and fragment."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.char_length(host) + 1, F.char_length(rest)), r"^[^?#]*", 0)
    return F.translate(host, CAPITALS, SMALL), path


def rule_for(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Struct of the longest fitting rule's name and verdict, or null."""
    out = None
    for r in sorted(rules, key=lambda r: (-len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        value = F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def _count(text: Column, chars: str) -> Column:
    return (F.char_length(text) - F.char_length(F.translate(text, chars, ""))).cast("double")


def lexical_features(url: Column, host: Column, path: Column) -> Column:
    """Array of doubles; all of a null URL are 0."""
    url = F.coalesce(url, F.lit(""))
    n = F.char_length(url).cast("double")
    size = F.greatest(n, F.lit(1.0))
    counts = F.transform(F.array_distinct(F.split(url, "")), lambda c: (n - F.char_length(F.replace(url, c, F.lit("")))) / size)
    entropy = F.aggregate(counts, F.lit(0.0), lambda total, p: total - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return F.array(
        n,
        F.char_length(host).cast("double"),
        F.char_length(path).cast("double"),
        F.char_length(query).cast("double"),
        _count(host, "."),
        F.size(F.array_remove(F.split(path, "/"), "")).cast("double"),
        _count(url, "0123456789") / size,
        _count(path, "0123456789") / F.greatest(F.char_length(path), F.lit(1)),
        _count(url, CAPITALS) / size,
        _count(url, "-_.~%+") / size,
        _count(host, "-"),
        entropy,
        F.when(query == "", 0.0).otherwise(_count(query, "&") + 1.0),
        F.contains(url, F.lit("#")).cast("double"),
        F.startswith(url, F.lit("https")).cast("double"),
    )


def _parts(host: Column, path: Column) -> dict[str, Column]:
    return {
        "last": F.substring_index(host, ".", -1),
        "two": F.substring_index(host, ".", -2),
        "folder": F.regexp_extract(path, r"^/([^/]*)/", 1),
        "file": F.regexp_extract(path, r"\.([A-Za-z0-9]{1,8})$", 1),
    }


def part_statistics(rows: DataFrame, name: str, total: int, base: float) -> DataFrame:
    """(name, fold, stats, both) of a part of the URL, for each fold that has it: its frequency and its
    share of blocked rows in the other folds, and whether its labelled rows have both verdicts."""
    counts = rows.groupBy(name, "fold").agg(F.count("*").alias("c"), F.count("label").alias("l"), F.sum("label").alias("b"))
    part = Window.partitionBy(name)  # a row for each fold
    l, b = F.sum("l").over(part), F.coalesce(F.sum("b").over(part), F.lit(0.0))  # noqa: E741
    share = (b - F.coalesce("b", F.lit(0.0)) + SMOOTHING * base) / (l - F.col("l") + SMOOTHING)
    both = (b > 0) & (b < l)
    stats = F.array(F.log1p(F.sum("c").over(part) / float(total)), share)
    if name in ("last", "two"):
        stats = F.when(both, stats).otherwise(F.array(F.lit(0.0), F.lit(base)))
    return counts.select(F.col(name).alias("s"), F.col("fold").alias("of"), stats.alias("stats"), both.alias("both"))


def judged(pages: DataFrame, id: str = "page_id", url: str = "url", rules: tuple[Rule, ...] = RULES, training: int = TRAINING_URLS) -> DataFrame:
    """The id with host, path, rule, verdict and ``score``, the trees' probability of being blocked
    (null where a rule decided)."""
    rows = pages.select(F.col(f"`{id}`").alias("id"), F.col(f"`{url}`").alias("url"))
    host, path = host_and_path(F.col("url"))
    rows = rows.withColumns({"host": host, "path": path})
    rows = rows.withColumn("ruled", rule_for(F.col("host"), F.col("path"), rules))
    rows = rows.withColumn("label", (F.col("ruled.verdict") == "block").cast("double"))
    rows = stored(rows.withColumns({"x": lexical_features(F.col("url"), F.col("host"), F.col("path")), **_parts(F.col("host"), F.col("path")), "fold": F.pmod(F.xxhash64("host"), F.lit(FOLDS))}), "urls")
    one = rows.agg(F.count("label").alias("n"), F.sum("label").alias("blocked"), F.count("*").alias("all")).first()
    n, blocked, total = one["n"], one["blocked"] or 0.0, one["all"]
    x = rows
    known = F.col("ruled").isNotNull()
    if 0 < blocked < n:
        for name in ("last", "two", "folder", "file"):
            # Hot parts are summed before they are shuffled, and their rows are split where they are joined.
            table = stored(part_statistics(rows, name, total, blocked / n), "parts")
            x = x.join(table, (x[name] == table["s"]) & (x["fold"] == table["of"])).withColumn("x", F.concat("x", "stats"))
            x = x.withColumnRenamed("both", "told") if name == "last" else x.drop("both")
            x = x.drop("s", "of", "stats")
        x = stored(x.select("id", "url", "host", "path", "ruled", "label", "told", array_to_vector("x").alias("features")), "features")
        told = x.filter(known & F.col("told")).count()
        usable = known & F.col("told") if told else known
        chosen = F.pmod(F.xxhash64("id", "url"), F.lit(1_000_000)) < F.lit(min(1.0, training / (told or n)) * 1_000_000)
        sample = stored(x.filter(usable & chosen).select("features", "label").repartition(4), "training")
        model = None
        if sample.select("label").distinct().count() == 2:
            model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=11, labelCol="label").fit(sample)
            x = model.transform(x).withColumn("score", F.when(~known, F.round(vector_to_array("probability")[1], 6)))
        else:
            x = x.withColumn("score", F.when(~known, F.lit(blocked / n)))
    else:
        x = x.withColumn("score", F.when(~known, F.lit(1.0 if n and blocked else 0.0)))
    own = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return x.select(F.col("id").alias(id), "host", "path", F.col("ruled.rule").alias("rule"), F.coalesce("ruled.verdict", own).alias("verdict"), "score")


def op3_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return judged(spark.read.parquet(f"{sf}/pages.parquet"))


QUERIES = {"op3_url_filter": op3_url_filter}
