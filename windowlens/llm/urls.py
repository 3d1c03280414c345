"""URL filtering: rules first, gradient-boosted trees for the rest
(DataFrame, SQL and MLlib functions only).

The labelled URLs are those a rule decides.  The trees see lexical features:
lengths, depth, digit ratio, character entropy, parameter counts, host
labels and hyphens, and the statistics of the URL's suffixes (share of
blocked labelled URLs, smoothed, and how many there are, for the top-level
domain, the last two host labels, the first folder of the path and the file
extension).  Statistics cover all labelled URLs; a labelled URL's own label
is taken out of the statistics it is trained on.  At most about
``train_rows`` labelled URLs, chosen by a hash, fit the trees.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windowlens.llm.common import staged, take

#: (verdict, host, path): a rule fits its host and all subdomains, for paths
#: that start with its path; the longest rule that fits decides.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]
TRAIN_ROWS = 50_000
TREES, DEPTH = 20, 4
PRIOR = 20.0           # weight of the overall share in a suffix's smoothed share
SUFFIXES = ("tld", "domain", "folder", "extension")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null; of
    rules equally long, block decides."""
    found = None
    for verdict, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "block")):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        value = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    if found is None:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    return found


def _count(text: Column, what: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(what), F.lit("")))).cast("double")


def _entropy(text: Column) -> Column:
    n = F.length(text).cast("double")
    return F.aggregate(
        F.array_distinct(F.split(text, "")), F.lit(0.0),
        lambda acc, c: acc - F.when(c == "", 0.0).otherwise(
            ((n - F.length(F.replace(text, c, F.lit("")))) / n) *
            F.log2((n - F.length(F.replace(text, c, F.lit("")))) / n)))


def lexical(df: DataFrame) -> DataFrame:
    """Adds the lexical features and suffixes to (url, host, path)."""
    url = F.coalesce("url", F.lit(""))
    n = F.greatest(F.length(url), F.lit(1)).cast("double")
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    return df.select(
        "*", F.length(url).cast("double").alias("length"), F.length("host").cast("double").alias("host_length"),
        F.length("path").cast("double").alias("path_length"), _count(F.col("path"), "/").alias("depth"),
        (F.length(F.regexp_replace(url, "[^0-9]", "")) / n).alias("digit_ratio"), _entropy(url).alias("entropy"),
        F.size(F.filter(F.split(query, "&"), lambda x: x != "")).cast("double").alias("parameters"),
        F.length(query).cast("double").alias("query_length"), _count(F.col("host"), ".").alias("host_dots"),
        _count(F.col("host"), "-").alias("host_hyphens"), F.when(url.contains("#"), 1.0).otherwise(0.0).alias("fragment"),
        F.when(F.col("path").endswith("/"), 1.0).otherwise(0.0).alias("trailing_slash"),
        F.substring_index("host", ".", -1).alias("tld"), F.substring_index("host", ".", -2).alias("domain"),
        F.regexp_extract("path", "^/([^/]*)/", 1).alias("folder"),
        F.regexp_extract("path", r"\.([A-Za-z0-9]{1,8})$", 1).alias("extension"))


LEXICAL = ["length", "host_length", "path_length", "depth", "digit_ratio", "entropy", "parameters", "query_length",
           "host_dots", "host_hyphens", "fragment", "trailing_slash"]
FEATURES = LEXICAL + [f"{s}_{x}" for s in SUFFIXES for x in ("share", "seen")]


def suffix_statistics(labelled: DataFrame, suffix: str) -> DataFrame:
    """(suffix, n, blocked) over all labelled URLs."""
    return labelled.groupBy(suffix).agg(F.count("*").alias(f"{suffix}_n"), F.sum("label").alias(f"{suffix}_blocked"))


def _with_statistics(df: DataFrame, statistics: dict[str, DataFrame], overall: float) -> DataFrame:
    """Smoothed shares and counts; a labelled row does not see itself."""
    own = F.when(F.col("label").isNull(), 0.0).otherwise(1.0)
    for s in SUFFIXES:
        df = df.join(statistics[s], s, "left")
        n = F.coalesce(f"{s}_n", F.lit(0)) - own
        blocked = F.coalesce(f"{s}_blocked", F.lit(0.0)) - F.coalesce("label", F.lit(0.0))
        df = df.withColumns({f"{s}_share": (blocked + PRIOR * overall) / (n + PRIOR), f"{s}_seen": F.log1p(n)})
        df = df.drop(f"{s}_n", f"{s}_blocked")
    return df


def filter_urls(pages: DataFrame, rules=RULES, train_rows: int = TRAIN_ROWS, trees: int = TREES, depth: int = DEPTH,
                id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: (page_id, host, path, rule, verdict, block_score).

    ``verdict`` is the rule's, else the trees' (block where the score is over
    0.5).  Null URLs and URLs without ``://`` have empty host and path, fit
    no rule and are judged by the trees like any other.  If the rules label
    no URL, the rest is allowed; if all labels are equal, the rest gets that
    verdict.  Rows that repeat are each returned, null ids are carried along,
    an empty table gives an empty result, other columns are ignored whatever
    their names.
    """
    url = F.col("url").cast("string")
    base = take(pages, page_id=id_col, url=url_col).select("page_id", url.alias("url"))
    parts = base.select("*", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = lexical(parts.withColumn("found", matched(F.col("host"), F.col("path"), rules)))
    judged = staged(judged.select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.when(F.col("found.verdict") == "block", 1.0).when(F.col("found.verdict") == "allow", 0.0).alias("label"),
        F.pmod(F.xxhash64("url"), F.lit(1 << 30)).alias("draw"), *LEXICAL, *SUFFIXES), "urls")

    labelled = judged.where("label is not null")
    total = labelled.agg(F.count("*").alias("n"), F.avg("label").alias("share")).first()
    n, overall = total["n"], total["share"]
    if not n or overall in (0.0, 1.0):
        score = F.lit(overall or 0.0)
        scored = judged.withColumn("block_score", score)
    else:
        statistics = {s: suffix_statistics(labelled, s) for s in SUFFIXES}
        table = staged(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(
            _with_statistics(judged, statistics, overall)).select("page_id", "host", "path", "rule", "label", "draw",
                                                                  "features"), "url-features")
        sample = table.where(F.col("label").isNotNull() & (F.col("draw") < min(1.0, train_rows / n) * (1 << 30)))
        model = GBTClassifier(labelCol="label", maxIter=trees, maxDepth=depth, seed=7).fit(sample)
        from pyspark.ml.functions import vector_to_array
        scored = model.transform(table).withColumn("block_score", vector_to_array("probability")[1])
    chosen = F.coalesce("label", F.col("block_score"))
    return scored.select("page_id", "host", "path", "rule",
                         F.when(chosen > 0.5, "block").otherwise("allow").alias("verdict"), "block_score")
