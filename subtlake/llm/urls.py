"""URL filters: rules first, and gradient-boosted trees over lexical features where no rule fits.

The trees learn from the URLs that the rules label.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtlake.llm.common import stored
from subtlake.session import checkpointed

#: (verdict, host, path): a rule fits its host and all subdomains, for paths that start with its own.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"),
         ("block", "net", "/fr/"))

FEATURES = ("url_length", "host_length", "path_length", "query_length", "depth", "labels", "digit_ratio", "entropy", "parameters", "hyphens",
            "longest_part", "suffix_rate", "parent_rate", "first_part_rate")
PLACES = ("suffix", "parent", "first_part")
_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; path: then up to ``?``, ``#`` or the end."""
    there = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.substring(url, F.instr(url, "://") + 3, F.lit(2**31 - 1))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.when(there, F.translate(host, *_LOWER)).otherwise(""), F.when(there, path).otherwise("")


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as host and path together, and its verdict; null if none does."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1:]))
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, name, start in reversed(ordered):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        text, verdict = F.when(fits, F.lit(name + start)).otherwise(text), F.when(fits, F.lit(kind)).otherwise(verdict)
    return text, verdict


def _entropy(text: Column) -> Column:
    """Bits per character."""
    size = F.char_length(text)
    return F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0),
                       lambda total, c: total - F.when(c == "", 0.0).otherwise(
                           (size - F.char_length(F.replace(text, c, F.lit("")))) / size
                           * F.log2((size - F.char_length(F.replace(text, c, F.lit("")))) / size)))


def lexical(rows: DataFrame) -> DataFrame:
    """``rows`` (url, host, path) with the lexical features; a null URL has zeros."""
    url = F.coalesce(F.col("url"), F.lit(""))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    parts = F.split(F.col("path"), "/")

    def number(x: Column) -> Column:
        return F.coalesce(x.cast("double"), F.lit(0.0))

    return rows.withColumns({
        "url_length": number(F.char_length(url)), "host_length": number(F.char_length("host")), "path_length": number(F.char_length("path")),
        "query_length": number(F.char_length(query)), "depth": number(F.size(F.filter(parts, lambda p: p != ""))),
        "labels": number(F.when(F.col("host") != "", F.size(F.split("host", r"\.")))),
        "digit_ratio": number(F.char_length(F.regexp_replace(url, "[^0-9]", "")) / F.greatest(F.char_length(url), F.lit(1))),
        "entropy": number(F.when(url != "", _entropy(url))),
        "parameters": number(F.size(F.filter(F.split(query, "&"), lambda p: p != ""))),
        "hyphens": number(F.regexp_count(url, F.lit("-"))),
        "longest_part": number(F.array_max(F.transform(F.split(url, "[^A-Za-z0-9]"), lambda p: F.char_length(p)))),
    })


def places(rows: DataFrame) -> DataFrame:
    """``rows`` (host, path) with what block rates are counted by."""
    return rows.withColumns({"suffix": F.substring_index("host", ".", -1), "parent": F.substring_index("host", ".", -2),
                             "first_part": F.regexp_extract("path", r"^/*([^/]*)", 1)})


def _draw(labelled: DataFrame, most: int) -> DataFrame:
    """At most ``most`` different URLs of ``labelled`` with ``weight``: of each label those with the smallest hash, half of the places
    or what the other label leaves; weights bring each label back to all its rows."""
    sizes = {r["label"]: (r["urls"], r["n"]) for r in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("urls"), F.sum("n").alias("n")).collect()}
    parts = []
    for label, (urls, _) in sorted(sizes.items()):
        other = sum(u for x, (u, _) in sizes.items() if x != label)
        places = max(most - other, (most + int(label)) // 2)
        parts.append(labelled.where(F.col("label") == label).orderBy(F.xxhash64("url"), "url").limit(places))
    drawn = checkpointed(reduce(DataFrame.unionAll, parts))
    there = {r["label"]: r["n"] for r in drawn.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    scale = reduce(lambda c, x: F.when(F.col("label") == x, F.lit(sizes[x][1] / there[x])).otherwise(c), there, F.lit(1.0))
    return drawn.withColumn("weight", F.col("n") * scale)


def block_rates(labelled: DataFrame, name: str, rate: float, smooth: float) -> DataFrame:
    """``name`` and ``{name}_rate``: the block rate over all labelled rows (``n`` of each URL), smoothed by ``rate``."""
    found = labelled.groupBy(name).agg(F.sum(F.col("label") * F.col("n")).alias("blocked"), F.sum("n").alias("n"))
    return found.select(name, ((F.col("blocked") + smooth * rate) / (F.col("n") + smooth)).alias(f"{name}_rate"))


def judge_urls(pages: DataFrame, rules=RULES, key: str = "page_id", url: str = "url", most: int = 20_000, trees: int = 10, depth: int = 4,
               smooth: float = 10.0) -> DataFrame:
    """``key``, ``host``, ``path``, ``rule``, ``verdict`` (allow or block), ``block_chance``: one row per input row.

    Where a rule fits, the longest decides. Elsewhere the trees do, fitted on at most ``most`` different URLs that rules label, of both
    labels and weighted by their rows. The block rates of suffixes, parent domains and first path parts cover all labelled rows and are
    smoothed by the rate over all of them. A null URL or one without ``://`` has an empty host and path and is judged by the trees. If
    the labels are all of one kind, so is every verdict; without labels it is allow.
    """
    rows = pages.select(F.col(key).alias("id"), F.col(url).alias("url"))
    host, path = host_and_path(F.col("url"))
    rows = rows.withColumn("host", host).withColumn("path", path)
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("ruled", verdict)
    labelled = rows.where("rule is not null").withColumn("label", (F.col("ruled") == "block").cast("double"))
    labelled = labelled.groupBy("url", "host", "path", "label").agg(F.count(F.lit(1)).alias("n"))
    labelled = stored(places(labelled), "labelled")
    stats = labelled.agg((F.sum(F.col("label") * F.col("n")) / F.sum("n")).alias("rate"), F.min("label").alias("low"), F.max("label").alias("high")).first()
    if stats["low"] is None or stats["low"] == stats["high"]:
        alone = "block" if stats["low"] == 1.0 else "allow"
        return rows.select(F.col("id").alias(key), "host", "path", "rule", F.coalesce("ruled", F.lit(alone)).alias("verdict"),
                           F.lit(float(alone == "block")).alias("block_chance"))
    tables = [stored(block_rates(labelled, name, stats["rate"], smooth), name) for name in PLACES]

    def features(some: DataFrame) -> DataFrame:
        for table in tables:  # they grow with the input
            some = some.join(table, table.columns[0], "left")
        some = lexical(some.fillna(float(stats["rate"]), [t.columns[1] for t in tables]))
        return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(some)

    trees_ = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, seed=7, cacheNodeIds=False, weightCol="weight")
    model = trees_.fit(features(_draw(labelled, most)).select("label", "weight", "features").repartition(2))
    judged = model.transform(features(places(rows)))
    chance = vector_to_array("probability")[1]
    verdict = F.coalesce("ruled", F.when(F.col("prediction") > 0.5, "block").otherwise("allow"))
    return judged.select(F.col("id").alias(key), "host", "path", "rule", verdict.alias("verdict"), chance.alias("block_chance"))
