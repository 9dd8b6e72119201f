"""URL filters: explicit host/path rules, and a path-template tree for the urls that no rule fits.

The tree: each path is cut into segments; a segment that is a number, a hexadecimal
id or one of these with an extension is a wildcard at once. Then, level by level from
the root and per host, the branches of a node are compared. Those whose labelled share of good
pages doesn't differ from their siblings' (a two-proportion z test) merge into one ``*`` branch. The
others are compared to each other: ordered by their share, neighbours that are alike by the
same test merge, again and again until none are; a class of one branch keeps its name, one of several
is ``*1``, ``*2`` and so on by rising share. A template is a host with its generalised path. It is
rejected if its labelled purity, smoothed towards its host's and that towards the whole table's, is
under a threshold.

Everything is built-in functions over (host, path) counts: urls are pre-aggregated
before anything is grouped, so a hot host costs one row per distinct path. A node's totals come
from a second aggregation and a join, never from a window over a host; branches that differ are first summed
in ``CELLS`` cells of equal share, so that a node's list has so many entries at most.

Defined results: a null url or one without ``://`` has an empty host and path; repeated
rows each get their row; null ids are carried through; an empty table gives no rows;
without labels every template has the prior purity 1 and is allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm.common import scratch, table, written

#: (verdict, host, path prefix)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Cells of equal share of good pages that a node's branches are summed in before they are compared to each other.
CELLS = 50
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, null if none does. Of equal length the first in order of (host + path) wins."""
    out = None
    for verdict, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        value = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def segment(raw: Column) -> Column:
    """A segment with its variable part as a wildcard; what follows a last dot stays."""
    stem, ext = F.regexp_extract(raw, r"(?s)\A(.*?)(\.[A-Za-z0-9]{1,5})?\z", 1), F.regexp_extract(raw, r"(?s)\A(.*?)(\.[A-Za-z0-9]{1,5})?\z", 2)
    kind = F.when(stem.rlike(r"\A[0-9]+\z"), "{n}").when(stem.rlike(r"\A(?=.*[0-9])[0-9A-Fa-f-]{8,}\z"), "{id}").otherwise(stem)
    return F.concat(kind, ext)


def shape_of(path: Column) -> Column:
    """All segments, generalised."""
    return F.transform(F.split(F.regexp_replace(path, r"\A/", ""), "/", -1), segment)


def alike(a: Column, b: Column, z: float) -> Column:
    """Whether two structs of labelled and good counts have shares that a two-proportion z test can't tell apart."""
    pooled = (a["good"] + b["good"]) / (a["labelled"] + b["labelled"])
    spread = F.sqrt(pooled * (1 - pooled) * (1 / a["labelled"] + 1 / b["labelled"]))
    return F.abs(a["good"] / a["labelled"] - b["good"] / b["labelled"]) <= z * spread


def merged(cells: Column, z: float) -> Column:
    """An ascending list of (low, high, labelled, good, branches) with alike neighbours merged, until none are."""
    last = lambda acc: F.get(acc, F.size(acc) - 1)

    def put(acc: Column, x: Column) -> Column:
        both = F.struct(last(acc)["low"].alias("low"), x["high"].alias("high"), *((last(acc)[c] + x[c]).alias(c) for c in ("labelled", "good", "branches")))
        return F.when((F.size(acc) > 0) & alike(last(acc), x, z), F.concat(F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))), F.array(both))).otherwise(F.concat(acc, F.array(x)))

    empty = F.array().cast("array<struct<low:int,high:int,labelled:bigint,good:bigint,branches:bigint>>")
    # A pass merges at least one pair while there is one, so as many passes as there are cells end with none.
    return F.aggregate(F.sequence(F.lit(1), F.size(cells)), cells, lambda acc, _: F.aggregate(acc, empty, put))


def tree(urls: DataFrame, z: float = 2.58, smoothing: float = 10.0) -> DataFrame:
    """urls (host, path, label) to templates: host, path_key, template, n, labelled, good, purity.

    label is 1, 0 or null. path_key is the path with its variable segments generalised, which
    is what urls join on; template is what the merged branches leave of it. There are as many
    levels as the data has: a path goes on to the next while it has a further step, and one
    that is alone in its node keeps the rest of its steps at once.
    """
    spark = urls.sparkSession
    shaped = urls.select("host", shape_of(F.col("path")).alias("shape"), "label")
    base = shaped.groupBy("host", F.concat_ws("/", "shape").alias("path_key"), "shape").agg(
        F.count("*").alias("n"), F.count("label").alias("labelled"), F.coalesce(F.sum("label"), F.lit(0)).cast("long").alias("good"))
    base = written(base.withColumns({"template": F.lit(""), "done": F.lit(False)}), "url-tree")
    sums = lambda extra: (F.sum("labelled").alias("labelled" + extra), F.sum("good").alias("good" + extra))
    node = ["host", "template"]
    anew = lambda df: df.repartition(F.xxhash64(*df.columns[:3]))  # so that adaptive execution can split a hot node's side of the join
    levels, left = [], base
    while not levels or left.limit(1).count():
        # Children of a node against their siblings: counts per child, then totals per node.
        left = left.withColumn("step", F.element_at("shape", len(levels) + 1))
        children = left.groupBy(*node, "step").agg(*sums("_c"), F.count("*").alias("paths_c"))
        nodes = children.groupBy(*node).agg(F.sum("labelled_c").alias("labelled_p"), F.sum("good_c").alias("good_p"), F.count("*").alias("branches"), F.sum("paths_c").alias("paths"))
        rest, pooled = F.col("labelled_p") - F.col("labelled_c"), F.try_divide("good_p", "labelled_p")
        own, others = F.try_divide("good_c", "labelled_c"), F.try_divide(F.col("good_p") - F.col("good_c"), rest)
        spread = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1), "labelled_c") + F.try_divide(F.lit(1), rest)))
        differs = (pooled > 0) & (pooled < 1) & (F.abs(own - others) > z * spread)  # null where either side has no label
        told = children.join(anew(nodes), node).withColumns({"differs": F.coalesce(differs, F.lit(False)), "cell": F.least(F.floor(own * CELLS), F.lit(CELLS - 1)).cast("int")})
        told = written(told.select(*node, "step", "labelled_c", "good_c", "branches", "paths", "differs", "cell"), "url-tree")
        cells = told.where("differs").groupBy(*node, "cell").agg(*(F.sum(c + "_c").alias(c) for c in ("labelled", "good")), F.count("*").alias("branches"))
        entry = F.struct(F.col("cell").alias("low"), F.col("cell").alias("high"), "labelled", "good", "branches")
        classes = cells.groupBy(*node).agg(F.array_sort(F.collect_list(entry)).alias("cells")).select(*node, merged(F.col("cells"), z).alias("classes"))
        in_class = F.filter("classes", lambda c: (c["low"] <= F.col("cell")) & (F.col("cell") <= c["high"]))
        number = F.array_position(F.transform("classes", lambda c: c["low"]), F.get(in_class, F.lit(0))["low"])
        name = F.when((F.col("branches") == 1) | F.col("differs") & (F.get(in_class, F.lit(0))["branches"] == 1), F.col("step")).when(F.col("differs"), F.concat(F.lit("*"), number.cast("string"))).otherwise("*")
        named = told.join(anew(classes), node, "left").select(*node, "step", (F.col("paths") == 1).alias("alone"), name.alias("branch"))
        further = F.concat("template", F.lit("/"), F.when(F.col("alone"), F.array_join(F.slice("shape", len(levels) + 1, F.size("shape")), "/")).otherwise(F.col("branch")))
        gone_on = left.join(named, [*node, "step"]).withColumns({"template": further, "done": F.col("alone") | (F.size("shape") == len(levels) + 1)})
        levels.append(scratch(spark, "url-tree"))
        gone_on.select(*base.columns).write.parquet(levels[-1])
        left = spark.read.schema(base.schema).parquet(levels[-1]).where(~F.col("done"))
    base = spark.read.schema(base.schema).parquet(*levels).where("done")
    total = base.agg(*sums("")).first()
    prior = total.good / total.labelled if total.labelled else 1.0
    hosts = base.groupBy("host").agg(*sums("_h"))
    templates = base.groupBy(*node).agg(F.sum("n").alias("n"), *sums(""))
    host_purity = (F.col("good_h") + smoothing * prior) / (F.col("labelled_h") + smoothing)
    templates = templates.join(anew(hosts), "host").withColumn("purity", (F.col("good") + smoothing * host_purity) / (F.col("labelled") + smoothing))
    return base.select("host", "path_key", "template").join(anew(templates).select(*node, "n", "labelled", "good", "purity", F.lit(prior).alias("prior")), node)


def judged(pages: DataFrame, labels: DataFrame, rules=RULES, min_purity: float = 0.7, z: float = 2.58, smoothing: float = 10.0) -> DataFrame:
    """pages (url and others) plus host, path, rule, verdict, template and purity.

    labels (label_key, label): label_key is the last number in a url's path, that is the id
    of the document a page shows.
    """
    located = pages.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    located = located.withColumn("_shape", F.concat_ws("/", shape_of(F.col("path"))))
    numbered = located.select("host", "path", F.expr(r"try_cast(nullif(regexp_extract(path, '([0-9]+)[^0-9/]*/?$', 1), '') as bigint)").alias("label_key"))
    one_each = labels.where("label_key is not null and label is not null").groupBy("label_key").agg(F.min("label").alias("label"))
    templates = tree(numbered.join(one_each, "label_key", "left").select("host", "path", "label"), z, smoothing)
    out = located.join(templates.select("host", F.col("path_key").alias("_shape"), "template", "purity"), ["host", "_shape"], "left")
    learned = F.when(F.col("purity") < min_purity, "block").otherwise("allow")
    fitting = rule_of(F.col("host"), F.col("path"), rules)
    return out.withColumn("_rule", fitting).withColumns({"rule": F.col("_rule.rule"), "verdict": F.coalesce(F.col("_rule.verdict"), learned)}).drop("_rule", "_shape")


def query(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("label_key"), F.col("quality").alias("label"))
    return judged(pages, labels).select("page_id", "host", "path", "rule", "verdict", "template", "purity")
