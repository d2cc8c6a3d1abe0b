"""URL filtering by association rules, in DataFrame operations only.

A few seed rules of host and path label the URLs they fit. FP-growth mines which token combinations of labelled URLs go with
which label, the tokens that the seed rule itself names left out, so that what is learnt isn't the seed rule again. Rules
with enough support and confidence judge the other URLs; they are found by an inverted index on each rule's rarest token.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.sources.tables import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$"
PIECE = r"([^\x00-/:-@\[-`{-\x7f]+)"  # letters, digits and all beyond ASCII
KEY = r"[?&]([^=&]+)"
SUPPORT = 0.01
CONFIDENCE = 90
RULES = "anchor string, tokens array<string>, verdict string, n long, n_both long, items int"


def url_part(url: Column, group: int) -> Column:
    """1: host in lower case (A-Z), 2: path, 3: query, 4: fragment; empty for a null URL or one without ``://``."""
    part = F.coalesce(F.regexp_extract(url, PARTS, group), F.lit(""))
    return F.translate(part, UPPER, LOWER) if group == 1 else part


def fitting_rule(host: Column, path: Column, seeds: Sequence[tuple[str, str]]) -> Column:
    """The longest of the seed rules (verdict, ``host/path``) that fits, as a struct; null if none does.

    A rule fits its host and all subdomains of it, if the path starts with the rule's. Seeds are a short list.
    """
    split = [(rule.split("/", 1)[0], "/" + rule.split("/", 1)[1], rule, verdict) for verdict, rule in seeds]
    rules = F.array(*[
        F.struct(F.lit(len(r)).alias("size"), F.lit(r).alias("rule"), F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path"))
        for h, p, r, v in split
    ])
    fits = lambda r: ((host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"]))) & F.startswith(path, r["path"])
    return F.array_max(F.filter(rules, fits))


def url_tokens(host: Column, path: Column, query: Column, fragment: Column) -> Column:
    """Distinct tokens: labels of the host, pieces of path and fragment, keys of the query. Numbers are alike."""
    low = lambda c: F.translate(c, UPPER, LOWER)
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    pieces = lambda c: F.transform(F.regexp_extract_all(low(c), F.lit(PIECE), 1), lambda x: F.when(x.rlike("^[0-9]+$"), "#").otherwise(x))
    named = lambda kind, xs: F.transform(xs, lambda x: F.concat(F.lit(kind), x))
    return F.array_distinct(F.concat(
        named("h:", labels), named("p:", pieces(path)), named("q:", F.regexp_extract_all(low(query), F.lit(KEY), 1)), named("f:", pieces(fragment))
    ))


def parse_urls(pages: DataFrame, seeds: Sequence[tuple[str, str]]) -> DataFrame:
    """Every row with ``host``, ``path``, the seed rule's ``rule`` and ``verdict``, its ``tokens`` and, where a seed rule
    fits, ``others``: the tokens but the host labels that any seed names and the path that this seed names. ``row`` tells
    repeated rows apart. Only ``page_id`` and ``url`` are read."""
    url = F.col("url").cast("string")
    parts = pages.select("page_id", *[url_part(url, i).alias(c) for i, c in enumerate(("host", "path", "query", "fragment"), 1)])
    seeded = parts.withColumn("seed", fitting_rule(F.col("host"), F.col("path"), seeds)).withColumn("row", F.monotonically_increasing_id())
    tokens = lambda host, path: url_tokens(host, path, F.col("query"), F.col("fragment"))
    labels = sorted({f"h:{x}" for _, rule in seeds for x in rule.split("/", 1)[0].split(".")})
    path = F.expr("substring(path, length(seed.path) + 1)")
    out = seeded.select(
        "row", "page_id", "host", "path", F.col("seed.rule").alias("rule"), F.col("seed.verdict").alias("verdict"),
        tokens(F.col("host"), F.col("path")).alias("tokens"), F.when(F.col("seed").isNotNull(), F.array_except(tokens(F.col("host"), path), F.array(*map(F.lit, labels)))).alias("others"),
    )
    return cut(out)


def mine_rules(labelled: DataFrame, support: float = SUPPORT, confidence: int = CONFIDENCE) -> DataFrame:
    """Rules (``tokens`` to ``verdict``) from rows ``row``, ``others`` and ``verdict``, stored.

    ``n`` rows have all the tokens, ``n_both`` of them have the verdict: at least ``support`` of all labelled rows, at
    least ``confidence`` percent of ``n``, and a larger share than among all rows. A rule is dropped if it holds one token
    less with the same verdict and no less confidence. Tokens of exactly the same rows are one item, and tokens of all
    rows none, since they change no count; so a long URL that repeats doesn't make every subset of its tokens an itemset.
    Frequent tokens are at most the mean number of tokens divided by ``support``. Ties, nulls: rows without tokens only count.
    """
    spark = labelled.sparkSession
    sizes = {r["verdict"]: r["n"] for r in labelled.groupBy("verdict").agg(F.count("*").alias("n")).collect()}  # one row a verdict
    total = sum(sizes.values())
    if not total:
        return spark.createDataFrame([], RULES)
    least = max(1, -int(-support * total // 1))
    single = labelled.select("row", "verdict", F.explode("others").alias("token"))
    digest = F.xxhash64("row", F.lit("url"))
    counts = single.groupBy("token").agg(F.count("*").alias("n"), F.bit_xor(digest).alias("x"), F.sum(digest.cast("decimal(38,0)")).alias("s"))
    classes = counts.filter((F.col("n") >= least) & (F.col("n") < total)).groupBy("n", "x", "s").agg(
        F.array_sort(F.collect_list("token")).alias("members")
    )
    items = cut(classes.select(F.get("members", 0).alias("token"), "members", "n"))
    baskets = single.join(items.select("token"), "token").groupBy("row").agg(F.collect_list("token").alias("items"), F.first("verdict").alias("verdict"))
    label = F.concat(F.lit("="), "verdict")
    baskets = cut(baskets.select(F.array_append("items", label).alias("items")))
    count = baskets.count()
    if not count:
        return spark.createDataFrame([], RULES)
    sets = cut(FPGrowth(minSupport=max(0.0, (least - 0.5) / count), itemsCol="items").fit(baskets).freqItemsets)
    names = F.array(*[F.lit(f"={v}") for v in sizes])
    split = sets.select(F.array_sort(F.array_except("items", names)).alias("items"), F.get(F.array_intersect("items", names), 0).alias("label"), "freq")
    whole = split.filter("label IS NULL").select("items", F.col("freq").alias("n"))
    both = split.filter("label IS NOT NULL AND size(items) > 0").select("items", F.expr("substring(label, 2)").alias("verdict"), F.col("freq").alias("n_both"))
    share = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair])
    sure = (F.col("n_both") * 100 >= F.col("n") * confidence) & (F.col("n_both") * total > F.col("n") * share[F.col("verdict")])
    rules = cut(both.join(whole, "items").filter(sure))
    less = rules.select(F.col("items").alias("part"), "verdict", F.col("n").alias("part_n"), F.col("n_both").alias("part_both"))
    parts = rules.withColumn("part", F.explode(F.transform("items", lambda x: F.array_remove("items", x))))
    weak = parts.join(less, ["part", "verdict"]).filter(F.col("part_both") * F.col("n") >= F.col("n_both") * F.col("part_n"))
    kept = rules.join(weak.select("items", "verdict").distinct(), ["items", "verdict"], "left_anti")
    each = kept.select("*", F.explode("items").alias("token")).join(items.select("token", "members", F.col("n").alias("size")), "token")
    return cut(each.groupBy("items", "verdict", "n", "n_both").agg(
        F.min(F.struct("size", "token"))["token"].alias("anchor"), F.array_sort(F.flatten(F.collect_list("members"))).alias("tokens")
    ).select("anchor", "tokens", "verdict", "n", "n_both", F.size("items").alias("items")))


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """For each of the rows (``row``, ``tokens``) that has all tokens of some rule, the best rule's ``verdict``, its share
    ``confidence`` and tokens ``mined``: most confident, then fewer items, then more rows, then block before allow."""
    found = urls.select("row", "tokens", F.explode("tokens").alias("anchor")).join(rules.withColumnRenamed("tokens", "needed"), "anchor")
    found = found.filter(F.size(F.array_except("needed", "tokens")) == 0)
    order = F.struct((F.col("n_both") / F.col("n")).alias("confidence"), (-F.col("items")).alias("items"), "n_both", "verdict", F.array_join("needed", " ").alias("mined"))
    best = found.groupBy("row").agg(F.max(order).alias("best"))
    return best.select("row", "best.verdict", "best.confidence", "best.mined")


def judge_urls(
    pages: DataFrame, seeds: Sequence[tuple[str, str]], support: float = SUPPORT, confidence: int = CONFIDENCE, default: str = "allow"
) -> DataFrame:
    """One row per row of ``pages``: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``confidence``, ``mined``.

    The longest fitting seed rule decides; else the best mined rule; else ``default``. ``page_id`` may be null or repeat,
    repeated URLs get the same verdict, a null URL or one without ``://`` has an empty host and path and no tokens; other
    columns aren't read; no pages give no rows. ``rule`` is null where no seed rule fits, ``confidence`` and ``mined``
    where no mined rule decided.
    """
    urls = parse_urls(pages, seeds)
    rules = mine_rules(urls.filter("rule IS NOT NULL"), support, confidence)
    found = match_rules(urls.filter("rule IS NULL"), rules).withColumnRenamed("verdict", "learnt")
    out = urls.join(found, "row", "left")
    verdict = F.coalesce("verdict", "learnt", F.lit(default)).alias("verdict")
    return out.select("page_id", "host", "path", "rule", verdict, "confidence", "mined")
