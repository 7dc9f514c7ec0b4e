"""URL filters: rules, and trust that spreads over the link graph between hosts.

Personalised PageRank starts from hosts with allowed pages; distrust starts from hosts with blocked pages
and runs against the links (a page that links to blocked ones is suspect). A host's weight as a start is the share of its pages. Hosts and links are small
beside pages: pages are reduced to distinct host links with map-side combine before anything iterates.
Scores are in units of one seed all of whose pages are allowed, or blocked, so the threshold means the same in a graph of any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.plans.common import checkpointed, join_checked

#: Fixed values of the op9 contract: verdict, host, path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
DAMPING = 0.85
#: Scores are settled when a step adds less than this to all of them together; each is then within 0.006 of its limit.
TOLERANCE = 1e-3
#: Where a host is blocked: its trust less its distrust, in units of one whole seed.
THRESHOLD = -0.1
AZ, az = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ://, up to / ? # or the end, A-Z lower-cased; empty for null and where there is no ://."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), AZ, az), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host, up to ? # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """hosts (host) with fits: the rules of the host and its parent domains, longest first.

    Each host is dealt to its suffixes and meets the rules there in an equi-join, so the rules can be as
    many as wanted; a host's own list has the rules of its few suffixes only. Of rules as long, block goes first.
    """
    parts = F.split("host", r"\.")
    suffix = F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), ".")))
    fit = hosts.select("host", suffix.alias("rule_host")).join(rules, "rule_host")
    entry = F.struct((-F.length(F.concat("rule_host", "rule_path"))).alias("o"), (F.col("rule_verdict") != "block").alias("a"), "rule_host", "rule_path", "rule_verdict")
    lists = fit.groupBy("host").agg(F.array_sort(F.collect_list(entry)).alias("fits"))
    return hosts.join(lists, "host", "left")


def spread(nodes: DataFrame, edges: DataFrame, seeds: DataFrame, tolerance: float = TOLERANCE, damping: float = DAMPING) -> DataFrame:
    """(host, trust, distrust): what comes of seeds (host, trust, distrust) along edges (src, dst), distinct ones.

    Personalised PageRank in units of one whole seed: a seed starts with its weight, and each step hands on `damping` of what came in the
    step before, in equal parts, trust along the links and distrust against them. What comes to a host without a way on ends there. So a host's
    scores follow from the seeds that reach it alone, and other hosts, linked or not, however many, don't move them. A step carries `damping` of the last one
    at most; steps go on until less than tolerance is handed on in all, so every score is within tolerance * damping / (1 - damping).
    Each step has one join and one grouping, in which a host's own row keeps its scores; lineage is cut in the shared folder at every fourth.
    """
    onward = edges.select(F.col("src").alias("a"), F.col("dst").alias("b"), F.lit(True).alias("with_links"))
    ways = onward.unionByName(edges.select(F.col("dst").alias("a"), F.col("src").alias("b"), F.lit(False).alias("with_links")))
    many = ways.groupBy("a", "with_links").agg(F.count(F.lit(1)).alias("n"))
    part = lambda with_links: F.when(F.col("with_links") == F.lit(with_links), damping / F.col("n")).otherwise(F.lit(0.0))
    shares = ways.join(many, ["a", "with_links"]).select("a", "b", part(True).alias("t"), part(False).alias("d"), F.lit(False).alias("own"))
    stays = nodes.select(F.col("host").alias("a"), F.col("host").alias("b"), F.lit(0.0).alias("t"), F.lit(0.0).alias("d"), F.lit(True).alias("own"))
    ways = checkpointed(shares.unionByName(stays))
    start = [F.coalesce(c, F.lit(0.0)) for c in ("trust", "distrust")]
    state = checkpointed(nodes.join(seeds, "host", "left").select("host", start[0].alias("trust"), start[1].alias("distrust"), start[0].alias("new_t"), start[1].alias("new_d")))
    while True:
        for _ in range(4):
            met = ways.join(state, F.col("a") == F.col("host"))
            kept = [F.sum(F.when(F.col("own"), F.col(c)).otherwise(F.lit(0.0))) for c in ("trust", "distrust")]
            came = [F.sum(F.col("t") * F.col("new_t")), F.sum(F.col("d") * F.col("new_d"))]
            state = met.groupBy(F.col("b").alias("host")).agg((kept[0] + came[0]).alias("trust"), (kept[1] + came[1]).alias("distrust"), came[0].alias("new_t"), came[1].alias("new_d"))
        state = checkpointed(state)
        if (state.agg(F.sum(F.col("new_t") + F.col("new_d"))).first()[0] or 0.0) < tolerance:
            return state.select("host", "trust", "distrust")


def host_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Distinct (src, dst) between different hosts from the pages' href and src attributes; //host/path is a link as well, others without :// stay on their host."""
    found = F.regexp_extract_all(F.col(html), F.lit(r"""(?i)(?:href|src)\s*=\s*["']?((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)"""), F.lit(1))
    links = pages.select(host_of(F.col(url)).alias("src"), F.explode(found).alias("to"))
    links = links.select("src", host_of(F.when(F.col("to").startswith("//"), F.concat(F.lit("http:"), "to")).otherwise(F.col("to"))).alias("dst"))
    return links.filter("src <> '' and dst <> '' and src <> dst").distinct()


def judge(pages: DataFrame, rules=RULES, key: str = "page_id", url: str = "url", html: str = "html", threshold: float = THRESHOLD) -> DataFrame:
    """One row for each page: key, host, path, rule, verdict, and the host's trust and distrust.

    The longest rule that fits decides. Else the host's score, trust less distrust in units of one whole seed, is held
    against the threshold: below it the page is blocked. Hosts that no seed reaches have score 0 and pass. Of rules as long that
    fit, block goes first. Null urls and those without :// have an empty host and path; pages of any length are read whole.
    Repeated pages get a row each; other columns, whatever their names, are not read; empty tables stay empty.
    """
    spark = pages.sparkSession
    listed = spark.createDataFrame([tuple(r) for r in rules], "rule_verdict string, rule_host string, rule_path string")
    narrow = pages.select(F.col(key).alias("__key"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    edges = checkpointed(host_links(pages, url, html))
    named = edges.select(F.col("dst").alias("host"))
    nodes = narrow.select("host").union(named).distinct()
    hosts = checkpointed(host_rules(nodes, listed))
    ruled = join_checked(narrow, hosts, "host", "left")
    first = F.element_at(F.filter("fits", lambda r: F.col("path").startswith(r["rule_path"])), 1)
    ruled = ruled.withColumn("__rule", F.when(F.size(F.filter("fits", lambda r: F.col("path").startswith(r["rule_path"]))) > 0, first))
    seeds = checkpointed(
        ruled.groupBy("host").agg(F.count(F.lit(1)).alias("pages"), F.count_if(F.col("__rule.rule_verdict") == "allow").alias("allowed"), F.count_if(F.col("__rule.rule_verdict") == "block").alias("blocked"))
    )
    share = [(F.col(c) / F.col("pages")).alias(name) for c, name in (("allowed", "trust"), ("blocked", "distrust"))]
    scores = spread(hosts.select("host"), edges, seeds.filter("allowed + blocked > 0").select("host", *share))
    judged = join_checked(ruled, scores, "host", "left")
    rule = F.concat("__rule.rule_host", "__rule.rule_path")
    by_graph = F.when(F.col("trust") - F.col("distrust") < threshold, "block").otherwise("allow")
    return judged.select(F.col("__key").alias(key), "host", "path", rule.alias("rule"), F.coalesce("__rule.rule_verdict", by_graph).alias("verdict"), "trust", "distrust")
