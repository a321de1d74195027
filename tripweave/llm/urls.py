"""URL filters: rules, and trust and distrust that spread over links between hosts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, free_name

DAMPING = 0.85
#: Propagation goes on until what is still under way can change no host's mass by more.
LEAST_CHANGE = 1e-10
_AT_ONCE = 4  # rounds between two checkpoints
#: A host is blocked if its distrust exceeds its trust by so much.
LEAST_DISTRUST = 0.5

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LINK = r"""(?i)(?:href|src)\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)"""

Rule = tuple[str, str]  # host and path, like example.com/de/, and allow or block


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?`` or ``#``, A-Z lower-cased; empty without ``://``."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    """After the host up to ``?`` or ``#``; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """(rule, verdict) of the longest rule that fits, else null.

    A rule fits its host and all its subdomains, where the path starts with the rule's.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: len(r[0])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        found = F.when(
            fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        ).otherwise(found)
    return found


def _named(df: DataFrame, rules: Sequence[Rule], found: str = "found") -> DataFrame:
    """host, path and rule beside the other columns, each computed once."""
    held = df.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    return held.withColumn(found, rule_for(F.col("host"), F.col("path"), rules))


def propagate(
    seeds: DataFrame, edges: DataFrame, least_change: float = LEAST_CHANGE, damping: float = DAMPING
) -> DataFrame:
    """(host, kind, mass): personalised PageRank of trust along edges and of distrust against them.

    ``seeds`` has (host, kind, mass) with kind trust or distrust, ``edges`` distinct (source,
    target).  mass = seed + damping * what neighbours pass on, each in equal parts; it is not scaled
    to a sum of 1, so a host's mass does not depend on how many others there are.  Only hosts that
    are reached have rows.  A round is a join on the passing host, which adaptive execution may split
    where one host has very many links, and a sum that is combined before the shuffle.

    A round passes on what the last one added.  All that is under way, together, shrinks by
    ``damping`` a round at least, so with a sum of s under way no host can still gain more than
    s * damping / (1 - damping); rounds end when that is at most ``least_change``.  That takes
    log(seeds / least_change) / log(1 / damping) rounds and some (about 230 for a million seeds),
    fewer where links lead nowhere.  The rounds run while the query is built.
    """
    arcs = edges.select(
        F.inline(F.array(
            F.struct(F.lit("trust").alias("kind"), F.col("source").alias("host"), F.col("target").alias("to")),
            F.struct(F.lit("distrust").alias("kind"), F.col("target").alias("host"), F.col("source").alias("to")),
        ))
    )
    degree = arcs.groupBy("kind", "host").agg(F.count(F.lit(1)).alias("degree"))
    arcs = cut(arcs.join(degree, ["kind", "host"]).select(
        "kind", "host", "to", (F.lit(damping) / F.col("degree")).alias("part")
    ))
    state = cut(seeds.select("host", "kind", "mass", F.col("mass").alias("added")))
    while True:
        under_way = state.agg(F.sum("added")).first()[0] or 0.0
        if under_way * damping / (1 - damping) <= least_change:
            return state.select("host", "kind", "mass")
        added, parts = state.where("added > 0").select("host", "kind", "added"), []
        for _ in range(_AT_ONCE):
            added = arcs.join(added, ["kind", "host"]).groupBy(F.col("to").alias("host"), "kind").agg(
                F.sum(F.col("part") * F.col("added")).alias("added")
            )
            parts.append(added.withColumn("mass", F.col("added")))
        before = [p.withColumn("added", F.lit(0.0)) for p in [state, *parts[:-1]]]
        state = cut(
            reduce(DataFrame.unionByName, [*before, parts[-1]]).groupBy("host", "kind")
            .agg(F.sum("mass").alias("mass"), F.sum("added").alias("added"))
        )


def links_of(pages: DataFrame) -> DataFrame:
    """(source, url) of the absolute links in the pages; relative ones stay on their host."""
    return pages.select(
        host_of(F.col("url")).alias("source"),
        F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(_LINK), F.lit(1))).alias("link"),
    ).select(
        "source",
        F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), "link"))
        .otherwise(F.col("link")).alias("url"),
    )


def host_scores(pages: DataFrame, rules: Sequence[Rule], **options) -> DataFrame:
    """(host, trust, distrust) of all hosts that rules or links give any.

    A host's seed of trust is the share of its known urls (of pages and links) that a rule allows,
    its seed of distrust the share that a rule blocks.
    """
    links = links_of(pages.select("url", "html"))
    counted = cut(
        pages.select(F.lit(None).cast("string").alias("source"), "url").unionByName(links)
        .transform(_named, rules)
        .groupBy("source", "host").agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("found.verdict") == "allow").alias("allow"),
            F.count_if(F.col("found.verdict") == "block").alias("block"),
        ).where("host != ''")
    )
    shares = counted.groupBy("host").agg(
        (F.sum("allow") / F.sum("n")).alias("trust"), (F.sum("block") / F.sum("n")).alias("distrust")
    )
    seeds = shares.select("host", F.inline(F.array(*[
        F.struct(F.lit(k).alias("kind"), F.col(k).alias("mass")) for k in ("trust", "distrust")
    ]))).where("mass > 0")
    edges = counted.where("source != '' and source != host").select(
        "source", F.col("host").alias("target")
    )
    mass = propagate(seeds, edges, **options)
    return mass.groupBy("host").agg(*[
        F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("mass"))), F.lit(0.0)).alias(k)
        for k in ("trust", "distrust")
    ])


def judge(
    pages: DataFrame, rules: Sequence[Rule], least_distrust: float = LEAST_DISTRUST, **options
) -> DataFrame:
    """The pages with host, path, rule, verdict (allow or block), trust and distrust of the host.

    The longest rule that fits a url decides; without one the host is blocked if its distrust
    exceeds its trust by ``least_distrust`` (compared to nine decimals, as sums of doubles depend on
    their order in the last ones).  Null urls and urls without ``://`` have an empty host and path
    and are allowed.  Rows of equal or null ids are judged each for itself; columns of ``pages``
    named as the new ones are replaced, html is read but not returned.
    """
    new = ["host", "path", "rule", "verdict", "trust", "distrust"]
    kept = [c for c in pages.columns if c not in new and c != "html"]
    found, other = free_name(pages, "found"), free_name(pages, "scored_host")
    scores = host_scores(pages, rules, **options).withColumnRenamed("host", other)
    joined = _named(pages.select(*kept), rules, found).join(
        scores, F.col("host") == F.col(other), "left"
    )
    trust, distrust = (F.coalesce(c, F.lit(0.0)) for c in ("trust", "distrust"))
    blocked = F.round(distrust - trust, 9) >= least_distrust
    return joined.select(
        *kept, "host", "path", F.col(f"{found}.rule").alias("rule"),
        F.coalesce(f"{found}.verdict", F.when(blocked, "block").otherwise("allow")).alias("verdict"),
        trust.alias("trust"), distrust.alias("distrust"),
    )
