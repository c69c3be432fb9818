"""URL filter: host and path rules first, trust and distrust spread over the host graph for every other page.

Native: DataFrame and SQL functions only. Links are read from the pages' html,
reduced to distinct host edges with counts before anything is joined, and
personalised PageRank runs from two seed sets at once: trust flows along links
from hosts that allow rules fit, distrust flows against links from hosts that
block rules fit. Ranks run until every host that a flow can reach is reached
and no score grows by more than a millionth of itself. A host is blocked if
distrust makes up at least `threshold` of what reached it.

Defined cases: a null url, or one without `://`, has an empty host and path,
fits no rule and gets `unknown`; a host that neither flow reaches gets
`unknown`; null html has no links; repeated pages count as often as they occur;
urls and html of any length are read whole; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget, is_empty, store

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (action, host, path) of the production query.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without one."""
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def matched(rules: Sequence[tuple[str, str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """The longest fitting rule as text and its action; of equally long ones the smaller text. Rules are few and become one expression."""
    text = action = None
    for act, name, prefix in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(prefix))
        text = F.when(fits, name + prefix) if text is None else text.when(fits, name + prefix)
        action = F.when(fits, act) if action is None else action.when(fits, act)
    return (text, action) if text is not None else (F.lit(None).cast("string"), F.lit(None).cast("string"))


def host_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(src, dst, n): links between different hosts. Links without `://` or a leading `//` stay on their host and are left out."""
    found = pages.select(host_of(F.col(url)).alias("src"), F.regexp_extract_all(F.col(html), F.lit(r"(?i)(?:href|src)\s*=\s*[\"']?((?:[a-z][a-z0-9+.-]*:)?//[^\"'\s<>]+)"), F.lit(1)).alias("links"))
    links = found.where("size(links) > 0 and src <> ''").select("src", F.explode("links").alias("link"))
    full = F.when(F.startswith("link", F.lit("//")), F.concat(F.lit("http:"), "link")).otherwise(F.col("link")).alias("link")
    ends = links.select("src", full).select("src", host_of(F.col("link")).alias("dst"))
    return ends.where("dst <> '' and dst <> src").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def spread(edges: DataFrame, seeds: DataFrame, rounds: int | None = 12, damping: float = 0.85, tolerance: float = 0.0) -> DataFrame:
    """Personalised PageRank of several graphs at once.

    edges: (kind, src, dst, share), share the part of src's score that goes to dst;
    seeds: (kind, node, seed). Returns (kind, node, score) of all reached nodes.
    Without `rounds` it runs until no node is new and no score has grown by more
    than `tolerance` of itself, which every fourth round asks; scores only grow,
    so a new node counts as grown and a round more does no harm.
    """
    if rounds is None and tolerance <= 0:
        raise ValueError("without rounds a tolerance is needed")
    back = seeds.select("kind", "node", ((1 - damping) * F.col("seed")).alias("score"))
    score = store(back, "rank")
    for turn in itertools.count(1) if rounds is None else range(rounds):
        sent = edges.join(score.select("kind", F.col("node").alias("src"), "score"), ["kind", "src"]).select("kind", F.col("dst").alias("node"), (damping * F.col("score") * F.col("share")).alias("score"))
        parts = sent.unionByName(back).withColumn("_old", F.lit(0.0)).unionByName(score.select("kind", "node", F.lit(0.0).alias("score"), F.col("score").alias("_old")))
        new = store(parts.groupBy("kind", "node").agg(F.sum("score").alias("score"), F.max("_old").alias("_old")), "rank")
        settled = rounds is None and turn % 4 == 0 and is_empty(new.where(F.col("score") - F.col("_old") > tolerance * F.col("score")))
        forget(score)
        score = new
        if settled:
            break
    return score.select("kind", "node", "score")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, threshold: float = 0.5, unknown: str = "allow", page_id: str = "page_id", url: str = "url", html: str = "html", rounds: int | None = None, tolerance: float = 1e-6) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) for each page."""
    host, path = host_of(F.col(url)), path_of(F.col(url))
    ruled = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    text, action = matched(rules, F.col("host"), F.col("path"))
    ruled = ruled.select("page_id", "host", "path", text.alias("rule"), action.alias("_action"))

    counts = store(ruled.where("_action is not null and host <> ''").groupBy("host", "_action").agg(F.count(F.lit(1)).alias("n")), "seeds")
    kinds = counts.select(F.when(F.col("_action") == "allow", "trust").otherwise("distrust").alias("kind"), F.col("host").alias("node"), "n")
    totals = kinds.groupBy("kind").agg(F.sum("n").alias("total"))
    seeds = kinds.join(F.broadcast(totals), "kind").select("kind", "node", (F.col("n") / F.col("total")).alias("seed"))  # totals: two rows

    found = store(host_edges(pages, url, html), "edges")
    if is_empty(found):
        scores = store(seeds.select("kind", "node", F.col("seed").alias("score")), "rank")
    else:
        ways = found.select(F.lit("trust").alias("kind"), "src", "dst", "n").unionByName(found.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n"))
        out = ways.groupBy("kind", "src").agg(F.sum("n").alias("total"))
        edges = store(ways.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("n") / F.col("total")).alias("share")), "shares")
        scores = spread(edges, seeds, rounds, tolerance=tolerance)
        forget(edges)
    hosts = scores.groupBy("node").agg(F.sum(F.when(F.col("kind") == "trust", F.col("score"))).alias("trust"), F.sum(F.when(F.col("kind") == "distrust", F.col("score"))).alias("distrust"))
    hosts = hosts.select(F.col("node").alias("host"), F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
    judged = ruled.join(hosts, "host", "left")
    reached = F.col("trust") + F.col("distrust")
    method = F.when(reached > 0, F.when(F.col("distrust") >= threshold * reached, "block").otherwise("allow")).otherwise(unknown)
    return judged.select("page_id", "host", "path", "rule", F.coalesce("_action", method).alias("verdict"), F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
