"""URL filters: rules, then link-graph propagation, with DataFrame functions only.

Rules of (verdict, host, path) decide the urls they fit: the host or a subdomain of it, with a path that starts
with theirs; the longest wins. For the rest the link graph decides. Host edges are the absolute links of the pages'
html. A host whose ruled pages are allowed by a majority of SEED_MAJORITY is a trusted seed, one whose are blocked
by as much a blocked seed. Trust is a personalised PageRank from the trusted seeds along the edges; distrust is one
from the blocked seeds against them, so a host that links to blocked hosts is distrusted. A host is blocked if its
distrust reaches BLOCK_AT and exceeds its trust. A full seed alone has 1 - DAMPING of its own kind.

Defined cases: a url that is null or has no `://` has an empty host and path, fits no rule and is allowed, and its
page is no part of the graph; null html has no links; equal links count once each page; repeated rows are judged
alike; ties of trust and distrust are allowed; empty tables give no rows; texts of any length are read whole; columns
other than page_id, url and html, whatever their names, play no part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.shared import written

ALLOW, BLOCK = "allow", "block"
DAMPING = 0.85
ROUNDS = 12
#: Rounds after which scores are written, so that plans stay short and lost executors cost little.
WRITE_EVERY = 4
SEED_MAJORITY = 2 / 3
BLOCK_AT = 0.05
MOST_RULES = 1000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK = r"""(?i)\b(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def winning_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """struct<rule, verdict> of the longest rule that fits, nulls if none does. Equally long ones go by their text."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules: they are compiled into one expression")
    none = F.struct(F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    chosen = none
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        chosen = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def host_edges(pages: DataFrame) -> DataFrame:
    """source, target, pages: how many pages of a host link to another. Links within a host are left out."""
    host, _ = host_and_path(F.col("url"))
    links = F.array_distinct(F.regexp_extract_all(F.col("html"), F.lit(_LINK), F.lit(1)))
    return (
        pages.select(host.alias("source"), F.explode(links).alias("target"))
        .select("source", lower_ascii(F.col("target")).alias("target"))
        .where("source <> '' and target <> '' and source <> target")
        .groupBy("source", "target")
        .agg(F.count("*").alias("pages"))
    )


def seeds(judged: DataFrame) -> DataFrame:
    """kind (allow or block), host, weight of the hosts with ruled pages; weights from 0 to 1."""
    return (
        judged.where("verdict is not null")
        .groupBy("host")
        .agg(F.avg((F.col("verdict") == ALLOW).cast("double")).alias("allowed"))
        .where((F.col("allowed") >= SEED_MAJORITY) | (1 - F.col("allowed") >= SEED_MAJORITY))
        .select(
            F.when(F.col("allowed") > 0.5, ALLOW).otherwise(BLOCK).alias("kind"),
            "host",
            F.abs(2 * F.col("allowed") - 1).alias("weight"),
        )
    )


def propagated(start: DataFrame, edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """kind, host, score: personalised PageRank from the seeds, trust along the edges and distrust against them.

    Both kinds run in one table. What a host without a way on holds isn't passed on."""
    start, edges = written(start, "seeds"), written(edges, "host-edges")
    scores = start.select("kind", "host", ((1 - DAMPING) * F.col("weight")).alias("score"))
    if edges.isEmpty():
        return scores
    out = edges.groupBy("source").agg(F.sum("pages").alias("total")).withColumnRenamed("source", "giver")
    into = edges.groupBy("target").agg(F.sum("pages").alias("total")).withColumnRenamed("target", "giver")
    along = edges.select(F.lit(ALLOW).alias("kind"), F.col("source").alias("giver"), F.col("target").alias("taker"), "pages")
    against = edges.select(F.lit(BLOCK).alias("kind"), F.col("target").alias("giver"), F.col("source").alias("taker"), "pages")
    ways = along.join(out, "giver").unionByName(against.join(into, "giver"))
    ways = written(ways.select("kind", "giver", "taker", (DAMPING * F.col("pages") / F.col("total")).alias("share")), "ways")
    base = scores
    for i in range(1, rounds + 1):
        given = ways.join(scores.withColumnRenamed("host", "giver"), ["kind", "giver"])
        given = given.select("kind", F.col("taker").alias("host"), (F.col("score") * F.col("share")).alias("score"))
        scores = given.unionByName(base).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        if i % WRITE_EVERY == 0 and i < rounds:
            scores = written(scores, "scores")
    return scores


def blocked_hosts(scores: DataFrame) -> DataFrame:
    """host, trust, distrust of the blocked hosts."""
    trust = F.sum(F.when(F.col("kind") == ALLOW, F.col("score")).otherwise(0.0))
    distrust = F.sum(F.when(F.col("kind") == BLOCK, F.col("score")).otherwise(0.0))
    return (
        scores.groupBy("host")
        .agg(trust.alias("trust"), distrust.alias("distrust"))
        .where((F.col("distrust") >= BLOCK_AT) & (F.col("distrust") > F.col("trust")))
    )


def judged_pages(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """page_id, host, path, rule, verdict, and decided_by (rule or graph)."""
    host, path = host_and_path(F.col("url"))
    ruled = pages.select("page_id", host.alias("host"), path.alias("path"))
    ruled = ruled.withColumn("_won", winning_rule(F.col("host"), F.col("path"), rules))
    ruled = ruled.select("page_id", "host", "path", F.col("_won.rule").alias("rule"), F.col("_won.verdict").alias("verdict"))
    blocked = blocked_hosts(propagated(seeds(ruled), host_edges(pages))).select("host", F.lit(BLOCK).alias("_method"))
    return ruled.join(blocked, "host", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("verdict", "_method", F.lit(ALLOW)).alias("verdict"),
        F.when(F.col("rule").isNotNull(), "rule").otherwise("graph").alias("decided_by"),
    )
