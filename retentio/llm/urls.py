"""URL filters: rules, and trust spread over the graph of hosts.

A url's host and path are parsed, and the longest rule that fits decides.
Urls without a rule get their host's verdict: personalised PageRank spreads
trust from hosts with allowed pages along links, and distrust from hosts with
blocked pages against them (who links to a bad host is suspect).  Hosts link
where a page of one has an absolute link to the other, and every host and its
parent domain link both ways.  A host is blocked where its distrust exceeds its
trust by more than ``margin``; hosts that neither reaches are allowed.

Everything is DataFrame code over the table of host edges, which is summed
map-side before it is shuffled, so a host with a third of all pages is one row
a task.  Rounds are cut by checkpoints.

Null urls and urls without ``://`` have an empty host and path; the empty host
has no links and is allowed.  Null pages have no links.  Repeated rows are
judged each and count in their host's weights.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DAMPING = 0.85
#: Share of the seeds' mass that may be left to spread at the end.
TOLERANCE = 1e-5
#: Rounds that are added up together, after which the mass left is looked at.
SUM_EVERY = 8
#: Links of one part of the tables that the rounds read and write.
LINKS_A_PART = 200_000
#: Share of trust and distrust within which they count as equal.
EQUAL = 1e-9
MARGIN = 0.0
#: Host and path of absolute links in a page.
LINK = r"""(?i)href\s*=\s*["']?https?://([^/"'?#\s>]+)"""


@dataclass(frozen=True)
class Rule:
    """Host (and its subdomains) and the start of the path."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The stated rules.
RULES = (Rule("org", "/", "allow"), Rule("example.org", "/es/", "block"), Rule("example.org", "/en/1", "block"),
         Rule("com", "/fr/", "allow"), Rule("com", "/de/", "block"))


def _rest(url: Column) -> Column:
    at = F.instr(F.coalesce(url, F.lit("")), "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """(text, verdict) of the longest fitting rule, null without one."""
    out = F.lit(None).cast("struct<text:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        out = F.when(fits, F.struct(F.lit(r.text).alias("text"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, w) links between different hosts; pages has host and html."""
    links = (pages.select("host", F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)))).alias("dst"))
             .select(F.col("host").alias("src"), F.translate("dst", UPPER, LOWER).alias("dst")))
    links = links.where("src <> '' and dst <> '' and src <> dst").groupBy("src", "dst").agg(F.count("*").alias("w"))
    names = pages.select("host").unionByName(links.select(F.col("dst").alias("host"))).distinct()
    # a.b.example.org: b.example.org, then example.org
    parts = F.split("host", r"\.")
    ups = names.select(F.explode(F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(parts) - 3, F.lit(-1))), lambda k: F.struct(
            F.array_join(F.slice(parts, k + 1, F.size(parts)), ".").alias("c"),
            F.array_join(F.slice(parts, k + 2, F.size(parts)), ".").alias("p")))).alias("x"), F.size(parts).alias("n"))
    ups = ups.where("n >= 3").select("x.c", "x.p").distinct()
    both = ups.select(F.col("c").alias("src"), F.col("p").alias("dst")).unionByName(
        ups.select(F.col("p").alias("src"), F.col("c").alias("dst"))).withColumn("w", F.lit(1).cast("long"))
    return links.unionByName(both).groupBy("src", "dst").agg(F.sum("w").alias("w"))


def pagerank(edges: DataFrame, seeds: DataFrame, *, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """Personalised PageRank per kind: (kind, host, rank).

    ``edges``: (kind, src, dst, w); ``seeds``: (kind, host, s).  The seeds' mass is spread along the
    links round by round, losing ``1 - damping`` of it each time and all of it at hosts without
    links, until the mass still under way is under ``tolerance`` of the seeds'.  Ranks are
    proportional to the seeds at any scale: nothing is rounded.
    """
    out = edges.groupBy("kind", "src").agg(F.sum("w").alias("total"))
    step = cut(edges.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("w") / F.col("total")).alias("p")))
    moved = cut(seeds.select("kind", "host", ((1 - damping) * F.col("s")).alias("rank")))
    first = moved.agg(F.sum("rank")).first()[0] or 0.0
    # A round's table has as many parts as the links fill: many rounds of tiny files would cost more than their rows.
    parts = max(1, -(-step.count() // LINKS_A_PART))
    # Links that fill one part only lie together, so a round needs no shuffle; others are dealt out by source once.
    step = cut(step.coalesce(1) if parts == 1 else step.repartition(parts, "kind", "src"))
    moved = cut(moved.coalesce(parts))
    rank, rounds = moved, []
    while True:
        # Every round is written, so no plan grows with the number of rounds.
        moved = cut(step.join(moved.withColumnRenamed("host", "src"), ["kind", "src"])
                    .groupBy("kind", F.col("dst").alias("host")).agg(F.sum(damping * F.col("p") * F.col("rank")).alias("rank")).coalesce(parts))
        rounds.append(moved)
        if len(rounds) == SUM_EVERY:
            for part in rounds:
                rank = rank.unionByName(part)
            rank, rounds = cut(rank.groupBy("kind", "host").agg(F.sum("rank").alias("rank")).coalesce(parts)), []
            if (moved.agg(F.sum("rank")).first()[0] or 0.0) <= tolerance * first:
                return rank


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, *, margin: float = MARGIN, id_col: str = "page_id",
          url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col``, host, path, rule, verdict, trust, distrust of every row."""
    url = F.col(url_col).cast("string")
    q = pages.select(F.col(id_col).alias("id"), host(url).alias("host"), path(url).alias("path"), F.col(html_col).cast("string").alias("html"))
    ruled = q.withColumn("r", matching_rule(F.col("host"), F.col("path"), rules))
    share = lambda v: F.sum((F.coalesce(F.col("r.verdict"), F.lit("")) == v).cast("long")) / F.count("*")
    counted = cut(ruled.where("host <> ''").groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust")))
    total = counted.agg(F.sum("trust").alias("t"), F.sum("distrust").alias("d")).first()
    seeds = counted.select(F.lit("trust").alias("kind"), "host", (F.col("trust") / F.lit(float(total.t or 1))).alias("s")).unionByName(
        counted.select(F.lit("distrust").alias("kind"), "host", (F.col("distrust") / F.lit(float(total.d or 1))).alias("s"))).where("s > 0")
    edges = cut(host_edges(q.select("host", "html")))
    kinds = edges.withColumn("kind", F.lit("trust")).unionByName(
        edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w").withColumn("kind", F.lit("distrust")))
    rank = pagerank(kinds, seeds).groupBy("host").agg(
        *[F.sum(F.when(F.col("kind") == k, F.col("rank")).otherwise(0.0)).alias(k) for k in ("trust", "distrust")])
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0)).alias(c)
    out = ruled.drop("html").join(rank.withColumnRenamed("host", "_host"), F.col("host") == F.col("_host"), "left")
    out = out.select("id", "host", "path", "r", zero("trust"), zero("distrust"))
    more = F.col("distrust") - F.col("trust")
    method = F.when((more > margin) & (more > EQUAL * (F.col("distrust") + F.col("trust"))), F.lit("block")).otherwise(F.lit("allow"))
    return out.select(F.col("id").alias(id_col), "host", "path", F.col("r.text").alias("rule"),
                      F.coalesce(F.col("r.verdict"), method).alias("verdict"), "trust", "distrust")
