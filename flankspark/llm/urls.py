"""URL filters: rules first, then trust and distrust carried over the links between hosts.

Hosts of urls that a rule allows are trusted seeds, hosts of blocked urls are blocked seeds. Trust is personalised PageRank from the trusted
seeds along the links; distrust runs from the blocked seeds against them, to those who link there. Links are absolute and
protocol-relative references in the pages, and each host's tie to the domain above it, both ways. On both sides a link's end is the
host's name without user and port. A seed weighs as many as its urls that a rule judges. What a host has not yet passed on is its
residue; a round passes on the residue of every host where it is over CHANGE of the host's rank, so each host settles by itself, at any
distance, and neither more rounds nor hosts that it isn't linked with change its rank. Rounds end when all have settled. A host whose trust
is at least half of its trust and distrust is allowed, as is one that neither reaches (as on pages without any link to a seed). Ranks fall
by DAMPING a link, so those beyond some 4000 links from every seed are zero in doubles.

Everything is built-in DataFrame functions. Links are counted for each pair of hosts before they are shuffled, so a hot host costs as many
rows as it has neighbours. The result of each round goes to the checkpoint folder.

Edge cases: a url that is null or has no ``://`` has an empty host and path, no rule, and verdict allow; empty hosts neither link nor
are linked; null pages have no links; repeated urls are judged alike and weigh as seeds by their number; an empty table gives an
empty result. Input columns pass through only if named in keep; those with the names of new columns give way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flankspark.llm.common import cut

#: (verdict, host, path), as the contract fixes them.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
DAMPING, SHARE = 0.85, 0.5
#: Rounds between two looks at whether all hosts have settled, and the part of a host's rank under which its residue stays where it is.
CHECKED, CHANGE = 5, 0.001
#: Links inside a domain weigh as many as so many references.
TIE = 1.0
#: Hosts whose verdicts, and links of hosts whose weights, are broadcast; more are joined by shuffle.
BROADCAST_HOSTS, BROADCAST_LINKS = 50_000, 50_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
REFERENCE = r"""(?i)href\s*=\s*["']?(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"'\s<>]+)"""


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def name_of(host: Column) -> Column:
    """The host without user and port: what links and pages have in common."""
    return F.regexp_replace(host, r"^.*@|:\d*$", "")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def by_rules(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null without one; a chain of tests, the longest first."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, on, under in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == on) | host.endswith(f".{on}")) & path.startswith(under)
        rule, verdict = F.when(fits, F.lit(on + under)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def host_links(pages: DataFrame, html: str) -> DataFrame:
    """(src, dst, w): counted links between different names of hosts, and ties to the domain above, both ways; pages has the name of each."""
    found = pages.where("name != ''").select("name", F.explode(F.array_distinct(F.regexp_extract_all(F.col(html), F.lit(REFERENCE), F.lit(1)))).alias("to"))
    named = found.select(F.col("name").alias("src"), name_of(F.translate("to", UPPER, LOWER)).alias("dst"))
    links = named.where("dst != '' and src != dst").groupBy("src", "dst").agg(F.count("*").cast("double").alias("w"))
    hosts = pages.select(F.col("name").alias("host")).distinct().unionByName(links.select(F.col("dst").alias("host"))).where("host != ''").distinct()
    # Every domain above a host, down to two labels.
    labels = F.split("host", "\\.")
    chain = F.transform(F.sequence(F.lit(1), F.size(labels) - 1), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    domains = hosts.where(F.size(labels) > 2).select(F.explode(chain).alias("low")).distinct()
    above = domains.select("low", F.regexp_replace("low", r"^[^.]*\.", "").alias("high")).where("high like '%.%'")
    ties = above.select(F.col("low").alias("src"), F.col("high").alias("dst")).unionByName(above.select(F.col("high").alias("src"), F.col("low").alias("dst")))
    return links.unionByName(ties.withColumn("w", F.lit(TIE))).groupBy("src", "dst").agg(F.sum("w").alias("w"))


def spread(links: DataFrame, seeds: DataFrame, rounds: int | None = None) -> DataFrame:
    """(host, trust, distrust) by PageRank that restarts at seeds(host, kind, part); kind 0 goes with the links, kind 1 against them.

    rounds: so many, in which every host passes on all that it has; without it, as many as hosts need to settle.
    """
    both = links.select(F.lit(0).alias("kind"), "src", "dst", "w").unionByName(links.select(F.lit(1).alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "w"))
    out = both.groupBy("kind", "src").agg(F.sum("w").alias("all"))
    ways = cut(both.join(out, ["kind", "src"]).select(F.col("kind").alias("of"), "src", "dst", (F.col("w") / F.col("all")).alias("w")))
    if ways.count() <= BROADCAST_LINKS:
        ways = F.broadcast(ways)
    # p is what a host keeps for good, r what it has still to pass on; both together are its rank so far.
    rank = seeds.groupBy("kind", "host").agg(F.lit(0.0).alias("p"), F.sum(F.col("part").cast("double")).alias("r"))
    open_ = F.col("r") > (0.0 if rounds else CHANGE) * F.col("p")

    def step(rank: DataFrame) -> DataFrame:
        # A row for what stays and, of open hosts, one for what goes; as both come from one reference, plans of several rounds don't double.
        both = rank.withColumn("way", F.explode(F.when(open_, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        moved = both.join(ways, (F.col("kind") == F.col("of")) & (F.col("host") == F.col("src")) & (F.col("way") == 1), "left").where("way = 0 or dst is not null")
        goes = F.col("way") == 1
        out = moved.select(
            "kind", F.when(goes, F.col("dst")).otherwise(F.col("host")).alias("host"), F.when(goes, 0.0).when(open_, F.col("p") + (1 - DAMPING) * F.col("r")).otherwise(F.col("p")).alias("p"),
            F.when(goes, F.lit(DAMPING) * F.col("r") * F.col("w")).when(open_, 0.0).otherwise(F.col("r")).alias("r"),
        )
        return out.groupBy("kind", "host").agg(F.sum("p").alias("p"), F.sum("r").alias("r"))

    left = rounds
    while True:
        now = CHECKED if left is None else min(CHECKED, left)
        for _ in range(now):
            rank = step(rank)
        rank = cut(rank)
        left = None if left is None else left - now
        if left == 0 or left is None and rank.where(open_).isEmpty():
            break
    rank = rank.select("kind", "host", (F.col("p") + F.col("r")).alias("p"))
    of = lambda k: F.sum(F.when(F.col("kind") == k, F.col("p")).otherwise(0.0))
    return rank.groupBy("host").agg(of(0).alias("trust"), of(1).alias("distrust"))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]] | None = None, url: str = "url", html: str = "html", keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """keep, host, path, rule, verdict, trust and distrust of each row of pages."""
    rules = RULES if rules is None else rules
    new = ("host", "path", "rule", "verdict", "trust", "distrust")
    keep = tuple(c for c in keep if c not in new)
    named = pages.select(*[F.col(c) for c in keep], F.col(html).alias("__html"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")).withColumn("__name", name_of(F.col("host")))
    rule, verdict = by_rules(F.col("host"), F.col("path"), rules)
    ruled = named.withColumns({"rule": rule, "by_rule": verdict})

    counted = cut(ruled.where("__name != ''").groupBy(F.col("__name").alias("host")).agg(F.count_if(F.col("by_rule") == "allow").alias("good"), F.count_if(F.col("by_rule") == "block").alias("bad")))
    hosts = counted.count()
    # Numbers of urls, not parts of all of them, or else seeds elsewhere would tip the balance of trust and distrust here.
    seeds = counted.select("host", F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("good").alias("part")), F.struct(F.lit(1).alias("kind"), F.col("bad").alias("part")))).alias("x"))
    seeds = seeds.select("x.kind", "host", "x.part").where("part > 0")
    ranks = spread(host_links(ruled.select(F.col("__name").alias("name"), "__html"), "__html"), seeds)
    open_hosts = counted.select("host").join(ranks, "host", "left").na.fill(0.0, ["trust", "distrust"]).withColumnRenamed("host", "__name")
    small = F.broadcast(open_hosts) if hosts <= BROADCAST_HOSTS else open_hosts
    judged = ruled.drop("__html").join(small, "__name", "left")
    # Nine digits of the part that trust has, whatever the number of hosts, so the order of sums can't decide a tie.
    all_of = F.col("trust") + F.col("distrust")
    trusted = F.coalesce(F.round(F.col("trust") / F.nullif(all_of, F.lit(0.0)), 9) >= SHARE, F.lit(True))
    final = F.coalesce("by_rule", F.when(trusted, F.lit("allow")).otherwise(F.lit("block")))
    return judged.withColumn("verdict", final).select(*keep, *new)
