"""URL filters: rules by host and path, and trust propagated over the links between hosts.

A url that a rule fits gets the longest rule's verdict. All others get their host's: personalised
PageRank spreads trust from the hosts of allowed urls along links, and distrust from the hosts of
blocked urls against them (who links to blocked hosts is suspect). Both start from shares of pages
and are scaled back to pages; a host is blocked if distrust is more than ``threshold`` of the sum, by
more than the ``tolerance`` to which both are known, so a host with as much of either is allowed, as is
one that neither reaches. Rounds go on until the masses change by less than the tolerance.

Everything is DataFrame functions. Links are counted per pair of hosts before anything else, so no
host's pages meet in one task, and each round of propagation is an equi-join and two pre-aggregated
sums, written to the shared folder.

A null url, or one without ``://``, has an empty host and path; empty hosts have no links and are
allowed. Null html has no links. Repeated pages are judged alike and count twice as seeds and links.
Of rules of equal length the first by code point wins. A page of any length gives each pair of hosts
it links once a link. An empty table gives no rows. Columns other
than id, url and html are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hosts of absolute links; relative ones stay on their host.
_LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    host: str  # and all subdomains
    path: str  # a prefix, with its slash
    allow: bool

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class TrustRules:
    damping: float = 0.85
    rounds: int = 200  # more than 1e-6 needs; without the tolerance by then it is an error
    tolerance: float = 1e-6  # of the total change in a round
    threshold: float = 0.5


def url_host(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.translate(F.coalesce(F.regexp_extract(rest, r"^[^/?#]*", 0), F.lit("")), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The name of the longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (-len(r.name), r.name), reverse=True):
        out = F.when(((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path), r.name).otherwise(out)
    return out


def _spread(links: DataFrame, seeds: DataFrame, trust: TrustRules, backwards: bool) -> DataFrame:
    """(host, mass) after propagation from (host, seed); both sum to one, or there are no seeds."""
    a, b = ("target", "source") if backwards else ("source", "target")
    edges = links.select(F.col(a).alias("a"), F.col(b).alias("b"), "n")
    out = materialize(edges.groupBy("a").agg(F.sum("n").alias("all")), "degrees")  # a join with a plain table can split a hub
    edges = materialize(edges.join(out, "a").select("a", "b", (F.col("n") / F.col("all")).alias("share")), "links")
    now, written = seeds.select("host", "seed", F.col("seed").alias("mass")), seeds
    for k in range(trust.rounds):
        sent = edges.join(now.select(F.col("host").alias("a"), "mass"), "a").groupBy(F.col("b").alias("host")).agg(F.sum(F.col("mass") * F.col("share")).alias("got"))
        both = now.select("host", "seed", "mass", F.lit(0.0).alias("got")).unionByName(sent.select("host", F.lit(0.0).alias("seed"), F.lit(0.0).alias("mass"), "got"))
        both = materialize(both.groupBy("host").agg(*(F.sum(c).alias(c) for c in ("seed", "mass", "got"))), "mass")
        kept = both.agg(F.sum("got")).first()[0] or 0.0  # the rest had nowhere to go and returns to the seeds
        after = trust.damping * (F.col("got") + (1.0 - kept) * F.col("seed")) + (1 - trust.damping) * F.col("seed")
        change = both.agg(F.sum(F.abs(after - F.col("mass")))).first()[0] or 0.0
        now = both.select("host", "seed", after.alias("mass"))
        if k:
            discard(written)
        written = both
        if change < trust.tolerance:
            discard(edges, out)
            return now.select("host", "mass")
    raise RuntimeError(f"propagation still changes {change} of the mass after {trust.rounds} rounds")


def host_trust(pages: DataFrame, links: DataFrame, trust: TrustRules = TrustRules()) -> DataFrame:
    """(host, trust, distrust), in pages, of every host that either reaches.

    pages: host and verdict (allow, block or null); links: source, target and n.
    """
    seeds = pages.filter("verdict is not null and host <> ''").groupBy("host").agg(F.sum((F.col("verdict") == "allow").cast("long")).alias("good"), F.sum((F.col("verdict") == "block").cast("long")).alias("bad"))
    seeds = materialize(seeds, "seeds")
    good, bad = (x or 0 for x in seeds.agg(F.sum("good"), F.sum("bad")).first())
    parts = []
    for column, total, backwards in (("good", good, False), ("bad", bad, True)):
        start = seeds.filter(F.col(column) > 0).select("host", (F.col(column) / F.lit(max(1, total))).alias("seed"))
        mass = F.col("mass") * float(total)
        zero = F.lit(0.0)
        spread = _spread(links, start, trust, backwards)
        parts.append(spread.select("host", (zero if backwards else mass).alias("trust"), (mass if backwards else zero).alias("distrust")))
    return parts[0].unionByName(parts[1]).groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))


def judge_urls(pages: DataFrame, rules: Sequence[Rule], trust: TrustRules = TrustRules(), id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, host, path, rule, verdict, trust and distrust of its host."""
    url = F.col(f"`{url_col}`")
    links = F.regexp_extract_all(F.col(f"`{html_col}`"), F.lit(_LINK), F.lit(1))
    seen = pages.select(F.col(f"`{id_col}`").alias("id"), url_host(url).alias("host"), url_path(url).alias("path"), links.alias("links"))
    allowed = F.array(*(F.lit(r.name) for r in rules if r.allow)).cast("array<string>")
    seen = seen.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    seen = materialize(seen.withColumn("verdict", F.when(F.col("rule").isNotNull(), F.when(F.array_contains(allowed, F.col("rule")), "allow").otherwise("block"))), "pages")
    target = F.translate(F.regexp_replace(F.col("link"), r"^[^@]*@", ""), _UPPER, _LOWER)
    edges = seen.filter("host <> '' and size(links) > 0").select(F.col("host").alias("source"), F.explode("links").alias("link")).select("source", target.alias("target"))
    edges = materialize(edges.filter("target <> source and target <> ''").groupBy("source", "target").agg(F.count(F.lit(1)).alias("n")), "links")
    hosts = host_trust(seen, edges, trust)
    out = seen.drop("links").join(hosts, "host", "left")
    zero = F.lit(0.0)
    good, bad = F.coalesce("trust", zero), F.coalesce("distrust", zero)
    verdict = F.coalesce("verdict", F.when(bad > (trust.threshold + trust.tolerance) * (good + bad), "block").otherwise("allow"))
    return out.select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), good.alias("trust"), bad.alias("distrust"))
