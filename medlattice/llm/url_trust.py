"""URL filtering by rules and by trust propagated over the link graph.

Pages that an allow or block rule fits seed their host with trust or distrust (the share of the
host's pages that the rules allow or block). Personalised PageRank carries trust along host edges. Distrust goes
against them: a host takes the mean distrust of what it links to, so it does not fall with the number of other hosts
that link there. A host whose distrust exceeds its trust and a threshold is blocked.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medlattice.llm.common import settle

_HOST = r"(?s)^.*?://([^/?#]*)"
_PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"
_LINK = r"""(?is)<a\s[^>]*?href\s*=\s*["']?((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)"""


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, ASCII lower case; else empty."""
    return _ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), _HOST, 1))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PATH, 1)


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule (verdict, host, path) that fits: its host or a subdomain
    of it, and a path that starts with the rule's; both null if none fits. The rules are a list in the plan: some hundreds at most."""
    rule = verdict = F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1], r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst, links): links with a host of their own, from other hosts, counted by pair of hosts."""
    links = F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(_LINK), F.lit(1))
    return (pages.select(url_host(F.col(url_col)).alias("src"), F.explode(links).alias("link"))
            .select("src", _ascii_lower(F.regexp_extract("link", r"^[^/]*//([^/?#]*)", 1)).alias("dst"))
            .where("src != '' and dst != '' and src != dst")
            .groupBy("src", "dst").agg(F.count("*").alias("links")))


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = 0.85, tolerance: float = 1e-6, settle_every: int = 5) -> DataFrame:
    """(host, kind, score) of scores walked along ``edges`` (kind, src, dst, share) from ``seeds`` (host, kind, seed).

    Of each kind, either the shares out of every host sum to 1 (personalised PageRank) or those into every host (mean over the
    edges into it), so changes fade by ``damping`` (below 1) a round. A seed without incoming edges scores its seed value. Rounds
    end once no score moves by more than ``tolerance`` (of itself, if above 1) in ``settle_every`` of them. State goes to the shared folder.
    """
    if not 0 <= damping < 1:
        raise ValueError("damping must be at least 0 and below 1")
    scores = seeds.select("host", "kind", F.col("seed").alias("score"))
    before = scores
    for r in count(1):
        sent = (edges.join(scores.withColumnRenamed("host", "src"), ["src", "kind"])
                .select(F.col("dst").alias("host"), "kind", (F.col("score") * F.col("share") * damping).alias("score")))
        scores = (sent.union(seeds.select("host", "kind", F.col("seed").alias("score")))
                  .groupBy("host", "kind").agg(F.sum("score").alias("score")))
        if r % settle_every == 0:
            scores = settle(scores, "trust")
            moved = scores.join(before.withColumnRenamed("score", "was"), ["host", "kind"], "left").where(
                F.abs(F.col("score") - F.coalesce("was", F.lit(0.0))) > tolerance * F.greatest(F.lit(1.0), "score"))
            if moved.isEmpty():
                return scores
            before = scores


def host_scores(pages: DataFrame, rules: list[tuple[str, str, str]], url_col: str = "url", html_col: str = "html",
                damping: float = 0.85, tolerance: float = 1e-6) -> DataFrame:
    """(host, trust, distrust) of every host that a seed reaches."""
    host, path = url_host(F.col(url_col)), url_path(F.col(url_col))
    _, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    seen = (pages.select(host.alias("host"), path.alias("path")).withColumn("verdict", verdict)
            .groupBy("host").agg(F.count("*").alias("n"), F.count_if(F.col("verdict") == "allow").alias("allow"),
                                 F.count_if(F.col("verdict") == "block").alias("block")).where("host != ''"))
    kinds = F.explode(F.array(F.struct(F.lit("trust").alias("kind"), (F.col("allow") / F.col("n")).alias("seed")),
                              F.struct(F.lit("distrust").alias("kind"), (F.col("block") / F.col("n")).alias("seed"))))
    seeds = settle(seen.select("host", kinds.alias("s")).select("host", "s.*").where("seed > 0"), "seeds")
    edges = settle(host_edges(pages, url_col, html_col), "host-edges")
    if edges.isEmpty():
        scores = seeds.withColumnRenamed("seed", "score")
    else:
        out = edges.groupBy("src").agg(F.sum("links").alias("all"))
        shares = edges.join(out, "src").withColumn("share", F.col("links") / F.col("all"))
        forward = shares.select(F.lit("trust").alias("kind"), "src", "dst", "share")
        reverse = shares.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "share")
        scores = propagate(seeds, settle(forward.union(reverse), "host-edges"), damping, tolerance)
    return scores.groupBy("host").agg(F.sum(F.when(F.col("kind") == "trust", F.col("score")).otherwise(0.0)).alias("trust"),
                                      F.sum(F.when(F.col("kind") == "distrust", F.col("score")).otherwise(0.0)).alias("distrust"))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               threshold: float = 0.5, damping: float = 0.85, tolerance: float = 1e-6) -> DataFrame:
    """(id, host, path, rule, verdict, trust, distrust), one row per input row.

    The verdict is that of the longest rule that fits. Without one, the page is blocked if its host's distrust is at
    least ``threshold`` (a host whose pages are all blocked has 1 from them; one with only links to such hosts has ``damping``)
    and above its trust. Null urls and urls without ``://``:
    empty host and path, allowed. Null html has no links. Empty table: no rows. Other columns are ignored.
    """
    scores = host_scores(pages, rules, url_col, html_col, damping, tolerance)
    rows = pages.select(F.col(id_col).alias("id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    joined = rows.join(settle(scores, "host-scores"), "host", "left")
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    own = F.when((distrust >= threshold) & (distrust > trust), "block").otherwise("allow")
    return joined.select(F.col("id").alias(id_col), "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"),
                         trust.alias("trust"), distrust.alias("distrust"))
