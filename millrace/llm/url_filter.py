"""URL verdicts: rules first, then trust and distrust propagated over host links."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import settle

# Rounds that the SQL unrolls. The query goes on until the scores of no host change by more than TOLERANCE of
# themselves; it looks every LOOK rounds, and LIMIT rounds without that are an error.
ROUNDS = 10
TOLERANCE = 1e-6
LOOK = 5
LIMIT = 2000
DAMPING = 0.85
# A host is blocked when more than this share of what reaches it is distrust; ties allow.
SHARE = 0.5
MARGIN = 1e-9
_LINK = r"""(?i)\shref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s<>]+)"""


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) after the first `://`, and the path behind it; both empty without one."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + F.lit(3))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return _ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: list[str]) -> Column:
    """The longest rule that fits, else null. A rule `host/path` fits its host and all subdomains when the
    path starts with the rule's. The rules are a short list, tried from the longest."""
    found = F.lit(None).cast("string")
    for rule in sorted(set(rules), key=lambda r: (len(r), r)):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def host_links(pages: DataFrame, site_links: bool) -> DataFrame:
    """(src, dst, weight): between different hosts, the number of pages of src that link to dst.

    pages: host, links. With site_links, a host and its parent domain are linked both ways if both have
    pages, with weight 1. The weights of a pair add up.
    """
    out = pages.where("host <> ''").select(F.col("host").alias("src"), F.explode("links").alias("dst"))
    out = out.where("src <> dst and dst <> ''").groupBy("src", "dst").agg(F.count("*").alias("w"))
    if site_links:
        hosts = pages.where("host <> ''").select("host").distinct()
        parents = hosts.select(F.col("host").alias("child"), F.regexp_extract("host", r"^[^.]+\.(.+)$", 1).alias("host"))
        pairs = parents.where("host <> ''").join(hosts, "host")
        out = out.unionAll(pairs.select(F.explode(F.array(
            F.struct(F.col("child").alias("src"), F.col("host").alias("dst"), F.lit(1).cast("bigint").alias("w")),
            F.struct(F.col("host").alias("src"), F.col("child").alias("dst"), F.lit(1).cast("bigint").alias("w")))).alias("e")
        ).select("e.*")).groupBy("src", "dst").agg(F.sum("w").alias("w"))
    return out


def propagate(links: DataFrame, seeds: DataFrame, rounds: int = LIMIT, damping: float = DAMPING) -> DataFrame:
    """(host, trust, distrust) of personalised PageRank, iterated until it has converged.

    seeds: host, trusted, blocked. Trust starts at trusted seeds and follows links, split by their weight;
    distrust starts at blocked seeds and follows links backwards, split likewise. A round joins the scores
    with the links once and adds up; only sums per host are shuffled, after partial sums. It has converged
    when the last round changed neither score of any host by more than TOLERANCE of it, so also no host
    is reached for the first time. Not having converged after `rounds` rounds is an error.
    """
    weight_out = links.groupBy("src").agg(F.sum("w").alias("all_out"))
    weight_in = links.groupBy("dst").agg(F.sum("w").alias("all_in"))
    shares = links.join(weight_out, "src").join(weight_in, "dst")
    # One row per direction: from whom, to whom, the share of trust and of distrust that moves.
    none = F.lit(0.0)
    moves = shares.select(F.col("src").alias("host"), F.col("dst").alias("to"),
                          (F.col("w") / F.col("all_out")).alias("good"), none.alias("bad")).unionAll(
        shares.select(F.col("dst").alias("host"), F.col("src").alias("to"),
                      none.alias("good"), (F.col("w") / F.col("all_in")).alias("bad")))
    moves = settle(moves.groupBy("host", "to").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")), "moves")
    start = settle(seeds.where("trusted > 0 or blocked > 0").select(
        "host", (F.col("trusted") * (1 - damping)).alias("trust"), (F.col("blocked") * (1 - damping)).alias("distrust")), "seeds")
    scores = start
    if moves.isEmpty():
        return scores
    for done in range(1, rounds + 1):
        moved = moves.join(scores, "host").select(
            F.col("to").alias("host"), (F.col("trust") * F.col("good") * damping).alias("trust"),
            (F.col("distrust") * F.col("bad") * damping).alias("distrust"))
        both = start.unionAll(moved)
        if done % LOOK and done < rounds:
            scores = both.groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
            continue
        # Beside the new scores of a host stand those of the round before.
        both = both.withColumns({"trust0": none, "distrust0": none}).unionAll(
            scores.select("host", none, none, F.col("trust").alias("trust0"), F.col("distrust").alias("distrust0")))
        both = settle(both.groupBy("host").agg(*(F.sum(c).alias(c) for c in ("trust", "distrust", "trust0", "distrust0"))), "scores")
        moving = [F.abs(F.col(c) - F.col(f"{c}0")) > TOLERANCE * F.col(c) for c in ("trust", "distrust")]
        scores = both.select("host", "trust", "distrust")
        if both.where(moving[0] | moving[1]).isEmpty():
            return scores
    raise RuntimeError(f"scores of hosts have not converged after {rounds} rounds")


def judge_urls(df: DataFrame, rules: dict[str, str], id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html", share: float = SHARE, rounds: int = LIMIT, damping: float = DAMPING,
               site_links: bool = True) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, trust, distrust.

    rules: a rule like `example.com/en/` and its verdict, allow or block. The longest rule that fits decides.
    Every other page takes its host's verdict: block when distrust is more than `share` of the trust and
    distrust that reach the host, allow otherwise, also where nothing reaches it. Every page that a rule
    allows is a trusted seed of its host, every page that one blocks a blocked seed. Links are the absolute
    ones in the page; relative ones stay on their host and move nothing. A host and its parent domain count
    as linked when both have pages (`site_links`).

    A null url, or one without `://`, has an empty host and path, no rule, and is allowed. Null or empty
    html has no links. Rows that repeat an id each give a row. Only the three named columns are read.
    """
    host, path = host_and_path(F.col("url"))
    pages = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    pages = pages.select("id", host.alias("host"), path.alias("path"), F.array_distinct(F.transform(
        F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(_LINK), F.lit(1)), _ascii_lower)).alias("links"))
    pages = pages.withColumn("rule", matching_rule(F.col("host"), F.col("path"), list(rules)))
    ruled = F.lit(None).cast("string")
    for rule, verdict in rules.items():
        ruled = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(ruled)
    pages = settle(pages.withColumn("ruled", ruled), "pages")

    seeds = pages.where("host <> ''").groupBy("host").agg(
        F.count_if(F.col("ruled") == "allow").alias("trusted"), F.count_if(F.col("ruled") == "block").alias("blocked"))
    scores = propagate(host_links(pages, site_links), seeds, rounds, damping)
    out = pages.select("id", "host", "path", "rule", "ruled").join(scores, "host", "left").na.fill(0.0, ["trust", "distrust"])
    bad = F.col("distrust") > (F.col("trust") + F.col("distrust")) * (share + MARGIN)
    return out.select(F.col("id").alias(id_col), "host", "path", "rule",
                      F.coalesce("ruled", F.when(bad, "block").otherwise("allow")).alias("verdict"), "trust", "distrust")
