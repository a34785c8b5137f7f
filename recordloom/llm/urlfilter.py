"""URL filters: rules first, and for hosts that no rule judges, trust and distrust along links.

Personalised PageRank spreads trust from hosts whose pages rules allow along links between hosts, and
distrust from hosts whose pages rules block along the same links reversed. A host is blocked if its
distrust is more than RATIO times its trust.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_written, written

#: Fixed values: (verdict, host, path).
RULES = (("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/"))
DAMPING, RATIO, DIGITS = 0.85, 1.0, 12
#: Share of a host's own mass below which a round's gain ends the rounds, and the most rounds until then; sql() goes on as long as a double can tell.
SETTLED, MOST_ROUNDS, SQL_ROUNDS = 1e-11, 1000, 230
#: Masses that differ by less than this share of themselves are equal. Masses are compared as they are, and rounded only to be reported.
TIE = 1e-9
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: An attribute's name in either case; its value in quotes or bare.
LINK = r"""(?i)\bhref\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]*)"""


def _after(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_after(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path(url: Column) -> Column:
    rest = _after(url)
    return F.regexp_extract(F.substring(rest, F.length(F.regexp_extract(rest, r"^[^/?#]*", 0)) + 1, F.length(rest)), r"^[^?#]*", 0)


def fitting(rules: tuple = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits columns host and path; nulls if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # longer ones later, so that they win
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def judged(pages: DataFrame, rules: tuple = RULES) -> DataFrame:
    rows = pages.select("page_id", host(F.coalesce("url", F.lit(""))).alias("host"), path(F.coalesce("url", F.lit(""))).alias("path"))
    name, verdict = fitting(rules)
    return rows.select("*", name.alias("rule"), verdict.alias("ruled"))


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links of pages to other hosts, counted by pairs of hosts. Links without a host stay on theirs and count nothing."""
    links = pages.select(host(F.coalesce("url", F.lit(""))).alias("src"), F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1))).alias("link"))
    pairs = links.select("src", host(F.regexp_replace("link", r"^[^/]*//", F.lit("://"))).alias("dst"))
    return pairs.where("src <> dst and src <> '' and dst <> ''").groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagated(seeds: DataFrame, edges: DataFrame, most: int = MOST_ROUNDS) -> DataFrame:
    """Personalised PageRank: seeds (host, mass) that sum to one, edges (src, dst, w) whose w sum to one by src; gives (host, mass).

    Mass that reaches a host without links goes no further. Round k adds what walks of k links bring, so masses
    only grow, and no walk is left undamped. Rounds end when no host, new ones included, gains more than SETTLED
    of its own mass, which no size of table changes; RuntimeError if that takes more than ``most`` rounds. Every
    round adds by host before it shuffles.
    """
    rank = written(seeds.select("host", ((1 - DAMPING) * F.col("mass")).alias("mass"), ((1 - DAMPING) * F.col("mass")).alias("gain")), "rank")
    for _ in range(most):
        moved = edges.join(rank.where("gain > 0").select(F.col("host").alias("src"), "gain"), "src").select(F.col("dst").alias("host"), F.lit(0.0).alias("mass"), (DAMPING * F.col("w") * F.col("gain")).alias("gain"))
        summed = rank.select("host", "mass", F.lit(0.0).alias("gain")).unionByName(moved).groupBy("host").agg(F.sum("mass").alias("mass"), F.sum("gain").alias("gain"))
        last, rank = rank, written(summed.select("host", (F.col("mass") + F.col("gain")).alias("mass"), "gain"), "rank")
        drop_written(last)
        if rank.where(F.col("gain") > SETTLED * F.col("mass")).isEmpty():
            return rank.select("host", "mass")
    raise RuntimeError(f"masses did not settle in {most} rounds")


def _shares(edges: DataFrame, src: str, dst: str) -> DataFrame:
    total = edges.groupBy(src).agg(F.sum("n").alias("total"))
    return edges.join(total, src).select(F.col(src).alias("src"), F.col(dst).alias("dst"), (F.col("n") / F.col("total")).alias("w"))


def trust(rows: DataFrame, edges: DataFrame, most: int = MOST_ROUNDS) -> DataFrame:
    """(host, trust, distrust, blocked) of every host with either, from judged rows and host edges."""
    counts = rows.where("ruled is not null and host <> ''").groupBy("host").agg(F.count_if(F.col("ruled") == "allow").alias("allow"), F.count_if(F.col("ruled") == "block").alias("block"))
    counts, edges = written(counts, "seeds"), written(edges, "links")
    totals = counts.agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")).first()
    out = []
    for column, src, dst in (("allow", "src", "dst"), ("block", "dst", "src")):
        seeds = counts.where(F.col(column) > 0).select("host", (F.col(column) / float(totals[column] or 1)).alias("mass"))
        out.append(propagated(seeds, _shares(edges, src, dst), most))
    both = out[0].withColumnRenamed("mass", "trust").join(out[1].withColumnRenamed("mass", "distrust"), "host", "full").na.fill(0.0, ["trust", "distrust"])
    blocked = F.col("distrust") > RATIO * (1 + TIE) * F.col("trust")
    return both.select("host", F.round("trust", DIGITS).alias("trust"), F.round("distrust", DIGITS).alias("distrust"), blocked.alias("blocked"))


def filtered(pages: DataFrame, rules: tuple = RULES) -> DataFrame:
    """One row per row of pages: (page_id, host, path, rule, verdict, trust, distrust).

    verdict: the longest fitting rule's; without one, block if links tell more distrust than trust of the
    host, else allow. Equal masses allow. Hosts that no seed reaches, and urls without a host, are allowed.
    Null urls have an empty host and path, null html has no links, html of any length is read whole; null ids and repeated rows are judged like others (links
    of repeated pages count again); an empty table gives no rows; other columns are not looked at.
    """
    rows = judged(pages, rules)
    hosts = trust(rows, host_edges(pages))
    out = rows.join(hosts, "host", "left")
    verdict = F.coalesce("ruled", F.when(F.col("blocked"), "block").otherwise("allow"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))


def sql() -> str:
    """The same over ``pages`` in DuckDB's SQL."""
    fits = "(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    cases = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    name, verdict = ("CASE " + " ".join(f"WHEN {fits.format(h=h, p=p)} THEN '{h + p if k else v}'" for v, h, p in cases) + " ELSE NULL END" for k in (1, 0))
    after = "CASE WHEN instr({x}, '://') > 0 THEN substr({x}, instr({x}, '://') + 3) ELSE '' END"
    low = "translate({x}, '" + UPPER + "', '" + LOWER + "')"
    steps = []
    for kind, src, dst in (("allow", "src", "dst"), ("block", "dst", "src")):
        steps.append(f"{kind}_w AS (SELECT {src} AS src, {dst} AS dst, n / sum(n) OVER (PARTITION BY {src}) AS w FROM edges)")
        # walks of k links, until what is left of their mass is below the last digit of a double
        steps.append(
            f"{kind}_walks(k, host, gain) AS (SELECT 0, host, {1 - DAMPING} * {kind}s / (SELECT sum({kind}s) FROM counts) FROM counts WHERE {kind}s > 0"
            f" UNION ALL SELECT k + 1, dst, sum({DAMPING} * w * gain) FROM {kind}_walks r JOIN {kind}_w e ON e.src = r.host WHERE k < {SQL_ROUNDS} GROUP BY k, dst)"
        )
        steps.append(f"{kind}_mass AS (SELECT host, sum(gain) AS mass FROM {kind}_walks GROUP BY host)")
    link = LINK.replace("'", "''")
    return f"""
WITH RECURSIVE rest AS (SELECT page_id, html, {after.format(x="coalesce(url, '')")} AS rest FROM pages),
parts AS (SELECT page_id, html, {low.format(x="regexp_extract(rest, '^[^/?#]*')")} AS host,
  regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM rest),
judged AS (SELECT page_id, html, host, path, {name} AS rule, {verdict} AS ruled FROM parts),
links AS (SELECT host AS src, unnest(regexp_extract_all(coalesce(html, ''), '{link}', 1)) AS link FROM judged),
pairs AS (SELECT src, {low.format(x="regexp_extract(regexp_replace(link, '^[^/]*//', ''), '^[^/?#]*')")} AS dst FROM links),
edges AS (SELECT src, dst, CAST(count(*) AS DOUBLE) AS n FROM pairs WHERE src <> dst AND src <> '' AND dst <> '' GROUP BY src, dst),
counts AS (SELECT host, CAST(count(*) FILTER (ruled = 'allow') AS DOUBLE) AS allows, CAST(count(*) FILTER (ruled = 'block') AS DOUBLE) AS blocks
  FROM judged WHERE ruled IS NOT NULL AND host <> '' GROUP BY host),
{", ".join(steps)},
hosts AS (SELECT coalesce(a.host, b.host) AS host, coalesce(a.mass, 0) AS trust, coalesce(b.mass, 0) AS distrust FROM allow_mass a FULL JOIN block_mass b ON a.host = b.host)
SELECT j.page_id, j.host, j.path, j.rule, coalesce(j.ruled, CASE WHEN h.distrust > {RATIO * (1 + TIE)} * h.trust THEN 'block' ELSE 'allow' END) AS verdict,
  round(coalesce(h.trust, 0), {DIGITS}) AS trust, round(coalesce(h.distrust, 0), {DIGITS}) AS distrust
FROM judged j LEFT JOIN hosts h ON j.host = h.host
"""
