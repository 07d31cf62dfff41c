"""Rules on URLs, and trust and distrust that spread over links between hosts."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import drop_table, store, stored_at

# Host and path prefix, with the verdict.
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
# Rules are matched one by one on every row, so that there may not be many.
MOST_RULES = 1000
# Share of a host's score that comes over links.
DAMPING = 0.85
# Distrust beyond trust from which a host is blocked. 1 is a host all of whose pages are blocked.
THRESHOLD = 0.5
# Rounds end when no score moves by more than this. Each takes away the same part of what is still
# to move, so that they end; the score then is within TOLERANCE / (1 - DAMPING) of its limit.
TOLERANCE = 1e-6
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_URL = r"://([^/?#]*)([^?#]*)"
_LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*+:)?//([^/?#"'\s<>]++)"""


def small_letters(text: Column) -> Column:
    """A-Z in small letters; others as they are."""
    return F.translate(text, _UPPER, _UPPER.lower())


def url_host(url: Column) -> Column:
    return F.coalesce(small_letters(F.regexp_extract(url, _URL, 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """struct(size, verdict, rule) of the longest rule that fits; of equals, block wins."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    fits = []
    for rule, verdict in rules:
        domain, _, prefix = rule.partition("/")
        on_host = (host == domain) | host.endswith(f".{domain}")
        fits.append(
            F.when(
                on_host & path.startswith(f"/{prefix}"),
                F.struct(F.lit(len(rule)).alias("size"), F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule")),
            )
        )
    none = F.lit(None).cast("struct<size: int, verdict: string, rule: string>")
    return F.array_max(F.array(none, *fits))


def host_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(src, dst, share): of a host's links to other hosts, the share that goes to each."""
    links = pages.select(
        url_host(F.col(url)).alias("src"),
        F.explode(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(_LINK), F.lit(1))).alias("link"),
    )
    counted = (
        links.select("src", small_letters(F.col("link")).alias("dst"))
        .where("src <> dst AND src <> '' AND dst <> ''")
        .groupBy("src", "dst")
        .agg(F.count("*").alias("n"))
    )
    # Stored, so that a host with very many links is no more than one skewed side of a join.
    counted = store(counted, "links")
    totals = store(counted.groupBy(F.col("src").alias("s")).agg(F.sum("n").alias("total")), "totals")
    return store(
        counted.join(totals, F.col("src") == F.col("s")).select("src", "dst", (F.col("n") / F.col("total")).alias("share")),
        "shares",
    )


def host_scores(
    seeds: DataFrame,
    links: DataFrame,
    damping: float = DAMPING,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """(host, trust, distrust) from (host, trusted, blocked), both 0 to 1.

    Trust goes along links, as in personalised PageRank from the trusted hosts: a host gives
    its linked hosts shares of its trust. Distrust goes against them: a host takes over the
    distrust of the hosts it links to, by shares. Both are in units of what a seed alone
    would have. Each round is two joins and sums, on narrow tables; it is written to the
    scratch folder. Rounds go on until no score moves by more than `tolerance`, some 90 of them
    at most for scores of hosts alone; `damping` is below 1.
    """
    spark = seeds.sparkSession
    hosts = seeds.select("host").unionAll(links.select("src")).unionAll(links.select("dst")).distinct()
    start = hosts.join(seeds, "host", "left").select(
        "host", *[F.coalesce(c, F.lit(0.0)).cast("double").alias(c) for c in ("trusted", "blocked")]
    )
    start = store(start, "seeds")
    now = start.select("host", F.col("trusted").alias("trust"), F.col("blocked").alias("distrust"))
    if links.isEmpty():
        return now
    path = None
    while True:
        given = links.join(now, F.col("src") == F.col("host")).select(
            F.col("dst").alias("to"), (F.col("trust") * F.col("share")).alias("t"), F.lit(0.0).alias("d")
        )
        taken = links.join(now, F.col("dst") == F.col("host")).select(
            F.col("src").alias("to"), F.lit(0.0).alias("t"), (F.col("distrust") * F.col("share")).alias("d")
        )
        moved = given.unionAll(taken).groupBy("to").agg(F.sum("t").alias("t"), F.sum("d").alias("d"))
        scored = start.join(moved, F.col("host") == F.col("to"), "left").select(
            "host",
            (F.col("trusted") + damping * F.coalesce("t", F.lit(0.0))).alias("trust"),
            (F.col("blocked") + damping * F.coalesce("d", F.lit(0.0))).alias("distrust"),
        )
        after, after_path = stored_at(scored, "scores")
        old = now.select(F.col("host").alias("h"), F.col("trust").alias("t0"), F.col("distrust").alias("d0"))
        step = F.greatest(F.abs(F.col("trust") - F.col("t0")), F.abs(F.col("distrust") - F.col("d0")))
        change = after.join(old, F.col("host") == F.col("h")).agg(F.max(step)).first()[0] or 0.0
        if path:
            drop_table(spark, path)
        now, path = after, after_path
        if change <= tolerance:
            return now


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    threshold: float = THRESHOLD,
    damping: float = DAMPING,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row: the verdict of the longest rule that
    fits, else that of the host: block if its distrust exceeds its trust by `threshold`.

    A host is a seed of trust, and of distrust, by the share of its pages that a rule allows
    or blocks. A host that neither rules nor links say anything of is allowed; so are the
    pages without a host: a url that is null or has no :// gives empty host and path. Null
    html has no links. Repeated rows come as often as they do; no rows give no rows.
    """
    host, path = url_host(F.col(url)), url_path(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("found", matching_rule(F.col("host"), F.col("path"), rules))
    said = F.col("found.verdict")
    seeds = rows.where("host <> ''").groupBy("host").agg(
        F.avg(F.when(said == "allow", 1.0).otherwise(0.0)).alias("trusted"),
        F.avg(F.when(said == "block", 1.0).otherwise(0.0)).alias("blocked"),
    )
    scores = host_scores(store(seeds, "shares"), host_links(pages, url, html), damping)
    bad = store(scores.where(F.col("distrust") - F.col("trust") >= threshold).select(F.col("host").alias("bad_host")), "bad")
    judged = rows.join(bad, F.col("host") == F.col("bad_host"), "left")
    of_host = F.when(F.col("bad_host").isNotNull(), "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"), F.coalesce(said, of_host).alias("verdict")
    )
