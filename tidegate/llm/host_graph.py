"""Trust and distrust along host links: personalised PageRank from both kinds of seeds.

Pages that a URL rule judges make seeds of their hosts: a host's share of allowed pages trusts it, its share
of blocked pages distrusts it. Trust flows along links (what trusted hosts link to is likelier good);
distrust flows against them (who links to blocked hosts is likelier bad). Both are personalised
PageRank and run as one job: an edge table with a kind, joined to the scores each round.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import keeps_columns, lower_ascii, written

DAMPING, TOLERANCE, ROUNDS = 0.85, 1e-3, 40
DISTRUST = 1.0  # a host whose distrust is at least this many times an even share, and its trust, is blocked
# Two labels under which a country's registry gives out names: no domain of its own, so its names are not joined.
REGISTRY = r"^(ac|co|com|edu|gob|gov|go|ltd|mil|ne|net|nom|or|org|plc|sch)[.][a-z]{2}$"
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*((?:https?:)?//[^"'\s>]+)"""


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    return F.when(url.contains("://"), lower_ascii(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1))).otherwise("")


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.when(url.contains("://"), F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1)).otherwise("")


def domains(host_column: Column) -> Column:
    """The host, its name without port and final dot, and every domain above that, the top level left out.

    Addresses of numbers, and names longer than the 253 characters a domain may have, have nothing above them.
    """
    name = F.regexp_replace(host_column, r"[.]?(:[0-9]*)?$", "")
    labels = F.split(name, "[.]", -1)
    n = F.size(labels)
    above = F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.array_join(F.slice(labels, i, n - i + 1), "."))
    above = F.filter(above, lambda d: ~d.rlike(REGISTRY))
    plain = (n > 1) & (F.length(name) <= 253) & ~name.rlike(r"^[0-9.]+$|[\[\]]")
    return F.array_distinct(F.concat(F.array(host_column), F.when(plain, above).otherwise(F.array().cast("array<string>"))))


def rule_of(host_column: Column, path_column: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """``struct<rule, verdict>`` of the longest rule that fits, else null; a rule is ``host/path...``.

    It fits its host and all subdomains if the URL's path starts with the rule's. Rules of one
    length that both fit are taken in the order given.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: -len(r[0]))[::-1]:
        name, slash, rest = rule.partition("/")
        fits = (host_column == name) | host_column.endswith(f".{name}")
        fits = fits & path_column.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def host_links(pages: DataFrame, url: str = "url", html: str = "html", parents: bool = True) -> DataFrame:
    """``src, dst, weight``: links between different hosts, with the number of pages that have them.

    Absolute and scheme-relative ``href`` of anchors count, each target host once a page. ``parents`` adds a
    link of weight 1 both ways between a host and the domain right above it, and so on up to below the top
    level, whether or not a page lies on that domain: so all hosts of a domain are joined. Rows are
    added up before they are dealt out.
    """
    source = host(F.col(url))
    targets = F.array_distinct(F.transform(
        F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(LINK), F.lit(1)),
        lambda u: host(F.when(u.startswith("//"), F.concat(F.lit("http:"), u)).otherwise(u)),
    ))
    links = pages.select(source.alias("src"), F.explode(targets).alias("dst")).where("src <> '' and dst <> '' and src <> dst")
    edges = links.groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))
    if not parents:
        return edges
    hosts = pages.select(source.alias("src")).where("src <> ''").distinct()
    chain = hosts.select(domains(F.col("src")).alias("chain"))
    steps = F.transform(F.sequence(F.lit(1), F.size("chain") - 1), lambda i: F.struct(
        F.element_at("chain", i).alias("src"), F.element_at("chain", i + 1).alias("dst")
    ))
    known = chain.where(F.size("chain") > 1).select(F.explode(steps).alias("s")).select("s.src", "s.dst").distinct()
    both = known.union(known.select("dst", "src")).withColumn("weight", F.lit(1.0))
    return edges.unionByName(both).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def propagated(links: DataFrame, seeds: DataFrame) -> DataFrame:
    """``kind, host, score`` for ``seeds`` (``kind, host, weight``; kinds 'trust' and 'distrust') over ``links``.

    Scores of a kind add up to 1. A host without links out gives its score back to the seeds; as that
    only multiplies all scores, it is done by the division at the end. Rounds end when a round
    changes the scores by less than TOLERANCE in all, or after ROUNDS.
    """
    total = seeds.groupBy("kind").agg(F.sum("weight").alias("total")).where("total > 0")
    base = written(seeds.join(F.broadcast(total), "kind").select("kind", "host", (F.col("weight") / F.col("total")).alias("base")).where("base > 0"), "seeds")
    edges = links.select(F.lit("trust").alias("kind"), "src", "dst", "weight").unionByName(
        links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    )
    out = edges.groupBy("kind", "src").agg(F.sum("weight").alias("out"))
    edges = written(edges.join(out, ["kind", "src"]).select("kind", F.col("src").alias("host"), "dst", (F.col("weight") / F.col("out")).alias("share")), "edges")
    scores = base.select("kind", "host", (F.col("base") * (1 - DAMPING)).alias("score"))
    for _ in range(ROUNDS):
        # a score moves by what the neighbours' scores moved; sums are made before rows are dealt out
        sent = scores.join(edges, ["kind", "host"]).select("kind", F.col("dst").alias("host"), (F.col("score") * F.col("share") * DAMPING).alias("score"))
        back = base.select("kind", "host", (F.col("base") * (1 - DAMPING)).alias("score"))
        moved = sent.unionByName(back).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        change = scores.select("kind", "host", (-F.col("score")).alias("score")).unionByName(moved)
        moved = written(
            change.groupBy("kind", "host").agg(F.sum("score").alias("delta"), F.max("score").alias("score")), "scores"
        )
        gap = moved.agg(F.sum(F.abs("delta"))).first()[0] or 0.0
        scores = moved.select("kind", "host", "score")
        if gap < TOLERANCE:
            break
    whole = scores.groupBy("kind").agg(F.sum("score").alias("whole"))  # two rows at most
    return scores.join(F.broadcast(whole), "kind").select("kind", "host", (F.col("score") / F.col("whole")).alias("score"))


@keeps_columns("_rule")
def judged(pages: DataFrame, rules: Sequence[tuple[str, str]], links: DataFrame | None = None, distrust: float = DISTRUST) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict, trust, distrust``.

    The verdict is the rule's if one fits. Else a host is blocked if its distrust is at least
    ``distrust`` times an even share of all hosts and more than its trust, and allowed otherwise; so
    hosts that no seed reaches, and pages without a host, are allowed. Null or odd URLs have an empty
    host and path. Repeated rows are each judged; columns with these names are replaced.
    """
    own = ("host", "path", "rule", "verdict", "trust", "distrust")
    url = F.col("url")
    named = pages.drop(*own).withColumns({"host": F.coalesce(host(url), F.lit("")), "path": F.coalesce(path(url), F.lit(""))})
    ruled = named.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    verdicts = ruled.groupBy("host").agg(
        F.sum((F.col("_rule.verdict") == "allow").cast("double")).alias("allowed"),
        F.sum((F.col("_rule.verdict") == "block").cast("double")).alias("blocked"), F.count("_rule").alias("n"),
    )
    verdicts = written(verdicts, "hosts")
    ways = F.array(*[F.struct(F.lit(k).alias("kind"), (F.col(c) / F.col("n")).alias("weight")) for k, c in (("trust", "allowed"), ("distrust", "blocked"))])
    seeds = verdicts.where("n > 0 and host <> ''").select("host", F.explode(ways).alias("s")).select("s.kind", "host", "s.weight")
    scores = propagated(links if links is not None else host_links(pages), seeds)
    hosts = verdicts.where("host <> ''").count()
    wide = scores.groupBy("host").agg(
        F.sum(F.when(F.col("kind") == "trust", F.col("score"))).alias("trust"), F.sum(F.when(F.col("kind") == "distrust", F.col("score"))).alias("distrust")
    )
    # one row a host: a host with a third of all pages is split on the side of the pages
    out = ruled.join(wide, "host", "left").withColumns({"trust": F.coalesce("trust", F.lit(0.0)), "distrust": F.coalesce("distrust", F.lit(0.0))})
    bad = (F.col("distrust") * hosts >= distrust) & (F.col("distrust") > F.col("trust"))
    out = out.withColumn("rule", F.col("_rule.rule")).withColumn(
        "verdict", F.coalesce(F.col("_rule.verdict"), F.when(bad, "block").otherwise("allow"))
    )
    return out.select(*[c for c in pages.columns if c not in own], *own)
