"""Quality rules of whole hosts, with DataFrame functions only.

Every document is measured and judged by a few rules. The failures of each rule are added up by host, and a
host's rate is shrunk towards all hosts' by a beta prior that is fitted to the hosts' own rates: of a host with
few documents little is known, so it is taken for an ordinary one. A host of which a rule's shrunk rate
passes LIMIT is blocked, and its verdict goes back to all of its documents.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import WORD, written

SYMBOLS = "[#*$%&|<>]"
BLANKS = " \t\n\x0b\f\r"
WINDOW = 3
LEAST_WORDS = 50
REPEATS = 50  # percent of the words
LIMIT = 0.5  # shrunk rate of a rule from which on a host is blocked
WEAKEST, STRONGEST = 1.0, 10000.0  # documents that the prior counts for, at least and at most
SALT = 16  # parts of each host when verdicts go back to documents

# Rules by name: whether a measured document fails.
RULES: dict[str, str] = {
    "short": f"n_words < {LEAST_WORDS}",
    "repeats": f"100 * n_repeat_words > {REPEATS} * n_words",
    "symbols": "10 * n_symbols > n_words",
    "lines": "10 * n_dup_lines > 3 * n_lines",
    "lengths": "word_chars < 3 * n_words or word_chars > 10 * n_words",
}
BASE = ("short", "repeats")


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeated(words: Column) -> Column:
    """Number of words that lie in a window found at two or more places of the text.

    Windows are named by 64-bit hashes; sorted by name, equal ones are neighbours.
    """
    n = F.size(words)
    nothing = F.array().cast("array<int>")
    starts = F.when(n >= WINDOW, F.sequence(F.lit(0), n - WINDOW)).otherwise(nothing)
    names = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))

    def covered(named: Column) -> Column:
        pairs = F.sort_array(F.transform(named, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            like = lambda e, j: F.coalesce(e["h"] == F.get(s, j)["h"], F.lit(False))
            found = F.filter(s, lambda e, j: F.when(j > 0, like(e, j - 1)).otherwise(F.lit(False)) | like(e, j + 1))
            return F.size(F.array_distinct(F.flatten(F.transform(found, lambda e: F.array(*[e["i"] + k for k in range(WINDOW)])))))

        return F.when(F.size(F.array_distinct(named)) == F.size(named), F.lit(0)).otherwise(bound(pairs, places))

    return bound(names, covered)


def measured(docs: DataFrame, host: str = "source", text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, host`` and the counts that the rules use, one row per row of ``docs``; texts are not kept.

    Words are runs of anything but blanks; a line counts as repeated if it holds a word and equals an earlier
    line. A null text is an empty one. Other columns, whatever their names, play no part.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    words = F.regexp_extract_all(whole, F.lit(WORD), F.lit(0))
    by_word = bound(words, lambda w: F.struct(F.size(w).alias("n"), _repeated(w).alias("r")))
    lines = F.filter(F.split(whole, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    by_line = bound(lines, lambda each: F.struct(F.size(each).alias("n"), F.size(F.array_distinct(each)).alias("d")))
    rows = docs.select(
        F.col(key).alias("doc_id"), F.col(host).alias("host"), by_word.alias("w"), by_line.alias("l"),
        F.length(F.translate(whole, BLANKS, "")).alias("word_chars"), F.regexp_count(whole, F.lit(SYMBOLS)).alias("n_symbols"),
    )
    counts = {
        "n_words": F.col("w.n"), "word_chars": F.col("word_chars"), "n_symbols": F.col("n_symbols"), "n_lines": F.col("l.n"),
        "n_dup_lines": F.col("l.n") - F.col("l.d"), "n_repeat_words": F.col("w.r"),
    }
    return rows.select("doc_id", "host", *[c.cast("long").alias(name) for name, c in counts.items()])


def host_rates(facts: DataFrame, rules: dict[str, str] = RULES) -> DataFrame:
    """``host, n_docs`` and for each rule ``<rule>_failed`` and ``<rule>_rate``, the shrunk rate; null hosts are none.

    The prior of a rule is the beta distribution with the mean of the hosts' rates and their variance, less what
    chance adds to it. Where chance explains all of it, or there is one host, the prior is as strong as it may be.
    """
    fails = [F.count_if(F.expr(rule)).alias(f"{name}_failed") for name, rule in rules.items()]
    hosts = written(facts.where("host is not null").groupBy("host").agg(F.count("*").alias("n_docs"), *fails), "hosts")
    asked = [F.avg(1 / F.col("n_docs")).alias("chance")]
    for name in rules:
        rate = F.col(f"{name}_failed") / F.col("n_docs")
        asked += [F.avg(rate).alias(f"{name}_mean"), F.var_samp(rate).alias(f"{name}_var")]
    over_all = hosts.agg(*asked).first()  # one row
    shrunk = []
    for name in rules:
        mean, spread_of_rates = (over_all[f"{name}_{part}"] or 0.0 for part in ("mean", "var"))
        spread = mean * (1 - mean)
        true_var = spread_of_rates - spread * (over_all["chance"] or 0.0)
        fitted = spread / true_var - 1 if true_var > 0 else STRONGEST
        strength = max(WEAKEST, min(STRONGEST, fitted))
        rate = (F.col(f"{name}_failed") + F.lit(mean * strength)) / (F.col("n_docs") + F.lit(strength))
        shrunk.append(rate.alias(f"{name}_rate"))
    return hosts.select("host", "n_docs", *[f"{name}_failed" for name in rules], *shrunk)


def judged(
    docs: DataFrame, rules: dict[str, str] = RULES, base: tuple[str, ...] = BASE, limit: float = LIMIT, **columns: str
) -> DataFrame:
    """The measured documents with ``base_failed``, ``host_blocked`` and ``kept``.

    Kept are documents that fail no rule of ``base`` and whose host is not blocked. A document without a host
    (null) is judged by itself. Verdicts are joined in SALT parts a host, so a host with a third
    of all documents is no single task. Rows that are alike are judged alike; no rows give no rows.
    """
    facts = written(measured(docs, **columns), "measured")
    rates = host_rates(facts, rules)
    blocked = reduce(lambda a, b: a | b, [F.col(f"{name}_rate") > limit for name in rules])
    verdicts = written(rates.select(F.col("host").alias("of_host"), blocked.alias("blocked")), "verdicts")
    parts = verdicts.withColumn("of_part", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    dealt = facts.withColumn("part", F.pmod(F.xxhash64(*facts.columns), F.lit(SALT)).cast("int"))
    joined = dealt.join(parts, (F.col("host") == F.col("of_host")) & (F.col("part") == F.col("of_part")), "left")
    failed = reduce(lambda a, b: a | b, [F.expr(rules[name]) for name in base])
    out = joined.select(*facts.columns, failed.alias("base_failed"), F.coalesce("blocked", F.lit(False)).alias("host_blocked"))
    return out.withColumn("kept", ~F.col("base_failed") & ~F.col("host_blocked"))
