"""Expected against found numbers of records per rule and location.

Counting pairs every assigned record with all records of the same id, and every
rule with all of its locations. Neither pairing is written out: both sides are
counted per id first, the counts are multiplied, and only the finished totals are
repeated for the locations of the rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate import config
from tidegate.config import CHECK_ORDER, RULE_TEXT_COLUMNS
from tidegate.functions import text
from tidegate.operators.matching import order_key, require, with_assignments, with_rulesets
from tidegate.operators.references import References

SAMPLE_LEVEL = "monster.lokaalid"


def verdict(limit: str | Column, found: str | Column, expected: str | Column, kind: str) -> Column:
    """Why a count fails its limit, or an empty text. A missing expectation fails only ``=``."""
    limit, found, expected = text.as_col(limit), text.as_col(found), text.as_col(expected)
    return (
        F.when((limit == "<=") & (found > expected), f"aantal {kind} groter dan verwacht")
        .when((limit == ">=") & (found < expected), f"aantal {kind} kleiner dan verwacht")
        .when((limit == "=") & ~found.eqNullSafe(expected), f"aantal {kind} ongelijk aan verwachting")
        .otherwise("")
    )


def rule_locations(refs: References) -> DataFrame:
    """How often each rule lists each of its locations, with the rule's expectation."""
    return (
        refs.rules.select(
            F.col("rule_id").alias("validatieregel"),
            F.explode(F.split("locatiecode", ";")).alias("rule_location"),
            F.col("aantal").cast("bigint").alias("aantalval"),
            "limiet",
        )
        .groupBy("validatieregel", "rule_location", "aantalval", "limiet")
        .agg(F.count("*").alias("_copies"))
    )


def _with_level(df: DataFrame, refs: References) -> DataFrame:
    """Add the ids and whether the first rule of the bundle counts samples; bundles without rules go."""
    settings = refs.side(
        "settings", lambda: refs.ruleset_facts.select("ruleset", F.col("group_by").alias("_group_by"))
    )
    return df.join(settings, "ruleset").withColumns(
        {
            "databundelcode": F.col("clean_name"),
            "sample_id": text.strip_prefix("monster_lokaalid"),
            "by_sample": F.coalesce(F.col("_group_by") == SAMPLE_LEVEL, F.lit(False)),
        }
    )


def count_lines(df: DataFrame, refs: References, bundles: DataFrame | None = None) -> DataFrame:
    """Found count per rule, bundle, record location and rule location, with the verdict."""
    require(df, "monster_lokaalid")
    assigned = _with_level(with_assignments(df, refs, bundles), refs)
    if not refs.has_locations_column:
        assigned = assigned.where(F.lit(False))
    with_rule = (
        assigned.withColumn("validatieregel", F.get("matched", F.lit(0)))
        .where(F.col("validatieregel").isNotNull())
        .withColumn("ord", order_key(refs))
    )
    if refs.settings.compat:
        left = with_rule.groupBy("bundle", "databundelcode", "record_id", "validatieregel").agg(
            F.count("*").alias("_assigned"), F.min("ord").alias("_first")
        )
        counted_id = F.when(F.col("by_sample"), F.col("sample_id")).otherwise(F.col("record_id"))
        right = (
            _with_level(with_rulesets(df, refs, bundles), refs)
            .where(F.col("location_code").isNotNull())
            .groupBy("bundle", counted_id.alias("record_id"), "location_code")
            .agg(F.count("*").alias("_found"))
        )
        totals = (
            left.join(right, ["bundle", "record_id"])
            .groupBy("bundle", "databundelcode", "validatieregel", "location_code")
            .agg(
                F.sum(F.col("_assigned") * F.col("_found")).alias("_n"),
                F.min_by("record_id", "_first").alias("record_id"),
            )
        )
    else:
        # Counts only the rule's own locations, and distinct samples where the rule asks for them.
        located = with_rule.where(F.col("location_code").isNotNull())
        unit = F.when(F.col("by_sample"), F.col("sample_id"))
        keys = ["bundle", "databundelcode", "validatieregel", "location_code"]
        per_sample = located.groupBy(*keys, "by_sample", unit.alias("_unit")).agg(
            F.count("*").alias("_rows"), F.min(F.struct("ord", "record_id")).alias("_first")
        )
        counted = F.when(F.col("by_sample"), F.col("_unit").isNotNull().cast("bigint")).otherwise(F.col("_rows"))
        totals = per_sample.groupBy(*keys).agg(
            F.sum(counted).alias("_n"), F.min("_first")["record_id"].alias("record_id")
        )

    rules = refs.side("rule_locations", lambda: rule_locations(refs))
    lines = totals.join(rules, "validatieregel")
    if refs.settings.compat:
        lines = lines.withColumn("aantaldat", F.col("_n") * F.col("_copies"))
    else:
        lines = lines.where(F.col("location_code") == F.col("rule_location")).withColumn("aantaldat", F.col("_n"))
    return lines.select(
        "bundle",
        "databundelcode",
        "validatieregel",
        F.col("location_code").alias("data_location"),
        "rule_location",
        "record_id",
        "aantaldat",
        "limiet",
        "aantalval",
        verdict("limiet", "aantaldat", "aantalval", refs.settings.record_kind).alias("uitvalreden"),
    )


def count_failures(lines: DataFrame) -> DataFrame:
    """The lines that fail, as report failures; one per rule location."""
    info = F.concat(
        F.lit("aantal datarecords: "),
        F.col("aantaldat").cast("string"),
        F.lit(". aantal verwacht: "),
        text.shown("limiet"),
        F.lit(" "),
        text.shown("aantalval"),
    )
    return lines.where(F.col("uitvalreden") != "").select(
        "bundle",
        "databundelcode",
        "record_id",
        F.lit(CHECK_ORDER["counts"]).alias("check_ord"),
        F.lit(0).alias("col_ord"),
        F.lit(config.COUNTS).alias("section"),
        "uitvalreden",
        info.alias("informatie"),
        F.format_string("%012d|%s|%s", "validatieregel", "data_location", "rule_location").alias("line"),
    )


def rule_records(refs: References) -> DataFrame:
    """Every rule as one JSON record; values that differ between its location rows are joined."""
    columns = [c for c in (*RULE_TEXT_COLUMNS, "aantal") if c in refs.rules.columns]
    exploded = refs.exploded(refs.rules).withColumns(
        {c: F.date_format(c, "yyyy-MM-dd") for c in ("startdatum", "einddatum")}
    )
    merged = exploded.groupBy(F.col("rule_id").alias("validatieregel")).agg(
        *[
            F.array_join(F.array_sort(F.collect_set(F.col(c).cast("string"))), ";").alias(c)
            for c in columns
        ]
    )
    values = [F.nullif(F.col(c), F.lit("")).alias(c) for c in columns]
    record = F.to_json(F.struct(*values), {"ignoreNullFields": "false"})
    return merged.select("validatieregel", record.alias("_record"))


def count_report(lines: DataFrame, refs: References) -> DataFrame:
    """The count report: lines of equal content once, the rule as a JSON record."""
    return (
        lines.select(
            "bundle",
            "databundelcode",
            "record_id",
            F.col("data_location").alias("locatiecode_aantal"),
            "aantaldat",
            "limiet",
            "aantalval",
            "uitvalreden",
            F.lit("").alias("recordnrs"),
            "validatieregel",
        )
        .dropDuplicates()
        .join(refs.side("rule_records", lambda: rule_records(refs)), "validatieregel")
        .drop("validatieregel")
        .withColumnRenamed("_record", "validatieregel")
    )
