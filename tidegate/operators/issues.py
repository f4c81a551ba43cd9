"""Drill-down into one or many count reports: issues, per-location summary, next steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions import dates, labels

NO_LOCATION = "null"


def issue_details(report: DataFrame, compat: bool = True) -> DataFrame:
    """The issues of a count report with severity, texts and the picked fields of the rule.

    The established texts call the found count "expected" and the other way round;
    ``compat=False`` puts them right.
    """
    rows = report.where(
        (F.coalesce("databundelcode", F.lit("")) != "") & (F.coalesce("uitvalreden", F.lit("")) != "")
    )
    found, wanted = F.col("aantaldat"), F.col("aantalval")
    first, second = (found, wanted) if compat else (wanted, found)
    record = labels.rule_record("validatieregel")
    return rows.withColumn("_record", record).select(
        "databundelcode",
        "record_id",
        labels.severity("uitvalreden").alias("severity"),
        F.lit("Data Validatie").alias("category"),
        labels.issue_description(F.col("locatiecode_aantal"), F.col("uitvalreden"), first, second).alias("description"),
        F.lit("aantal monsters").alias("field"),
        F.concat(
            F.coalesce(first.cast("string"), F.lit("null")),
            F.lit(" ("),
            F.coalesce("limiet", F.lit("null")),
            F.lit(")"),
        ).alias("expected_value"),
        F.coalesce(F.nullif(second.cast("string"), F.lit("")), F.lit("Onbekend")).alias("actual_value"),
        labels.recommendation(F.col("uitvalreden"), first, second).alias("recommendation"),
        F.coalesce(F.nullif("locatiecode_aantal", F.lit("")), F.lit("Onbekend")).alias("location"),
        F.col("_record")["criteria"].alias("rule_criteria"),
        F.col("_record")["grootheid_code"].alias("rule_grootheid"),
        F.col("_record")["groep"].alias("rule_groep"),
        F.col("_record")["leverdatum"].alias("rule_leverdatum"),
        "uitvalreden",
        "locatiecode_aantal",
    )


def issues_with_bundle(issues: DataFrame, overview: DataFrame) -> DataFrame:
    """Issues with the criterion and status of their bundle, found by the name with blanks."""
    info = overview.groupBy(F.translate("databundelcode", "+", " ").alias("databundelcode")).agg(
        F.min("krmcriterium").alias("krmcriterium"), F.min("combined_status").alias("combined_status")
    )
    return issues.join(info, "databundelcode", "left")


def issue_summary(issues: DataFrame) -> DataFrame:
    """Issues per bundle and location, one row per reason with its count.

    The list of reasons of a location is kept whole as reason and count.
    """
    location = F.coalesce("locatiecode_aantal", F.lit(NO_LOCATION))
    reasons = issues.groupBy("databundelcode", location.alias("location"), F.col("uitvalreden").alias("reason")).agg(
        F.count("*").alias("reason_count")
    )
    totals = reasons.groupBy("databundelcode", "location").agg(F.sum("reason_count").alias("location_count"))
    return reasons.join(totals, ["databundelcode", "location"])


def issue_totals(issues: DataFrame) -> DataFrame:
    """Per bundle: issues, high-severity issues, locations and distinct descriptions."""
    location = F.coalesce("locatiecode_aantal", F.lit(NO_LOCATION))
    return (
        issues.groupBy("databundelcode", location.alias("_location"), "description")
        .agg(F.count("*").alias("_n"), F.count_if(F.col("severity") == "High").alias("_high"))
        .groupBy("databundelcode")
        .agg(
            F.sum("_n").alias("total_issues"),
            F.sum("_high").alias("high_severity"),
            F.countDistinct("_location").alias("affected_locations"),
            F.countDistinct("description").alias("issue_types"),
        )
    )


def next_steps(totals: DataFrame, today: str | Column) -> DataFrame:
    """What to do next per bundle, in order, with deadlines."""

    def step(number: int, description: Column, days: int, wanted: Column) -> Column:
        row = F.struct(
            F.lit(number).alias("step"),
            description.alias("description"),
            F.lit(False).alias("completed"),
            dates.deadline(today, days).alias("deadline"),
        )
        return F.when(wanted, row)

    number = lambda c: F.col(c).cast("string")
    high = F.concat(
        F.lit("Corrigeer kritieke data problemen ("), number("high_severity"), F.lit(" gevallen)")
    )
    counts = F.concat(
        F.lit("Controleer monster aantal inconsistenties op "), number("affected_locations"), F.lit(" locatie(s)")
    )
    some = F.col("total_issues") > 0
    steps = F.array(
        step(1, high, 7, some & (F.col("high_severity") > 0)),
        step(2, counts, 14, some),
        step(3, F.lit("Evalueer data verzamel methodologie"), 21, some & (F.col("issue_types") > 1)),
        step(4, F.lit("Herzend gecorrigeerde dataset na fixes"), 28, some),
        step(5, F.lit("Nieuwe validatie aanvragen"), 35, some),
    )
    return totals.select("databundelcode", F.inline(F.array_compact(steps)))
