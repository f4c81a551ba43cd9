"""Publication: criteria, export schema, export gate, merging of exported layers, status rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions import projections, text, wkb
from tidegate.operators.references import References

# The published columns in order. Two kinds are numbers, one is binary.
EXPORT_COLUMNS = (
    "meetobject.lokaalid",
    "monster.lokaalid",
    "meetwaarde.lokaalid",
    "monstercompartiment.code",
    "begindatum",
    "begintijd",
    "einddatum",
    "eindtijd",
    "tijd_utcoffset",
    "typering.code",
    "grootheid.code",
    "parameter.code",
    "parameter.omschrijving",
    "biotaxon.naam",
    "eenheid.code",
    "hoedanigheid.code",
    "waardebewerkingsmethode.code",
    "limietsymbool",
    "numeriekewaarde",
    "alfanumeriekewaarde",
    "kwaliteitsoordeel.code",
    "orgaan.code",
    "organisme.naam",
    "bemonsteringsapparaat.omschrijving",
    "geometriepunt.x",
    "geometriepunt.y",
    "referentiehorizontaal.code",
    "begindiepte_m",
    "einddiepte_m",
    "referentievlak.code",
    "bemonsteringsmethode.code",
    "bemonsteringsmethode.codespace",
    "waardebepalingstechniek.code",
    "monprog.naam",
    "krmcriterium",
    "meetobject.namespace",
    "levensstadium.code",
    "lengteklasse.code",
    "geslacht.code",
    "verschijningsvorm.code",
    "levensvorm.code",
    "waardebepalingsmethode.code",
    "geom",
)
NUMBERS = {"numeriekewaarde", "geometriepunt.x", "geometriepunt.y"}
BINARIES = {"geom"}

# Columns that never leave the validation, and those dropped on publishing.
NOT_EXPORTED = ("resultaatdatum", "namespace", "analysecompartiment_code")
NOT_PUBLISHED = (
    "parameter",
    "record_id",
    "locatiecode",
    "locatie.code",
    "cleaned_lokaalid",
    "cleaned_meetwaarde_lokaalid",
    "recordnr_monster",
    "uitvalreden",
    "informatie",
)


def first_rules(refs: References) -> DataFrame:
    """Criteria and code of the first rule of every rule set."""
    return refs.side("first_rules", lambda: refs.ruleset_facts.select("ruleset", "criteria", "first_code"))


def expand_criteria(df: DataFrame, refs: References, bundles: DataFrame | None = None) -> DataFrame:
    """Every record once per criterion of its bundle's first rule; unchanged where no rule applies."""
    names = df if bundles is None else bundles

    def per_bundle() -> DataFrame:
        return refs.bundle_rulesets(names).join(first_rules(refs), "ruleset", "left").select(
            "bundle", F.split("criteria", ";").alias("_criteria"), F.col("first_code").alias("_code")
        )

    expanded = df.join(refs.side(("criteria", names), per_bundle), "bundle", "left").withColumn(
        "_criterion", F.explode_outer("_criteria")
    )
    own = lambda c: F.col(c) if c in df.columns else F.lit(None).cast("string")
    has_rule = F.col("_code").isNotNull()
    return expanded.withColumns(
        {
            "krmcriterium": F.when(has_rule, F.concat(F.lit("ANSNL-"), F.col("_criterion"))).otherwise(own("krmcriterium")),
            "monprog_naam": F.when(has_rule, F.col("_code")).otherwise(own("monprog_naam")),
        }
    ).drop("_criteria", "_code", "_criterion")


def with_geometry(df: DataFrame) -> DataFrame:
    """``df`` with the point of its coordinates as ``geom``; once a record, so before its criteria are expanded."""
    if "geom" in df.columns or not {"lon", "lat"} <= set(df.columns):
        return df
    return df.withColumn("geom", wkb.point("lon", "lat"))


def export_columns(df: DataFrame, dotted: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """The published columns that exist, in order and type; a number that does not parse is null.

    ``keep`` names further columns to put in front, such as the partition column ``bundle``.
    """
    df = with_geometry(df.drop(*NOT_EXPORTED))
    chosen: list[Column] = [F.col(c) for c in keep]
    for name in EXPORT_COLUMNS:
        inner = name.replace(".", "_")
        if inner in df.columns:
            kind = "double" if name in NUMBERS else "binary" if name in BINARIES else "string"
            c = F.col(inner)
            value = c if kind == "binary" else c.try_cast(kind)
            chosen.append(value.alias(name if dotted else inner))
    return df.select(*chosen)


def gate(df: DataFrame, refs: References, summary: DataFrame) -> DataFrame:
    """The records of the bundles that may be exported: valid, or approved by hand.

    The summary is what all checks together yield, so it is computed once, here.
    """
    may_leave = F.col("bundle_valid") | F.col("has_akkoord")
    passed = refs.side(("passed", summary), lambda: summary.where(may_leave).select("bundle"))
    return df.join(passed, "bundle", "left_semi")


def merge_layers(*layers: DataFrame) -> DataFrame:
    """Exported layers as one dataset: coordinates in degrees, lower-case names, all columns.

    A layer with a column ``crs`` is moved from the system that each row names: its geometries of any kind, and
    its coordinates ``lon, lat`` if it has them. A system that is not known is an error.
    """
    merged = None
    for layer in layers:
        named = layer.toDF(*[c.lower() for c in layer.columns])
        if "crs" in named.columns:
            if "geom" in named.columns:
                named = named.withColumn("geom", wkb.to_lonlat("geom", "crs"))
            if {"lon", "lat"} <= set(named.columns):
                moved = named.withColumn("_moved", projections.degrees("crs", "lon", "lat"))
                named = moved.withColumns({"lon": F.col("_moved.lon"), "lat": F.col("_moved.lat")}).drop("_moved")
            named = named.drop("crs")
        merged = named if merged is None else merged.unionByName(named, allowMissingColumns=True)
    return merged.drop(*NOT_PUBLISHED)


def status_rows(refs: References, summary: DataFrame, now: Column) -> DataFrame:
    """One status row per bundle: first criterion of its first rule, time, and status sentence."""
    from tidegate.operators.report import status_text

    names = refs.bundle_rulesets(summary)
    criterion = F.concat(F.lit("ANSNL-"), F.get(F.split("criteria", ";"), F.lit(0)))
    return (
        summary.join(names.select("bundle", "ruleset"), "bundle")
        .join(first_rules(refs), "ruleset", "left")
        .select(
            F.col("bundle").alias("databundelcode"),
            criterion.alias("krmcriterium"),
            F.date_format(now, "yyyy-MM-dd HH:mm:ss").alias("last_updated"),
            status_text().alias("status"),
        )
    )


def upsert_status(target: DataFrame, updates: DataFrame) -> DataFrame:
    """Status table with the updates applied: three fields replaced by key, new keys appended.

    ``updates`` holds a key once. Written as a left join and an anti join because, unlike a
    full outer join, both can be split when many rows share one key.
    """
    fields = ("krmcriterium", "last_updated", "status")
    new = updates.select(
        F.col("databundelcode").alias("_key"), *[F.col(f).alias(f"_new_{f}") for f in fields]
    )
    hit = F.col("_key").isNotNull()
    kept = target.join(new, F.col("databundelcode") == F.col("_key"), "left").select(
        *[
            F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c)
            for c in target.columns
        ]
    )
    known = target.select("databundelcode").distinct()
    added = updates.join(known, "databundelcode", "left_anti").select("databundelcode", *fields)
    return kept.unionByName(added, allowMissingColumns=True)
