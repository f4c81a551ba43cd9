"""Which validation rules apply to which record.

Matching never groups or shuffles the records: every record meets at most one row
of the rule index (all rules that share its codes, location and apparatus), and
the rules of that row are tested against its date and taxon in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.config import APPARATUS, MATCH_COLUMNS
from tidegate.functions import dates, text
from tidegate.operators.references import References, match_key

NO_RULE, HAS_RULE = 5, 0


def require(df: DataFrame, *columns: str) -> None:
    """Raise before any job starts if the records lack a column."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"records lack column(s): {', '.join(missing)}")


def spread_nulls(key: Column, *order: str) -> Column:
    """Give records without a key many different ones that match nothing, so a shuffle spreads them."""
    filler = F.concat(F.lit("\u0000"), F.xxhash64(*order).cast("string"))
    return F.coalesce(key, filler)


def order_struct(refs: References) -> Column:
    return F.struct(*[F.col(c) for c in refs.settings.order_by])


def order_key(refs: References) -> Column:
    """One value that orders the records of a bundle: a plain column where one is enough."""
    order = refs.settings.order_by
    return F.col(order[0]) if len(order) == 1 else order_struct(refs)


def with_rulesets(df: DataFrame, refs: References, bundles: DataFrame | None = None) -> DataFrame:
    """Add the clean bundle name, the rule set and the stripped ids to every record.

    ``bundles`` (column ``bundle``) saves the pass that finds the bundle names.
    """
    require(df, "bundle", "meetwaarde_lokaalid", "meetobject_lokaalid", *refs.settings.order_by)
    names = refs.bundle_side(df if bundles is None else bundles)
    return df.join(names, "bundle", "left").withColumns(
        {
            "record_id": text.strip_prefix("meetwaarde_lokaalid"),
            "location_code": text.strip_prefix("meetobject_lokaalid"),
        }
    )


def with_memberships(df: DataFrame, refs: References) -> DataFrame:
    """Add the parameter key and the number of group rows of the rule set that hold it."""
    require(df, "parameter_code", "biotaxon_naam")
    keyed = df.withColumn("parameter_key", text.parameter_key())
    keyed = keyed.withColumn(
        "_member_key", spread_nulls(F.col("parameter_key"), *refs.settings.order_by)
    )
    side = refs.side("memberships", lambda: refs.memberships)
    on = (F.col("ruleset") == F.col("_side_ruleset")) & (F.col("_member_key") == F.col("_member"))
    return (
        keyed.join(side, on, "left")
        .withColumn("n_groups", F.coalesce("n_groups", F.lit(0)))
        .drop("_side_ruleset", "_member", "_member_key")
    )


def with_matches(df: DataFrame, refs: References) -> DataFrame:
    """Add ``matched``: the ids of all rules that apply to the record, lowest first."""
    require(df, "begindatum", "biotaxon_naam")
    present = [c for c in MATCH_COLUMNS if c in df.columns]
    apparatus = F.col(APPARATUS) if APPARATUS in df.columns else F.lit(None)
    keyed = df.withColumns(
        {
            "_apparatus": apparatus.cast("string"),
            "begin": dates.record_date("begindatum", day_first=not refs.settings.compat),
        }
    )
    keyed = keyed.withColumn("_key", match_key("ruleset", "location_code", "_apparatus", present))
    joined = keyed.join(refs.side("match", lambda: refs.match_index), F.col("_key") == F.col("_match_key"), "left")
    applies = lambda r: (
        (r["start"] <= F.col("begin"))
        & (F.col("begin") <= r["end"])
        & (F.col("biotaxon_naam").isNull() | r["taxa"])
    )
    in_groups = F.col("parameter_key").isNull() | (F.col("n_groups") >= 1)
    usable = in_groups & F.col("begin").isNotNull() & F.col("_rules").isNotNull()
    ids = F.transform(F.filter("_rules", applies), lambda r: r["rule_id"])
    none = F.lit([]).cast("array<int>")
    return joined.withColumn("matched", F.when(usable, ids).otherwise(none)).drop(
        "_apparatus", "_key", "_match_key", "_rules"
    )


def with_assignments(df: DataFrame, refs: References, bundles: DataFrame | None = None) -> DataFrame:
    """The records with everything rule matching finds out about them."""
    return with_matches(with_memberships(with_rulesets(df, refs, bundles), refs), refs)


def assignments(df: DataFrame, refs: References, bundles: DataFrame | None = None) -> DataFrame:
    """One row per record of a bundle that has rules: the rules that apply and the outcome code."""
    require(df, "monster_lokaalid")
    assigned = with_assignments(df, refs, bundles).where(F.col("ruleset").isNotNull())
    if not refs.has_locations_column:
        assigned = assigned.where(F.lit(False))
    return assigned.select(
        "bundle",
        F.col("clean_name").alias("databundelcode"),
        *refs.settings.order_by,
        "record_id",
        F.when(F.size("matched") > 0, HAS_RULE).otherwise(NO_RULE).alias("uitvalreden"),
        F.col("matched").alias("mogelijke_validatieregels"),
        F.get("matched", F.lit(0)).alias("validatieregel"),
        F.when(F.col("n_groups") > 1, 1).otherwise(0).alias("betreftverzameling"),
        F.col("monster_lokaalid").alias("monster_identificatie"),
    )


def groups_for_rules(groups: DataFrame, rules: DataFrame) -> DataFrame:
    """The group rows whose group some rule names."""
    named = rules.select(F.col("groep").alias("_named")).distinct()
    return groups.join(named, F.col("groep").eqNullSafe(F.col("_named")), "left_semi")
