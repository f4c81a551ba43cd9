"""Checks that look at one record at a time, all of them in one pass over the records.

Each check is a condition. The numbers of the conditions that hold are exploded to
one row per failure, and only those rows get their texts. Conditions and texts use
no lambda functions, so the pass stays in generated code; the few expressions that
do need lambdas sit in projections of their own.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate import config
from tidegate.config import CHECK_ORDER
from tidegate.functions import dates, geo, text
from tidegate.operators.matching import (
    order_struct,
    require,
    spread_nulls,
    with_matches,
    with_memberships,
    with_rulesets,
)
from tidegate.operators.references import TEXT_SEPARATOR, References
from tidegate.operators.shapes import tile_distances

# What the fixed-value checks accept. Records are read as text, so the
# whole-number spellings of the quality codes are listed too.
QUALITY_CODES = ("00", "03", "04", "25", "99", "0", "3", "4")
HORIZONTAL_REFERENCES = ("EPSG:4258", "EPSG4258")
NAMESPACE = "NL80"
LIMIT_SYMBOLS = ("<", ">")

GEO_CHECKS = ("unknown_location", "location_distance")
FIXED_VALUE_CHECKS = ("quality_code", "namespace", "horizontal_reference", "analysis_compartment")
OTHER_CHECKS = ("missing_value", "limit_symbol")
ROW_CHECKS = (
    *GEO_CHECKS,
    "mandatory_columns",
    "value_in_any_rule",
    *FIXED_VALUE_CHECKS,
    "records_without_rule",
    *OTHER_CHECKS,
    "date_range",
)


@dataclass
class Check:
    """When a record fails, and what the report says about it."""

    name: str
    section: str
    reason: str
    when: Column
    info: Column
    column: int = 0


def in_file(columns: list[str], name: str) -> Column:
    """Does the bundle's own file have the column? Taken for granted if its header is not known."""
    if "header" not in columns or name == "location_code":
        return F.lit(True)
    return F.col("header").isNull() | F.array_contains("header", name)


# Columns that no delivery brings.
OWN = ("bundle", "row_ord", "extras", "header", "lon", "lat")
HITS = "array<struct<check:int,place:int>>"


def _absent() -> Column:
    """Mandatory columns besides the known ones that the bundle's file has without a value in this record."""
    given = F.coalesce(F.col("extras"), F.create_map().cast("map<string,string>"))
    return F.filter("_others", lambda o: F.map_contains_key(given, o["name"]) & given[o["name"]].isNull())


def _mandatory(columns: list[str], refs: References) -> list[Check]:
    return [
        Check(
            "mandatory_columns",
            config.MANDATORY,
            "verplichte kolom is leeg",
            F.col(name).isNull() & in_file(columns, name),
            F.lit(f"geen waarde in bestand voor: {label}"),
            position,
        )
        for position, (label, name) in enumerate(refs.mandatory_names([c for c in columns if c not in OWN]), start=1)
    ]


def _value_tests(columns: list[str]) -> list[tuple[str, str, str]]:
    """(record column, rule column, label) in the order of the test."""
    tests = [(c, c, label) for c, label in config.VALUE_COLUMNS if c in columns]
    return [*tests, ("location_code", "locatiecode", "Locatiecode")]


def _unsuited(columns: list[str], refs: References) -> Column:
    """Number of the first column whose value suits no rule of the bundle, else null.

    The texts of all rules are searched at once: a value is part of some rule text if it is
    part of their concatenation and does not hold the separator itself.
    """
    chain = F
    for number, (data, rule, _) in enumerate(_value_tests(columns)):
        value, texts, without = F.col(data).cast("string"), F.col(f"text_{rule}"), F.col(f"without_{rule}")
        if not refs.settings.compat:
            listed = texts.contains(F.concat(F.lit(";"), value, F.lit(";"))) & ~value.contains(";")
            suits = F.when(value.isNull(), without).otherwise(listed)
        elif rule == "locatiecode":
            # a missing location suits a rule without locations, and only that
            suits = F.when(value.isNull(), without).otherwise(
                texts.contains(value) & ~value.contains(TEXT_SEPARATOR)
            )
        else:
            shown = text.shown(value)
            suits = texts.contains(shown) & ~shown.contains(TEXT_SEPARATOR)
        bad = ~F.coalesce(suits, F.lit(False))
        if "header" in columns:
            bad = bad & in_file(columns, data)
        chain = chain.when(bad, number)
    return F.when(F.col("ruleset").isNotNull(), chain)


def _value_check(columns: list[str]) -> Check:
    tests = _value_tests(columns)
    pick = lambda parts: F.element_at(F.array(*parts), F.col("_unsuited") + 1)
    info = F.concat(
        pick([F.lit(label) for _, _, label in tests]),
        F.lit(" '"),
        pick([text.shown(data) for data, _, _ in tests]),
        F.lit("' niet in: {"),
        pick([F.col(f"shown_{rule}") for _, rule, _ in tests]),
        F.lit("}"),
    )
    return Check(
        "value_in_any_rule", config.COLUMN_VALUE, "ongeldige code", F.col("_unsuited").isNotNull(), info
    )


def _distance_check(refs: References, metres: Column) -> Check:
    info = F.concat(
        F.lit("afstand van locatie: "),
        text.shown("location_code"),
        F.lit(": "),
        metres.cast("bigint").cast("string"),
        F.lit("m"),
    )
    limit = refs.settings.max_location_distance_m
    return Check("location_distance", config.GEO, "locatie verder dan 100 meter", F.col("_metres") > limit, info)


def _fixed(name: str, when: Column, info: Column) -> Check:
    return Check(name, config.FIXED_VALUES, "vaste waarde ongeldig", when, info)


def _not_among(value: Column, allowed: tuple[str, ...]) -> Column:
    return ~F.coalesce(value.isin(*allowed), F.lit(False))


def _quoted(before: str, value: Column, after: str) -> Column:
    return F.concat(F.lit(f'{before} "'), text.shown(value), F.lit(f'" {after}'))


def _build(name: str, columns: list[str], refs: References) -> list[Check]:
    c = F.col
    if name == "unknown_location":
        info = F.concat(F.lit("onbekende locatie: "), text.shown("location_code"))
        return [Check(name, config.GEO, "onbekende locatie", c("_known_location").isNull(), info)]
    if name == "location_distance":
        return [_distance_check(refs, c("_metres"))]
    if name == "mandatory_columns":
        return _mandatory(columns, refs)
    if name == "value_in_any_rule":
        return [_value_check(columns)]
    if name == "quality_code":
        code = c("kwaliteitsoordeel_code").cast("string")
        info = _quoted("Kwaliteitsoordeel", code, "niet in (00,03,04,25,99)")
        return [_fixed(name, _not_among(code, QUALITY_CODES), info)]
    if name == "namespace":
        differs = ~c("namespace").eqNullSafe(NAMESPACE)
        return [_fixed(name, differs, _quoted("Namespace", c("namespace"), 'ongelijk aan "NL80"'))]
    if name == "horizontal_reference":
        code = c("referentiehorizontaal_code")
        info = _quoted("Referentiehorizontaal.code", code, 'ongelijk aan "EPSG:4258"')
        return [_fixed(name, _not_among(code, HORIZONTAL_REFERENCES), info)]
    if name == "analysis_compartment":
        filled = c("analysecompartiment_code").isNotNull()
        return [_fixed(name, filled, F.lit("analysecompartiment_code is niet leeg"))]
    if name == "records_without_rule":
        if not refs.has_locations_column:
            return []
        none = c("ruleset").isNotNull() & (F.size("matched") == 0)
        info = F.lit("geen enkele validatieregel van toepassing")
        return [Check(name, config.RULES, "geen validatieregel", none, info)]
    if name == "missing_value":
        empty = c("numeriekewaarde").isNull() & c("alfanumeriekewaarde").isNull()
        info = F.lit("numerieke EN alfanumerieke waarde zijn leeg")
        return [Check(name, config.OTHER, "waarde ontbreekt", empty, info)]
    if name == "limit_symbol":
        other = c("limietsymbool").isNotNull() & ~c("limietsymbool").isin(*LIMIT_SYMBOLS)
        info = F.lit("limietsymbool dient leeg te zijn of < of >")
        return [Check(name, config.OTHER, "limietsymbool ongeldig", other, info)]
    within = F.coalesce(c("begin").between(c("min_start"), c("max_end")), F.lit(False))
    info = F.concat(
        dates.report_date("begin"),
        F.lit(" valt buiten datumbereik validatieregels ("),
        dates.report_date("min_start"),
        F.lit(" tm "),
        dates.report_date("max_end"),
        F.lit(")"),
    )
    return [Check(name, config.DATES, "datum valt buiten bereik", c("ruleset").isNotNull() & ~within, info)]


# Record columns a check cannot do without.
_NEEDS = {
    "location_distance": ("lon", "lat"),
    "quality_code": ("kwaliteitsoordeel_code",),
    "namespace": ("namespace",),
    "horizontal_reference": ("referentiehorizontaal_code",),
    "analysis_compartment": ("analysecompartiment_code",),
    "missing_value": ("numeriekewaarde", "alfanumeriekewaarde"),
    "limit_symbol": ("limietsymbool",),
    "date_range": ("begindatum",),
}


def with_locations(df: DataFrame, refs: References) -> DataFrame:
    """Look up every record's location; ``_known_location`` stays null where there is none."""
    looked_up = df.withColumn(
        "_location_key", spread_nulls(F.col("location_code"), *refs.settings.order_by)
    )
    side = refs.side("locations", lambda: refs.location_index)
    return looked_up.join(side, F.col("_location_key") == F.col("_known_location"), "left").drop("_location_key")


def with_distances(df: DataFrame, refs: References) -> DataFrame:
    """Metres to the location's (first) point, and an array of metres to its other geometries."""
    placed = geo.with_utm31(df, "lon", "lat", "_x", "_y")
    x, y = F.col("_x"), F.col("_y")
    near = placed.withColumn("_metres", geo.point_distance(x, y, F.col("_point_x"), F.col("_point_y")))
    none = F.lit([]).cast("array<double>")
    if refs.plain_locations:
        return near.withColumn("_metres_more", none)
    to_points = F.transform("_more_points", lambda p: geo.point_distance(x, y, p["x"], p["y"]))
    more = near.withColumn("_metres_more", F.coalesce(to_points, none))
    return _with_shape_distances(more, refs) if refs.shaped_locations else more


def _with_shape_distances(df: DataFrame, refs: References) -> DataFrame:
    """Add the metres to the lines and areas of each record's location; a place is looked at once for all its records.

    Places are told apart by their degrees and projected once each: a filter on the projected place would
    project it again for every record and every use.
    """
    lon, lat = geo.finite("lon"), geo.finite("lat")
    complete = F.col("_shaped") & lon.isNotNull() & lat.isNotNull()
    degrees = df.where(complete).select(F.col("location_code").alias("location"), lon.alias("lon"), lat.alias("lat")).distinct()
    places = geo.with_utm31(degrees, "lon", "lat", "x", "y")
    metres = F.array_sort(F.collect_list("metres")).alias("_metres_shapes")
    found = tile_distances(places, refs.edge_tiles).groupBy("location", "lon", "lat").agg(metres)
    keyed = found.withColumnsRenamed({"location": "_at_location", "lon": "_at_lon", "lat": "_at_lat"})
    spread = spread_nulls(F.when(complete, F.col("location_code")), *refs.settings.order_by)
    at = {"_place": spread, "_lon": lon, "_lat": lat}
    same = (F.col("_place") == F.col("_at_location")) & (F.col("_lon") == F.col("_at_lon")) & (F.col("_lat") == F.col("_at_lat"))
    joined = df.withColumns(at).join(keyed, same, "left")
    both = F.concat("_metres_more", F.coalesce("_metres_shapes", F.lit([]).cast("array<double>")))
    return joined.withColumn("_metres_more", both).drop(*at, *keyed.columns)


def row_failures(
    df: DataFrame, refs: References, checks: Iterable[str] = ROW_CHECKS, bundles: DataFrame | None = None
) -> DataFrame:
    """Failures of the wanted single-record checks, one row each, in one pass."""
    wanted = list(checks)
    unknown = set(wanted) - set(ROW_CHECKS)
    if unknown:
        raise ValueError(f"unknown check(s): {', '.join(sorted(unknown))}")
    for check in wanted:
        require(df, *_NEEDS.get(check, ()))

    work = with_rulesets(df, refs, bundles)
    if "records_without_rule" in wanted and refs.has_locations_column:
        work = with_matches(with_memberships(work, refs), refs)
    elif "date_range" in wanted:
        work = work.withColumn("begin", dates.record_date("begindatum", day_first=not refs.settings.compat))
    if set(GEO_CHECKS) & set(wanted):
        work = with_locations(work, refs)
    far_more = False
    if "location_distance" in wanted:
        work = with_distances(work, refs)
        far_more = not refs.plain_locations
        if far_more:
            limit = refs.settings.max_location_distance_m
            work = work.withColumn("_far_more", F.filter("_metres_more", lambda d: d > limit))
    columns = [*df.columns, *(["header"] if "header" in work.columns else [])]
    if {"value_in_any_rule", "date_range"} & set(wanted):
        work = work.join(refs.ruleset_facts, "ruleset", "left")
    if "value_in_any_rule" in wanted:
        work = work.withColumn("_unsuited", _unsuited(columns, refs))

    rows = [c for check in wanted for c in _build(check, columns, refs)]
    # a hit names its check, and its place where a check can fail several times for one record
    numbers = F.array(*[F.when(c.when, F.struct(F.lit(number).alias("check"), F.lit(-1).alias("place"))) for number, c in enumerate(rows)])
    several = lambda number, found: F.transform(F.sequence(F.lit(0), F.size(found) - 1), lambda i: F.struct(F.lit(number).alias("check"), i.alias("place")))
    extra = "extras" in df.columns and "mandatory_columns" in wanted
    # what needs a lambda function stands in columns of its own, so that the rest, and the exploding, stay in generated code
    more = []
    if extra:
        # in a column of its own first: a lambda function can't hold a subquery
        work = work.withColumn("_others", refs.mandatory_others([c for c in columns if c not in OWN]))
        work = work.withColumn("_absent", _absent()).drop("_others")
        rows.append(Check("mandatory_columns", config.MANDATORY, "verplichte kolom is leeg", F.lit(False), F.lit("")))
        more.append(F.when(F.size("_absent") > 0, several(len(rows) - 1, F.col("_absent"))).otherwise(F.array().cast(HITS)))
    if far_more:
        distance = next(i for i, c in enumerate(rows) if c.name == "location_distance")
        more.append(F.when(F.size("_far_more") > 0, several(distance, F.col("_far_more"))).otherwise(F.array().cast(HITS)))
    if more:
        work = work.withColumn("_hits", F.concat(*more)).withColumn("_hits", F.concat(numbers, F.col("_hits")))
        numbers = F.col("_hits")
    # the outer kind, as for the other Spark makes the array a second time to see whether it is empty
    hits = work.withColumn("_hit", F.explode_outer(numbers)).where(F.col("_hit").isNotNull())

    which, place, infos = F.col("_hit.check"), F.col("_hit.place"), F
    if far_more:
        more = _distance_check(refs, F.get("_far_more", place))
        infos = infos.when((which == distance) & (place >= 0), more.info)
    if extra:
        absent = F.get("_absent", place)
        infos = infos.when((which == len(rows) - 1) & (place >= 0), F.concat(F.lit("geen waarde in bestand voor: "), absent["label"]))
    for number, c in enumerate(rows):
        infos = infos.when(which == number, c.info)
    table = [(CHECK_ORDER[c.name], c.column, c.section, c.reason) for c in rows]
    constant = lambda i: F.element_at(F.lit([row[i] for row in table]), which + 1)
    return hits.select(
        "bundle",
        F.col("clean_name").alias("databundelcode"),
        "record_id",
        order_struct(refs).alias("ord"),
        constant(0).alias("check_ord"),
        (F.when((which == len(rows) - 1) & (place >= 0), len(columns) + absent["ord"]).otherwise(constant(1)) if extra else constant(1)).alias("col_ord"),
        constant(2).alias("section"),
        constant(3).alias("uitvalreden"),
        infos.alias("informatie"),
    )
