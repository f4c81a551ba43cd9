"""Reference tables (rules, groups, column definition, locations) and the rule sets.

Which rules apply to a bundle is decided by its name: a rule applies when its
bundle code is a prefix of the name. All codes that are prefixes of one name are
prefixes of the longest of them, so the longest matching code names the whole
*rule set*. Everything prepared here is keyed by that code: its size follows the
rule list and not the number of bundles or records.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.config import APPARATUS, MATCH_COLUMNS, RULE_TEXT_COLUMNS, VALUE_COLUMNS, Settings
from tidegate.functions import dates, geo, text
from tidegate.operators.shapes import edge_tiles
from tidegate.runtime import Settled, forget, settled, source_state

# Stands for a missing group name, so that missing meets missing in plain comparisons.
NO_GROUP = "\u0000"
# Separates the rule texts that one search looks through; a value that holds it matches nothing.
TEXT_SEPARATOR = "\u0001"


def normalise_rules(rules: DataFrame) -> DataFrame:
    """Lower-case headers, accept both spellings of the location column, add absent columns as null."""
    names = [c.strip().lower() for c in rules.columns]
    aliases = {"locatie.code": "locatiecode", "locatie_code": "locatiecode"}
    named = rules.toDF(*[aliases.get(n, n).replace(".", "_") for n in names])
    absent = {c: F.lit(None).cast("string") for c in RULE_TEXT_COLUMNS if c not in named.columns}
    if "aantal" not in named.columns:
        absent["aantal"] = F.lit(None).cast("int")
    columns = ["rule_id", *RULE_TEXT_COLUMNS, "aantal"]
    return named.withColumns(absent).select(*columns).withColumn("rule_id", F.col("rule_id").cast("int"))


def prefixes_of(value: Column, lengths: Column) -> Column:
    """The prefixes of ``value`` with the given lengths, none longer than the value itself."""
    fitting = F.filter(lengths, lambda n: n <= F.length(value))
    return F.transform(fitting, lambda n: F.substring(value, F.lit(1), n))


@dataclass
class References:
    """The reference tables of a run and what is derived from them.

    ``rules`` carry ``rule_id``; ``points`` is ``(mpnident, lon, lat)``; ``rings`` is
    ``(mpnident, geom, ring, vertex, lon, lat, area)`` for lines and polygons.
    """

    rules: DataFrame
    groups: DataFrame | None = None
    columns: DataFrame | None = None
    points: DataFrame | None = None
    rings: DataFrame | None = None
    settings: Settings = field(default_factory=Settings)

    def __post_init__(self) -> None:
        # A list without any location column gives no assignments and no counts.
        spellings = {"locatiecode", "locatie.code", "locatie_code"}
        self.has_locations_column = any(c.strip().lower() in spellings for c in self.rules.columns)
        self._sides: dict[object, Settled] = {}
        self._listed = normalise_rules(self.rules)
        self.rules = self._settle("all rules", lambda: self._listed).table
        self._state: tuple | None = None

    def _settle(self, name: object, build: Callable[[], DataFrame]) -> Settled:
        if name not in self._sides:
            self._sides[name] = settled(build())
        return self._sides[name]

    def side(self, name: object, build: Callable[[], DataFrame]) -> DataFrame:
        """A look-up table for joins: computed once, written, and read back as a plain table."""
        return self._settle(name, build).table

    def clear(self) -> None:
        """Forget everything derived, so that changed source files are read again."""
        forget(self._sides.values())
        self._sides.clear()
        for name in [n for n, v in vars(type(self)).items() if isinstance(v, cached_property)]:
            self.__dict__.pop(name, None)
        self.rules = self._settle("all rules", lambda: self._listed).table

    def refresh(self) -> None:
        """``clear`` if a file behind the reference tables has changed since the last call.

        What was derived for single deliveries is dropped in any case.
        """
        state = source_state(self._listed, self.groups, self.columns, self.points, self.rings)
        if self._state is not None and state != self._state:
            self.clear()
        self._state = state
        own = [n for n in self._sides if not isinstance(n, str)]
        forget(self._sides[n] for n in own)
        for name in own:
            del self._sides[name]

    # -- rule sets ---------------------------------------------------------

    def _codes(self) -> Settled:
        code = F.col("databundelcode")
        return self._settle("codes", lambda: self.rules.where(code.isNotNull()).select(code.alias("ruleset")).distinct())

    @property
    def codes(self) -> DataFrame:
        return self._codes().table

    def _with_prefixes(self, df: DataFrame, name: str) -> DataFrame:
        side = self._codes()
        if "lengths" not in side.facts:
            # as many rows as codes have different lengths
            rows = side.table.select(F.length("ruleset").alias("n")).distinct().collect()
            side.facts["lengths"] = sorted(r["n"] for r in rows)
        lengths = F.lit(side.facts["lengths"]).cast("array<int>")
        return df.withColumn("_prefix", F.explode(prefixes_of(F.col(name), lengths)))

    @cached_property
    def ruleset_rules(self) -> DataFrame:
        """One row per rule set and rule in it."""
        prefixed = self._with_prefixes(self.codes, "ruleset")
        return self.side("rules", lambda: self.rules.join(prefixed, F.col("databundelcode") == F.col("_prefix")).drop("_prefix"))

    def bundle_rulesets(self, bundles: DataFrame) -> DataFrame:
        """``bundle`` names with their clean name and rule set (null if no code is a prefix).

        A ``header`` (the columns the bundle's file really has) is kept.
        """
        names = bundles.select("bundle").distinct()
        if "header" in bundles.columns:
            names = bundles.groupBy("bundle").agg(F.first("header", True).alias("header"))
        names = names.withColumn("clean_name", text.clean_bundle("bundle"))
        hits = self._with_prefixes(names.select("bundle", "clean_name"), "clean_name").join(
            self.codes, F.col("_prefix") == F.col("ruleset")
        )
        longest = hits.groupBy("bundle").agg(F.max_by("ruleset", F.length("ruleset")).alias("ruleset"))
        return names.join(longest, "bundle", "left")

    def select_rules(self, bundles: DataFrame) -> DataFrame:
        """The rules of every bundle."""
        named = self.bundle_rulesets(bundles).select("bundle", "ruleset")
        return named.join(self.ruleset_rules, "ruleset").drop("ruleset")

    def bundle_side(self, bundles: DataFrame) -> DataFrame:
        """The rule set of every bundle, to join to its records."""
        return self.side(("bundles", bundles), lambda: self.bundle_rulesets(bundles))

    def exploded(self, rules: DataFrame) -> DataFrame:
        """One row per rule and location code, rule dates read as dates."""
        strict = self.settings.strict_rule_dates
        return rules.withColumns(
            {
                "locatiecode": F.explode_outer(F.split("locatiecode", ";")),
                "startdatum": dates.rule_date("startdatum", strict),
                "einddatum": dates.rule_date("einddatum", strict),
            }
        )

    # -- look-up tables for the record passes --------------------------------

    @cached_property
    def ruleset_facts(self) -> DataFrame:
        return self.side("facts", self._ruleset_facts)

    def _ruleset_facts(self) -> DataFrame:
        """Per rule set: date bounds, settings of its first rule, and the allowed values as text."""
        strict = self.settings.strict_rule_dates
        rules = self.ruleset_rules
        facts = rules.groupBy("ruleset").agg(
            F.min(dates.rule_date("startdatum", strict)).alias("min_start"),
            F.max(dates.rule_date("einddatum", strict)).alias("max_end"),
            F.trim(F.min_by(F.struct("group_by"), "rule_id")["group_by"]).alias("group_by"),
            F.min_by(F.struct("criteria"), "rule_id")["criteria"].alias("criteria"),
            F.min_by("databundelcode", "rule_id").alias("first_code"),
        )
        checked = [name for name, _ in VALUE_COLUMNS] + ["locatiecode"]
        pairs = F.explode(
            F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("val")) for c in checked])
        )
        values = (
            rules.select("ruleset", "rule_id", pairs.alias("p"))
            .groupBy("ruleset", F.col("p.col").alias("col"), F.col("p.val").alias("val"))
            .agg(F.min("rule_id").alias("first_seen"))
        )
        listed = (
            values.groupBy("ruleset", "col")
            .agg(F.array_sort(F.collect_list(F.struct("first_seen", "val"))).alias("seen"))
            .select("ruleset", "col", F.col("seen.val").alias("vals"))
            .groupBy("ruleset")
            .agg(*[F.max(F.when(F.col("col") == c, F.col("vals"))).alias(f"vals_{c}") for c in checked])
        )
        compat = self.settings.compat
        columns = {}
        for c in checked:
            values = F.col(f"vals_{c}")
            columns[f"shown_{c}"] = F.array_join(values, ",", text.MISSING)
            columns[f"without_{c}"] = F.exists(values, lambda v: v.isNull())
            if not compat:
                columns[f"text_{c}"] = F.concat(F.lit(";"), F.array_join(values, ";"), F.lit(";"))
            elif c == "locatiecode":
                columns[f"text_{c}"] = F.array_join(values, TEXT_SEPARATOR)
            else:
                columns[f"text_{c}"] = F.array_join(values, TEXT_SEPARATOR, text.MISSING)
        arrays = [f"vals_{c}" for c in checked]
        return facts.join(listed, "ruleset").withColumns(columns).drop(*arrays)

    @cached_property
    def match_index(self) -> DataFrame:
        """Rules by everything a record must equal: one row per key, the rules in a sorted array."""
        strict = self.settings.strict_rule_dates
        rule = F.struct(
            "rule_id",
            dates.rule_date("startdatum", strict).alias("start"),
            dates.rule_date("einddatum", strict).alias("end"),
            F.coalesce(F.lower("biotaxon_of_niet") == "j", F.lit(False)).alias("taxa"),
        )
        keyed = self.ruleset_rules.withColumn("_rule", rule).withColumn(
            "_location", F.explode_outer(F.split("locatiecode", ";"))
        )
        keyed = keyed.withColumn("_apparatus", F.explode_outer(F.split(APPARATUS, ";")))
        key = match_key("ruleset", "_location", "_apparatus")
        return keyed.groupBy(key.alias("_match_key")).agg(F.array_sort(F.collect_set("_rule")).alias("_rules"))

    @cached_property
    def memberships(self) -> DataFrame:
        """Per rule set and lower-cased parameter: in how many rows of its groups it occurs."""
        wanted = self.ruleset_rules.select(
            "ruleset", F.coalesce("groep", F.lit(NO_GROUP)).alias("_group")
        ).distinct()
        if self.groups is None:
            raise ValueError("matching rules needs the group list")
        members = self.groups.where(F.col("parameter").isNotNull()).select(
            F.coalesce("groep", F.lit(NO_GROUP)).alias("_group"), F.lower("parameter").alias("_member")
        )
        counted = members.groupBy("_group", "_member").agg(F.count("*").alias("_n"))
        return (
            counted.join(wanted, "_group")
            .groupBy(F.col("ruleset").alias("_side_ruleset"), "_member")
            .agg(F.sum("_n").cast("int").alias("n_groups"))
        )

    @cached_property
    def location_index(self) -> DataFrame:
        """Per location id: its projected points, and whether it has lines or areas (``edge_tiles`` holds those)."""
        parts = []
        if self.points is None and self.rings is None:
            raise ValueError("the location checks need points or shapes")
        if self.points is not None:
            east, north = geo.to_utm31("lon", "lat")
            parts.append(
                self.points.where(F.col("mpnident").isNotNull())
                .select("mpnident", F.struct(east.alias("x"), north.alias("y")).alias("point"))
                .groupBy("mpnident")
                .agg(F.collect_list("point").alias("_points"))
                .withColumn("_shaped", F.lit(False))
            )
        if self.rings is not None:
            shaped = self.rings.where(F.col("mpnident").isNotNull()).select("mpnident").distinct()
            parts.append(shaped.select("mpnident", F.lit(None).cast(POINTS).alias("_points"), F.lit(True).alias("_shaped")))
        whole = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        merged = whole.groupBy(F.col("mpnident").alias("_known_location")).agg(
            F.first("_points", True).alias("_points"), F.max("_shaped").alias("_shaped")
        )
        first = F.get("_points", F.lit(0))
        rest = F.when(F.size("_points") > 1, F.slice("_points", 2, F.size("_points")))
        return merged.select(
            "_known_location",
            first["x"].alias("_point_x"),
            first["y"].alias("_point_y"),
            rest.alias("_more_points"),
            "_shaped",
        )

    @property
    def edge_tiles(self) -> DataFrame:
        """The edges of all lines and areas, in tiles."""
        return self.side("tiles", lambda: edge_tiles(self.rings.where(F.col("mpnident").isNotNull())))

    @cached_property
    def shaped_locations(self) -> bool:
        """Has a location lines or areas?"""
        side = self._settle("locations", lambda: self.location_index)
        if "shaped" not in side.facts:
            side.facts["shaped"] = bool(side.table.where("_shaped").take(1))
        return side.facts["shaped"]

    @cached_property
    def plain_locations(self) -> bool:
        """Is every location a single point? Then distances need no arrays at all."""
        side = self._settle("locations", lambda: self.location_index)
        if "plain" not in side.facts:
            odd = side.table.where(F.col("_more_points").isNotNull() | F.col("_shaped"))
            side.facts["plain"] = not odd.take(1)
        return side.facts["plain"]

    def _mandatory(self) -> DataFrame:
        if self.columns is None:
            raise ValueError("the check on mandatory columns needs the column definition")
        order = F.col("col_ord") if "col_ord" in self.columns.columns else F.lit(0)
        label = F.lower("kolomnaam")
        return self.columns.where(F.col("ihm_verplicht") == "V").select(
            label.alias("label"), F.replace(label, F.lit("."), F.lit("_")).alias("name"), order.cast("int").alias("ord")
        )

    def mandatory_names(self, present: list[str]) -> list[tuple[str, str]]:
        """Mandatory columns among those ``present``, as (name in the report, internal name).

        Definitions of one column count together, so there are no more than columns.
        """
        side = self._settle("mandatory", self._mandatory)
        key = ("mandatory", tuple(sorted(present)))
        if key not in side.facts:
            own = side.table.where(F.col("name").isin(*present)).groupBy("name").agg(
                F.min(F.struct("ord", "label")).alias("first"), F.count("*").alias("n")
            )
            rows = sorted(own.collect(), key=lambda r: tuple(r["first"]))
            side.facts[key] = [(r["first"]["label"], r["name"]) for r in rows for _ in range(r["n"])]
        return side.facts[key]

    def mandatory_others(self, present: list[str]) -> Column:
        """The other mandatory columns as an array of (name, label, place), for records with extra columns."""
        side = self.side("mandatory", self._mandatory)
        entry = F.struct("name", "label", "ord")
        return side.where(~F.col("name").isin(*present)).agg(F.array_sort(F.collect_list(entry))).scalar()


POINTS = "array<struct<x:double,y:double>>"


def match_key(ruleset: str, location: str, apparatus: str, present: list[str] | None = None) -> Column:
    """The values a record and a rule share, as one struct.

    Structs compare field by field with null equal to null, which is the wanted
    meaning and leaves the join a plain hash join on a single key.
    """
    have = MATCH_COLUMNS if present is None else present
    fields = [F.col(ruleset).alias("ruleset")]
    for c in MATCH_COLUMNS:
        value = F.col(c).cast("string") if c in have else F.lit(None).cast("string")
        fields.append(value.alias(c))
    fields += [F.col(location).alias("location"), F.col(apparatus).cast("string").alias("apparatus")]
    return F.struct(*fields)
