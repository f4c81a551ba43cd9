"""Settings shared by every check, and the fixed words of the reports."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    """How a run treats its records.

    ``compat`` keeps the established behaviour of the checks, oddities included;
    ``compat=False`` switches on the corrected behaviour described in the README.
    ``order_by`` names the columns that give the records of one bundle a total
    order (the row ordinal of the delivered file unless told otherwise).
    """

    max_location_distance_m: float = 100.0
    compat: bool = True
    strict_rule_dates: bool = False
    order_by: tuple[str, ...] = ("row_ord",)
    record_kind: str = "monsters"


# Section names of the failure report, in report order.
GEO = "Geo controle"
MANDATORY = "Verplichte kolommen controle"
COLUMN_VALUE = "Kolomwaarde controle"
COUNTS = "Aantal controle"
PARAMETERS = "Parameter controle"
COLLECTIONS = "Parameter verzameling controle"
FIXED_VALUES = "Vaste waarden controle"
RULES = "Regel controle"
OTHER = "Overige controle"
DATES = "Datumbereik controle"

# Position of every check in the report; a bundle's failures are listed in this order.
CHECK_ORDER = {
    "unknown_location": 10,
    "location_distance": 11,
    "mandatory_columns": 20,
    "value_in_any_rule": 30,
    "counts": 40,
    "parameters": 50,
    "collections": 60,
    "quality_code": 70,
    "namespace": 71,
    "horizontal_reference": 72,
    "analysis_compartment": 73,
    "records_without_rule": 80,
    "missing_value": 90,
    "limit_symbol": 91,
    "date_range": 100,
}

# Columns a record and a rule must share to match (data name = rule name).
MATCH_COLUMNS = (
    "eenheid_code",
    "grootheid_code",
    "typering_code",
    "hoedanigheid_code",
    "monstercompartiment_code",
    "waardebewerkingsmethode_code",
    "orgaan_code",
    "organisme_naam",
)
APPARATUS = "bemonsteringsapparaat_omschrijving"

# Columns of the any-rule value check with the name the message shows, in test order.
VALUE_COLUMNS = (
    ("grootheid_code", "Grootheid.code"),
    ("typering_code", "Typering.code"),
    ("eenheid_code", "Eenheid.code"),
    ("hoedanigheid_code", "Hoedanigheid.code"),
    ("waardebewerkingsmethode_code", "Waardebewerkingsmethode"),
    ("monstercompartiment_code", "Compartimentcode"),
    (APPARATUS, "Veldapparaatomschrijving"),
    ("organisme_naam", "Organismenaam"),
)

RULE_TEXT_COLUMNS = (
    "databundelcode",
    "criteria",
    *MATCH_COLUMNS,
    APPARATUS,
    "locatiecode",
    "groep",
    "startdatum",
    "einddatum",
    "biotaxon_of_niet",
    "group_by",
    "limiet",
    "leverdatum",
)
