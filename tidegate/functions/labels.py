"""Wording of the status overview and its drill-down."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegate.functions.text import as_col, clean_bundle

# Combined statuses.
COMPLIES = "Voldoet"
DEVIATES = "Voldoet met afwijkingen"
NOT_YET = "Geleverd maar voldoet nog niet"
NOT_AVAILABLE = "Gegevens nog niet beschikbaar"

# Words in a reason that set its severity.
HIGH_WORDS = ("kritiek", "ontbreekt", "fout")
MEDIUM_WORDS = ("ongelijk", "verwachting", "afwijking")


def _has_any(value: Column, words: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [value.contains(w) for w in words])


def combined_status(valid: str | Column, approved: str | Column, delivered: str | Column) -> Column:
    valid, approved, delivered = as_col(valid), as_col(approved), as_col(delivered)
    return (
        F.when(~delivered, NOT_AVAILABLE)
        .when(valid, COMPLIES)
        .when(approved, DEVIATES)
        .otherwise(NOT_YET)
    )


def severity(reason: str | Column) -> Column:
    r = F.lower(as_col(reason))
    return F.when(_has_any(r, HIGH_WORDS), "High").when(_has_any(r, MEDIUM_WORDS), "Medium").otherwise("Low")


def filled(value: str | Column, fallback: str) -> Column:
    """A value as text; missing, empty and zero read as ``fallback``."""
    c = as_col(value).cast("string")
    return F.when(c.isNull() | c.isin("", "0", "0.0"), F.lit(fallback)).otherwise(c)


def issue_description(location: Column, reason: Column, first: Column, second: Column) -> Column:
    return F.concat(
        filled(reason, "Onbekende reden"),
        F.lit(" op locatie "),
        filled(location, "Onbekende locatie"),
        F.lit(". Verwacht: "),
        filled(first, "onbekend"),
        F.lit(", Gevonden: "),
        filled(second, "onbekend"),
    )


def recommendation(reason: Column, first: Column, second: Column) -> Column:
    r = F.lower(reason)
    unequal = F.concat(
        F.lit("Controleer waarom er "),
        filled(second, "een afwijkend aantal"),
        F.lit(" monsters zijn gevonden in plaats van de verwachte "),
        filled(first, "hoeveelheid"),
        F.lit(
            ". Mogelijk is er een probleem met de bemonsteringsmethode of zijn er monsters verloren gegaan."
        ),
    )
    generic = F.concat(
        F.lit("Onderzoek en corrigeer de oorzaak van: "),
        reason,
        F.lit(". Neem indien nodig contact op met het data team voor ondersteuning."),
    )
    return (
        F.when(r.contains("aantal monsters ongelijk"), unequal)
        .when(
            r.contains("ontbreekt"),
            "Voeg de ontbrekende data toe of verzamel aanvullende monsters op deze locatie.",
        )
        .when(
            r.contains("format") | r.contains("formaat"),
            "Corrigeer het dataformaat zodat het voldoet aan de verwachte specificaties.",
        )
        .otherwise(generic)
    )


def count_report_name(bundle: str | Column) -> Column:
    """File name of a bundle's count report, null without a bundle code."""
    c = as_col(bundle)
    name = F.concat(F.lit("validatielijst_per_locatie_met_aantal_"), clean_bundle(c), F.lit(".csv"))
    return F.when(c != "", name)


def rule_record(value: str | Column) -> Column:
    """Rule record text as a map. Text that is no JSON is read again with single quotes and ``nan`` put right, else null."""
    raw = as_col(value)
    repaired = F.replace(F.replace(raw, F.lit("'"), F.lit('"')), F.lit("nan"), F.lit("null"))
    return F.coalesce(F.from_json(raw, "map<string,string>"), F.from_json(repaired, "map<string,string>"))
