"""Small deliveries and reference lists for the tests."""

from __future__ import annotations

from pyspark.sql import types as T

from tidegate.config import Settings
from tidegate.operators.references import References

RECORD = {
    "bundle": "B1 2024",
    "row_ord": 0,
    "meetwaarde_lokaalid": "NL80_L1_1",
    "monster_lokaalid": "NL80_M1",
    "meetobject_lokaalid": "NL80_L1",
    "grootheid_code": "CONC",
    "typering_code": None,
    "eenheid_code": "mg/l",
    "hoedanigheid_code": None,
    "monstercompartiment_code": None,
    "waardebewerkingsmethode_code": None,
    "orgaan_code": None,
    "organisme_naam": None,
    "bemonsteringsapparaat_omschrijving": "NET",
    "parameter_code": "Cu",
    "biotaxon_naam": None,
    "begindatum": "23-1-2018",
    "numeriekewaarde": "1.5",
    "alfanumeriekewaarde": None,
    "limietsymbool": None,
    "kwaliteitsoordeel_code": "00",
    "namespace": "NL80",
    "referentiehorizontaal_code": "EPSG:4258",
    "analysecompartiment_code": None,
    "lon": 3.0,
    "lat": 52.0,
}
RULE = {
    "rule_id": 2,
    "databundelcode": "B1",
    "criteria": "D1C1;D5C2",
    "locatiecode": "L1;L2",
    "grootheid_code": "CONC",
    "typering_code": None,
    "eenheid_code": "mg/l",
    "hoedanigheid_code": None,
    "monstercompartiment_code": None,
    "waardebewerkingsmethode_code": None,
    "orgaan_code": None,
    "organisme_naam": None,
    "bemonsteringsapparaat_omschrijving": "NET;BOR",
    "groep": "metalen",
    "startdatum": "1-1-2018",
    "einddatum": "31-12-2018",
    "biotaxon_of_niet": "n",
    "group_by": "meetwaarde.lokaalid",
    "aantal": 1,
    "limiet": "=",
    "leverdatum": "15-9-2023",
}


def frame(spark, base: dict, rows: list[dict]):
    kinds = {int: T.LongType(), float: T.DoubleType()}
    schema = T.StructType([T.StructField(k, kinds.get(type(v), T.StringType())) for k, v in base.items()])
    return spark.createDataFrame([tuple({**base, **r}[k] for k in base) for r in rows], schema)


def records(spark, *rows: dict):
    return frame(spark, RECORD, [{"row_ord": i, **r} for i, r in enumerate(rows)])


def rules(spark, *rows: dict):
    return frame(spark, RULE, [{"rule_id": i + 2, **r} for i, r in enumerate(rows)])


def references(spark, rule_rows=({},), groups=(("metalen", "CU"),), points=(("L1", 3.0, 52.0), ("L2", 3.1, 52.0)), **settings):
    return References(
        rules=rules(spark, *rule_rows),
        groups=spark.createDataFrame(list(groups), "groep string, parameter string"),
        columns=spark.createDataFrame([("Begindatum", "V")], "kolomnaam string, ihm_verplicht string"),
        points=spark.createDataFrame(list(points), "mpnident string, lon double, lat double"),
        settings=Settings(**settings),
    )
