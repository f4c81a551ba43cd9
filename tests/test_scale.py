"""Plans that hold when a side is too large to broadcast, when keys are hot, and against brute force."""

import random
from collections import Counter, defaultdict
from datetime import date

import pytest
from helpers import RECORD, RULE, frame, records, references
from pyspark.sql import functions as F

from tidegate.operators import counts, matching, rank, row_checks, status
from tidegate.plans import sample_views as sv

SF = "/root/testdata/sf0.001"


def rows(df):
    return Counter(str(sorted(r.asDict(True).items())) for r in df.collect())


@pytest.mark.parametrize("scale", [False, True])
def test_same_results_when_nothing_may_be_broadcast(spark, scale):
    m, names = sv.records(spark, SF), sv.bundle_names(spark, SF)

    def run():
        refs = sv.references(spark, SF, scale)
        return (
            rows(matching.assignments(m, refs, names)),
            rows(row_checks.row_failures(m, refs, bundles=names)),
            rows(counts.count_lines(m, refs, names)),
        )

    want = run()
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert run() == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def plan_of(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def test_no_cross_joins_and_no_shuffle_of_records_for_row_checks(spark):
    m, names = sv.records(spark, SF), sv.bundle_names(spark, SF)
    refs = sv.references(spark, SF)
    for df in (row_checks.row_failures(m, refs, bundles=names), counts.count_lines(m, refs, names)):
        plan = plan_of(df)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # the only exchanges above the record view are broadcasts
    plain = spark.read.parquet(f"{SF}/lineitem.parquet")
    assert plain.count() > 0
    outer = plan_of(matching.assignments(records(spark, {}), references(spark), records(spark, {}).select("bundle")))
    assert "SortMergeJoin" not in outer.split("InMemoryRelation")[0]


def test_only_needed_columns_are_read(spark):
    m = sv.records(spark, SF).select("bundle", "limietsymbool")
    assert "l_shipdate" not in plan_of(m) and "l_partkey" in plan_of(m)


def test_one_id_with_a_third_of_all_rows(spark):
    hot = [{"meetwaarde_lokaalid": "NL80_hot", "meetobject_lokaalid": f"NL80_L{1 + i % 2}"} for i in range(200)]
    cold = [{"meetwaarde_lokaalid": f"NL80_{i}"} for i in range(100)]
    found = counts.count_lines(records(spark, *hot, *cold), references(spark)).collect()
    got = {(r["data_location"], r["rule_location"]): r["aantaldat"] for r in found}
    # 200 assigned times 100 found at each location, plus the 100 single records at the first
    assert got == {("L1", "L1"): 20100, ("L1", "L2"): 20100, ("L2", "L1"): 20000, ("L2", "L2"): 20000}


def test_dense_rank_over_many_ranges(spark):
    ids = [("A", f"NL80_{i % 500:04d}") for i in range(2000)] + [("B", f"NL80_{i}") for i in range(50)] + [("B", None)]
    df = spark.createDataFrame(ids, "bundle string, meetwaarde_lokaalid string")
    got = {(r["bundle"], r["record_id"]): r["recordnr_monster"] for r in rank.sample_dense_rank(df, ranges=7).collect()}
    want = {}
    for bundle in "AB":
        values = sorted({i.replace("NL80_", "") for b, i in ids if b == bundle and i})
        want.update({(bundle, v): n for n, v in enumerate(values, 1)})
    assert got == want


def test_latest_planning_and_consume_once(spark):
    planning = spark.createDataFrame(
        [("P a", "c1", "1-1-2024", 0), ("P b", "c2", "2-1-2024", 1), ("P a", "c3", "3-1-2024", 2), ("Q", "c", "onbekend", 3),
         ("Q", "d", "1-1-2030", 4), ("R", "c", "5-5-2025", 5), ("R", "e", "geen", 6), ("", "c", "1-1-2024", 7), ("S", "", "1-1-2024", 8)],
        "databundelcode string, criteria string, leverdatum string, ord long",
    )
    dedup = status.dedupe_planning(planning)
    got = {r["databundelcode"]: (r["criteria"], r["ord"]) for r in dedup.collect()}
    assert got == {"P a": ("c3", 0), "P b": ("c2", 1), "Q": ("c", 3), "R": ("c", 5)}

    sentence = "validatie is: {} akkoord file is: {}"
    table = spark.createDataFrame(
        [("P+x+1", "k", "2024-01-01 00:00:00", sentence.format(True, False), 0), ("P+x+2", "k", "2024-02-01 00:00:00", sentence.format(False, True), 1),
         ("P+x+3", "k", "2024-02-01 00:00:00", sentence.format(True, True), 2), ("Z+y", "kz", None, sentence.format(False, False), 3), ("Z+z", "kz", "bad", "x", 4)],
        "databundelcode string, krmcriterium string, last_updated string, status string, ord long",
    )
    published = spark.createDataFrame([("P a v2",), ("Z+y+final",)], "databundelcode string")
    over = status.status_overview(status.parse_status(table), dedup, published)
    got = {r["validation_databundelcode"] or r["databundelcode"]: r for r in over.collect()}
    assert set(got) == {"P a", "P b", "Q", "R", "Z+y"}
    first = got["P a"]
    assert (first["databundelcode"], first["krmcriterium"], first["combined_status"], first["publication_status"]) == ("P+x+2", "c3", "Voldoet met afwijkingen", "published")
    assert (got["P b"]["delivery_status"], got["P b"]["combined_status"]) == ("not_delivered", "Gegevens nog niet beschikbaar")
    assert (got["Z+y"]["publication_status"], got["Z+y"]["combined_status"], got["Z+y"]["leverdatum"]) == ("published", "Geleverd maar voldoet nog niet", None)


def test_layers(spark):
    catalog = spark.createDataFrame(
        [(1, "D8C1", "D8C1 historie"), (2, "D8C1", "D8C1 Actueel"), (3, "D1C1", "D1C1 overzicht"), (4, "D5C2", "tst_actueel_indicator_D5C2")],
        "id int, criterium string, name string",
    )
    wanted = spark.createDataFrame(
        [("ANSNL-D8C1; D1C1", "published"), ("D5C2;D1C1", "not_published"), ("X", "published")], "krmcriterium string, publication_status string"
    )
    got = {(r["criterium"], r["publication_status"]): r["layer_id"] for r in status.pick_layers(wanted, catalog).collect()}
    assert got == {("D8C1", "published"): 2, ("D1C1", "published"): 3, ("D5C2", "not_published"): 4, ("D1C1", "not_published"): None, ("X", "published"): None}


def brute_force(data, rule_rows, groups, names):
    """Matching, missing rules and counts, record by record as the definitions read."""
    def day(text, month_first):
        try:
            a, b, y = (int(p) for p in text.split("-"))
        except (AttributeError, ValueError):
            return None
        for m, d in ((a, b), (b, a)) if month_first else ((b, a),):
            try:
                return date(y, m, d)
            except ValueError:
                continue
        return None

    strip = lambda v: None if v is None else v.replace("NL80_", "")
    assigned = []
    for r in data:
        own = [x for x in rule_rows if r["bundle"].startswith(x["databundelcode"])]
        if not own:
            continue
        members = [p.lower() for g, p in groups if g in {x["groep"] for x in own}]
        c, t = r["parameter_code"], r["biotaxon_naam"]
        key = c.lower() if c and not t else t.lower() if t and not c else None
        begin, hits = day(r["begindatum"], True), []
        for x in own:
            same = all(r[n] == x[n] for n in names)
            place, tool = strip(r["meetobject_lokaalid"]), r["bemonsteringsapparaat_omschrijving"]
            listed = lambda v, l: v is None if l is None else v in l.split(";")
            ok = same and listed(place, x["locatiecode"]) and listed(tool, x["bemonsteringsapparaat_omschrijving"])
            ok = ok and (key is None or key in members) and begin is not None
            ok = ok and day(x["startdatum"], False) <= begin <= day(x["einddatum"], False)
            if ok and not (t and (x["biotaxon_of_niet"] or "").lower() != "j"):
                hits.append(x["rule_id"])
        assigned.append((r, sorted(set(hits)), int(members.count(key) > 1) if key else 0))
    totals = defaultdict(int)
    for r, hits, _ in assigned:
        if hits:
            rule = next(x for x in rule_rows if x["rule_id"] == hits[0])
            for q, _, _ in assigned:
                if q["bundle"] == r["bundle"] and q["meetwaarde_lokaalid"] == r["meetwaarde_lokaalid"] and q["meetobject_lokaalid"]:
                    for place in (rule["locatiecode"] or "").split(";"):
                        if place:
                            totals[r["bundle"], hits[0], strip(q["meetobject_lokaalid"]), place] += 1
    return assigned, dict(totals)


def test_random_records_against_brute_force(spark):
    rng = random.Random(7)
    pick = rng.choice
    data = [
        {
            **RECORD,
            "row_ord": i,
            "bundle": pick(["B1 a", "B1", "B2 x", "Q"]),
            "meetwaarde_lokaalid": f"NL80_{rng.randrange(120)}",
            "meetobject_lokaalid": pick([None, "NL80_L1", "NL80_L2", "NL80_L3"]),
            "grootheid_code": pick(["CONC", None]),
            "typering_code": pick(["T", None]),
            "bemonsteringsapparaat_omschrijving": pick(["NET", "BOR", None]),
            "parameter_code": pick([None, "Cu", "Zn", "Pb"]),
            "biotaxon_naam": pick([None, None, "Cu"]),
            "begindatum": pick(["23-1-2018", "3-4-2018", "12-12-2017", None, "x", "31-2-2018"]),
        }
        for i in range(300)
    ]
    rule_rows = [
        {
            **RULE,
            "rule_id": i + 2,
            "databundelcode": pick(["B", "B1", "B2", "B1 a"]),
            "grootheid_code": pick(["CONC", None]),
            "typering_code": pick(["T", None]),
            "locatiecode": pick(["L1;L2", "L1;L3", "L2;L2", None]),
            "bemonsteringsapparaat_omschrijving": pick(["NET;BOR", "BOR", None]),
            "groep": pick(["g1", "g2"]),
            "startdatum": pick(["1-1-2017", "1-3-2018"]),
            "einddatum": pick(["31-12-2018", "1-4-2018"]),
            "biotaxon_of_niet": pick(["j", "n", None]),
        }
        for i in range(25)
    ]
    groups = [("g1", "CU"), ("g2", "Cu"), ("g1", "zn"), ("g3", "Pb")]
    refs = references(spark, groups=groups)
    refs = type(refs)(rules=frame(spark, RULE, rule_rows), groups=refs.groups, columns=refs.columns, points=refs.points)
    m = frame(spark, RECORD, data)
    names = ["grootheid_code", "typering_code", "eenheid_code"]
    want, totals = brute_force(data, rule_rows, groups, names)
    got = matching.assignments(m, refs).orderBy("row_ord").collect()
    assert [(r["row_ord"], r["mogelijke_validatieregels"], r["betreftverzameling"]) for r in got] == [
        (r["row_ord"], hits, flag) for r, hits, flag in want
    ]
    assert sum(bool(h) for _, h, _ in want) > 20
    lines = counts.count_lines(m, refs).collect()
    assert {(r["databundelcode"], r["validatieregel"], r["data_location"], r["rule_location"]): r["aantaldat"] for r in lines} == totals
    assert F is not None


def test_prefixes_of_published_codes_are_not_broadcast(spark):
    published = spark.createDataFrame([("B_1+x+final",), ("B 2",), (None,)], "databundelcode string")
    codes = spark.createDataFrame([("B_1+x",), ("B  2",), ("B_3",)], "code string")
    found = status.published_flags(codes, published)
    assert {r["code"] for r in found.collect()} == {"B_1+x", "B  2"}
    # the estimate does not know how many prefixes there are, so a small one must not decide
    plan = plan_of(found)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


@pytest.mark.parametrize("name", ["failures_all", "failures_corrected", "export_gate"])
def test_the_tables_are_joined_once_for_all_passes(spark, name):
    """The checks pass over the records several times; every pass reads the written records."""
    from tidegate.plans.sample_queries import QUERIES

    plan = QUERIES[name](spark, SF)._jdf.queryExecution().analyzed().toString()
    assert "meetwaarde_lokaalid" in plan and "l_orderkey" not in plan
    assert sv.delivered(spark, SF).exceptAll(sv.records(spark, SF)).count() == 0
