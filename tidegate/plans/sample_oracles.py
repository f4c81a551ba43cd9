"""The registered queries in plain SQL, to check the Spark results against.

Written step by step as the definitions read, without the shortcuts of the Spark plans.
"""

from __future__ import annotations

from tidegate.plans import sample_views as sv

_TABLES = {t: t for t in ("lineitem", "orders", "part", "supplier", "customer")}


def _view(sql: str) -> str:
    return sql.format(**_TABLES).strip()


_BASE = {
    "m": _view(sv.RECORDS),
    "rules": _view(sv.RULES),
    "rules_scale": _view(sv.RULES_SCALE),
    "grp": _view(sv.GROUPS),
    "places": _view(sv.POINTS),
    "rings": _view(sv.RINGS),
    "status_tbl": _view(sv.STATUS),
    "planning": _view(sv.PLANNING),
    "published": _view(sv.PUBLISHED),
    "catalog": _view(sv.CATALOG),
    "approvals": _view(sv.APPROVALS),
    "updates": _view(sv.UPDATES),
    "bundles": "select distinct o_orderpriority bundle from orders",
}


def _sql(body: str, **steps: str) -> str:
    """``body`` behind the views and the given steps as common table expressions."""
    ctes = {**_BASE, **steps}
    return "with " + ",\n".join(f"{name} as ({text})" for name, text in ctes.items()) + f"\n{body}"


def _matching(rules: str, day_first: bool = False) -> dict[str, str]:
    month = "try_strptime(begindatum, '%m-%d-%Y'), " if not day_first else ""
    return {
        "br": f"""select b.bundle, r.*, try_strptime(startdatum, '%d-%m-%Y') s, try_strptime(einddatum, '%d-%m-%Y') e
            from bundles b join {rules} r on starts_with(replace(b.bundle, '+', ' '), r.databundelcode)""",
        "ex": """select br.*, unnest(case when locatiecode is null then [cast(null as varchar)] else string_split(locatiecode, ';') end) loc from br""",
        "grp_n": """select x.bundle, lower(g.parameter) p, count(*) n from (select distinct bundle, groep from br) x
            join grp g on g.groep is not distinct from x.groep group by 1, 2""",
        "mk": f"""select m.*, replace(meetwaarde_lokaalid, 'NL80_', '') rid, replace(monster_lokaalid, 'NL80_', '') sid,
            replace(meetobject_lokaalid, 'NL80_', '') loc,
            case when biotaxon_naam is null then lower(parameter_code) when parameter_code is null then lower(biotaxon_naam) end pkey,
            coalesce({month}try_strptime(begindatum, '%d-%m-%Y')) bd from m""",
        "mg": "select mk.*, coalesce(n, 0) n_groups from mk left join grp_n on grp_n.bundle = mk.bundle and p = pkey",
        "hits": """select k1, k2, k3, k4, mg.begindatum, mg.grootheid_code gc, coalesce(mg.typering_code, '-') tc, list_sort(list(distinct rule_id)) ids from mg join ex on mg.bundle = ex.bundle
            and mg.grootheid_code is not distinct from ex.grootheid_code
            and mg.typering_code is not distinct from ex.typering_code
            and mg.eenheid_code is not distinct from ex.eenheid_code
            and mg.loc is not distinct from ex.loc
            and list_contains(string_split(ex.bemonsteringsapparaat_omschrijving, ';'), mg.bemonsteringsapparaat_omschrijving)
            and s <= bd and bd <= e
            and (pkey is null or n_groups >= 1)
            and (biotaxon_naam is null or lower(coalesce(biotaxon_of_niet, '')) = 'j') group by 1, 2, 3, 4, 5, 6, 7""",
        "asg": """select mg.*, ids, ids[1] rule from mg left join hits on hits.k1 = mg.k1 and hits.k2 = mg.k2 and hits.k3 = mg.k3 and hits.k4 = mg.k4
            and hits.begindatum = mg.begindatum and hits.gc = mg.grootheid_code and hits.tc = coalesce(mg.typering_code, '-')
            where mg.bundle in (select bundle from br)""",
    }


_HAND, _SCALE = _matching("rules"), _matching("rules_scale")

_RULE_MATCH = """select bundle, bundle databundelcode, row_ord, rid record_id,
 case when rule is null then 5 else 0 end uitvalreden, coalesce(array_to_string(ids, ';'), '') mogelijke_validatieregels,
 rule validatieregel, case when n_groups > 1 then 1 else 0 end betreftverzameling, monster_lokaalid monster_identificatie from asg"""


def _failure(section: str, reason: str, info: str, source: str, extra: str = "") -> str:
    return f"select '{section}' section, bundle databundelcode, rid record_id, '{reason}' uitvalreden, {info} informatie{extra} from {source}"


_UNKNOWN = _failure(
    "Geo controle", "onbekende locatie", "'onbekende locatie: '||coalesce(loc, 'nan')",
    "mk where not exists (select 1 from places where places.mpnident = mk.loc)",
)


# Fixed values, apart from those of the code under test: GRS80's eccentricity, the scaled rectifying
# radius, and the coefficients of the series for the transverse Mercator projection.
_ECCENTRICITY = 0.08181919084262149
_RADIUS = 6364902.166165086
_SERIES = (0.0008377318206303529, 7.608527714248998e-07, 1.1976380015605232e-09, 2.4433761945220637e-12)


def _utm(lon: str, lat: str, prefix: str) -> list[str]:
    """Nested selects that turn degrees into metres, one step of the series each."""
    e = repr(_ECCENTRICITY)
    factor = repr(_RADIUS)
    east = " + ".join(f"{a!r} * cos(2*{k}*{prefix}xi) * sinh(2*{k}*{prefix}eta)" for k, a in enumerate(_SERIES, 1))
    north = " + ".join(f"{a!r} * sin(2*{k}*{prefix}xi) * cosh(2*{k}*{prefix}eta)" for k, a in enumerate(_SERIES, 1))
    return [
        f"sinh(atanh(sin(radians({lat}))) - {e} * atanh({e} * sin(radians({lat})))) {prefix}t, radians({lon} - 3.0) {prefix}l",
        f"atan2({prefix}t, cos({prefix}l)) {prefix}xi, atanh(sin({prefix}l) / sqrt(1 + {prefix}t * {prefix}t)) {prefix}eta",
        f"500000.0 + {factor} * ({prefix}eta + {east}) {prefix}e, {factor} * ({prefix}xi + {north}) {prefix}n",
    ]


def _project(source: str, lon: str, lat: str, prefix: str) -> str:
    sql = source
    for step in _utm(lon, lat, prefix):
        sql = f"(select *, {step} from {sql})"
    return sql


_GEO = {
    "mp": "select * from " + _project("mk", "lon", "lat", "d_"),
    "lp": "select * from " + _project("places", "lon", "lat", "g_"),
    "near": """select mp.*, sqrt((d_e - g_e) * (d_e - g_e) + (d_n - g_n) * (d_n - g_n)) dist
        from mp join lp on mp.loc = lp.mpnident""",
    "rp": "select * from " + _project("rings", "lon", "lat", "v_"),
    "edge": """select mpnident, a, x1, y1, x2, y2 from (select mpnident, ring a, v_e x1, v_n y1,
        lead(v_e) over w x2, lead(v_n) over w y2 from rp window w as (partition by mpnident, ring order by vertex)) where x2 is not null""",
    "spot": "select distinct loc, d_e, d_n from mp where loc in (select mpnident from rings)",
    "reach": """select loc, d_e, d_n,
        sum(case when (y1 > d_n) <> (y2 > d_n) and d_e < (x2 - x1) * (d_n - y1) / (y2 - y1) + x1 then 1 else 0 end) crossings,
        min(sqrt(pow(d_e - x1 - u * (x2 - x1), 2) + pow(d_n - y1 - u * (y2 - y1), 2))) nearest
        from (select *, greatest(0.0, least(1.0, ((d_e - x1) * (x2 - x1) + (d_n - y1) * (y2 - y1)) / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)))) u
              from spot join edge on mpnident = loc) group by 1, 2, 3""",
}
_LAYERS = """select mp.k1, mp.k2, mp.k3, mp.k4, round(sqrt(pow(mp.d_e - g_e, 2) + pow(mp.d_n - g_n, 2)), 3) to_point,
 round(case when crossings % 2 = 1 then 0.0 else nearest end, 3) to_area
 from mp join reach on reach.loc = mp.loc and reach.d_e = mp.d_e and reach.d_n = mp.d_n left join lp on lp.mpnident = mp.loc"""
_WIDE = """select mpnident, ring, vertex, lon + s * (1 + 0.3::double * sin(9 * t)) * cos(t) lon, lat + 0.6::double * s * (1 + 0.3::double * sin(9 * t)) * sin(t) lat
 from (select *, (vertex % 360) * 3.141592653589793::double / 180 t, case ring when 0 then 0.05::double else 0.01::double end s
   from places, unnest(range(361)) v(vertex), unnest([0, 1]) r(ring) where mpnident like 'S%')"""
_FAR = _failure(
    "Geo controle", "locatie verder dan 100 meter",
    "'afstand van locatie: '||loc||': '||cast(cast(trunc(dist) as bigint) as varchar)||'m'", "near where dist > 100",
)
_MANDATORY = " union all ".join(
    _failure("Verplichte kolommen controle", "verplichte kolom is leeg", f"'geen waarde in bestand voor: {c}'", f"mk where {c} is null")
    for c in ("meetobject_lokaalid", "begindatum", "kwaliteitsoordeel_code", "namespace")
)

_CHECKED = [
    ("grootheid_code", "Grootheid.code"),
    ("typering_code", "Typering.code"),
    ("eenheid_code", "Eenheid.code"),
    ("bemonsteringsapparaat_omschrijving", "Veldapparaatomschrijving"),
]
_VALUES = {
    "texts": " union all ".join(
        f"select bundle, '{c}' col, coalesce({c}, 'nan') v, {c} raw, min(rule_id) f from br group by 1, 3, 4"
        for c in [name for name, _ in _CHECKED] + ["locatiecode"]
    ),
    "allowed": "select bundle, col, string_agg(v, ',' order by f) txt from texts group by 1, 2",
    "bad": " union all ".join(
        f"""select x.bundle, {i} pos, '{c}' col, '{label}' label, x.v from (select distinct bundle, coalesce({c}, 'nan') v from mk) x
            where not exists (select 1 from texts t where t.bundle = x.bundle and t.col = '{c}' and contains(t.v, x.v))"""
        for i, (c, label) in enumerate(_CHECKED)
    )
    + """ union all select x.bundle, 9, 'locatiecode', 'Locatiecode', x.v from (select distinct bundle, loc v from mk) x
            where not exists (select 1 from texts t where t.bundle = x.bundle and t.col = 'locatiecode'
              and (contains(t.raw, x.v) or (t.raw is null and x.v is null)))""",
    "codes": """select distinct bundle, coalesce(grootheid_code, 'nan') g, coalesce(typering_code, 'nan') t, coalesce(eenheid_code, 'nan') u,
        coalesce(bemonsteringsapparaat_omschrijving, 'nan') a, loc from mk where bundle in (select bundle from br)""",
    "worst": """select codes.bundle, g, t, u, a, loc, arg_min(struct_pack(label := label, v := bad.v, col := bad.col), pos) h
        from codes join bad on bad.bundle = codes.bundle
        and case col when 'grootheid_code' then v = g when 'typering_code' then v = t when 'eenheid_code' then v = u
          when 'bemonsteringsapparaat_omschrijving' then v = a else v is not distinct from loc end group by 1, 2, 3, 4, 5, 6""",
    "firstbad": """select mk.bundle, rid, h from mk join worst w on w.bundle = mk.bundle and g = coalesce(grootheid_code, 'nan')
        and t = coalesce(typering_code, 'nan') and u = coalesce(eenheid_code, 'nan') and a = coalesce(bemonsteringsapparaat_omschrijving, 'nan')
        and w.loc is not distinct from mk.loc""",
}
_VALUE_CHECK = """select 'Kolomwaarde controle' section, firstbad.bundle databundelcode, rid record_id, 'ongeldige code' uitvalreden,
 h.label||' '''||coalesce(h.v, 'nan')||''' niet in: {'||txt||'}' informatie
 from firstbad join allowed on allowed.bundle = firstbad.bundle and allowed.col = h.col"""

_FIXED = " union all ".join(
    _failure("Vaste waarden controle", "vaste waarde ongeldig", info, f"mk where {where}")
    for info, where in (
        ("""'Kwaliteitsoordeel "'||coalesce(kwaliteitsoordeel_code, 'nan')||'" niet in (00,03,04,25,99)'""",
         "kwaliteitsoordeel_code is null or kwaliteitsoordeel_code not in ('00', '03', '04', '25', '99', '0', '3', '4')"),
        ("""'Namespace "'||coalesce(namespace, 'nan')||'" ongelijk aan "NL80"'""", "namespace is distinct from 'NL80'"),
        ("""'Referentiehorizontaal.code "'||coalesce(referentiehorizontaal_code, 'nan')||'" ongelijk aan "EPSG:4258"'""",
         "referentiehorizontaal_code is null or referentiehorizontaal_code not in ('EPSG:4258', 'EPSG4258')"),
        ("'analysecompartiment_code is niet leeg'", "analysecompartiment_code is not null"),
    )
)
_OTHER = " union all ".join(
    (
        _failure("Overige controle", "waarde ontbreekt", "'numerieke EN alfanumerieke waarde zijn leeg'",
                 "mk where numeriekewaarde is null and alfanumeriekewaarde is null"),
        _failure("Overige controle", "limietsymbool ongeldig", "'limietsymbool dient leeg te zijn of < of >'",
                 "mk where limietsymbool is not null and limietsymbool not in ('<', '>')"),
    )
)
_NO_RULE = _failure("Regel controle", "geen validatieregel", "'geen enkele validatieregel van toepassing'", "asg where rule is null")
_BOUNDS = {"bounds": "select bundle, min(s) lo, max(e) hi from br group by bundle"}
_DATES = """select 'Datumbereik controle' section, mk.bundle databundelcode, rid record_id, 'datum valt buiten bereik' uitvalreden,
 coalesce(strftime(bd, '%d-%m-%Y'), 'nan')||' valt buiten datumbereik validatieregels ('||strftime(lo, '%d-%m-%Y')||' tm '||strftime(hi, '%d-%m-%Y')||')' informatie
 from mk join bounds on bounds.bundle = mk.bundle where bd is null or bd < lo or bd > hi"""

_REASON = """case when limiet = '<=' and aantaldat > aantalval then 'aantal monsters groter dan verwacht'
 when limiet = '>=' and aantaldat < aantalval then 'aantal monsters kleiner dan verwacht'
 when limiet = '=' and aantaldat is distinct from aantalval then 'aantal monsters ongelijk aan verwachting' else '' end"""
_COUNTS = {
    "level": "select bundle, coalesce(trim(arg_min(coalesce(group_by, ''), rule_id)) = 'monster.lokaalid', false) by_sample from br group by bundle",
    "facts": "select mk.bundle, mk.loc, case when by_sample then sid else rid end id from mk join level on level.bundle = mk.bundle",
    "fan": """select a.bundle, a.rule, a.rid, a.k1, a.k2, a.k3, a.k4, ex.loc rule_location, ex.aantal, ex.limiet
        from asg a join ex on ex.bundle = a.bundle and ex.rule_id = a.rule""",
    "lines": f"""select *, {_REASON} uitvalreden from (
        select fan.bundle databundelcode, fan.rule validatieregel, f.loc data_location, rule_location,
          first(fan.rid order by k1, k2, k3, k4) record_id, count(*) aantaldat, any_value(fan.limiet) limiet, cast(any_value(fan.aantal) as bigint) aantalval
        from fan join facts f on f.bundle = fan.bundle and f.id = fan.rid
        where f.loc is not null and rule_location is not null group by 1, 2, 3, 4)""",
}
_COUNTS_FIXED = {
    "level": _COUNTS["level"],
    "lines": f"""select *, {_REASON} uitvalreden from (
        select a.bundle databundelcode, a.rule validatieregel, a.loc data_location, a.loc rule_location,
          first(a.rid order by k1, k2, k3, k4) record_id,
          case when bool_or(by_sample) then count(distinct sid) else count(*) end aantaldat,
          any_value(r.limiet) limiet, cast(any_value(r.aantal) as bigint) aantalval
        from asg a join level on level.bundle = a.bundle
        join (select distinct bundle, rule_id, loc, limiet, aantal from ex) r on r.bundle = a.bundle and r.rule_id = a.rule and r.loc = a.loc
        group by 1, 2, 3, 4)""",
}
_COUNT_FAILURES = """select 'Aantal controle' section, databundelcode, record_id, uitvalreden,
 'aantal datarecords: '||cast(aantaldat as varchar)||'. aantal verwacht: '||coalesce(limiet, 'nan')||' '||coalesce(cast(aantalval as varchar), 'nan') informatie
 from lines where uitvalreden <> ''"""

_RECORD_COLUMNS = (
    "databundelcode", "criteria", "eenheid_code", "grootheid_code", "typering_code", "hoedanigheid_code",
    "monstercompartiment_code", "waardebewerkingsmethode_code", "orgaan_code", "organisme_naam",
    "bemonsteringsapparaat_omschrijving", "locatiecode", "groep", "startdatum", "einddatum", "biotaxon_of_niet",
    "group_by", "limiet", "leverdatum", "aantal",
)
_ABSENT = ("hoedanigheid_code", "monstercompartiment_code", "waardebewerkingsmethode_code", "orgaan_code", "organisme_naam")


def _record_value(c: str) -> str:
    if c in _ABSENT:
        return "cast(null as varchar)"
    if c == "locatiecode":
        return "array_to_string(list_sort(list_distinct(string_split(locatiecode, ';'))), ';')"
    if c in ("startdatum", "einddatum"):
        return f"strftime(try_strptime({c}, '%d-%m-%Y'), '%Y-%m-%d')"
    return f"cast({c} as varchar)"


_REPORT = {
    **_COUNTS,
    "rule_text": "select rule_id, to_json({"
    + ", ".join(f"'{c}': {_record_value(c)}" for c in _RECORD_COLUMNS)
    + "}) txt from rules_scale",
    "rep": """select distinct databundelcode, record_id, data_location locatiecode_aantal, aantaldat, limiet, aantalval, uitvalreden, '' recordnrs, cast(txt as varchar) validatieregel
        from lines join rule_text on rule_id = validatieregel""",
}


def _filled(c: str, fallback: str) -> str:
    return f"case when {c} is null or cast({c} as varchar) in ('', '0', '0.0') then '{fallback}' else cast({c} as varchar) end"


_ISSUES = {
    **_REPORT,
    "iss": f"""select databundelcode, record_id,
        case when regexp_matches(lower(uitvalreden), 'kritiek|ontbreekt|fout') then 'High'
             when regexp_matches(lower(uitvalreden), 'ongelijk|verwachting|afwijking') then 'Medium' else 'Low' end severity,
        'Data Validatie' category,
        uitvalreden||' op locatie '||{_filled('locatiecode_aantal', 'Onbekende locatie')}||'. Verwacht: '||{_filled('aantaldat', 'onbekend')}||', Gevonden: '||{_filled('aantalval', 'onbekend')} description,
        'aantal monsters' field,
        cast(aantaldat as varchar)||' ('||limiet||')' expected_value,
        coalesce(cast(aantalval as varchar), 'Onbekend') actual_value,
        case when contains(lower(uitvalreden), 'aantal monsters ongelijk')
             then 'Controleer waarom er '||{_filled('aantalval', 'een afwijkend aantal')}||' monsters zijn gevonden in plaats van de verwachte '||{_filled('aantaldat', 'hoeveelheid')}||'. Mogelijk is er een probleem met de bemonsteringsmethode of zijn er monsters verloren gegaan.'
             when contains(lower(uitvalreden), 'ontbreekt') then 'Voeg de ontbrekende data toe of verzamel aanvullende monsters op deze locatie.'
             when contains(lower(uitvalreden), 'format') or contains(lower(uitvalreden), 'formaat') then 'Corrigeer het dataformaat zodat het voldoet aan de verwachte specificaties.'
             else 'Onderzoek en corrigeer de oorzaak van: '||uitvalreden||'. Neem indien nodig contact op met het data team voor ondersteuning.' end recommendation,
        coalesce(nullif(locatiecode_aantal, ''), 'Onbekend') as location,
        validatieregel->>'criteria' rule_criteria, validatieregel->>'grootheid_code' rule_grootheid,
        validatieregel->>'groep' rule_groep, validatieregel->>'leverdatum' rule_leverdatum,
        uitvalreden, locatiecode_aantal
        from rep where uitvalreden <> ''""",
    "tot": """select databundelcode, count(*) total_issues, count(*) filter (where severity = 'High') high_severity,
        count(distinct coalesce(locatiecode_aantal, 'null')) affected_locations, count(distinct description) issue_types from iss group by 1""",
}

_ALL = {**_HAND, **_GEO, **_VALUES, **_BOUNDS, **_COUNTS}
_ALL["fails"] = " union all ".join(
    f"select * from ({part})"
    for part in (_UNKNOWN, _FAR, _MANDATORY, _VALUE_CHECK, _COUNT_FAILURES, _FIXED, _NO_RULE, _OTHER, _DATES)
)
_ALL["sect"] = "select databundelcode, section, count(*) failures from fails group by 1, 2"
_ALL["summ"] = """select b.bundle, coalesce(sum(failures), 0) = 0 bundle_valid, coalesce(any_value(approved), false) has_akkoord,
 cast(coalesce(sum(failures), 0) as bigint) validation_failures,
 coalesce(string_agg(section||'='||cast(failures as varchar), ';' order by section), '') failures_by_section
 from bundles b left join sect on sect.databundelcode = b.bundle left join approvals a on a.bundle = b.bundle group by 1"""

_FAILED = "select databundelcode bundle, section, uitvalreden, count(*) failures from fails group by 1, 2, 3"
_INGESTED = _sql(_FAILED, **_ALL)
_AGAIN = _sql(_FAILED, **{"m": f"select * from ({_BASE['m']}) where bundle <> '3-MEDIUM' and (bundle <> '1-URGENT' or k2 % 2 = 1)", **_ALL})

_LABEL = """case when biotaxon_naam is not null and parameter_code is null then biotaxon_naam
 when parameter_code is not null and biotaxon_naam is null then parameter_code
 else coalesce(parameter_code, 'nan')||' / '||coalesce(biotaxon_naam, 'nan') end"""

_COLLECT = {
    **_HAND,
    "verz": """select a.bundle databundelcode, g.groep, lower(g.parameter) parameter, min(a.rid) record_id
        from asg a join br on br.bundle = a.bundle and br.rule_id = a.rule join grp g on g.groep = br.groep
        where a.n_groups > 1 group by 1, 2, 3""",
}
_MISSING = """select 'Parameter verzameling controle' section, databundelcode, record_id, 'ontbrekende parameter' uitvalreden,
 'parameter "'||parameter||'" uit groep "'||groep||'" niet gevonden' informatie from verz"""

_FIRST = {
    **_HAND,
    "lead_rule": "select bundle, arg_min(criteria, rule_id) criteria, arg_min(databundelcode, rule_id) code from br group by 1",
    "crit": "select bundle, code, unnest(string_split(criteria, ';')) c from lead_rule",
    "wide": "select m.*, 'ANSNL-'||c krmcriterium, code monprog_naam from m left join crit on crit.bundle = m.bundle",
}
_PARAMETERS = f"""select 'Parameter controle' section, d.bundle databundelcode, d.rid record_id, 'parameter is ongeldig' uitvalreden,
 'parameter "'||label||'" i.c.m. groep ('||coalesce(lower(groep), '')||') uit de validatieregel komt niet voor in de groep-lijst' informatie
 from (select *, {_LABEL} label from mk) d join asg a on a.bundle = d.bundle and a.rid = d.rid
 join (select * from ex where locatiecode is not null) x on x.bundle = a.bundle and x.rule_id = a.rule
 where label <> 'nan / nan' and lower(label) not in (select lower(parameter) from grp) group by 1, 2, 3, 4, 5"""
_INTENT = _MISSING + """ where not exists (select 1 from asg a join br on br.bundle = a.bundle and br.rule_id = a.rule
 where a.bundle = verz.databundelcode and br.groep = verz.groep and a.pkey = verz.parameter)"""
_TESTED = {**{c: c for c, _ in _CHECKED}, "locatiecode": "loc"}
_SUITS = " and ".join(
    f"exists (select 1 from vals where vals.bundle = mk.bundle and vals.c = '{c}' and vals.v is not distinct from mk.{own})" for c, own in _TESTED.items()
)
_CORRECTED = {
    **_matching("rules", day_first=True), **_GEO, **_BOUNDS, **_COUNTS_FIXED, "verz": _COLLECT["verz"],
    "vals": " union ".join(
        f"select bundle, '{c}' c, unnest(case when {c} is null then [cast(null as varchar)] else string_split({c}, ';') end) v from br" for c in _TESTED
    ),
}
_CORRECTED["fails"] = " union all ".join(
    f"select * from ({part})"
    for part in (
        _UNKNOWN, _FAR, _MANDATORY, _COUNT_FAILURES, _FIXED, _NO_RULE, _OTHER, _DATES, _PARAMETERS, _INTENT,
        _failure("Kolomwaarde controle", "ongeldige code", "''", f"mk where bundle in (select bundle from br) and not ({_SUITS})"),
    )
)
_EXPORTED = (
    "meetobject_lokaalid", "monster_lokaalid", "meetwaarde_lokaalid", "monstercompartiment_code", "begindatum", "typering_code",
    "grootheid_code", "parameter_code", "biotaxon_naam", "eenheid_code", "hoedanigheid_code", "waardebewerkingsmethode_code",
    "limietsymbool", "numeriekewaarde", "alfanumeriekewaarde", "kwaliteitsoordeel_code", "orgaan_code", "organisme_naam",
    "bemonsteringsapparaat_omschrijving", "referentiehorizontaal_code", "monprog_naam", "krmcriterium",
)

_PUBLISH = """select meetwaarde_lokaalid, grootheid_code, cast(null as varchar) apparaat, round(lon, 6) lon, round(lat, 6) lat from m where cast(substr(bundle, 1, 1) as int) % 2 = 1
 union all select meetwaarde_lokaalid, null, bemonsteringsapparaat_omschrijving, round(lon, 6), round(lat, 6) from m where cast(substr(bundle, 1, 1) as int) % 2 = 0"""

_BASE_CODE = "case when contains({c}, '+') then trim(split_part({c}, '+', 1)) else trim(split_part({c}, ' ', 1)) end"
_STATUS = {
    "parsed": """select databundelcode, krmcriterium, last_updated,
        coalesce(lower(nullif(regexp_extract(status, '(?i)validatie is: (True|False)', 1), '')) = 'true', false) validation,
        coalesce(lower(nullif(regexp_extract(status, '(?i)akkoord file is: (True|False)', 1), '')) = 'true', false) approval,
        status, ord from status_tbl""",
    "based": f"select *, {_BASE_CODE.format(c='databundelcode')} base from parsed",
    "latest": """select * exclude (rn) from (select *, row_number() over (partition by base order by coalesce(last_updated, timestamp '1970-01-01') desc, ord) rn from based) where rn = 1""",
    "pdates": "select *, try_strptime(leverdatum, '%d-%m-%Y') d, row_number() over (partition by databundelcode order by ord) place from planning",
    "pfirst": "select databundelcode, d is null bad, ord as first_ord from pdates where place = 1",
    "dedup": """select databundelcode, criteria, leverdatum, first_ord ord from (
        select p.*, f.first_ord, row_number() over (partition by p.databundelcode order by
          case when f.bad then p.place else 1 end, p.d desc nulls last, p.ord) rn
        from pdates p join pfirst f on f.databundelcode = p.databundelcode) where rn = 1""",
    "placed": f"""select *, row_number() over (partition by base order by ord) rn from (select *, {_BASE_CODE.format(c='databundelcode')} base from dedup)""",
    "whole": """select coalesce(l.databundelcode, p.databundelcode) databundelcode, p.criteria krmcriterium, l.last_updated,
          coalesce(validation, false) validation, coalesce(approval, false) approval, status, p.leverdatum,
          l.base is not null delivered, p.databundelcode validation_databundelcode, case when l.base is not null then p.databundelcode end code
        from placed p left join latest l on l.base = p.base and p.rn = 1
        union all select databundelcode, krmcriterium, last_updated, validation, approval, status, null, true, null, databundelcode
        from latest where base not in (select base from placed)""",
    "live": """select distinct b.code from (select distinct code, regexp_replace(code, '\\s+', '+', 'g') n from whole where code is not null) b
        join published q on starts_with(regexp_replace(q.databundelcode, '\\s+', '+', 'g'), b.n)""",
    "over": """select whole.*, case when delivered then 'delivered' else 'not_delivered' end delivery_status,
        case when live.code is not null then 'published' else 'not_published' end publication_status,
        case when not delivered then 'Gegevens nog niet beschikbaar' when approval then case when validation then 'Voldoet' else 'Voldoet met afwijkingen' end
             when validation then 'Voldoet' else 'Geleverd maar voldoet nog niet' end combined_status
        from whole left join live on live.code = whole.code""",
    "picked": """select criterium, arg_min(struct_pack(id := id, name := name), id) filter (where contains(lower(name), 'actueel') or contains(lower(name), 'current')) cur,
        arg_min(struct_pack(id := id, name := name), id) any_layer, arg_min(struct_pack(id := id, name := name), id) filter (where contains(lower(name), 'tst_actueel_indicator')) tst
        from catalog group by 1""",
    "wanted": """select distinct regexp_replace(trim(c), '^ANSNL?-', '') criterium, publication_status
        from (select unnest(string_split(krmcriterium, ';')) c, publication_status from over) where trim(c) <> ''""",
}
_YEAR = """coalesce(case when regexp_matches(leverdatum, '^[^-]*-[^-]*-[^-]{4}$') then try_cast(regexp_extract(leverdatum, '(\\d+)$', 1) as int) end,
 year(try_strptime(leverdatum, '%Y-%m-%d')))"""
_MOMENT = "strftime(last_updated, '%Y-%m-%d %H:%M:%S')"


def build() -> dict[str, str]:
    return {
        "rule_list": _sql(
            """select cast(row_number() over (order by rule_id) + 1 as int) rule_id, databundelcode, grootheid_code, eenheid_code, locatiecode,
            aantal, limiet, cast(null as varchar) leverdatum,
            '€ ' || coalesce(cast(aantal as varchar), 'geen') || ';"' || eenheid_code || '"' || chr(10) || 'regel ' || limiet note from rules_scale"""
        ),
        "status_files": _sql(
            f"""select databundelcode, krmcriterium, {_MOMENT} last_updated, validation, approval, status, leverdatum, delivery_status,
            publication_status, combined_status, validation_databundelcode from over""",
            **_STATUS,
        ),
        "shape_distance": _sql(
            """select k1, k2, k3, k4, round(case when crossings % 2 = 1 then 0.0 else nearest end, 2) distance
            from mp join reach on reach.loc = mp.loc and reach.d_e = mp.d_e and reach.d_n = mp.d_n""",
            **{
                "m": f"select * replace (lon + (k3 % 211) * 0.0007::double - 0.07::double as lon, lat + (k1 % 199) * 0.0005::double - 0.05::double as lat) from ({_BASE['m']})",
                "rings": _WIDE, **_HAND, **_GEO,
            },
        ),
        "foreign_layers": _sql("select meetwaarde_lokaalid, round(lon, 6) lon, round(lat, 6) lat from m"),
        "binary_layers": _sql(_LAYERS, **_HAND, **_GEO),
        "location_layer": _sql(_LAYERS, **_HAND, **_GEO),
        "failure_report": _sql(
            "select section, databundelcode, uitvalreden, count(*) failures, count(distinct record_id) records from fails group by 1, 2, 3", **_ALL
        ),
        "code_texts": """select o_orderkey, o_orderkey % 3 <> 0 and o_orderpriority in ('1-URGENT', '3-MEDIUM') listed, o_orderkey % 5 in (0, 2) flag,
            o_orderpriority||'+'||cast(o_orderkey as varchar) bundle from orders""",
        "rule_selection": _sql("select bundle, rule_id, databundelcode from br", **_HAND),
        "rules_exploded": _sql(
            """select rule_id, unnest(string_split(locatiecode, ';')) locatiecode,
            strftime(try_strptime(startdatum, '%d-%m-%Y'), '%Y-%m-%d') startdatum, strftime(try_strptime(einddatum, '%d-%m-%Y'), '%Y-%m-%d') einddatum from rules_scale"""
        ),
        "rule_match": _sql(_RULE_MATCH, **_HAND),
        "rule_match_scale": _sql(_RULE_MATCH, **_SCALE),
        "records_without_rule": _sql(_NO_RULE, **_HAND),
        "groups_for_rules": _sql("select groep, parameter from grp where groep in (select groep from rules)"),
        "collection_flag": _sql(
            """select k1, k2, k3, k4, pkey parameter_key, cast(n_groups as int) n_groups, case when n_groups > 1 then 1 else 0 end betreftverzameling
            from mg where bundle in (select bundle from br)""",
            **_HAND,
        ),
        "unknown_location": _sql(_UNKNOWN, **_HAND),
        "location_distance": _sql(_FAR, **_HAND, **_GEO),
        "polygon_distance": _sql(
            """select k1, k2, k3, k4, round(case when crossings % 2 = 1 then 0.0 else nearest end, 3) distance
            from mp join reach on reach.loc = mp.loc and reach.d_e = mp.d_e and reach.d_n = mp.d_n""",
            **_HAND, **_GEO,
        ),
        "mandatory_columns": _sql(_MANDATORY, **_HAND),
        "value_in_any_rule": _sql(_VALUE_CHECK, **_HAND, **_VALUES),
        "count_reconciliation": _sql("select * from lines", **_SCALE, **_COUNTS),
        "count_reconciliation_samples": _sql("select * from lines", **_HAND, **_COUNTS),
        "count_reconciliation_fixed": _sql("select * from lines", **_matching("rules_scale", True), **_COUNTS_FIXED),
        "count_reconciliation_samples_fixed": _sql("select * from lines", **_matching("rules", True), **_COUNTS_FIXED),
        "count_report": _sql("select * from rep", **_SCALE, **_REPORT),
        "parameter_check": _sql(
            f"""select 'Parameter controle' section, d.bundle databundelcode, d.rid record_id, 'parameter is ongeldig' uitvalreden,
            'parameter "'||label||'" i.c.m. groep ('||coalesce(lower(groep), '')||') uit de validatieregel komt niet voor in de groep-lijst' informatie,
            count(*) copies
            from (select *, {_LABEL} label from mk) d join asg a on a.bundle = d.bundle and a.rid = d.rid
            join (select * from ex where locatiecode is not null) x on x.bundle = a.bundle and x.rule_id = a.rule
            where label <> 'nan / nan' and lower(label) not in (select lower(parameter) from grp) group by 1, 2, 3, 4, 5""",
            **_HAND,
        ),
        "collection_groups": _sql("select * from verz", **_COLLECT),
        "collection_reference": _sql(
            _MISSING + " where parameter not in (select lower(g2.parameter) from grp g2)", **_COLLECT
        ),
        "collection_intent": _sql(
            _INTENT, **_COLLECT,
        ),
        "fixed_values": _sql(_FIXED, **_HAND),
        "other_checks": _sql(_OTHER, **_HAND),
        "date_range": _sql(_DATES, **_HAND, **_BOUNDS),
        "failures_all": _sql("select * from fails", **_ALL),
        "failures_by_section": _sql("select * from sect", **_ALL),
        "failures_corrected": _sql(
            "select databundelcode, section, uitvalreden, count(*) failures, count(distinct record_id) records from fails group by 1, 2, 3", **_CORRECTED
        ),
        "bundle_summary": _sql(
            """select *, 'Databundel validatie is: '||case when bundle_valid then 'True' else 'False' end||' en akkoord file is: '||case when has_akkoord then 'True' else 'False' end status from summ""",
            **_ALL,
        ),
        "sample_dense_rank": _sql(
            "select distinct bundle, rid record_id, dense_rank() over (partition by bundle order by rid) recordnr_monster from mk", **_HAND
        ),
        "criteria_fanout": _sql("select k1, k2, k3, k4, bundle, krmcriterium, monprog_naam from wide", **_FIRST),
        "export_projection": _sql(
            "select bundle, " + ", ".join(_EXPORTED)
            + ", lon geometriepunt_x, lat geometriepunt_y, lon geom_x, lat geom_y from wide",
            **_FIRST,
        ),
        "export_gate": _sql(
            """select bundle, meetwaarde_lokaalid, krmcriterium, monprog_naam from wide
            where bundle in (select summ.bundle from summ where bundle_valid or has_akkoord)""",
            **{**_ALL, **_FIRST},
        ),
        "merge_layers": _sql(_PUBLISH),
        "status_upsert": _sql(
            """select coalesce(t.databundelcode, u.databundelcode) databundelcode,
            case when u.databundelcode is not null then u.krmcriterium else t.krmcriterium end krmcriterium,
            case when u.databundelcode is not null then '2025-01-01 12:00:00' else strftime(t.last_updated, '%Y-%m-%d %H:%M:%S') end last_updated,
            case when u.databundelcode is not null then u.status else t.status end status
            from status_tbl t full join updates u on u.databundelcode = t.databundelcode"""
        ),
        "status_parse": _sql(f"select databundelcode, krmcriterium, {_MOMENT} last_updated, validation, approval, status from parsed", **_STATUS),
        "planning_dedupe": _sql("select databundelcode, criteria, leverdatum, ord from dedup", **_STATUS),
        "latest_delivery": _sql(
            f"select base base_databundelcode, databundelcode, krmcriterium, {_MOMENT} last_updated, validation, approval from latest", **_STATUS
        ),
        "status_overview": _sql(
            f"""select databundelcode, krmcriterium, {_MOMENT} last_updated, validation, approval, status, leverdatum, delivery_status,
            publication_status, combined_status, validation_databundelcode from over""",
            **_STATUS,
        ),
        "status_filter_search_page": _sql(
            f"""select databundelcode, krmcriterium, leverdatum, combined_status, publication_status from over
            where combined_status = 'Voldoet' and delivery_status = 'delivered' and {_YEAR} = 2023
            and contains(lower(concat_ws('|', databundelcode, krmcriterium, {_MOMENT}, leverdatum, combined_status, delivery_status, publication_status)), 'mach')
            order by databundelcode desc, validation_databundelcode limit 5 offset 5""",
            **_STATUS,
        ),
        "overview_last_page": _sql(
            """select databundelcode, krmcriterium, leverdatum, combined_status, publication_status from over
            order by databundelcode desc, validation_databundelcode nulls first offset (select (count(*) - 1) // 25 * 25 from over)""",
            **_STATUS,
        ),
        "status_spellings": """with s as (select o_orderkey % 5 kind, o_custkey, o_orderpriority, o_orderstatus, o_orderkey from orders where o_orderkey % 5 <> 4)
            select 'B_'||o_custkey||case kind when 1 then '+x' when 2 then '+y' else '' end databundelcode,
              case kind when 1 then o_orderpriority when 3 then '' else 'late' end krmcriterium, 'day '||cast(o_orderkey % 31 as varchar) last_updated,
              o_orderkey % 2 = 0 validation, true approval, o_orderstatus status, o_orderkey ord from s""",
        "failure_intake": """select 'Externe controle' section, o_orderpriority databundelcode, case when o_orderkey % 3 > 0 then cast(o_orderkey as varchar) else 'nan' end record_id,
            o_orderstatus uitvalreden, 'day '||cast(o_orderkey % 31 as varchar) informatie from orders
            union all select 'refused', null, null, 'failures lack column(s): informatie', null""",
        "count_report_files": _sql("select * replace (nullif(recordnrs, '') as recordnrs, nullif(uitvalreden, '') as uitvalreden) from rep", **_SCALE, **_REPORT),
        "published_layers": f"""with p as ({_sql("select meetwaarde_lokaalid, round(lon, 6) lon, round(lat, 6) lat, case when cast(substr(bundle, 1, 1) as int) % 2 = 1 then 'first' else 'second' end bundle from m")})
            select 'both' state, bundle, meetwaarde_lokaalid, lon, lat from p union all select 'withdrawn', bundle, meetwaarde_lokaalid, lon, lat from p where bundle = 'second'""",
        "kpis": _sql(
            """select count(*) total_bundles, count(*) filter (where delivered) delivered_bundles, count(*) filter (where validation) valid_bundles,
            count(*) filter (where publication_status = 'published') published_bundles,
            count(*) filter (where combined_status in ('Voldoet', 'Voldoet met afwijkingen')) compliant_bundles,
            count(distinct krmcriterium) unique_criteria from over""",
            **_STATUS,
        ),
        "filter_options": _sql("select distinct krmcriterium from over order by 1", **_STATUS),
        "year_options": _sql(
            f"select distinct y as year from (select {_YEAR} y from over union all select unnest([2023, 2024, 2025, 2026])) where y is not null order by 1 desc",
            **_STATUS,
        ),
        "issue_details": _sql("select * from iss", **_SCALE, **_ISSUES),
        "issue_summary": _sql(
            """select databundelcode, coalesce(locatiecode_aantal, 'null') as location, uitvalreden reason, count(*) reason_count,
            cast(sum(count(*)) over (partition by databundelcode, coalesce(locatiecode_aantal, 'null')) as bigint) location_count
            from iss group by 1, 2, 3""",
            **_SCALE, **_ISSUES,
        ),
        "issue_totals": _sql("select * from tot", **_SCALE, **_ISSUES),
        "issue_bundles": _sql(
            """select databundelcode, record_id, iss.location, severity, case when approved is not null then 'ANSNL-D1C1' end krmcriterium,
            case when approved then 'Voldoet met afwijkingen' when not approved then 'Geleverd maar voldoet nog niet' end combined_status
            from iss left join approvals on bundle = databundelcode""",
            **_SCALE, **_ISSUES,
        ),
        "next_steps": _sql(
            """select databundelcode, step, description, false completed, strftime(date '2025-06-01' + cast(n_days as int), '%Y-%m-%d') deadline from (
            select databundelcode, 1 step, 'Corrigeer kritieke data problemen ('||cast(high_severity as varchar)||' gevallen)' description, 7 n_days from tot where high_severity > 0
            union all select databundelcode, 2, 'Controleer monster aantal inconsistenties op '||cast(affected_locations as varchar)||' locatie(s)', 14 from tot
            union all select databundelcode, 3, 'Evalueer data verzamel methodologie', 21 from tot where issue_types > 1
            union all select databundelcode, 4, 'Herzend gecorrigeerde dataset na fixes', 28 from tot
            union all select databundelcode, 5, 'Nieuwe validatie aanvragen', 35 from tot)""",
            **_SCALE, **_ISSUES,
        ),
        "display_dates": _sql(
            """select coalesce(validation_databundelcode, databundelcode) code, databundelcode,
            coalesce(strftime(last_updated, '%d/%m/%Y, %H:%M'), 'Geen datum') updated,
            case when leverdatum is null then 'Geen leverdatum' else coalesce(strftime(try_strptime(leverdatum, '%d-%m-%Y'), '%d/%m/%Y'), leverdatum) end delivery,
            'validatielijst_per_locatie_met_aantal_'||replace(databundelcode, '+', ' ')||'.csv' report_name from over""",
            **_STATUS,
        ),
        "layer_pick": _sql(
            """select w.criterium, w.publication_status,
            case when w.publication_status = 'not_published' then tst.id else coalesce(cur, any_layer).id end layer_id,
            case when w.publication_status = 'not_published' then tst.name else coalesce(cur, any_layer).name end layer_name
            from wanted w left join picked on picked.criterium = w.criterium""",
            **_STATUS,
        ),
        "bundle_scan": _sql(
            "select bundle, meetwaarde_lokaalid, typering_code, begindatum, numeriekewaarde, limietsymbool, lon, lat from m"
        ),
        "bundle_files": _sql("select bundle, true approved, count(*) n_rows, 0 errors, 19 n_columns from m group by bundle"),
        "stream_status": """select 'U_'||cast(user_id as varchar) databundelcode, 'ANSNL-'||event_type krmcriterium,
            strftime(ts, '%Y-%m-%d %H:%M:%S') last_updated, event_type status
            from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) rn from events) where rn = 1""",
        "stream_ingest": _INGESTED,
        "redelivery": f"""with f as ({_INGESTED}), s as ({_AGAIN}),
            v as (select b.bundle, count(x.section) n from (select distinct o_orderpriority bundle from orders) b
              left join (select * from f where bundle <> '1-URGENT' union all select * from s where bundle = '1-URGENT') x on x.bundle = b.bundle group by 1)
            select *, 'delivered' state from f union all select *, 'broken' from f union all select *, 'repeated' from s
            union all select 'all', 'status', 'Databundel validatie is: '||case when n = 0 then 'True' else 'False' end||' en akkoord file is: True', count(*), 'status'
            from v group by 3""",
        "stream_republish": _sql(
            """select bundle, meetwaarde_lokaalid, round(lon, 6) lon, round(lat, 6) lat from m
            where bundle <> '2-HIGH' and (bundle <> '1-URGENT' or k2 <= 2)"""
        ),
        "stream_publish": _sql(_PUBLISH),
    }
