"""The test tables seen as deliveries, reference lists and status tables.

The SQL is portable between Spark and other engines; table names are written in
braces and filled in by the caller.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidegate.config import Settings
from tidegate.operators.references import References
from tidegate.runtime import scratch_path

# Rows of equal order and line number have the same record id.
ORDER = ("row_ord",)

RECORDS = """
select l.l_orderkey * 10 + l.l_linenumber row_ord, l.l_orderkey k1, l.l_linenumber k2, l.l_partkey k3, l.l_suppkey k4, o.o_orderpriority bundle,
 'NL80_'||cast(l.l_orderkey as string)||'_'||cast(l.l_linenumber as string) meetwaarde_lokaalid,
 'NL80_'||cast(l.l_orderkey as string) monster_lokaalid,
 'NL80_S'||cast(l.l_suppkey % 20 as string) meetobject_lokaalid,
 l.l_returnflag grootheid_code, nullif(l.l_linestatus,'F') typering_code, p.p_type eenheid_code,
 'DEV'||cast(l.l_linenumber % 3 as string) bemonsteringsapparaat_omschrijving,
 case when l.l_partkey % 4 <> 0 then p.p_name end parameter_code,
 case when l.l_partkey % 8 in (0,1) then p.p_brand end biotaxon_naam,
 case when l.l_orderkey % 97 = 0 then null when l.l_orderkey % 89 = 0 then 'geen datum'
  else cast(day(l.l_shipdate) as string)||'-'||cast(month(l.l_shipdate) as string)||'-'||cast(year(l.l_shipdate) as string) end begindatum,
 case when l.l_linenumber = 7 then null else l.l_quantity end numeriekewaarde,
 case when l.l_partkey % 3 = 0 then p.p_name end alfanumeriekewaarde,
 case l.l_orderkey % 5 when 0 then '<' when 1 then '>' when 2 then '=' end limietsymbool,
 case l.l_partkey % 7 when 0 then '00' when 1 then '3' when 2 then '50' when 3 then null else '99' end kwaliteitsoordeel_code,
 cast(null as string) hoedanigheid_code, cast(null as string) monstercompartiment_code, cast(null as string) waardebewerkingsmethode_code,
 cast(null as string) orgaan_code, cast(null as string) organisme_naam,
 case when l.l_suppkey % 11 = 0 then null when l.l_suppkey % 13 = 0 then 'NL99' else 'NL80' end namespace,
 case l.l_linenumber % 4 when 0 then 'EPSG:4258' when 1 then 'EPSG4258' when 2 then 'EPSG:4326' end referentiehorizontaal_code,
 case when l.l_partkey % 50 = 0 then 'OW' end analysecompartiment_code,
 cast(2 as double) + (l.l_suppkey % 20) * cast(0.1 as double) + (l.l_linenumber % 3) * cast(0.001 as double) lon,
 cast(51.5 as double) + (l.l_suppkey % 20) * cast(0.1 as double) lat
 from {lineitem} l join {orders} o on l.l_orderkey=o.o_orderkey join {part} p on l.l_partkey=p.p_partkey
"""

RULES = """
select * from (values
 (2,'1-','D1C1;D5C2','A',cast(null as string),'SMALL','S0;S1;S2;S3;S4;S5','DEV0;DEV1','g0','1-1-1995','31-12-1998','n','meetwaarde.lokaalid',3,'<=','15-9-2022'),
 (3,'1-URGENT','D8C1','A',cast(null as string),'SMALL','S3;S4;S5;S6','DEV1;DEV2','g1','1-1-1996','31-12-2001','j','meetwaarde.lokaalid',4,'=','1-3-2023'),
 (4,'2-HIGH','D1C2','R','O','LARGE',cast(null as string),'DEV0;DEV1;DEV2','g1','1-1-1995','31-12-2001','j','monster.lokaalid',1,'>=','15-9-2023'),
 (5,'3-MEDIUM','D10C1;D10C3','N','O','PROMO','S10;S11;S12;S13;S14;S15;S16','DEV2','g2','1-1-1997','31-12-1997','j','meetwaarde.lokaalid',cast(null as int),'=','15-9-2023'),
 (6,'3-MEDIUM','D10C1','N',cast(null as string),'PROMO','S10;S11;S12','DEV0;DEV2','g0','1-6-1997','31-12-1999',cast(null as string),'meetwaarde.lokaalid',2,'>=','1-1-2024'))
 r(rule_id,databundelcode,criteria,grootheid_code,typering_code,eenheid_code,locatiecode,bemonsteringsapparaat_omschrijving,groep,startdatum,einddatum,biotaxon_of_niet,group_by,aantal,limiet,leverdatum)
"""

# One rule for each combination of bundle, unit and quantity that occurs; its number follows from the
# combination, so nothing has to be numbered as a whole.
RULES_SCALE = """
select cast(cast(substr(o_orderpriority, 1, 1) as int) * 10000 + ascii(substr(p_type, 2, 1)) * 100 + ascii(l_returnflag) as int) rule_id, o_orderpriority databundelcode, 'D1C1;D8C1' criteria,
 l_returnflag grootheid_code, cast(null as string) typering_code, p_type eenheid_code,
 'S0;S1;S2;S3;S4;S5;S6;S7;S8;S9;S10;S11;S12;S13;S14;S15;S16;S17' locatiecode, 'DEV0;DEV1' bemonsteringsapparaat_omschrijving, 'g'||cast(length(p_type) % 3 as string) groep,
 '1-1-1995' startdatum, case when l_returnflag = 'A' then '31-12-1998' else '31-12-2001' end einddatum, case when p_type like '%M%' then 'j' else 'n' end biotaxon_of_niet,
 'meetwaarde.lokaalid' group_by, case when l_returnflag = 'N' then null else 20 end aantal, case l_returnflag when 'A' then '<=' when 'R' then '>=' else '=' end limiet, '15-9-2023' leverdatum
 from (select distinct o_orderpriority, p_type, l_returnflag from {lineitem} join {orders} on l_orderkey = o_orderkey join {part} on l_partkey = p_partkey) c
"""

GROUPS = """
select distinct 'g'||cast(p_size % 3 as string) groep, upper(p_name) parameter from {part} union select distinct 'g'||cast(p_size % 3 as string), p_brand from {part} where p_size < 10
"""

POINTS = """
select distinct case when s_suppkey % 10 = 7 then 'X' else 'S' end||cast(s_suppkey % 20 as string) mpnident, cast(2 as double) + (s_suppkey % 20) * cast(0.1 as double) lon, cast(51.5 as double) + (s_suppkey % 20) * cast(0.1 as double) lat from {supplier}
"""

# A square with a hole around every location: (ring, vertex, degrees east, degrees north) of its corners.
_CORNERS = (
    (0, 0, -0.05, -0.05), (0, 1, 0.05, -0.05), (0, 2, 0.05, 0.05), (0, 3, -0.05, 0.05), (0, 4, -0.05, -0.05),
    (1, 0, -0.001, -0.001), (1, 1, 0.003, -0.001), (1, 2, 0.003, 0.001), (1, 3, -0.001, 0.001), (1, 4, -0.001, -0.001),
)
RINGS = " union all ".join(
    f"select distinct 'S'||cast(s_suppkey % 20 as string) mpnident, 0 geom, {ring} ring, {vertex} vertex, "
    f"cast(2 as double) + (s_suppkey % 20) * cast(0.1 as double) + cast({east} as double) lon, "
    f"cast(51.5 as double) + (s_suppkey % 20) * cast(0.1 as double) + cast({north} as double) lat, true area from {{supplier}}"
    for ring, vertex, east, north in _CORNERS
)

COLUMNS = """
select * from (values (1,'meetobject_lokaalid','V'),(2,'begindatum','V'),(3,'kwaliteitsoordeel_code','V'),(4,'namespace','V'),(5,'parameter_code','C'),(6,'limietsymbool','N'),(7,'not_in_bundle','V')) c(col_ord,kolomnaam,ihm_verplicht)
"""

STATUS = """
select case when o_custkey % 4 = 0 then 'D_' else 'B_' end||cast(o_custkey as string)||'+v'||cast(o_orderkey as string) databundelcode, 'ANSNL-'||o_orderpriority krmcriterium, o_orderdate last_updated,
 'Databundel validatie is: '||case when o_orderstatus='F' then 'True' else 'False' end||' en akkoord file is: '||case when o_orderkey % 3 = 0 then 'True' else 'False' end status,
 o_orderkey ord from {orders}
"""

PLANNING = """
select case when c_custkey % 7 = 0 then 'P_' else 'B_' end||cast(c_custkey as string)||' '||c_mktsegment databundelcode, c_mktsegment criteria,
 cast(c_custkey % 28 + 1 as string)||'-'||cast(c_custkey % 12 + 1 as string)||'-'||cast(2022 + c_custkey % 4 as string) leverdatum, c_custkey ord from {customer}
union all select 'B_'||cast(c_custkey as string)||' extra', c_mktsegment, '15-9-2023', c_custkey + 100000000 from {customer} where c_custkey % 10 = 1
union all select 'B_'||cast(c_custkey as string)||' '||c_mktsegment, c_mktsegment, case when c_custkey % 3 = 0 then 'onbekend' else '31-12-2026' end, c_custkey + 200000000 from {customer} where c_custkey % 9 = 2
"""

PUBLISHED = """
select case when c_custkey % 5 = 0 then 'B_' else 'U_' end||cast(c_custkey as string)||'+'||c_mktsegment||'+final' databundelcode from {customer}
"""

# Map layers per criterion: one in four current, one in nine a test layer.
CATALOG = """
select c_custkey id, c_mktsegment criterium, c_mktsegment||case when c_custkey % 9 = 4 then ' tst_actueel_indicator' when c_custkey % 4 = 3 then ' Actueel' else ' historie' end||' '||cast(c_custkey as string) name from {customer}
"""

# Approvals by hand: a bundle with an expensive order is approved.
APPROVALS = """
select o_orderpriority bundle, max(o_totalprice) > 0 and o_orderpriority in ('2-HIGH', '4-NOT SPECIFIED') approved from {orders} group by o_orderpriority
"""

# New deliveries: every customer delivers again, replacing the status of the last order;
# customers without orders deliver for the first time.
UPDATES = """
select 'B_'||cast(c_custkey as string)||'+v'||coalesce(cast(max(o_orderkey) as string), 'new') databundelcode, 'ANSNL-'||c_mktsegment krmcriterium,
 'Databundel validatie is: True en akkoord file is: False' status from {customer} left join {orders} on c_custkey = o_custkey group by c_custkey, c_mktsegment
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in names}


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A view of this module over the tables in ``sf_dir``."""
    used = [t for t in ("lineitem", "orders", "part", "supplier", "customer") if "{" + t + "}" in sql]
    return spark.sql(sql, **tables(spark, sf_dir, *used))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = tables(spark, sf_dir, "orders", "part")
    return spark.sql(RECORDS, lineitem=table(spark, sf_dir, "lineitem"), **used)


def delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records as a written table, for jobs with several passes over them: the tables are joined once, not for each pass."""
    found, path = records(spark, sf_dir), scratch_path(spark, "delivered")
    found.write.parquet(path)
    return spark.read.schema(found.schema).parquet(path)


def bundle_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bundle names; at hand in the order table, so that no pass over the records is needed."""
    return view(spark, sf_dir, "select distinct o_orderpriority bundle from {orders}")


def references(spark: SparkSession, sf_dir: str, scale: bool = False, **settings) -> References:
    """The reference lists of the tests, with the short hand-made or the generated rule list."""
    return References(
        rules=view(spark, sf_dir, RULES_SCALE if scale else RULES),
        groups=view(spark, sf_dir, GROUPS),
        columns=view(spark, sf_dir, COLUMNS),
        points=view(spark, sf_dir, POINTS),
        settings=Settings(order_by=ORDER, **settings),
    )
