"""Reference lists, location layers, status, planning and count-report tables."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions import text, wkb
from tidegate.functions.labels import count_report_name
from tidegate.sources import snapshots
from tidegate.sources.delimited import read_numbered

GUESSED_DELIMITERS = (",", ";", "\t", "|")


def one_file(df: DataFrame, path: str) -> DataFrame:
    """``df`` if it is read from one file, whose rows then are in file order."""
    if len(df.inputFiles()) != 1:
        raise ValueError(f"{path}: an ordered list must be one file")
    return df


def read_list(spark: SparkSession, path: str, sep: str = ";", encoding: str = "cp1252") -> DataFrame:
    """One reference file with ``new_index`` 1..N in file order, the usual empty-cell tokens as null.

    The file is read in parts, whose number changes neither the records nor their numbers.
    """
    raw = read_numbered(spark, path, sep, encoding)
    cells = [text.blank_to_null(raw[name]).alias(c) for c in raw.columns[:-1] for name in ["`" + c.replace("`", "``") + "`"]]
    return raw.select(*cells, "new_index")


def read_rules(spark: SparkSession, path: str, sep: str = ";", encoding: str = "cp1252") -> DataFrame:
    """Rule list; a rule's id is its row in the spreadsheet (the header is row 1)."""
    rules = read_list(spark, path, sep, encoding).withColumn("rule_id", (F.col("new_index") + 1).cast("int"))
    names = {c: c.strip().lower() for c in rules.columns}
    amount = next((c for c, n in names.items() if n == "aantal"), None)
    if amount:
        rules = rules.withColumn(amount, F.col(f"`{amount}`").try_cast("double").cast("int"))
    return rules


def read_columns(spark: SparkSession, path: str, sep: str = ";", encoding: str = "cp1252") -> DataFrame:
    """Column definition in file order."""
    return read_list(spark, path, sep, encoding).withColumnRenamed("new_index", "col_ord")


def locations_from_wkt(layer: DataFrame, wkt: str = "geometry") -> tuple[DataFrame, DataFrame]:
    """Points and rings of a layer ``(mpnident, <wkt>)`` with points, lines, polygons and multi-forms."""
    numbered = layer.select("mpnident", F.upper(wkt).alias("_wkt"), F.xxhash64(wkt).alias("geom"))
    bodies = numbered.withColumn("_bodies", F.regexp_extract_all("_wkt", F.lit(r"\(([^()]+)\)"), F.lit(1)))
    is_point = F.col("_wkt").contains("POINT")
    xy = lambda c: F.split(F.trim(c), r"\s+")
    coordinate = lambda c, i: F.get(xy(c), F.lit(i)).try_cast("double")

    pairs = bodies.where(is_point).withColumn("_body", F.explode("_bodies"))
    pairs = pairs.withColumn("_pair", F.explode(F.split("_body", ",")))
    points = pairs.select(
        "mpnident", coordinate(F.col("_pair"), 0).alias("lon"), coordinate(F.col("_pair"), 1).alias("lat")
    )
    rings = bodies.where(~is_point).select(
        "mpnident",
        "geom",
        F.col("_wkt").contains("POLYGON").alias("area"),
        F.posexplode("_bodies").alias("ring", "_body"),
    )
    rings = rings.select(
        "mpnident", "geom", "area", "ring", F.posexplode(F.split("_body", ",")).alias("vertex", "_pair")
    ).select(
        "mpnident",
        "geom",
        "ring",
        "vertex",
        coordinate(F.col("_pair"), 0).alias("lon"),
        coordinate(F.col("_pair"), 1).alias("lat"),
        "area",
    )
    return points, rings


def locations_from_wkb(layer: DataFrame, geometry: str = "geometry", crs: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Points and rings of a layer ``(mpnident, <geometry>)`` in well-known binary, of any kind and byte order.

    With ``crs``, a column that names each row's system, coordinates are moved to degrees first. The lines of a collection
    and its areas are two shapes.
    """
    shape = F.col(geometry) if crs is None else wkb.to_lonlat(geometry, crs)
    named = layer.select("mpnident", F.xxhash64(geometry).alias("geom"), wkb.parsed(shape).alias("g"))
    parts = named.select("mpnident", "geom", "g.parts")
    of = lambda kind: F.flatten(F.transform(F.filter("parts", lambda p: p["kind"] == kind), lambda p: p["rings"]))
    points = parts.select("mpnident", F.explode(F.flatten(of(wkb.POINT))).alias("p")).select("mpnident", "p.x", "p.y")
    shapes = None
    for kind in (wkb.LINE, wkb.AREA):
        area = F.lit(kind == wkb.AREA)
        rings = parts.select("mpnident", F.xxhash64("geom", area).alias("geom"), F.posexplode(of(kind)).alias("ring", "vertices"), area.alias("area"))
        each = rings.select("mpnident", "geom", "ring", F.posexplode("vertices").alias("vertex", "p"), "area").select(
            "mpnident", "geom", "ring", "vertex", F.col("p.x").alias("lon"), F.col("p.y").alias("lat"), "area"
        )
        shapes = each if shapes is None else shapes.unionByName(each)
    return points.toDF("mpnident", "lon", "lat"), shapes


def union_layers(*layers: DataFrame) -> DataFrame:
    """Location layers of the same kind under each other."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), layers)


def guess_delimiter(spark: SparkSession, path: str) -> str:
    """The candidate that occurs most often in the header line."""
    header = spark.read.text(path).first()
    line = header["value"] if header else ""
    return max(GUESSED_DELIMITERS, key=line.count)


def read_dashboard_csv(
    spark: SparkSession, path: str, sep: str | None = None, numbers: tuple[str, ...] = (), order: str | None = None,
    part_files: bool = False,
) -> DataFrame:
    """Status, published or count-report table: headers lower-cased with underscores, ``ord`` in file order.

    ``numbers`` names the columns to read as whole numbers; the others stay text. With ``order``, a column that
    holds each row's place, ``path`` may be a folder of part files, which are read side by side; so it may with
    ``part_files``, for tables whose rows stand in no order (``ord`` then follows the files).
    """
    delimiter = sep or guess_delimiter(spark, path)
    raw = spark.read.csv(path, sep=delimiter, header=True, encoding="utf-8", multiLine=True, quote='"', escape='"')
    names = [re.sub(r"\s+", "_", c.strip().lower()) for c in raw.columns]
    df = raw.toDF(*names)
    for c in numbers:
        if c in names:
            df = df.withColumn(c, F.col(c).try_cast("double").cast("bigint"))
    if order:
        return _in_order(df, order)
    return (df if part_files else one_file(df, path)).withColumn("ord", F.monotonically_increasing_id())


def _in_order(df: DataFrame, order: str) -> DataFrame:
    """``df`` with the column ``order`` as the whole number ``ord``."""
    return df.withColumn("_ord", F.col(order).cast("bigint")).drop(order).withColumnRenamed("_ord", "ord")


def read_status(spark: SparkSession, path: str, sep: str | None = None, order: str | None = None) -> DataFrame:
    return read_dashboard_csv(spark, path, sep, order=order)


def read_published(spark: SparkSession, path: str, sep: str | None = None, order: str | None = None) -> DataFrame:
    return read_dashboard_csv(spark, path, sep, order=order)


def read_planning(spark: SparkSession, path: str, encoding: str = "utf-8", order: str | None = None) -> DataFrame:
    """Planning columns of the rule list, missing values as empty text; ``order`` as for the other tables."""
    raw = spark.read.csv(path, sep=";", header=True, encoding=encoding, multiLine=True, quote='"', escape='"')
    df = raw.toDF(*[c.strip() for c in raw.columns])
    columns = ("databundelcode", "criteria", "leverdatum")
    value = lambda c: F.coalesce(F.col(c), F.lit("")) if c in df.columns else F.lit("")
    if order:
        return _in_order(df.select(*[value(c).alias(c) for c in columns], F.col(order)), order)
    listed = one_file(df, path).select(*[value(c).alias(c) for c in columns])
    return listed.withColumn("ord", F.monotonically_increasing_id())


def read_count_report(spark: SparkSession, folder: str, bundle: str) -> DataFrame:
    """The count report of one bundle from the folder of reports."""
    name = spark.range(1).select(count_report_name(F.lit(bundle)).alias("n")).first()["n"]
    if name is None:
        raise ValueError("no bundle code given")
    return read_dashboard_csv(spark, f"{folder.rstrip('/')}/{name}", ",", ("aantaldat", "aantalval"), part_files=True)


def read_layers(spark: SparkSession, root: str, target: str = "test") -> DataFrame:
    """All exported layers of the test or the production folder, columns merged.

    Layers that deliveries have written are read as one snapshot of the current ones.
    """
    folders = {"test": "geopackages", "production": "geopackages_productie"}
    if target not in folders:
        raise ValueError(f"unknown target: {target}")
    current = snapshots.read(spark, root, folders[target])
    if current is not None:
        return current
    return spark.read.option("mergeSchema", "true").parquet(f"{root.rstrip('/')}/{folders[target]}")
