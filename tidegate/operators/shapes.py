"""Distances to lines and areas of any size, by tiles of their edges.

A tile holds consecutive edges of a ring and their box. For a place, the distance to a vertex of each tile bounds how far the
shape can be, so only tiles whose box is nearer than the least of these bounds can hold the nearest edge; for the
question whether a place lies inside, only tiles that a line to the east of it can cross matter. The edges of those tiles
alone are looked at, each in a row of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.functions import geo

TILE = 64  # edges


def edge_tiles(rings: DataFrame, size: int = TILE) -> DataFrame:
    """``mpnident, geom, ring, tile, area``, the box ``x_min .. y_max``, a vertex ``x, y`` and the ``edges`` of each tile.

    ``rings`` is ``(mpnident, geom, ring, vertex, lon, lat, area)``. A ring of one vertex is an edge of no length;
    vertices without coordinates are passed over.
    """
    east, north = geo.to_utm31("lon", "lat")
    placed = rings.select("mpnident", "geom", "ring", "vertex", "area", east.alias("x1"), north.alias("y1"))
    along = Window.partitionBy("mpnident", "geom", "ring").orderBy("vertex")
    linked = placed.where("x1 is not null and y1 is not null").select(
        "*", F.row_number().over(along).alias("place"), F.lead(F.struct("x1", "y1")).over(along).alias("next")
    )
    ends = linked.where((F.col("place") == 1) | F.col("next").isNotNull()).withColumn("next", F.coalesce("next", F.struct("x1", "y1")))
    edges = ends.select(
        "mpnident", "geom", "ring", "area", F.floor((F.col("place") - 1) / size).alias("tile"),
        "x1", "y1", F.col("next.x1").alias("x2"), F.col("next.y1").alias("y2"),
    )
    lower, upper = (lambda c: F.min(F.least(f"{c}1", f"{c}2"))), (lambda c: F.max(F.greatest(f"{c}1", f"{c}2")))
    return edges.groupBy("mpnident", "geom", "ring", "tile").agg(
        F.max("area").alias("area"), lower("x").alias("x_min"), upper("x").alias("x_max"), lower("y").alias("y_min"),
        upper("y").alias("y_max"), F.first(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y"))).alias("some"),
        F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges"),
    )


def tile_distances(places: DataFrame, tiles: DataFrame) -> DataFrame:
    """The columns of ``places``, ``geom`` and ``metres`` of every place (``location, x, y`` and more, each once) and shape of its location.

    0 inside of an area, holes counted out; else the distance to the nearest edge.
    """
    here, there, own = F.col("location"), F.col("mpnident"), places.columns
    boxes = tiles.drop("edges")
    most = geo.point_distance(F.col("x"), F.col("y"), F.col("some.x"), F.col("some.y"))
    reach = places.join(boxes, here == there).groupBy(*own, "geom").agg(F.min(most).alias("most"))

    def beyond(c: str) -> Column:
        return F.greatest(F.col(f"{c}_min") - F.col(c), F.lit(0.0), F.col(c) - F.col(f"{c}_max"))

    least = F.sqrt(beyond("x") * beyond("x") + beyond("y") * beyond("y"))
    crossed = F.col("area") & F.col("y").between(F.col("y_min"), F.col("y_max")) & (F.col("x") <= F.col("x_max"))
    shaped = tiles.withColumnRenamed("geom", "of_geom")
    met = reach.join(shaped, (here == there) & (F.col("geom") == F.col("of_geom"))).where((least <= F.col("most")) | crossed)
    each = met.select(*own, "geom", "area", F.inline("edges"))
    x, y, x1, y1, x2, y2 = map(F.col, ("x", "y", "x1", "y1", "x2", "y2"))
    passes = ((y1 > y) != (y2 > y)) & (x < (x2 - x1) * (y - y1) / F.nullif(y2 - y1, F.lit(0.0)) + x1)
    found = each.groupBy(*own, "geom").agg(
        F.min(geo.segment_distance(x, y, x1, y1, x2, y2)).alias("nearest"), F.count_if(passes & F.col("area")).alias("passed")
    )
    return found.select(*own, "geom", F.when(F.col("passed") % 2 == 1, 0.0).otherwise(F.col("nearest")).alias("metres"))
