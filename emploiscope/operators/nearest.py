"""The nearest of many places for points on a map, without comparing every point with every place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emploiscope.session import working_folder

# A node of the tree that holds more positions is divided into 16; the figure sets the work, not the result.
LEAF = 32
# Degrees of the root, which holds the globe from its south-west corner; nodes of the last level (0.2 m) stay whole.
ROOT = 512.0
LAST_LEVEL = 14


def nearest_places(points: DataFrame, places: DataFrame, key: str, latitude: str = "latitude", longitude: str = "longitude") -> DataFrame:
    """``latitude, longitude, key`` of the nearest place for every distinct position in ``points``.

    Distances are those of a map that is true at the point's latitude: degrees of latitude, and
    degrees of longitude times its cosine; nothing wraps at 180 degrees. Equally near places go by the
    smaller key. Positions without both numbers, or off the globe, have no row; nor has any position if
    no place has a position.

    The places are laid out as a tree of boxes, divided where there are many. A point first goes down to
    the nearest box of every level, which gives a distance that its nearest place can't exceed; it then
    visits the boxes that aren't farther away, and is compared with the places of the last ones. Neither
    a dense region nor places that share a position make pairs of all their points and places: a point
    keeps one row in the first part, and one for each box that may hold its nearest place in the second.
    """
    spark = points.sparkSession
    lat, lon = F.col(latitude).cast("double"), F.col(longitude).cast("double")
    on_globe = (F.abs(lat) <= 90) & (F.abs(lon) <= 180)
    known = places.select(F.col(key).alias("key"), lat.alias("lat"), lon.alias("lon")).filter(on_globe & F.col("key").isNotNull())
    levels = place_tree(known.groupBy("lat", "lon").agg(F.min("key").alias("key")))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    search = points.select(lat.alias("_lat"), lon.alias("_lon")).filter(on_globe).repartition(tasks, "_lat", "_lon").distinct()
    search = search.withColumn("_narrow", F.cos(F.radians("_lat"))).withColumn("_bound", F.lit(float("inf")))
    # The root's id as a value of the row: a join with a constant would compare all rows of both sides.
    root, carried = _cell(0, "_lat", "_lon").alias("_at"), ["_lat", "_lon", "_narrow"]
    search = search.select(*carried, "_bound", root)
    for nodes in levels:
        boxes = F.transform("_children", lambda box: F.struct(_least(box).alias("least"), _most(box).alias("most"), box["id"].alias("id")))
        search = search.join(nodes.select("_id", "_children"), F.col("_at") == F.col("_id"), "left").select(*carried, "_bound", boxes.alias("_boxes"))
        surely = F.array_min(F.transform("_boxes", lambda box: box["most"]))
        search = search.select(*carried, F.least("_bound", surely).alias("_bound"), F.array_min("_boxes")["id"].alias("_at"))
    search = search.select(*carried, "_bound", root, F.lit(None).cast(f"struct<away:double,key:{known.schema['key'].dataType.simpleString()}>").alias("_best"))
    for nodes in levels:
        best = F.array_min(F.transform("_places", lambda place: F.struct(_away(place["lon"] - F.col("_lon"), place["lat"] - F.col("_lat")).alias("away"), place["key"].alias("key"))))
        near = F.transform(F.filter("_children", lambda box: _least(box) <= F.col("_bound")), lambda box: box["id"])
        search = search.join(nodes, F.col("_at") == F.col("_id"), "left").select(*carried, "_bound", F.coalesce("_best", best).alias("_best"), F.explode_outer(near).alias("_at"))
        search = search.filter("_at IS NOT NULL OR _best IS NOT NULL")
    found = search.groupBy("_lat", "_lon").agg(F.min("_best").alias("_best")).filter("_best IS NOT NULL")
    return found.select(F.col("_lat").alias(latitude), F.col("_lon").alias(longitude), F.col("_best.key").alias(key))


def place_tree(known: DataFrame) -> list[DataFrame]:
    """Per level the nodes ``_id, _children, _places`` over the distinct positions ``known(lat, lon, key)``.

    A node of at most ``LEAF`` positions has them as ``_places``; any other has the boxes (id, south, north,
    west, east) around what its parts hold as ``_children``. Ids are those of a level; the root's is 0.
    """
    spark = known.sparkSession
    folder = working_folder(spark, "nearest")
    known = _saved(spark, known, f"{folder}/positions")
    levels, open_ = [], known.withColumn("_id", _cell(0))
    for level in range(LAST_LEVEL + 1):
        sizes = open_.groupBy("_id").agg(F.count("*").alias("n"))
        many = F.col("n") > (LEAF if level < LAST_LEVEL else 1 << 62)
        sizes = _saved(spark, sizes.select("_id", many.alias("_many")), f"{folder}/sizes-{level}")
        held = open_.join(sizes, "_id")
        whole = held.filter("NOT _many").groupBy("_id").agg(F.collect_list(F.struct("lat", "lon", "key")).alias("_places"))
        divided = held.filter("_many").drop("_many").withColumn("_part", _cell(level + 1))
        extent = [F.min("lat").alias("south"), F.max("lat").alias("north"), F.min("lon").alias("west"), F.max("lon").alias("east")]
        boxes = divided.groupBy("_id", F.col("_part").alias("id")).agg(*extent).groupBy("_id")
        children = boxes.agg(F.collect_list(F.struct("id", "south", "north", "west", "east")).alias("_children"))
        nodes = children.unionByName(whole, allowMissingColumns=True).select("_id", "_children", "_places")
        levels.append(_saved(spark, nodes, f"{folder}/level-{level}"))
        if sizes.filter("_many").isEmpty():
            return levels
        open_ = divided.select("lat", "lon", "key", F.col("_part").alias("_id"))
    return levels


def _saved(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _cell(level: int, lat: str = "lat", lon: str = "lon") -> Column:
    width = F.lit(ROOT / 4**level)
    east, north = F.floor((F.col(lon) + 180) / width), F.floor((F.col(lat) + 180) / width)
    return east * F.lit(4**LAST_LEVEL) + north


def _away(east: Column, north: Column) -> Column:
    """The square of a distance; the same steps for places and boxes, so that rounding leaves no place outside its box."""
    return F.pow(east * F.col("_narrow"), F.lit(2.0)) + F.pow(north, F.lit(2.0))


def _least(box: Column) -> Column:
    """How near a place of the box may be."""
    none = F.lit(0.0)
    east = F.greatest(box["west"] - F.col("_lon"), F.col("_lon") - box["east"], none)
    return _away(east, F.greatest(box["south"] - F.col("_lat"), F.col("_lat") - box["north"], none))


def _most(box: Column) -> Column:
    """How far the farthest corner of the box is."""
    east = F.greatest(F.col("_lon") - box["west"], box["east"] - F.col("_lon"))
    return _away(east, F.greatest(F.col("_lat") - box["south"], box["north"] - F.col("_lat")))
