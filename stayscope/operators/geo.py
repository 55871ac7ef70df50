"""Codes looked up by the end of a text or by the region a point lies in; map markers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayscope.functions.scores import marker_colour
from stayscope.operators.joins import attach
from stayscope.sources.checkpoints import cut_lineage

LISTED_CELLS = 64
ROUNDING = 1e-9  # of where an outline is crossed, as a share of its coordinates


def suffix_lookup(
    df: DataFrame,
    text_col: str,
    lookup: DataFrame,
    name_col: str,
    code_col: str,
    order_col: str,
    prefer: str = "first",
    out: str = "Country",
) -> DataFrame:
    """Add the code of the name that a text ends with, ignoring case; NULL without a match.

    Of several names the first by `order_col` wins, or with ``prefer="longest"`` the longest; after
    that NULL orders come last and names and codes decide. Each distinct text offers its ends, in
    upper case and in the lengths that occur, to an equality join, whatever the lookup's size.
    """
    names = lookup.select(
        F.upper(name_col).alias("_name"), F.col(code_col).alias("_code"), F.col(order_col).alias("_ord")
    ).where(F.length("_name") > 0)
    rank = F.struct(F.col("_ord").isNull(), "_ord", "_name", "_code")
    names = names.groupBy("_name").agg(F.min(rank).alias("_rank"), F.min_by("_code", rank).alias("_code"))
    names = cut_lineage(names)
    lengths = names.agg(F.collect_set(F.length("_name")).alias("l")).scalar()
    ends = (
        df.select(text_col)
        .where(F.col(text_col).isNotNull())
        .distinct()
        .withColumns({"_upper": F.upper(text_col), "_len": F.explode(lengths)})
        .where(F.col("_len") <= F.length("_upper"))
        .withColumn("_name", F.right("_upper", F.col("_len")))
        .drop("_upper")
    )
    best = F.col("_rank") if prefer == "first" else F.struct(-F.col("_len"), F.col("_rank"))
    found = attach(ends, names, "_name", "inner").groupBy(text_col).agg(F.min_by("_code", best).alias(out))
    return attach(df, cut_lineage(found), text_col)


def _inside(x: Column, y: Column, vertices: Column) -> Column:
    """Whether a ray from the point to the right crosses the outline an odd number of times."""
    turned = F.concat(F.slice(vertices, 2, F.size(vertices)), F.slice(vertices, 1, 1))
    edges = F.zip_with(vertices, turned, lambda a, b: F.struct(a.alias("a"), b.alias("b")))

    def crosses(e: Column) -> Column:
        a, b = e["a"], e["b"]
        meets = a["x"] + F.try_divide((b["x"] - a["x"]) * (y - a["y"]), b["y"] - a["y"])
        return ((a["y"] > y) != (b["y"] > y)) & F.coalesce(x < meets, F.lit(False))

    return F.aggregate(edges, F.lit(False), lambda odd, e: odd != crosses(e))


def point_lookup(
    df: DataFrame,
    x: str,
    y: str,
    regions: DataFrame,
    code_col: str,
    vertices_col: str = "vertices",
    cell: float = 1.0,
    out: str = "Country",
    listed_cells: int = LISTED_CELLS,
) -> DataFrame:
    """Add the code of the region a point lies in; the smallest code if several; NULL if none.

    `regions` has a code and an array of (x, y) corners per row. A region is listed, without its
    outline, under the grid cells that its box touches: cells of size `cell` times the smallest power
    of two at which there are at most `listed_cells`, so a region of any size and unit has a
    bounded list. Points look in one cell of each size that occurs, and candidates meet by an
    equality join, which keeps those whose box holds the point; outlines come last. Only distinct
    points are looked up, by as many tasks as a shuffle has: their few bytes say little of the work.
    """

    def extent(field: str) -> tuple[Column, Column]:
        values = F.transform(vertices_col, lambda v: v[field].cast("double"))
        return F.array_min(values), F.array_max(values)

    (x0, x1), (y0, y1) = extent("x"), extent("y")
    side = max(1, int(listed_cells**0.5) - 1)
    reach = F.greatest(x1 - x0, y1 - y0) / (cell * side)
    level = F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(reach, F.lit(1.0))))).cast("int")
    shapes = regions.where(F.size(vertices_col) > 0).select(
        F.col(code_col).alias("_code"), F.col(vertices_col).alias("_vertices"), level.alias("_level"),
        *[v.alias(n) for n, v in zip(("_x0", "_x1", "_y0", "_y1"), (x0, x1, y0, y1), strict=True)],
    )
    shapes = cut_lineage(shapes.withColumn("_region", F.monotonically_increasing_id()))

    def at(value: Column | str) -> Column:
        return F.floor(F.col(value) / (F.pow(F.lit(2.0), F.col("_level")) * cell)).cast("long")

    def held(value: str, low: str, high: str) -> Column:
        spare = F.greatest(F.abs(low), F.abs(high)) * ROUNDING
        return (F.col(value) >= F.col(low) - spare) & (F.col(value) <= F.col(high) + spare)

    box = ["_x0", "_x1", "_y0", "_y1"]
    listed = shapes.select("_region", "_level", *box, F.explode(F.sequence(at("_x0"), at("_x1"))).alias("_cx"))
    listed = listed.withColumn("_cy", F.explode(F.sequence(at("_y0"), at("_y1"))))
    levels = shapes.agg(F.collect_set("_level").alias("l")).scalar()
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    points = df.select(x, y).where(F.col(x).isNotNull() & F.col(y).isNotNull()).distinct().repartition(tasks, x, y)
    points = points.withColumn("_level", F.explode(levels)).withColumns({"_cx": at(x), "_cy": at(y)})
    near = attach(points, cut_lineage(listed), ["_level", "_cx", "_cy"], "inner", tasks=tasks)
    near = near.where(held(x, "_x0", "_x1") & held(y, "_y0", "_y1")).select(x, y, "_region")
    outlines = shapes.select("_region", "_code", "_vertices")
    found = (
        attach(near, outlines, "_region", "inner")
        .where(_inside(F.col(x).cast("double"), F.col(y).cast("double"), F.col("_vertices")))
        .groupBy(x, y)
        .agg(F.min("_code").alias(out))
    )
    return attach(df, cut_lineage(found), [x, y])


def map_markers(df: DataFrame, x: str, y: str, score: str, name: str) -> DataFrame:
    """Distinct places with both coordinates: name, position, score and marker colour."""
    placed = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return placed.select(name, x, y, score).distinct().withColumn("colour", marker_colour(score))
