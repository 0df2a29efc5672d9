"""Pages as pictures: thresholds, ruled lines and columns of boxes, without an image library.

A raster row is an array of grey levels (image keys, y, levels). What concerns one row stays in it; what concerns a
column or a whole picture is aggregated before it is dealt out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def otsu_threshold(rows: DataFrame, by: tuple[str, ...] = ("image",), levels: str = "levels", most: int = 256) -> DataFrame:
    """(by, threshold): the level that parts each picture's pixels into two classes whose means differ most.

    Pixels at or below the threshold are the darker class. From a histogram, of which tasks deal out at most ``most``
    counts a picture; classes are prefix sums over it, and of equal variances the lower level counts. Levels outside
    0 to most - 1 and nulls don't count; a picture of one level has that level."""
    pixels = rows.select(*by, F.explode(levels).alias("v")).where(F.col("v").between(0, most - 1))
    bins = pixels.groupBy(*by, F.col("v").cast("int").alias("v")).agg(F.count("*").alias("n"))
    up_to = Window.partitionBy(*by).orderBy("v")  # of one picture's levels
    whole = Window.partitionBy(*by)
    sums = bins.withColumns({"w0": F.sum("n").over(up_to), "s0": F.sum(F.col("n") * F.col("v")).over(up_to), "w": F.sum("n").over(whole), "s": F.sum(F.col("n") * F.col("v")).over(whole)})
    w1 = F.col("w") - F.col("w0")
    # in whole numbers up to the last step: (mean difference squared) w0 w1 = (s0 w - s w0)^2 / (w0 w1 w^2)
    apart = (F.col("s0") * F.col("w") - F.col("s") * F.col("w0")).cast("double")
    between = F.when(w1 == 0, 0.0).otherwise(apart * apart / (F.col("w0").cast("double") * w1))
    return sums.groupBy(*by).agg(F.max(F.struct(between.alias("b"), (-F.col("v")).alias("v")))["v"].alias("v")).select(*by, (-F.col("v")).alias("threshold"))


def runs(mask: Column) -> Column:
    """The runs of true in an array of booleans, as (start, size)."""
    kind = "array<struct<start:int,size:int>>"
    ends = F.filter(F.transform(F.concat(mask, F.array(F.lit(False))), lambda m, i: F.when(~F.coalesce(m, F.lit(False)), i)), lambda i: i.isNotNull())
    before = F.concat(F.array(F.lit(-1)), F.slice(ends, F.lit(1), F.size(ends) - 1))
    return F.filter(F.zip_with(before, ends, lambda a, b: F.struct((a + 1).alias("start"), (b - a - 1).alias("size"))), lambda r: r["size"] > 0).cast(kind)


def runs_of_places(places: Column) -> Column:
    """The runs of neighbours in a sorted array of distinct places, as (start, size)."""
    start = F.array().cast("array<struct<start:int,size:int>>")

    def put(acc: Column, p: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        touches = F.coalesce(last["start"] + last["size"] == p, F.lit(False))
        grown = F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(last["start"].alias("start"), (last["size"] + 1).alias("size"))))
        return F.when(touches, grown).otherwise(F.concat(acc, F.array(F.struct(p.alias("start"), F.lit(1).alias("size")))))

    return F.aggregate(places, start, put)


def covered(found: Column, least: int) -> Column:
    """How many places are in runs of ``least`` or more: what an opening leaves."""
    return F.aggregate(F.filter(found, lambda r: r["size"] >= least), F.lit(0), lambda a, r: a + r["size"])


def _middles(places: Column, length: Column) -> Column:
    """Middles of runs of places; a run that reaches the end isn't closed."""
    return F.transform(F.filter(runs_of_places(F.array_sort(places)), lambda r: r["start"] + r["size"] < length), lambda r: F.floor(r["start"] + r["size"] / 2).cast("int"))


def ruled_lines(rows: DataFrame, by: tuple[str, ...] = ("image",), mask: str = "mask", kernel: int = 8, share: float = 0.3) -> DataFrame:
    """(by, ys, xs): positions of the horizontal and vertical lines of pictures (by, y, mask of dark pixels).

    An opening keeps runs of at least ``kernel`` dark pixels; a row or column is part of a line where what is kept
    covers more than ``share`` of the picture's width or height; touching ones are one line, at their middle. Rows lie
    from 0 to the largest y; missing ones are blank, and short masks end blank. Pictures without lines have empty arrays."""
    keys = list(by)
    rows = rows.where(F.col(mask).isNotNull())
    lines = rows.select(*keys, "y", F.size(mask).alias("width"), covered(runs(F.col(mask)), kernel).alias("cover"))
    flat = lines.groupBy(*keys).agg((F.max("y") + 1).alias("height"), F.max("width").alias("width"), F.collect_list(F.when(F.col("cover") >= kernel, F.struct("y", "cover"))).alias("some"))
    flat = flat.select(*keys, "height", "width", F.transform(F.filter("some", lambda s: s["cover"] > F.col("width") * share), lambda s: s["y"].cast("int")).alias("ys"))
    dark = rows.select(*keys, "y", F.explode(F.filter(F.transform(F.col(mask), lambda m, i: F.when(m, i)), lambda i: i.isNotNull())).alias("x"))
    columns = dark.groupBy(*keys, "x").agg(F.array_sort(F.collect_list(F.col("y").cast("int"))).alias("at"))  # of one column of one picture
    columns = columns.select(*keys, "x", covered(runs_of_places(F.col("at")), kernel).alias("cover")).where(F.col("cover") >= kernel)
    upright = columns.groupBy(*keys).agg(F.collect_list(F.struct("x", "cover")).alias("some"))
    both = flat.join(upright, keys, "left")
    xs = F.transform(F.filter(F.coalesce("some", F.array().cast("array<struct<x:int,cover:int>>")), lambda s: s["cover"] > F.col("height") * share), lambda s: s["x"])
    return both.select(*keys, _middles(F.col("ys"), F.col("height")).alias("ys"), _middles(xs, F.col("width")).alias("xs"))


def ruled_cells(lines: DataFrame, by: tuple[str, ...] = ("image",)) -> DataFrame:
    """(by, row, col, y1, y2, x1, x2): the cells between neighbouring lines; none where an axis has fewer than two."""
    spans = lambda c: F.zip_with(F.slice(c, F.lit(1), F.greatest(F.size(c) - 1, F.lit(0))), F.slice(c, F.lit(2), F.greatest(F.size(c) - 1, F.lit(0))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    rows = lines.select(*by, "xs", F.posexplode(spans(F.col("ys"))).alias("row", "y")).select(*by, "row", "y", F.posexplode(spans(F.col("xs"))).alias("col", "x"))
    return rows.select(*by, "row", "col", F.col("y.a").alias("y1"), F.col("y.b").alias("y2"), F.col("x.a").alias("x1"), F.col("x.b").alias("x2"))


def text_columns(boxes: DataFrame, by: tuple[str, ...] = ("doc_id", "page_no"), least_gap: float = 0.0) -> DataFrame:
    """boxes (by, x1, x2, ...) with the table column (``col``, from 0) that each lies in, and its extent (col_left, col_right).

    A sweep over the ends of the boxes of a page: where as many have ended as have begun lies a gutter, if it is wider than
    ``least_gap``. Boxes without extent are columns of their own place; boxes with a null end are left out."""
    keys = list(by)
    kept = boxes.where(F.col("x1").isNotNull() & F.col("x2").isNotNull()).withColumns({"x1": F.least("x1", "x2"), "x2": F.greatest("x1", "x2")})
    ends = kept.select(*keys, F.explode(F.array(F.struct(F.col("x1").alias("x"), F.lit(1).alias("d")), F.struct((F.col("x2") + least_gap).alias("x"), F.lit(-1).alias("d")))).alias("e"))
    # ends at one place are one, beginnings first: what touches is not apart
    steps = ends.groupBy(*keys, F.col("e.x").alias("x"), F.col("e.d").alias("d")).agg(F.sum("e.d").alias("n"))
    sweep = Window.partitionBy(*keys).orderBy("x", F.desc("d"))  # of one page
    open_ = steps.withColumn("open", F.sum("n").over(sweep))
    gaps = open_.where((F.col("open") == 0) & (F.col("d") == -1)).select(*keys, (F.col("x") - least_gap).alias("col_right"))
    spans = gaps.groupBy(*keys).agg(F.array_sort(F.collect_list("col_right")).alias("__rights"))  # of one page's gutters
    # the first right edge that isn't left of the box
    at = F.size(F.filter("__rights", lambda r: r < F.col("x1")))
    out = kept.join(spans, keys).withColumn("col", at).withColumn("col_right", F.get("__rights", F.col("col"))).drop("__rights")
    return out.withColumn("col_left", F.min("x1").over(Window.partitionBy(*keys, "col")))
