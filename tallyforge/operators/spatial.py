"""Layout: cells of text with places to rows and grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def boxes_to_text(boxes: DataFrame, least_conf: float = 0.5, share: float = 0.012, least_gap: float = 8.0) -> DataFrame:
    """(doc_id, page_no, text) of boxes (doc_id, page_no, page_height, y, x, conf, text): cells of one row are
    joined by tabs, rows by line feeds. A new row begins where y is further than the gap from the cell before."""
    page = ["doc_id", "page_no"]
    kept = boxes.where(F.coalesce("conf", F.lit(1.0)) >= least_conf)
    order = Window.partitionBy(*page).orderBy("y", "x", "text")
    gap = F.greatest(F.coalesce("page_height", F.lit(0)) * share, F.lit(least_gap))
    new = F.coalesce((F.col("y") - F.lag("y").over(order) > gap).cast("int"), F.lit(0))
    kept = kept.withColumn("__new", new).withColumn("__row", F.sum("__new").over(order))
    cells = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x", "y", "text"))), lambda c: c["text"]), "\t")  # of one row of one page
    rows = kept.groupBy(*page, "__row").agg(cells.alias("line"))
    return rows.groupBy(*page).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__row", "line"))), lambda r: r["line"]), "\n").alias("text"))


def runs_to_positions(projection: Column, share: float = 0.3) -> Column:
    """Midpoints of the runs where an array of numbers exceeds a share of its largest: ruled lines of a grid."""
    limit = F.array_max(projection) * share
    start = F.struct(F.lit(-1).alias("from"), F.expr("cast(array() as array<int>)").alias("out"))
    closed = F.concat(projection.cast("array<double>"), F.array(F.lit(-1.0)))

    def step(acc: Column, x: Column) -> Column:
        on = x["v"] > limit
        mid = ((acc["from"] + x["i"] - 1) / 2).cast("int")
        return F.struct(F.when(on, F.when(acc["from"] < 0, x["i"]).otherwise(acc["from"])).otherwise(-1).alias("from"), F.when(~on & (acc["from"] >= 0), F.concat(acc["out"], F.array(mid))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(F.transform(closed, lambda v, i: F.struct(v.alias("v"), i.alias("i"))), start, step, lambda acc: acc["out"])


def overlap(a: Column, b: Column) -> Column:
    """Area that two boxes [x1, y1, x2, y2] share."""
    side = lambda k: F.greatest(F.lit(0.0), F.least(F.get(a, F.lit(k + 2)), F.get(b, F.lit(k + 2))) - F.greatest(F.get(a, F.lit(k)), F.get(b, F.lit(k))))
    return side(0) * side(1)


def overlapping(cells: DataFrame, lines: DataFrame, size: float, keys: tuple[str, ...] = ("doc_id", "page_no")) -> DataFrame:
    """cells (keys, cell_id, bbox) with the lines (keys, line_id, bbox, text) that overlap them, and the area.

    Boxes are put into squares of a grid and joined by square, and a pair is kept in the square that has the
    corner where their overlap begins: an equi-join without duplicates, however large the page."""

    def squares(df: DataFrame, box: str) -> DataFrame:
        at = lambda k: F.floor(F.get(box, F.lit(k)) / size).cast("int")
        return df.withColumn("__x", F.explode(F.sequence(at(0), at(2)))).withColumn("__y", F.explode(F.sequence(at(1), at(3))))

    a = squares(cells.withColumnRenamed("bbox", "__a"), "__a")
    b = squares(lines.withColumnRenamed("bbox", "__b"), "__b")
    both = a.join(b, [*keys, "__x", "__y"]).withColumn("area", overlap(F.col("__a"), F.col("__b")))
    corner = lambda k: F.floor(F.greatest(F.get("__a", F.lit(k)), F.get("__b", F.lit(k))) / size)
    return both.where((F.col("area") > 0) & (corner(0) == F.col("__x")) & (corner(1) == F.col("__y"))).drop("__x", "__y", "__a", "__b")


def cell_texts(pairs: DataFrame, keys: tuple[str, ...] = ("doc_id", "page_no", "cell_id")) -> DataFrame:
    """(keys, text): the lines of each cell, those with more overlap first."""
    got = F.array_sort(F.collect_list(F.struct((-F.col("area")).alias("o"), "line_id", "text")))  # of one cell
    return pairs.groupBy(*keys).agg(F.concat_ws(" ", F.transform(got, lambda x: x["text"])).alias("text"))


def clean_grid(rows: Column) -> Column:
    """Cells trimmed and on one line; rows that are blank throughout left out; null for less than two rows."""
    done = F.transform(rows, lambda r: F.transform(r, lambda c: F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), "\n", " "))))
    some = F.filter(done, lambda r: F.exists(r, lambda c: c != ""))
    return F.when(F.size(some) >= 2, some)
