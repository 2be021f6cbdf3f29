"""Boxes of text found on page images: geometry, order of reading, duplicates, and the choice between recognisers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import general_layer
from ..functions.text import col

POINTS = "array<struct<x:double,y:double>>"


def box_metrics(points) -> Column:
    """struct(left, top, right, bottom, center_y, height); the height is 1 at least."""
    xs, ys = F.transform(col(points), lambda p: p["x"]), F.transform(col(points), lambda p: p["y"])
    top, bottom = F.array_min(ys), F.array_max(ys)
    return F.struct(F.array_min(xs).alias("left"), top.alias("top"), F.array_max(xs).alias("right"), bottom.alias("bottom"), ((top + bottom) / 2).alias("center_y"), F.greatest(F.lit(1.0), bottom - top).alias("height"))


def clockwise(points) -> Column:
    """The corners in the order top left, top right, bottom right, bottom left; the first point wins a tie."""
    ranked = F.transform(col(points), lambda p, i: F.struct((p["x"] + p["y"]).alias("s"), (p["y"] - p["x"]).alias("d"), i.alias("i"), p.alias("p")))
    low = lambda k: F.array_min(F.transform(ranked, lambda r: F.struct(r[k].alias("v"), r["i"].alias("i"), r["p"].alias("p"))))["p"]
    high = lambda k: F.array_min(F.transform(ranked, lambda r: F.struct((-r[k]).alias("v"), r["i"].alias("i"), r["p"].alias("p"))))["p"]
    return F.array(low("s"), low("d"), high("s"), high("d"))


def crop_size(points, padding: int = 8) -> Column:
    """struct(width, height) of the straightened crop: the longer of opposite sides, 1 at least, and padding around."""
    c = clockwise(points)
    side = lambda a, b: F.sqrt((c[a]["x"] - c[b]["x"]) * (c[a]["x"] - c[b]["x"]) + (c[a]["y"] - c[b]["y"]) * (c[a]["y"] - c[b]["y"]))
    size = lambda a, b: (F.greatest(F.lit(1), F.greatest(a, b).cast("int")) + 2 * max(0, padding)).cast("int")
    return F.struct(size(side(2, 3), side(1, 0)).alias("width"), size(side(1, 2), side(0, 3)).alias("height"))


def box_key(points) -> Column:
    """The corners rounded half to even: boxes with the same key are the same."""
    return F.transform(col(points), lambda p: F.struct(F.bround(p["x"], 0).cast("long").alias("x"), F.bround(p["y"], 0).cast("long").alias("y")))


def distinct_boxes(boxes: DataFrame) -> DataFrame:
    """The first box (page_key, box_no, pts) of each key of a page."""
    return boxes.groupBy("page_key", box_key("pts").alias("_key")).agg(F.min_by(F.struct("box_no", "pts"), "box_no").alias("b")).select("page_key", "b.box_no", "b.pts")


def reading_order(boxes: Column) -> Column:
    """An array of boxes (box_no, pts) in order of reading.

    By their tops, each box joins the first line whose mean centre is within max(8, 0.65 of the upper median height) of its
    own; lines are read from the left. The means move as boxes join, so this is a fold and no window."""
    items = F.transform(boxes, lambda b: F.struct(box_metrics(b["pts"])["top"].alias("top"), box_metrics(b["pts"])["left"].alias("left"), b["box_no"].alias("box_no"), box_metrics(b["pts"])["center_y"].alias("center"), b["pts"].alias("pts")))
    heights = F.array_sort(F.transform(boxes, lambda b: box_metrics(b["pts"])["height"]))
    near = F.greatest(F.lit(8.0), F.get(heights, F.floor(F.size(heights) / 2).cast("int")) * 0.65)
    item = "struct<left:double,top:double,box_no:int,pts:" + POINTS + ">"
    empty = F.array().cast(f"array<struct<sum:double,n:int,items:array<{item}>>>")

    def add(lines: Column, x: Column) -> Column:
        at = F.array_position(F.transform(lines, lambda l: F.abs(x["center"] - l["sum"] / l["n"]) <= near), True)
        new = F.struct(x["left"].alias("left"), x["top"].alias("top"), x["box_no"].cast("int").alias("box_no"), x["pts"].alias("pts"))
        grown = F.transform(lines, lambda l, i: F.when(i + 1 == at, F.struct((l["sum"] + x["center"]).alias("sum"), (l["n"] + 1).alias("n"), F.concat(l["items"], F.array(new)).alias("items"))).otherwise(l))
        return F.when(at > 0, grown).otherwise(F.concat(lines, F.array(F.struct(x["center"].alias("sum"), F.lit(1).alias("n"), F.array(new).alias("items")))))

    lines = F.aggregate(F.array_sort(items), empty, add)
    # at equal left edges the box that joined first comes first
    by_left = lambda l: F.transform(F.array_sort(F.transform(l["items"], lambda x, i: F.struct(x["left"].alias("left"), i.alias("i"), x.alias("x")))), lambda y: y["x"])
    return F.transform(F.flatten(F.transform(lines, by_left)), lambda x: F.struct(x["box_no"].alias("box_no"), x["pts"].alias("pts")))


def better_text(first, second) -> Column:
    """Of two recognitions, both repaired, the second if it alone has an @, has fewer question marks, or is longer by more
    than five characters and has none; else the first."""
    a, b = general_layer(first), general_layer(second)
    marks = lambda x: F.length(x) - F.length(F.replace(x, F.lit("?"), F.lit("")))
    at = lambda x: F.contains(x, F.lit("@"))
    better = (at(b) & ~at(a)) | (marks(b) < marks(a)) | ((F.length(b) > F.length(a) + 5) & (marks(b) == 0))
    return F.when((b != "") & better, b).otherwise(a)


def first_success(attempts: DataFrame) -> DataFrame:
    """(page_key, text): of the attempts (page_key, lang_rank, variant_rank, text) the first, by language and then by
    variant, whose text isn't empty; pages without one are absent."""
    return attempts.where("text is not null and text != ''").groupBy("page_key").agg(F.min_by("text", F.struct("lang_rank", "variant_rank")).alias("text"))
