"""Layouts and boxes: slots, overlap and containment joins, nearest slots, fragments, reading order, nine slices."""

from __future__ import annotations

from collections.abc import Iterator
from math import hypot

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packloom.functions import constants as C
from packloom.functions import scalars as S


def layout_slots(specs: DataFrame) -> DataFrame:
    """Slots of specs (layout_id, width, height, columns, rows, margin, gutter, safe), row by row from index 1.

    What doesn't divide evenly goes to the first columns and rows, one pixel each; everything is arithmetic on the
    slot's place, so no window is needed.
    """
    cell = specs.select("*", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("row")).select("*", F.explode(F.sequence(F.lit(0), F.col("columns") - 1)).alias("column"))

    def edge(total: Column, count: Column, k: Column) -> tuple[Column, Column]:
        usable = total - 2 * F.col("margin") - (count - 1) * F.col("gutter")
        base, rest = F.floor(usable / count).cast("int"), F.pmod(usable, count)
        start = F.col("margin") + k * (base + F.col("gutter")) + F.least(k, rest)
        return start, start + base + F.when(k < rest, 1).otherwise(0)

    (l, r), (t, b) = edge(F.col("width"), F.col("columns"), F.col("column")), edge(F.col("height"), F.col("rows"), F.col("row"))  # noqa: E741
    safe = F.col("safe")
    out = cell.select("layout_id", (F.col("row") * F.col("columns") + F.col("column") + 1).alias("idx"), "row", "column", l.alias("l"), t.alias("t"), r.alias("r"), b.alias("b"), (l + safe).alias("sl"), (t + safe).alias("st"), (r - safe).alias("sr"), (b - safe).alias("sb"))
    return out.select("*", F.floor((F.col("sl") + F.col("sr")) / 2).cast("int").alias("cx"), F.floor((F.col("st") + F.col("sb")) / 2).cast("int").alias("cy"))


def _side(df: DataFrame, prefix: str, keep: list[str]) -> DataFrame:
    return df.select(*(F.col(c).alias(c if c in keep else f"{prefix}{c}") for c in df.columns))


def overlapping_pairs(boxes: DataFrame, within: str, order: str) -> DataFrame:
    """Pairs of boxes (columns l, t, r, b) of one image that overlap, with area and IoU; an equi join with a range condition."""
    a, b = _side(boxes, "a_", [within]), _side(boxes, "b_", [within])
    x = lambda p: S.box(*(F.col(f"{p}{c}") for c in "ltrb"))
    meets = (F.col(f"a_{order}") < F.col(f"b_{order}")) & (F.greatest("a_l", "b_l") < F.least("a_r", "b_r")) & (F.greatest("a_t", "b_t") < F.least("a_b", "b_b"))
    return a.join(b, within).where(meets).select(within, F.col(f"a_{order}").alias("first"), F.col(f"b_{order}").alias("second"), S.overlap_area(x("a_"), x("b_")).alias("overlap"), S.iou(x("a_"), x("b_")).alias("iou"))


def slots_spanned(components: DataFrame, slots: DataFrame, layout: str, component: str) -> DataFrame:
    """Components that hold the centres of two slots or more. Slots of a layout are few and bounded: they are broadcast."""
    inside = (F.col("cx") >= F.col("x.l")) & (F.col("cx") < F.col("x.r")) & (F.col("cy") >= F.col("x.t")) & (F.col("cy") < F.col("x.b"))
    found = components.alias("x").join(F.broadcast(slots.select(layout, "idx", "cx", "cy")), layout).where(inside)
    return found.groupBy(layout, component).agg(F.count("*").alias("slots"), F.array_sort(F.collect_list("idx")).alias("indices")).where("slots > 1")


def nearest_slot(components: DataFrame, slots: DataFrame, layout: str) -> DataFrame:
    """components with the slot whose centre is nearest theirs; the lower index wins ties.

    The slots of a layout come as one array, so each component is one row throughout and nothing is shuffled but slots.
    """
    arrays = slots.groupBy(layout).agg(F.array_sort(F.collect_list(F.struct("idx", "cx", "cy"))).alias("_slots"))
    x, y = (F.col("l") + F.col("r")) / 2, (F.col("t") + F.col("b")) / 2
    best = F.array_min(F.transform("_slots", lambda s: F.struct((F.pow(s["cx"] - x, 2.0) + F.pow(s["cy"] - y, 2.0)).alias("d2"), s["idx"].alias("idx"))))
    return components.join(F.broadcast(arrays), layout).withColumn("_best", best).withColumn("slot", F.col("_best.idx")).withColumn("distance", F.sqrt("_best.d2")).drop("_best", "_slots")


def reassigned_fragments(components: DataFrame, image: str, component: str, most: float) -> DataFrame:
    """Fragments that lie nearer another slot's anchor than their own, within `most`: where each would go.

    A slot's anchor is its largest component (the first of equals). All moves are judged on the same snapshot.
    """
    x = S.box(F.col("l"), F.col("t"), F.col("r"), F.col("b"))
    rows = components.select(image, "slot", component, "pixels", x.alias("box"))
    anchors = rows.groupBy(image, "slot").agg(F.max_by(F.struct(component, "box"), F.struct("pixels", (-F.col(component)).alias("low"))).alias("a")).select(image, "slot", F.col(f"a.{component}").alias("anchor"), F.col("a.box").alias("anchor_box"))
    loose = rows.join(anchors, [image, "slot"]).where(F.col(component) != F.col("anchor")).select(image, component, "slot", "box", S.gap(F.col("box"), F.col("anchor_box")).alias("own_gap"))
    others = anchors.select(image, F.col("slot").alias("other"), F.col("anchor_box").alias("other_box"))
    near = loose.join(others, image).where("other <> slot").groupBy(image, component, "slot", "own_gap").agg(F.min(F.struct(S.gap(F.col("box"), F.col("other_box")).alias("gap"), F.col("other").alias("to_slot"))).alias("n"))
    return near.where((F.col("n.gap") <= most) & (F.col("n.gap") + 1e-6 < F.col("own_gap"))).select(image, component, F.col("slot").alias("from_slot"), "n.to_slot", "own_gap", "n.gap")


def row_major(boxes: DataFrame, image: str) -> DataFrame:
    """Reading order: rows are centres divided by the image's median height, half to even; then left, then top."""
    medians = boxes.groupBy(image).agg(F.greatest(F.lit(1.0), F.percentile((F.col("b") - F.col("t")).cast("double"), F.lit(0.5))).alias("_median"))
    rows = boxes.join(medians, image).withColumn("line", F.rint((F.col("t") + F.col("b")) / 2.0 / F.col("_median")).cast("int"))
    every = [c for c in boxes.columns if c not in (image, "l", "t")]
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(image).orderBy("line", "l", "t", *every))).drop("_median")


def _grown(boxes: list[tuple], policy: tuple[float, float, float], major: float) -> list[str]:
    """Classes of boxes (pixels, l, t, r, b), the largest first."""
    fixed, share, most = policy
    classes: list[str] = ["anchor"] + [""] * (len(boxes) - 1)
    held, joined = [boxes[0]], True
    while joined:
        joined = False
        # The reach holds for the pass; a component that joins counts for those after it.
        diagonal = hypot(max(x[3] for x in held) - min(x[1] for x in held), max(x[4] for x in held) - min(x[2] for x in held))
        reach = min(max(fixed, share * diagonal), most)
        for k, (_, l, t, r, b) in enumerate(boxes):  # noqa: E741
            if not classes[k] and min(hypot(max(0, max(l, x[1]) - min(r, x[3])), max(0, max(t, x[2]) - min(b, x[4]))) for x in held) <= reach:
                classes[k], joined = "merged", True
                held.append(boxes[k])
    return [c or ("major-detached" if x[0] >= boxes[0][0] * major else "detached") for c, x in zip(classes, boxes, strict=True)]


def classified_components(components: DataFrame, slot: list[str], policy: tuple[float, float, float] = (12.0, 0.15, 1e9), major: float = C.MAJOR_COMPONENT_RATIO) -> DataFrame:
    """Class of each component of a slot: anchor, merged, major-detached or detached.

    Growth is a fold whose state is the merged boxes. A slot's components, few by nature, come as one row; rows are
    folded in Arrow batches.
    """
    item = F.struct((-F.col("pixels")).alias("smaller"), "comp_id", "l", "t", "r", "b")
    rows = components.groupBy(*slot).agg(F.array_sort(F.collect_list(item)).alias("items"))

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes = [_grown([(-x["smaller"], x["l"], x["t"], x["r"], x["b"]) for x in items], policy, major) for items in batch.column(len(slot)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(classes, pa.list_(pa.string()))], [*batch.schema.names, "classes"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    out = rows.mapInArrow(classify, f"{fields}, classes array<string>")
    return out.select(*slot, F.explode(F.arrays_zip("items", "classes")).alias("x")).select(*slot, "x.items.comp_id", F.col("x.classes").alias("class"))


def nine_slice_checks(borders: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    """Targets that a sprite's borders (left, bottom, right, top) at its pixels per unit don't fit: both axes of each."""
    units = lambda a, b: (F.col(a) + F.col(b)) * 100.0 / F.col("ppu")
    out = borders.join(targets, key).select("*", units("left", "right").alias("units_x"), units("bottom", "top").alias("units_y"))
    return out.withColumn("exceeds", (F.col("units_x") >= F.col("target_w")) | (F.col("units_y") >= F.col("target_h")))
