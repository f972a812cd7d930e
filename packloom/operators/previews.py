"""Review images: contact sheets, layout guides, stretched nine-slice sprites and reflowed sheets, one page a row.

A page holds a bounded number of images: columns * rows of a contact sheet, the slots of a layout, nine patches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from packloom.functions import scalars as S

from .kernels import resized_rgba

#: Colours of a contact sheet (page, two of the checker, outline, cross), its checker's tile, room around an image and width of the cross.
PAGE, TILES, OUTLINE, CROSS, TILE, ROOM, STROKE = (17, 24, 39), ((217, 221, 227), (243, 244, 246)), (71, 85, 105), (220, 38, 38), 12, 16, 6
#: Colours and widths of a layout guide's lines (page, frame, slot, safe box, centre) and half the length of a centre mark.
GUIDE, FRAME, SLOT, SAFE, CENTRE, MARK = (244, 246, 248), ((47, 59, 74), 4), ((37, 99, 235), 4), ((245, 158, 11), 3), ((220, 38, 38), 2), 14
_IMAGE = "width int, height int, rgba binary"


def over(top: np.ndarray, ground: np.ndarray) -> np.ndarray:
    """A top image over a ground of the same size, both RGBA; exact rounding over opaque ground."""
    a, b = top[..., 3:].astype(np.int64), ground[..., 3:].astype(np.int64)
    share = a * 255 + b * (255 - a)
    colour = np.where(share > 0, (top[..., :3] * (a * 255) + ground[..., :3].astype(np.int64) * (b * (255 - a)) + share // 2) // np.maximum(share, 1), 0)
    return np.concatenate([colour, (share + 127) // 255], axis=2).astype(np.uint8)


def _solid(width: int, height: int, colour: tuple[int, ...]) -> np.ndarray:
    return np.full((height, width, 4), (*colour, 255), np.uint8)


def _paste(page: np.ndarray, image: np.ndarray, x: int, y: int) -> None:
    h, w = image.shape[:2]
    page[y : y + h, x : x + w] = over(image, page[y : y + h, x : x + w])


def _outline(page: np.ndarray, l: int, t: int, r: int, b: int, colour: tuple[int, int, int], width: int) -> None:  # noqa: E741
    """The rim of a box, r and b exclusive, drawn inwards."""
    hold = page[t + width : b - width, l + width : r - width].copy()
    page[t:b, l:r, :3] = colour
    page[t + width : b - width, l + width : r - width] = hold


def _fitted(image: np.ndarray, width: int, height: int) -> np.ndarray:
    h, w = image.shape[:2]
    scale = min(width / w, height / h, 1.0)
    size = max(1, round(w * scale)), max(1, round(h * scale))
    return image if size == (w, h) else resized_rgba(image, *size)


def contact_page(images: list[tuple[int, np.ndarray | None]], columns: int, rows: int, cell: int) -> np.ndarray:
    """Images (place, RGBA; None: missing) in their cells, fitted and centred over a checker."""
    used = max(1, -(-(max((place for place, _ in images), default=0) + 1) // columns))
    page = _solid(columns * cell, min(rows, used) * cell, PAGE)
    y, x = np.mgrid[:cell, :cell]
    ground = np.concatenate([np.array(TILES, np.uint8)[(x // TILE + y // TILE) % 2], np.full((cell, cell, 1), 255, np.uint8)], axis=2)
    cross = (np.minimum(abs(x - y), abs(x + y - cell + 1)) * 2 <= STROKE) & (np.minimum(x, y) >= ROOM) & (np.maximum(x, y) <= cell - ROOM)
    for place, image in images:
        left, top = place % columns * cell, place // columns * cell
        preview = ground.copy()
        if image is None:
            preview[cross, :3] = CROSS
        else:
            image = _fitted(image, cell - ROOM, cell - ROOM)
            _paste(preview, image, (cell - image.shape[1]) // 2, (cell - image.shape[0]) // 2)
        page[top : top + cell, left : left + cell] = preview
        _outline(page, left, top, left + cell, top + cell, OUTLINE, 1)
    return page


def _drawn(rows: DataFrame, keys: list[str], draw: Callable[[dict], np.ndarray | None], extra: list[str] | None = None) -> DataFrame:
    """rows with keys and extra columns and the image that draw makes of a row; rows without one have null bytes."""
    kept = [*keys, *(extra or [])]
    kinds = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                one = batch.slice(k, 1)
                out = draw(one.to_pylist()[0])
                size = (None, None) if out is None else (out.shape[1], out.shape[0])
                cells = [*(one.column(batch.schema.get_field_index(c)) for c in kept), *(pa.array([x], pa.int32()) for x in size), pa.array([None if out is None else out.tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(cells, [*kept, "width", "height", "rgba"])

    return rows.mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in kept) + f", {_IMAGE}")


def _pixels(data: bytes | None, width: int | None, height: int | None) -> np.ndarray | None:
    return None if data is None else np.frombuffer(data, np.uint8).reshape(height, width, 4)


def contact_sheets(assets: DataFrame, by: str, order: list[str], columns: int = 4, rows: int = 6, cell: int = 192) -> DataFrame:
    """(by, page, assets, missing, width, height, rgba): pages of assets (by, order, width, height, rgba) in order.

    Null bytes are missing files, shown as a cross. A page is as high as its used rows; pages count from 0.
    """
    place = F.row_number().over(Window.partitionBy(by).orderBy(*order)) - 1
    item = F.struct(F.col("_place").alias("place"), "width", "height", "rgba")
    placed = assets.withColumn("_at", place).withColumns({"page": F.floor(F.col("_at") / (columns * rows)).cast("int"), "_place": F.pmod("_at", F.lit(columns * rows))})
    pages = placed.groupBy(by, "page").agg(F.count("*").alias("assets"), F.count_if(F.col("rgba").isNull()).alias("missing"), F.collect_list(item).alias("items"))
    draw = lambda r: contact_page([(x["place"], _pixels(x["rgba"], x["width"], x["height"])) for x in r["items"]], columns, rows, cell)
    return _drawn(pages, [by, "page"], draw, ["assets", "missing"])


def layout_guides(specs: DataFrame, slots: DataFrame, layout: str = "layout_id") -> DataFrame:
    """(layout, width, height, rgba): the frame, slots, safe boxes and centres of layouts (layout, width, height)."""
    lists = slots.groupBy(layout).agg(F.collect_list(F.struct("idx", "l", "t", "r", "b", "sl", "st", "sr", "sb", "cx", "cy")).alias("slots"))
    rows = specs.select(layout, F.col("width").cast("int").alias("w"), F.col("height").cast("int").alias("h")).join(lists, layout, "left")

    def draw(r: dict) -> np.ndarray:
        page = _solid(r["w"], r["h"], GUIDE)
        _outline(page, 0, 0, r["w"], r["h"], *FRAME)
        for s in sorted(r["slots"] or [], key=lambda s: s["idx"]):
            _outline(page, s["l"], s["t"], s["r"], s["b"], *SLOT)
            _outline(page, s["sl"], s["st"], s["sr"], s["sb"], *SAFE)
            colour, width = CENTRE
            half = width // 2
            page[s["cy"] - half : s["cy"] + width - half, max(0, s["cx"] - MARK) : s["cx"] + MARK + 1, :3] = colour
            page[max(0, s["cy"] - MARK) : s["cy"] + MARK + 1, s["cx"] - half : s["cx"] + width - half, :3] = colour
        return page

    return _drawn(rows, [layout], draw)


def nine_sliced(image: np.ndarray, width: int, height: int, border: tuple[int, int, int, int]) -> np.ndarray:
    """An image at another size with border (left, bottom, right, top) kept as it is and the rest stretched."""
    left, bottom, right, top = border
    h, w = image.shape[:2]
    width, height = max(width, left + right + 1), max(height, top + bottom + 1)
    cuts = lambda size, a, b: list(zip((0, a, size - b), (a, size - b, size), strict=True))
    out = np.zeros((height, width, 4), np.uint8)
    for (t0, t1), (y0, y1) in zip(cuts(h, top, bottom), cuts(height, top, bottom), strict=True):
        for (l0, l1), (x0, x1) in zip(cuts(w, left, right), cuts(width, left, right), strict=True):
            patch = image[t0:t1, l0:l1]
            if patch.size and y1 > y0 and x1 > x0:
                patch = patch if patch.shape[:2] == (y1 - y0, x1 - x0) else resized_rgba(patch, x1 - x0, y1 - y0)
                out[y0:y1, x0:x1] = np.where(patch[..., 3:] > 0, patch, 0)
    return out


def stretched_sprites(sprites: DataFrame, sprite: str, factors: tuple[float, ...] = (0.5, 1.5, 2.0)) -> DataFrame:
    """(sprite, factor, width, height, rgba) of sprites (w, h, rgba, left, bottom, right, top) for each factor.

    Borders that leave no middle, and null bytes, give null bytes.
    """
    rows = sprites.select(sprite, "w", "h", "rgba", "left", "bottom", "right", "top", F.explode(F.array(*map(F.lit, factors))).alias("factor"))

    def draw(r: dict) -> np.ndarray | None:
        image, border = _pixels(r["rgba"], r["w"], r["h"]), tuple(r[c] for c in ("left", "bottom", "right", "top"))
        if image is None or None in border or min(border) < 0 or border[0] + border[2] >= r["w"] or border[1] + border[3] >= r["h"]:
            return None
        return nine_sliced(image, round(r["w"] * r["factor"]), round(r["h"] * r["factor"]), border)

    return _drawn(rows, [sprite, "factor"], draw)


def reflowed_sheets(sources: DataFrame, crops: DataFrame, slots: DataFrame, image: str, transparent: float = 12.0, opaque: float = 96.0) -> DataFrame:
    """(image, width, height, rgba): approved crops of flat sheets, moved into the safe boxes of slots on the key's colour.

    sources: image, w, h, rgba, key (#RRGGBB), canvas_w, canvas_h. crops: image, position, box (l, t, r, b). slots: idx,
    sl, st, sr, sb; the first crop goes to the first slot. Crops are scaled down at most; their edge is as soft as
    their distance from the key. A sheet with more crops than slots, none, or a box outside it has null bytes.
    """
    n = slots.count()
    place = F.row_number().over(Window.partitionBy(image).orderBy("position"))
    placed = crops.select(image, place.alias("idx"), "box").join(slots.select("idx", "sl", "st", "sr", "sb"), "idx", "left")
    lists = placed.groupBy(image).agg(F.array_sort(F.collect_list(F.struct("idx", "box", "sl", "st", "sr", "sb"))).alias("crops"))
    rows = sources.withColumn("k", S.hex_to_rgb(F.col("key"))).join(lists, image, "left")

    def draw(r: dict) -> np.ndarray | None:
        source, found = _pixels(r["rgba"], r["w"], r["h"]), r["crops"] or []
        inside = lambda b: 0 <= b["l"] < b["r"] <= r["w"] and 0 <= b["t"] < b["b"] <= r["h"]
        if source is None or r["k"] is None or not found or len(found) > n or not all(inside(c["box"]) for c in found):
            return None
        key = tuple(r["k"][c] for c in "rgb")
        page = _solid(r["canvas_w"], r["canvas_h"], key)
        for c in found:
            b = c["box"]
            crop = source[b["t"] : b["b"], b["l"] : b["r"]].copy()
            away = np.sqrt(((crop[..., :3].astype(np.float64) - key) ** 2).sum(axis=2))
            crop[..., 3] = np.rint(np.clip((away - transparent) / (opaque - transparent), 0, 1) * 255)
            crop = _fitted(crop, c["sr"] - c["sl"], c["sb"] - c["st"])
            _paste(page, crop, c["sl"] + (c["sr"] - c["sl"] - crop.shape[1]) // 2, c["st"] + (c["sb"] - c["st"] - crop.shape[0]) // 2)
        return page

    return _drawn(rows, [image], draw)
