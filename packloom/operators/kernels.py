"""Image kernels that SQL expresses badly, as Arrow batches of packed RGBA images: one image is one row's work."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

LOBES = 3


def lanczos_weights(size: int, target: int) -> np.ndarray:
    """target x size weights of a Lanczos filter; widened when shrinking; rows sum to 1."""
    scale = size / target
    reach = max(scale, 1.0)
    centre = (np.arange(target) + 0.5) * scale - 0.5
    x = (np.arange(size)[None, :] - centre[:, None]) / reach
    w = np.where(np.abs(x) < LOBES, np.sinc(x) * np.sinc(x / LOBES), 0.0)
    return w / w.sum(1, keepdims=True)


def resized_rgba(rgba: np.ndarray, width: int, height: int) -> np.ndarray:
    """An h x w x 4 image resized with colours weighted by alpha, so that hidden colours don't bleed."""
    a = rgba.astype(np.float64)
    alpha = a[..., 3:] / 255.0
    flat = np.concatenate([a[..., :3] * alpha, a[..., 3:]], 2)
    out = np.einsum("ij,jkc->ikc", lanczos_weights(a.shape[0], height), flat)
    out = np.clip(np.einsum("ij,kjc->kic", lanczos_weights(a.shape[1], width), out), 0, 255)
    share = out[..., 3:] / 255.0
    colour = np.divide(out[..., :3], share, out=np.zeros_like(out[..., :3]), where=share > 0)
    solid = np.rint(out[..., 3:])
    return np.concatenate([np.where(solid > 0, np.rint(np.clip(colour, 0, 255)), 0), solid], 2).astype(np.uint8)


def resized(images: DataFrame, image: str) -> DataFrame:
    """images (image, width, height, rgba, new_width, new_height) with their bytes at the new size; null bytes stay null."""
    kind = dict(images.dtypes)[image]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, w, h, data, nw, nh = batch.columns
            out = [resized_rgba(np.frombuffer(d, np.uint8).reshape(y, x, 4), tx, ty).tobytes() if d is not None else None for x, y, d, tx, ty in zip(*(c.to_pylist() for c in (w, h, data, nw, nh)), strict=True)]
            yield pa.RecordBatch.from_arrays([ids, nw, nh, pa.array(out, pa.binary())], [image, "width", "height", "rgba"])

    rows = images.selectExpr(f"`{image}`", "cast(width as int)", "cast(height as int)", "rgba", "cast(new_width as int)", "cast(new_height as int)")
    return rows.mapInArrow(run, f"`{image}` {kind}, width int, height int, rgba binary")


def box_sums(a: np.ndarray, radius: int) -> np.ndarray:
    """Sums over squares of a 2-D array, cut at its edge, by cumulative sums."""
    s = np.pad(np.cumsum(np.cumsum(a, 0), 1), ((1, 0), (1, 0)))
    n, m = a.shape
    y0, y1 = np.maximum(np.arange(n) - radius, 0), np.minimum(np.arange(n) + radius + 1, n)
    x0, x1 = np.maximum(np.arange(m) - radius, 0), np.minimum(np.arange(m) + radius + 1, m)
    return s[y1][:, x1] - s[y0][:, x1] - s[y1][:, x0] + s[y0][:, x0]


def chroma_removed(rgb: np.ndarray, key: tuple[int, int, int], transparent: float = 12.0, opaque: float = 96.0, radius: int = 8) -> np.ndarray:
    """RGBA of an image on a flat key: a soft matte by distance, and edges coloured from solid neighbours.

    A half-transparent pixel takes the mean colour of solid pixels near it where there are any; else the key's share
    is taken out of it. Transparent pixels lose their colour.
    """
    c = rgb.astype(np.float64)
    k = np.array(key, np.float64)
    alpha = np.clip((np.sqrt(((c - k) ** 2).sum(2)) - transparent) / (opaque - transparent), 0, 1)
    solid = (alpha >= 1).astype(np.float64)
    near = box_sums(solid, radius)
    mean = np.stack([box_sums(c[..., j] * solid, radius) for j in range(3)], 2) / np.maximum(near, 1)[..., None]
    unmixed = np.clip((c - (1 - alpha)[..., None] * k) / np.maximum(alpha, 1 / 255)[..., None], 0, 255)
    edge = (alpha > 0) & (alpha < 1)
    colour = np.where((edge & (near > 0))[..., None], mean, np.where(edge[..., None], unmixed, c))
    level = np.rint(alpha * 255)
    return np.concatenate([np.where(level[..., None] > 0, np.rint(colour), 0), level[..., None]], 2).astype(np.uint8)


def keyed_out(images: DataFrame, image: str, key: tuple[int, int, int], transparent: float = 12.0, opaque: float = 96.0) -> DataFrame:
    """images (image, width, height, rgba) with the key removed."""
    kind = dict(images.dtypes)[image]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, w, h, data = batch.columns
            out = [chroma_removed(np.frombuffer(d, np.uint8).reshape(y, x, 4)[..., :3], key, transparent, opaque).tobytes() if d is not None else None for x, y, d in zip(w.to_pylist(), h.to_pylist(), data.to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([ids, w, h, pa.array(out, pa.binary())], [image, "width", "height", "rgba"])

    rows = images.selectExpr(f"`{image}`", "cast(width as int)", "cast(height as int)", "rgba")
    return rows.mapInArrow(run, f"`{image}` {kind}, width int, height int, rgba binary")
