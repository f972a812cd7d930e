"""Sources and sinks: images with bad files as rows, listings, documents, reports, import plans."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASSET = "struct<semantic_name:string,state:string,description:string,frame_style:string,enabled:boolean>"
CATEGORY = f"struct<category:string,canvas:array<int>,grid:array<int>,target_size:array<int>,padding:int,alignment:string,chroma_key:string,transparency_mode:string,fragment_policy:map<string,string>,assets:array<{ASSET}>,outer_margin:int,gutter:int,safe_padding:int>"
REQUEST = f"schema_version int, project_id string, style_notes string, generation_method string, categories array<{CATEGORY}>, _corrupt_record string"
MANIFEST = "id string, job_id string, category string, semantic_name string, state string, source_index int, category_index int, source_bbox array<int>, output string, width int, height int, pivot array<double>, qa string"


def images(spark: SparkSession, path: str, recursive: bool = False, pattern: str = "*.png") -> DataFrame:
    """path, width, height, channels, data (RGBA bytes by row), error: bad files are rows with an error, not failures."""
    reader = spark.read.format("image").option("dropInvalid", False)
    # With folders below, only files of the pattern are images.
    reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", pattern) if recursive else reader
    raw = reader.load(path).select("image.*")
    bad = F.col("mode") < 0
    return raw.select(F.col("origin").alias("path"), F.when(~bad, F.col("width")).alias("width"), F.when(~bad, F.col("height")).alias("height"), F.when(~bad, F.col("nChannels")).alias("channels"), F.when(~bad, F.col("data")).alias("data"), F.when(bad, "source-decode-failed").alias("error"))


def image_pixels(images: DataFrame, image: str = "path") -> DataFrame:
    """(image, x, y, r, g, b, a) of decoded images; their bytes are blue, green, red and, with four channels, alpha."""

    def explode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        for frame in frames:
            for name, w, h, n, data in zip(frame[image], frame["width"], frame["height"], frame["channels"], frame["data"], strict=True):
                w, h, n = int(w), int(h), int(n)
                a = np.frombuffer(data, np.uint8).reshape(h, w, n).astype(np.int32)
                y, x = np.divmod(np.arange(w * h, dtype=np.int32), w)
                flat = a.reshape(-1, n)
                one = lambda k: flat[:, k if n >= 3 else 0]  # noqa: B023, E731
                yield pd.DataFrame({image: name, "x": x, "y": y, "r": one(2), "g": one(1), "b": one(0), "a": flat[:, 3] if n == 4 else 255})

    good = images.where("data is not null").select(image, "width", "height", "channels", "data")
    return good.mapInPandas(explode, f"`{image}` string, x int, y int, r int, g int, b int, a int")


def listing(spark: SparkSession, path: str, pattern: str = "*.png", recursive: bool = True) -> DataFrame:
    """path, length, modified of files; contents are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", recursive).load(path).select("path", "length", F.col("modificationTime").alias("modified"))


def file_digests(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path and SHA-256 of files."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path).select("path", F.sha2("content", 256).alias("sha256"))


def requests(spark: SparkSession, path: str) -> DataFrame:
    """Batch requests, one JSON document a file; unreadable ones keep their text in _corrupt_record."""
    return spark.read.schema(REQUEST).option("multiLine", True).option("mode", "PERMISSIVE").json(path)


def requested_assets(requests: DataFrame, state: str = "Default") -> DataFrame:
    """One row for each enabled asset with its place; defaults fill blank states."""
    c = requests.select("project_id", F.posexplode("categories").alias("category_ord", "c"))
    a = c.select("project_id", "category_ord", F.col("c.category").alias("category"), F.posexplode("c.assets").alias("asset_ord", "a"))
    a = a.where(F.coalesce("a.enabled", F.lit(True)) & (F.trim("a.semantic_name") != ""))
    return a.select("project_id", "category_ord", "category", "asset_ord", F.trim("a.semantic_name").alias("semantic_name"), F.coalesce(F.nullif(F.trim("a.state"), F.lit("")), F.lit(state)).alias("state"), F.coalesce("a.description", F.lit("")).alias("description"), F.coalesce(F.nullif(F.trim("a.frame_style"), F.lit("")), F.lit("default")).alias("frame_style"))


def report_lines(rows: DataFrame, by: str, order: list[str], line: Column) -> DataFrame:
    """One text a report: its lines in order. A report's lines are few."""
    items = F.array_sort(F.collect_list(F.struct(*order, line.alias("_line"))))
    return rows.groupBy(by).agg(F.array_join(F.transform(items, lambda x: x["_line"]), "\n").alias("text"))


def import_plan(sprites: DataFrame, screens: DataFrame, project: str) -> DataFrame:
    """A JSON document for each project: its sprites and screens."""
    as_list = lambda df, name: df.groupBy(project).agg(F.collect_list(F.struct(*(c for c in df.columns if c != project))).alias(name))
    both = as_list(sprites, "sprites").join(as_list(screens, "screens"), project, "full")
    return both.select(project, F.to_json(F.struct("sprites", "screens")).alias("plan"))


def png(width: int, height: int, rgba: bytes) -> bytes:
    """A PNG of RGBA bytes."""
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    lines = b"".join(b"\0" + rgba[k * width * 4 : (k + 1) * width * 4] for k in range(height))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 6, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


def png_images(pixels: DataFrame, image: str) -> DataFrame:
    """(image, width, height, content): each image's pixels as a PNG, absent pixels transparent. An image is one row's work."""
    at = F.struct("y", "x", "r", "g", "b", "a")
    rows = pixels.groupBy(image).agg((F.max("x") + 1).alias("width"), (F.max("y") + 1).alias("height"), F.collect_list(at).alias("pixels"))

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for w, h, items in zip(frame["width"], frame["height"], frame["pixels"], strict=True):
                data = bytearray(4 * w * h)
                for p in items:
                    k = 4 * (p["y"] * w + p["x"])
                    data[k : k + 4] = bytes((p["r"], p["g"], p["b"], p["a"]))
                out.append(png(int(w), int(h), bytes(data)))
            yield frame[[image, "width", "height"]].assign(content=out)

    kind = dict(pixels.dtypes)[image]
    return rows.mapInPandas(encode, f"`{image}` {kind}, width int, height int, content binary")


def packed_images(images: DataFrame, image: str = "path") -> DataFrame:
    """(image, width, height, channels, rgba, error) of decoded images: their bytes as red, green, blue, alpha; bad files keep null bytes."""
    kind = dict(images.dtypes)[image]

    def swap(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            out = []
            for w, h, n, data in zip(*(batch.column(k).to_pylist() for k in range(1, 5)), strict=True):
                if data is None:
                    out.append(None)
                    continue
                a = np.frombuffer(data, np.uint8).reshape(h, w, n)
                colours = a[..., [2, 1, 0]] if n >= 3 else np.repeat(a[..., :1], 3, axis=2)
                alpha = a[..., 3:4] if n == 4 else np.full((h, w, 1), 255, np.uint8)
                out.append(np.concatenate([colours, alpha], axis=2).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), batch.column(3), pa.array(out, pa.binary()), batch.column(5)], [image, "width", "height", "channels", "rgba", "error"])

    rows = images.select(image, *(F.col(c).cast("int").alias(c) for c in ("width", "height", "channels")), "data", "error")
    return rows.mapInArrow(swap, f"`{image}` {kind}, width int, height int, channels int, rgba binary, error string")


def write_pngs(images: DataFrame, root: str) -> int:
    """Writes images (file, width, height, rgba) as PNGs below root, a path or URI that all executors share; their number.

    A file is written aside and moved, so that a task that runs again leaves the same files. Names that aren't below
    root are refused.
    """

    def write(batches: Iterator) -> Iterator:
        import uuid

        import pyarrow as pa
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)
        for batch in batches:
            for file, w, h, data in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                parts = file.replace("\\", "/").split("/")
                if parts[0] == "" or ".." in parts:
                    raise ValueError(f"not below the root: {file}")
                path = "/".join([base.rstrip("/"), *parts])
                system.create_dir(path.rsplit("/", 1)[0], recursive=True)
                aside = f"{path}.{uuid.uuid4().hex}.part"
                with system.open_output_stream(aside) as out:
                    out.write(png(w, h, data))
                system.move(aside, path)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    rows = images.where("rgba IS NOT NULL").select("file", F.col("width").cast("int"), F.col("height").cast("int"), "rgba")
    return rows.mapInArrow(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
