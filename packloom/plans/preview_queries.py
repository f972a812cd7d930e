"""Queries of review images, over the 8 x 8 images of embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from packloom.operators import previews as V
from packloom.operators import raster as P

from .registry import query
from .standins import PIXELS, pixels

_CELL, _COLUMNS, _ROWS = 24, 4, 4


@query(f"""WITH {PIXELS}, v AS (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS pos FROM (SELECT DISTINCT vec_id, label FROM embeddings)),
s AS (SELECT label, pos // 16 AS page, pos % 16 % 4 AS cx, pos % 16 // 4 AS cy, vec_id, vec_id % 7 = 0 AS missing FROM v),
g AS (SELECT s.*, x.i AS x, y.i AS y, CASE WHEN (x.i // 12 + y.i // 12) % 2 = 0 THEN [217, 221, 227] ELSE [243, 244, 246] END AS c FROM s, range(0, 24) AS x(i), range(0, 24) AS y(i)),
d AS (SELECT g.*, CASE WHEN g.x IN (0, 23) OR g.y IN (0, 23) THEN [71, 85, 105] WHEN missing AND least(abs(g.x - g.y), abs(g.x + g.y - 23)) * 2 <= 6 AND least(g.x, g.y) >= 16 AND greatest(g.x, g.y) <= 8 THEN [220, 38, 38]
  WHEN NOT missing AND px.a IS NOT NULL THEN [(px.r * px.a * 2 + c[1] * (255 - px.a) * 2 + 255) // 510, (px.g * px.a * 2 + c[2] * (255 - px.a) * 2 + 255) // 510, (px.b * px.a * 2 + c[3] * (255 - px.a) * 2 + 255) // 510] ELSE c END AS p
  FROM g LEFT JOIN px ON px.vec_id = g.vec_id AND px.x = g.x - 8 AND px.y = g.y - 8),
t AS (SELECT label, page, count(DISTINCT vec_id) AS assets, count(DISTINCT vec_id) FILTER (WHERE missing) AS missing, max(cy) + 1 AS used, sum((p[1] + 3 * p[2] + 7 * p[3]) * ((cy * 24 + y) * 96 + cx * 24 + x + 1)) AS drawn, count(*) AS n,
  sum((cy * 24 + y) * 96 + cx * 24 + x + 1) AS places FROM d GROUP BY ALL)
SELECT label, CAST(page AS INTEGER) AS page, assets, missing, CAST(96 AS INTEGER) AS width, CAST(used * 24 AS INTEGER) AS height, CAST(drawn + (17 + 3 * 24 + 7 * 39) * (CAST(used * 24 * 96 AS BIGINT) * (used * 24 * 96 + 1) // 2 - places) AS BIGINT) AS digest FROM t""")
def contact_sheet_pages(spark, d):
    """Pages of 4 x 4 cells; digest: each pixel's colours times its place, so that a moved or changed pixel shows."""
    images = P.packed(pixels(spark, d), "vec_id", 8, 8).join(pixels(spark, d).select("vec_id", "label").distinct(), "vec_id")
    shown = images.withColumn("rgba", F.when(F.col("vec_id") % 7 != 0, F.col("rgba")))
    pages = V.contact_sheets(shown, "label", ["vec_id"], _COLUMNS, _ROWS, _CELL)
    byte = lambda i, k: F.conv(F.hex(F.substring("rgba", (4 * i + k + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    place = F.explode(F.sequence(F.lit(0), F.col("width") * F.col("height") - 1)).alias("i")
    dots = pages.select("label", "page", "assets", "missing", "width", "height", "rgba", place)
    value = (byte(F.col("i"), 0) + 3 * byte(F.col("i"), 1) + 7 * byte(F.col("i"), 2)) * (F.col("i") + 1)
    return dots.groupBy("label", "page", "assets", "missing", "width", "height").agg(F.sum(value).alias("digest"))


@query()
def stretched_previews(spark, d):
    """Sprites at three sizes; corners keep their pixels (tests hold them to it)."""
    sprites = P.packed(pixels(spark, d), "vec_id", 8, 8).select("vec_id", F.col("width").alias("w"), F.col("height").alias("h"), "rgba", *(F.lit(2).alias(c) for c in ("left", "bottom", "right", "top")))
    return V.stretched_sprites(sprites, "vec_id")
