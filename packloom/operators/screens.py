"""Rules of screens: scroll chains, prefabs of earlier screens, toggle groups, and reference images."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packloom.functions import rules as R

#: Fixed value: least width and height of a reference image.
REFERENCE_LEAST = 256


def scroll_issues(elements: DataFrame, screen: str) -> DataFrame:
    """(screen, id, ord, severity, code) of scroll views (screen, id, kind, parent_id, viewport_id, content_id, horizontal, vertical).

    The viewport is a ScrollViewport below the view, the content is below that viewport, and one axis scrolls. Where
    elements share an id, one that fits is enough.
    """
    below = elements.where("parent_id IS NOT NULL")
    side = lambda df, c, p, flag: df.select(screen, F.col("id").alias(c), F.col("parent_id").alias(p)).distinct().withColumn(flag, F.lit(True))
    views = elements.where("kind = 'ScrollView'").select(screen, "id", "viewport_id", "content_id", "horizontal", "vertical")
    rows = views.join(side(below.where("kind = 'ScrollViewport'"), "viewport_id", "id", "v_fits"), [screen, "viewport_id", "id"], "left")
    rows = rows.join(side(below, "content_id", "viewport_id", "c_fits"), [screen, "content_id", "viewport_id"], "left")
    rules = {
        "scroll-viewport-invalid": ("fail", F.col("v_fits").isNull()),
        "scroll-content-invalid": ("fail", F.col("c_fits").isNull()),
        "scroll-axis-missing": ("fail", ~F.coalesce(F.col("horizontal") | F.col("vertical"), F.lit(False))),
    }
    return R.issues(rows, rules, screen, "id")


def prefab_issues(elements: DataFrame, screens: DataFrame, screen: str) -> DataFrame:
    """Elements (screen, screen_ord, id, kind, prefab_screen) whose prefab isn't an earlier screen (screen, screen_ord), or that may have none.

    Only instances that name a prefab look it up: elements that name none would all be one key of the join.
    """
    earlier = screens.groupBy(F.col(screen).alias("prefab_screen")).agg(F.min("screen_ord").alias("prefab_ord"))
    prefab, named = F.coalesce(F.col("kind") == "PrefabInstance", F.lit(False)), F.col("prefab_screen").isNotNull()
    kept = [screen, "id", "kind", "prefab_screen", "screen_ord"]
    rows = elements.where(prefab & named).join(earlier, "prefab_screen", "left").select(*kept, "prefab_ord")
    rows = rows.unionByName(elements.where(prefab != named).select(*kept, F.lit(None).cast(dict(earlier.dtypes)["prefab_ord"]).alias("prefab_ord")))
    rules = {
        "prefab-screen-not-earlier": ("fail", prefab & ~F.coalesce(F.col("prefab_ord") < F.col("screen_ord"), F.lit(False))),
        "prefab-screen-unexpected": ("fail", ~prefab & F.col("prefab_screen").isNotNull()),
    }
    return R.issues(rows, rules, screen, "id")


def toggle_issues(bindings: DataFrame, elements: DataFrame, screen: str) -> DataFrame:
    """(screen, group, code, n) of toggle groups: bindings (screen, group, ord, button_id, target_id, default_target_id).

    Where elements share an id, it is a Button's if one of them is.
    """
    side = lambda which, c, flag: elements.where(which).select(screen, F.col("id").alias(c)).distinct().withColumn(flag, F.lit(True))
    rows = bindings.join(side("kind = 'Button'", "button_id", "button"), [screen, "button_id"], "left")
    # A group's targets are counted once each before they are looked up, so that no task holds more than one of both.
    each = rows.groupBy(screen, "group", "target_id").agg(F.count("*").alias("n"), F.count_if(F.col("button").isNull()).alias("odd"), F.bool_or(F.col("target_id") == F.col("default_target_id")).alias("default"))
    rows = each.join(side("kind IS NOT NULL", "target_id", "target"), [screen, "target_id"], "left")
    found = rows.groupBy(screen, "group").agg(
        F.sum("odd").alias("toggle-button-invalid"),
        F.sum(F.when(F.col("target").isNull(), F.col("n")).otherwise(0)).alias("toggle-target-missing"),
        F.sum(F.when(F.col("target_id").isNotNull(), F.col("n") - 1).otherwise(0)).alias("toggle-target-repeated"),
        F.when(F.sum("n") < 2, 1).otherwise(0).cast("long").alias("toggle-too-few-bindings"),
        F.when(F.coalesce(F.bool_or("default"), F.lit(False)), 0).otherwise(1).cast("long").alias("toggle-default-invalid"),
    )
    codes = [c for c in found.columns if c.startswith("toggle-")]
    return found.select(screen, "group", F.explode(F.array(*(F.struct(F.lit(c).alias("code"), F.col(f"`{c}`").alias("n")) for c in codes))).alias("i")).select(screen, "group", "i.*").where("n > 0")


def reference_issues(images: DataFrame, batch: str, least: int = REFERENCE_LEAST) -> DataFrame:
    """(batch, file, ord, severity, code) of reference images: batch, file, role, width, height, frames, sha256 (a null width: unreadable).

    Files without a role are named wrongly and not looked at further. Sizes, frames, contents that an earlier file has,
    several canonical images (on each of them) and files of one name but another extension are judged on the rest.
    """
    read = F.col("role").isNotNull() & F.col("width").isNotNull()
    firsts = images.where(read).groupBy(batch, "sha256").agg(F.min("file").alias("first_file"))
    canonical = images.where("role = 'canonical'").groupBy(batch).agg(F.count("*").alias("canonicals"))
    rows = images.join(firsts, [batch, "sha256"], "left").join(canonical, batch, "left")
    rules = {
        "invalid-reference-name": ("fail", F.col("role").isNull()),
        "unreadable-reference-image": ("fail", F.col("role").isNotNull() & F.col("width").isNull()),
        "animated-reference-image": ("fail", read & (F.col("frames") != 1)),
        "reference-too-small": ("fail", read & ((F.col("width") < least) | (F.col("height") < least))),
        "duplicate-reference-content": ("fail", read & (F.col("first_file") != F.col("file"))),
        "multiple-canonical-references": ("fail", (F.col("role") == "canonical") & (F.col("canonicals") > 1)),
    }
    return R.issues(rows, rules, batch, "file")


def ordered_union(*stages: DataFrame, order: list[str | Column]) -> DataFrame:
    """Issue streams one after the other, each with the number of its stage; columns that a stage lacks are null."""
    out = None
    for k, df in enumerate(stages):
        df = df.withColumn("stage_ord", F.lit(k))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out.orderBy("stage_ord", *order)
