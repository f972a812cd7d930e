"""From request documents to the jobs of a batch, and from an inventory to request documents.

A request is one nested row. Its plan is refused as a whole where any check of it fails; all failing checks are listed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packloom.functions import constants as C
from packloom.functions import scalars as S

from .boxes import layout_slots
from .lineage import cut
from .tables import packed_sheets

#: How assets become transparent; a method that cannot prove native alpha; layout of a sheet in pixels.
MODES, BUILT_IN = ("chroma-key", "model-matte-derived", "native-alpha-required"), "built-in-imagegen"
MARGIN, GUTTER, SAFE, PADDING = 96, 48, 64, 8


@dataclass(frozen=True)
class Plan:
    """categories, assets, aliases, jobs, slots and issues of all requests; those with issues have only these."""

    categories: DataFrame
    assets: DataFrame
    aliases: DataFrame
    jobs: DataFrame
    slots: DataFrame
    issues: DataFrame


def _default(category: Column, field: int) -> Column:
    out = F.lit(None).cast("int" if 1 < field < 8 else "string")
    for row in C.CATEGORIES:
        if row[field] is not None:
            out = F.when(category == row[0], row[field]).otherwise(out)
    return out


def _pair(given: Column, category: Column, field: int) -> tuple[Column, Column]:
    """Two numbers of an array of exactly two positive ones, or of the category where the array is null; else nulls."""
    good = (F.size(given) == 2) & (F.get(given, F.lit(0)) > 0) & (F.get(given, F.lit(1)) > 0)
    return tuple(F.when(given.isNull(), _default(category, field + k)).when(good, F.get(given, F.lit(k))) for k in range(2))


def _categories(requests: DataFrame) -> DataFrame:
    """One row for each category block, its defaults filled in; requests without blocks keep one row of nulls."""
    rows = requests.select("project", F.coalesce("style_notes", F.lit("")).alias("style"), F.coalesce("generation_method", F.lit(BUILT_IN)).alias("method"), F.posexplode_outer("categories").alias("category_ord", "c"))
    name = F.col("c.category")
    pairs = {}
    for column, field in (("canvas", 2), ("grid", 4), ("target", 6)):
        given = F.col("c.target_size" if column == "target" else f"c.{column}")
        pairs |= dict(zip((f"{column}_w", f"{column}_h"), _pair(given, name, field), strict=True))
    named = F.col("c.target_size").isNotNull() | _default(name, 6).isNotNull()
    rows = rows.select("*", name.alias("category"), F.coalesce("c.transparency_mode", F.lit(MODES[0])).alias("mode"), *(v.alias(k) for k, v in pairs.items()), named.alias("has_target"))
    words = F.concat_ws(" ", "style", F.array_join(F.transform("c.assets", lambda a: F.concat_ws(" ", a["semantic_name"], a["description"])), " "))
    choice = S.chroma_key_choice(F.col("c.chroma_key"), S.subject_colours(words))
    keyed = F.col("mode") == MODES[0]
    number = lambda field, value: F.coalesce(F.col(f"c.{field}"), F.lit(value)).alias(field)
    extras = [number("padding", PADDING), F.coalesce("c.alignment", _default(name, 8)).alias("alignment"), number("outer_margin", MARGIN), number("gutter", GUTTER), number("safe_padding", SAFE)]
    return rows.select("*", (F.col("grid_w") * F.col("grid_h")).alias("capacity"), F.when(keyed, choice["key"]).alias("chroma_key"), F.when(keyed, choice["mode"]).otherwise("not-applicable").alias("key_mode"), F.when(keyed, choice["issue"]).alias("key_issue"), *extras)


def _assets(categories: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(assets with their category_index, aliases of Panels that share an earlier one's frame style)."""
    rows = categories.select("project", "category_ord", "category", "capacity", F.posexplode("c.assets").alias("asset_ord", "a"))
    blank = lambda field, value: F.coalesce(F.nullif(F.trim(f"a.{field}"), F.lit("")), F.lit(value)).alias(field)
    rows = rows.select("project", "category_ord", "category", "capacity", "asset_ord", F.trim(F.coalesce("a.semantic_name", F.lit(""))).alias("semantic_name"), blank("state", "Default"), blank("description", ""), blank("frame_style", "default"))
    # Panels by frame style, other assets each by its own place.
    frame = F.when(F.col("category") == "Panel", S.panel_frame_key(F.col("frame_style"))).otherwise(F.col("asset_ord").cast("string"))
    same = Window.partitionBy("project", "category_ord", frame).orderBy("asset_ord")
    first = F.first(F.struct("asset_ord", "semantic_name", "state")).over(same)
    rows = rows.withColumn("first", first)
    kept = rows.where(F.col("first.asset_ord") == F.col("asset_ord")).drop("first")
    index = F.row_number().over(Window.partitionBy("project", "category_ord").orderBy("asset_ord"))
    aliases = rows.where(F.col("first.asset_ord") < F.col("asset_ord")).select("project", "category_ord", "category", "asset_ord", "semantic_name", "state", "frame_style", F.col("first.semantic_name").alias("reuse_semantic_name"), F.col("first.state").alias("reuse_state"))
    return kept.withColumn("category_index", index), aliases


def _issues(requests: DataFrame, categories: DataFrame, assets: DataFrame) -> DataFrame:
    known = [row[0] for row in C.CATEGORIES]
    repeated = F.row_number().over(Window.partitionBy("project", "category").orderBy("category_ord")) > 1
    usable = lambda total, count: total - 2 * F.col("outer_margin") - (count - 1) * F.col("gutter")
    w, h = usable(F.col("canvas_w"), F.col("grid_w")), usable(F.col("canvas_h"), F.col("grid_h"))
    tight = lambda room, count: F.floor(room / count) <= 2 * F.col("safe_padding")
    checks = {
        "request-without-categories": F.col("c").isNull(),
        "unsupported-category": F.col("c").isNotNull() & ~F.coalesce(F.col("category").isin(known), F.lit(False)),
        "duplicate-category": F.col("repeated") & F.col("category").isNotNull(),
        "category-without-assets": F.col("c").isNotNull() & (F.coalesce(F.size("c.assets"), F.lit(0)) <= 0),
        "invalid-canvas": F.col("c.canvas").isNotNull() & F.col("canvas_w").isNull(),
        "invalid-grid": F.col("c.grid").isNotNull() & F.col("grid_w").isNull(),
        "invalid-target-size": F.col("c.target_size").isNotNull() & F.col("target_w").isNull(),
        "layout-without-room": (F.least("outer_margin", "gutter", "safe_padding") < 0) | (w < F.col("grid_w")) | (h < F.col("grid_h")) | tight(w, F.col("grid_w")) | tight(h, F.col("grid_h")),
        "unsupported-transparency-mode": ~F.col("mode").isin(*MODES),
        "native-alpha-not-provable": (F.col("mode") == MODES[2]) & (F.col("method") == BUILT_IN),
    }
    codes = F.array_compact(F.array(*(F.when(when, F.lit(code)) for code, when in checks.items()), F.col("key_issue")))
    by_category = categories.withColumn("repeated", repeated).select("project", "category_ord", "category", F.explode(codes).alias("code"))
    blank = assets.where("semantic_name = ''").select("project", "category_ord", "category", F.lit("asset-without-name").alias("code"))
    over = assets.where("capacity > 0").groupBy("project", "category_ord", "category", "capacity", "semantic_name").count().where("count > capacity").select("project", "category_ord", "category", F.lit("group-exceeds-sheet").alias("code"))
    twice = requests.groupBy("project").count().where("count > 1").select("project", F.lit(None).cast("int").alias("category_ord"), F.lit(None).cast("string").alias("category"), F.lit("duplicate-project").alias("code"))
    return by_category.unionByName(blank).unionByName(over).unionByName(twice).distinct()


def batch_plan(requests: DataFrame) -> Plan:
    """Jobs of request documents (project_id, style_notes, generation_method, categories; see sources.requests).

    Groups of one semantic name stay on one sheet; sheets are filled in the order of first appearance. Project ids
    become slugs, and requests that share one are refused. All work is by project and category, so requests are
    independent of each other. Tables that several others read are written once, to the checkpoint folder.
    """
    named = requests.withColumn("project", S.slugify(F.coalesce("project_id", F.lit(""))))
    every = cut(_categories(named))
    all_assets, all_aliases = _assets(every)
    issues = cut(_issues(named, every, all_assets))
    refused = issues.select("project").distinct()
    good = lambda df: df.join(refused, "project", "left_anti")
    categories, assets, aliases = good(every), good(all_assets), good(all_aliases)

    block = F.struct("project", "category_ord", "capacity")
    groups = assets.groupBy(block.alias("block"), "semantic_name").agg(F.min("asset_ord").alias("first"), F.count("*").alias("n"))
    sheets = packed_sheets(groups, "block", ["first"], "n", "semantic_name", F.col("block.capacity"))
    sheets = sheets.select("block.project", "block.category_ord", F.col("name").alias("semantic_name"), F.col("sheet").alias("sheet_number")).join(groups.select("block.project", "block.category_ord", "semantic_name", "first"), ["project", "category_ord", "semantic_name"])
    slot = F.row_number().over(Window.partitionBy("project", "category_ord", "sheet_number").orderBy("first", "asset_ord"))
    placed = assets.join(sheets, ["project", "category_ord", "semantic_name"]).withColumn("slot", slot).withColumn("job_id", S.job_id(F.col("category"), F.col("sheet_number")))
    placed = cut(placed.select("project", "job_id", "category_ord", "category", "sheet_number", "slot", "category_index", "semantic_name", "state", "description", "frame_style"))

    counts = placed.groupBy("project", "category_ord", "category", "sheet_number", "job_id").agg(F.count("*").cast("int").alias("expected_count"))
    detail = categories.select("project", "category_ord", "canvas_w", "canvas_h", "grid_w", "grid_h", F.when(F.col("has_target"), F.col("target_w")).alias("target_w"), F.when(F.col("has_target"), F.col("target_h")).alias("target_h"), "mode", "chroma_key", "key_mode", "padding", "alignment", "outer_margin", "gutter", "safe_padding")
    rows = counts.join(detail, ["project", "category_ord"])
    path = lambda folder, ending: F.concat(F.lit(folder), F.col("job_id"), F.lit(ending))
    only = lambda mode, column: F.when(F.col("mode") == mode, column)
    jobs = cut(rows.select(
        "*",
        F.row_number().over(Window.partitionBy("project").orderBy("category_ord", "sheet_number")).alias("generation_sequence"),
        S.risk_priority(F.col("category")).alias("risk_priority"),
        F.lit("awaiting-generation").alias("status"),
        path("requests/", ".json").alias("request_file"),
        path("prompts/", ".md").alias("prompt_file"),
        path("references/layout-guides/", ".json").alias("layout_json"),
        path("generated/current/", ".png").alias("generated_output"),
        only(MODES[1], path("generated/current/", "-alpha-matte.png")).alias("alpha_matte_output"),
        only(MODES[2], path("generated/current/", ".provenance.json")).alias("provenance_file"),
        F.concat(F.lit("final/"), F.col("category")).alias("final_directory"),
    ))
    specs = jobs.select(F.struct("project", "job_id").alias("layout_id"), F.col("canvas_w").alias("width"), F.col("canvas_h").alias("height"), F.col("grid_w").alias("columns"), F.col("grid_h").alias("rows"), F.col("outer_margin").alias("margin"), "gutter", F.col("safe_padding").alias("safe"))
    slots = layout_slots(specs).select("layout_id.project", "layout_id.job_id", "idx", "row", "column", "l", "t", "r", "b", "sl", "st", "sr", "sb", "cx", "cy")
    return Plan(categories, placed, aliases, jobs, slots, issues)


def job_documents(plan: Plan) -> DataFrame:
    """(project, request_file, document): the JSON request of each job, its assets in slot order."""
    asset = F.struct("slot", "semantic_name", "state", "description", "category_index")
    own = plan.assets.groupBy("project", "job_id").agg(F.array_sort(F.collect_list(asset)).alias("assets"))
    document = F.struct(F.lit(2).alias("schema_version"), F.col("project").alias("project_id"), "job_id", "category", F.array("canvas_w", "canvas_h").alias("canvas"), F.array("grid_w", "grid_h").alias("grid"), "chroma_key", F.col("mode").alias("transparency_mode"), "padding", "alignment", F.transform("assets", lambda a: a.dropFields("slot")).alias("assets"))
    return plan.jobs.join(own, ["project", "job_id"]).select("project", "request_file", F.to_json(document).alias("document"))


def batch_requests(inventory: DataFrame, settings: DataFrame | None = None) -> DataFrame:
    """Request documents (nested, as `batch_plan` reads them) of inventories: what is to be generated, by category.

    inventory: project_id, screen_ord, asset_ord, category, semantic_name, state, description, frame_style, action.
    Categories stand in the order of their first asset. settings: project_id, style_notes, generation_method,
    max_extra_calls, at most a row for each project. A project that reuses everything has no categories. Extra calls
    are as asked, else what the categories reserve; generate_count and reuse_count tell how the inventory was met.
    """
    at = F.struct("screen_ord", "asset_ord")
    asset = F.struct(at.alias("at"), F.struct("semantic_name", "state", "description", "frame_style", F.lit(None).cast("boolean").alias("enabled")).alias("asset"))
    made = inventory.where("action = 'generate'").groupBy("project_id", "category").agg(F.min(at).alias("first"), F.array_sort(F.collect_list(asset)).alias("assets"))
    nulls = [F.lit(None).cast(kind).alias(name) for name, kind in (("canvas", "array<int>"), ("grid", "array<int>"), ("target_size", "array<int>"), ("padding", "int"), ("alignment", "string"), ("chroma_key", "string"), ("transparency_mode", "string"), ("fragment_policy", "map<string,string>"))]
    edges = [F.lit(None).cast("int").alias(name) for name in ("outer_margin", "gutter", "safe_padding")]
    block = F.struct("first", F.struct("category", *nulls, F.transform("assets", lambda a: a["asset"]).alias("assets"), *edges).alias("c"))
    sooner = lambda a, b: F.when(a["first"] < b["first"], -1).otherwise(1)
    grouped = made.groupBy("project_id").agg(F.transform(F.array_sort(F.collect_list(block), sooner), lambda b: b["c"]).alias("categories"))
    totals = inventory.groupBy("project_id").agg(F.count_if(F.col("action") == "generate").alias("generate_count"), F.count_if(F.col("action") == "reuse").alias("reuse_count"))
    rows = totals.join(grouped, "project_id", "left")
    rows = rows.join(settings, "project_id", "left") if settings is not None else rows.select("*", F.lit(None).cast("string").alias("style_notes"), F.lit(None).cast("string").alias("generation_method"), F.lit(None).cast("int").alias("max_extra_calls"))
    names = F.transform("categories", lambda c: c["category"])
    suggested = F.when(F.col("categories").isNull(), F.lit(1)).otherwise(S.generation_budget(names))
    return rows.select(
        "project_id",
        F.coalesce("style_notes", F.lit("")).alias("style_notes"),
        F.coalesce("generation_method", F.lit(BUILT_IN)).alias("generation_method"),
        F.coalesce("max_extra_calls", suggested).alias("max_extra_calls"),
        F.when(F.col("max_extra_calls").isNull(), "risk-reserved").otherwise("explicit-total").alias("strategy"),
        "categories",
        "generate_count",
        "reuse_count",
        (F.col("generate_count") == 0).alias("all_assets_reused"),
    )
