"""Batch planning from JSON documents, and request documents from an inventory."""

import json

import pytest

from packloom.operators import planning
from packloom.sources import files


@pytest.fixture
def read(spark, tmp_path):
    def write(*documents):
        for k, d in enumerate(documents):
            (tmp_path / f"{k}.json").write_text(json.dumps(d, ensure_ascii=False))
        return files.requests(spark, str(tmp_path))

    return write


def named(*names):
    return [{"semantic_name": n, "state": s} for n, s in names]


GOOD = {
    "project_id": "Bag & Shop",
    "style_notes": "Emerald trim",
    "categories": [
        {"category": "Icon_Item", "grid": [2, 2], "assets": named(("Sword", ""), ("Shield", "A"), ("Sword", " B "), ("Helm", "A"), ("Helm", "B"), ("Ring", "A"))},
        {"category": "Panel", "assets": [{"semantic_name": "Main"}, {"semantic_name": "List", "frame_style": " DEFAULT "}, {"semantic_name": "Shop", "frame_style": "gold"}]},
        {"category": "Icon_Effect", "transparency_mode": "model-matte-derived", "assets": named(("Glow", "A"))},
    ],
}


def test_jobs_of_a_document(read):
    plan = planning.batch_plan(read(GOOD))
    assert plan.issues.collect() == []
    jobs = {r.job_id: r for r in plan.jobs.collect()}
    assert [j for j, _ in sorted(jobs.items(), key=lambda x: x[1].generation_sequence)] == ["icon-item-sheet-01", "icon-item-sheet-02", "panel-sheet-01", "panel-sheet-02", "icon-effect-sheet-01"]
    assert {r.project for r in jobs.values()} == {"bag-shop"}
    first = jobs["icon-item-sheet-01"]
    # Sword and Sword, Shield fill three of four slots; the two Helms don't fit and open the second sheet.
    assert (first.expected_count, first.chroma_key, first.key_mode, first.risk_priority, first.target_w) == (3, "#FF00FF", "auto-declared-palette", 10, 128)
    assert jobs["icon-item-sheet-02"].expected_count == 3
    effect = jobs["icon-effect-sheet-01"]
    assert (effect.chroma_key, effect.key_mode, effect.alpha_matte_output, effect.provenance_file) == (None, "not-applicable", "generated/current/icon-effect-sheet-01-alpha-matte.png", None)
    slots = [(r.slot, r.semantic_name, r.state, r.category_index) for r in plan.assets.where("job_id = 'icon-item-sheet-01'").orderBy("slot").collect()]
    assert slots == [(1, "Sword", "Default", 1), (2, "Sword", "B", 3), (3, "Shield", "A", 2)]
    assert [(r.semantic_name, r.reuse_semantic_name) for r in plan.aliases.collect()] == [("List", "Main")]
    boxes = plan.slots.where("job_id = 'panel-sheet-01'").collect()
    assert [(r.idx, r.sl, r.st, r.sr, r.sb) for r in boxes] == [(1, 160, 160, 864, 864)]
    documents = {r.request_file: json.loads(r.document) for r in planning.job_documents(plan).collect()}
    assert [a["semantic_name"] for a in documents["requests/icon-item-sheet-02.json"]["assets"]] == ["Helm", "Helm", "Ring"]


def test_all_failing_checks_are_listed(read):
    ok = {"category": "Button", "assets": named(("A", "x"))}
    bad = {
        "project_id": "bad",
        "categories": [
            {"category": "Icon_Item", "grid": [1, 1], "assets": named(("Sword", "A"), ("Sword", "B"), ("  ", "C"))},
            {"category": "Hat", "assets": named(("A", "x"))},
            {"category": "Button", "grid": [0, 4], "canvas": [10], "target_size": [1, 2, 3], "assets": []},
            ok,
            {"category": "Icon_Nav", "transparency_mode": "magic", "assets": named(("A", "x"))},
            {"category": "Icon_Skill", "transparency_mode": "native-alpha-required", "assets": named(("A", "x"))},
            {"category": "Icon_General", "chroma_key": "#00FF00", "assets": named(("Jade", "x"))},
            {"category": "Icon_Status", "outer_margin": 1020, "assets": named(("A", "x"))},
        ],
    }
    plan = planning.batch_plan(read(bad, {"project_id": "empty", "categories": []}, {"project_id": "Twin", "categories": [ok]}, {"project_id": "twin ", "categories": [ok]}, {"project_id": "fine", "categories": [ok]}))
    assert {(r.project, r.category_ord, r.code) for r in plan.issues.collect()} == {
        ("bad", 0, "group-exceeds-sheet"),
        ("bad", 0, "asset-without-name"),
        ("bad", 1, "unsupported-category"),
        ("bad", 2, "category-without-assets"),
        ("bad", 2, "invalid-canvas"),
        ("bad", 2, "invalid-grid"),
        ("bad", 2, "invalid-target-size"),
        ("bad", 3, "duplicate-category"),
        ("bad", 4, "unsupported-transparency-mode"),
        ("bad", 5, "native-alpha-not-provable"),
        ("bad", 6, "chroma-key-conflicts-with-subject"),
        ("bad", 7, "layout-without-room"),
        ("empty", None, "request-without-categories"),
        ("twin", None, "duplicate-project"),
        ("twin", 0, "duplicate-category"),
    }
    assert [r.project for r in plan.jobs.collect()] == ["fine"]


def test_requests_of_an_inventory_can_be_planned(spark):
    rows = [(0, 0, "Panel", "Main", "generate"), (0, 1, "Icon_General", "Close", "generate"), (1, 0, "Icon_General", "Close", "reuse"), (1, 1, "Icon_General", "Open", "generate"), (1, 2, "Panel", "Shop", "exclude")]
    inventory = spark.createDataFrame([("Bag", *r[:4], "Default", "", None, r[4]) for r in rows] + [("Old", 1, 0, "Panel", "Main", "Default", "", None, "reuse")], "project_id string, screen_ord int, asset_ord int, category string, semantic_name string, state string, description string, frame_style string, action string")
    found = planning.batch_requests(inventory)
    by = {r.project_id: r for r in found.collect()}
    assert [(c.category, [a.semantic_name for a in c.assets]) for c in by["Bag"].categories] == [("Panel", ["Main"]), ("Icon_General", ["Close", "Open"])]
    assert (by["Bag"].max_extra_calls, by["Bag"].strategy, by["Bag"].generate_count, by["Bag"].reuse_count) == (2, "risk-reserved", 3, 1)
    assert (by["Old"].categories, by["Old"].all_assets_reused, by["Old"].max_extra_calls) == (None, True, 1)
    settings = spark.createDataFrame([("Bag", "Violet", None, 4)], "project_id string, style_notes string, generation_method string, max_extra_calls int")
    asked = planning.batch_requests(inventory, settings).where("project_id = 'Bag'")
    assert [(r.max_extra_calls, r.strategy, r.style_notes) for r in asked.collect()] == [(4, "explicit-total", "Violet")]
    plan = planning.batch_plan(asked)
    assert sorted((r.job_id, r.expected_count, r.chroma_key) for r in plan.jobs.collect()) == [("icon-general-sheet-01", 2, "#00FF00"), ("panel-sheet-01", 1, "#00FF00")]
    assert planning.batch_plan(asked.where("false")).jobs.collect() == []
