"""Whole corrections of small sheets: refusals, preflight, flat backgrounds, targets, manifests, review images, the command line."""

import json

import numpy as np
import pytest

from packloom.__main__ import main
from packloom.operators import corrections as X
from packloom.sources import files

KEY = (0, 255, 0)
SHEET = np.zeros((40, 60, 4), np.uint8)
SHEET[..., 3] = 255
SHEET[..., :3] = KEY
SHEET[8:20, 6:16, :3] = (200, 20, 30)
SHEET[10:30, 34:50, :3] = (20, 30, 200)
A, B = [3, 4, 20, 24], [30, 6, 54, 34]


def asset(bbox, number, **more):
    return {"source_index": str(number), "bbox": bbox, "category": "Icon_Item", "category_index": str(number), "semantic_name": f"thing {number}"} | more


def document(project, *assets, **more):
    return {"project": project, "approved": True, "image_size": [60, 40], "background": {"mode": "flat-color", "color": "#00FF00"}, "assets": list(assets)} | more


@pytest.fixture
def run(spark, tmp_path):
    def go(documents, sheets=None, listed=None):
        path = tmp_path / "documents.json"
        path.write_text("\n".join(map(json.dumps, documents)))
        settings, candidates = X.split(spark.read.schema("project string, " + X.DOCUMENT).json(str(path)))
        sheets = {d["project"]: SHEET for d in documents} if sheets is None else sheets
        rows = [(p, None if a is None else a.shape[1], None if a is None else a.shape[0], None if a is None else a.tobytes()) for p, a in sheets.items()]
        table = spark.createDataFrame(rows, "project string, width int, height int, rgba binary")
        return X.applied(settings, candidates, table, listed), candidates, table

    return go


def issues_of(done):
    return sorted((r.project, -1 if r.position is None else r.position, r.code) for r in done.issues.collect())


def test_boxes_become_assets_on_their_targets(run):
    done, _, _ = run([document("p", asset(A, 1, target_size=[16, 16], padding=2, alignment="bottom-center"), asset(B, 2, state="Pressed now", padding=1), asset([0, 0, 9, 9], 1, enabled=False))])
    assert issues_of(done) == []
    first, second = sorted(done.entries.collect(), key=lambda r: r.position)
    assert (first.id, first.output) == ("06_Icon_Item_Thing1_Default_001", "final/Icon_Item/06_Icon_Item_Thing1_Default_001.png")
    assert (first.trim, first.width, first.height, first.pivot, first.chroma_key) == ([3, 4, 13, 16], 16, 16, [0.5, 0.0], "#00FF00")
    assert (first.scale, first.content_w, first.content_h, first.content_x, first.content_y) == (1.0, 10, 12, 3, 2)
    assert (second.id, second.width, second.height, second.content_x, second.content_y) == ("06_Icon_Item_Thing2_PressedNow_002", 18, 22, 1, 1)
    images = {r.file: np.frombuffer(r.rgba, np.uint8).reshape(r.height, r.width, 4) for r in done.images.collect()}
    want = np.zeros((22, 18, 4), np.uint8)
    want[1:21, 1:17] = (20, 30, 200, 255)
    assert (images[second.output] == want).all()
    report = done.reports.first()
    assert (report.status, report.expected_count, report.manifest_count, report.pass_count, report.fail_count, report.manual_action_required) == ("complete", 2, 2, 2, 0, [])


def test_crops_grow_only_if_asked_to(run):
    done, _, _ = run([document("p", asset(A, 1, allow_upscale=True), asset(B, 2), normalization={"target_size": [28, 34], "padding": 2})])
    big, plain = sorted(done.entries.collect(), key=lambda r: r.position)
    assert (big.scale, big.content_w, big.content_h) == (2.4, 24, 29) and (plain.scale, plain.content_w, plain.content_h) == (1.0, 16, 20)


def test_refused_projects_export_nothing(run):
    one = asset(A, 1)
    documents = [
        document("approval", one, approved=False),
        document("approval-null", one, approved=None),
        document("checker", one, background={"mode": "checkerboard"}),
        document("colour", one, background={"mode": "flat-color", "color": "green"}),
        document("empty"),
        document("disabled", asset(A, 1, enabled=False)),
        document("gone", one),
        document("good", one),
        document("mode", one, background=None),
        document("size", one, image_size=[61, 40]),
        document("unread", one),
    ]
    sheets = {d["project"]: SHEET for d in documents if d["project"] != "gone"} | {"unread": None}
    done, _, _ = run(documents, sheets)
    codes = {p: code for p, _, code in issues_of(done)}
    assert codes == {"approval": "corrections-not-approved", "approval-null": "corrections-not-approved", "checker": "fake-checkerboard-background", "colour": "unresolved-background", "empty": "no-enabled-assets", "disabled": "no-enabled-assets", "gone": "missing-file", "mode": "unresolved-background", "size": "image-size-mismatch", "unread": "source-decode-failed"}
    assert [r.project for r in done.entries.collect()] == ["good"]
    status = {r.project: (r.status, r.manual_action_required) for r in done.reports.collect()}
    assert len(status) == 11 and status.pop("good") == ("complete", []) and status["gone"] == ("failed", ["missing-file"]) and {s for s, _ in status.values()} == {"failed"}


def test_preflight_names_fields_and_indices(run):
    done, candidates, sheets = run([document("cuts", asset([8, 4, 20, 24], 1), asset(B, 2)), document("twice", asset(A, 7, category_index="1"), asset([10, 6, 54, 34], 9, category_index="3")), document("none", asset([22, 30, 28, 38], 1), asset(None, 2), asset(B, 3, source_index="x"))])
    rows = {(r.project, r.position, r.code): r for r in done.issues.collect()}
    assert set(rows) == {("cuts", 0, "bbox-cuts-foreground"), ("twice", 1, "overlapping-corrections"), ("twice", 1, "bbox-cuts-foreground"), ("twice", 0, "non-continuous-category-index"), ("twice", 1, "non-continuous-category-index"), ("none", 0, "empty-correction"), ("none", 1, "invalid-bbox-shape"), ("none", 2, "invalid-source-index"), ("none", 0, "non-continuous-category-index"), ("none", 2, "non-continuous-category-index")}
    assert rows["cuts", 0, "bbox-cuts-foreground"].recommended == [4, 4, 20, 24]
    assert rows["twice", 1, "overlapping-corrections"].location == "assets[0].bbox <-> assets[1].bbox"
    reports = {r.project: r for r in done.reports.collect()}
    assert reports["cuts"].manual_action_required == ["1", "assets[0].bbox"]
    assert reports["twice"].manual_action_required == ["7", "9", "assets[0].bbox <-> assets[1].bbox", "assets[0].category_index", "assets[1].bbox", "assets[1].category_index"]
    assert done.entries.count() == 0 and {r.status for r in reports.values()} == {"failed"}
    page = {r.project: np.frombuffer(r.rgba, np.uint8).reshape(r.height, r.width, 4) for r in X.review_images(candidates, sheets, done.issues).collect()}["cuts"]
    assert page.shape == (40 + X.HEADER, 120, 4) and tuple(page[0, 0, :3]) == X.PAGE
    assert tuple(page[X.HEADER + 4, 8, :3]) == X.FOUND and tuple(page[X.HEADER + 4, 68, :3]) == X.FAILING and tuple(page[X.HEADER + 33, 113, :3]) == X.APPROVED
    assert (page[X.HEADER :, :60, :3][:4] == SHEET[:4, :, :3]).all()


def test_what_cannot_be_placed_is_told(run):
    done, _, _ = run([document("p", asset(A, 1, padding=8, target_size=[16, 16]), asset(B, 2, alignment="left")), document("q", asset(A, 1, target_size=[0, 4]), asset(B, 2))])
    told = issues_of(done)
    assert ("p", 0, "padding-leaves-no-room") in told and ("p", 1, "unsupported-alignment") in told and ("q", 0, "invalid-target-size") in told and ("q", -1, "count-mismatch") in told
    assert [(r.project, r.position) for r in done.entries.collect()] == [("q", 1)]
    assert {r.status for r in done.reports.collect()} == {"failed"}


def test_no_documents(run):
    done, candidates, sheets = run([], {})
    assert [df.count() for df in (done.issues, done.entries, done.images, done.reports, X.review_images(candidates, sheets, done.issues))] == [0] * 5


def test_stray_files_fail(spark, run):
    listed = spark.createDataFrame([("p", "final/Icon_Item/old.png")], "project string, file string")
    done, _, _ = run([document("p", asset(A, 1))], listed=listed)
    assert issues_of(done) == [("p", -1, "unexpected-files")] and done.reports.first().status == "failed"


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "sheet.png").write_bytes(files.png(60, 40, SHEET.tobytes()))
    corrections = document("", asset(A, 1), asset(B, 2), background={"mode": "flat-color", "color": "#00FF00"})
    (tmp_path / "boxes.json").write_text(json.dumps(corrections, indent=2))
    arguments = ["correct", "--input", str(tmp_path / "sheet.png"), "--corrections", str(tmp_path / "boxes.json"), "--project-id", "bag", "--output", str(tmp_path / "run")]
    assert main(arguments) == 0
    assert json.loads(capsys.readouterr().out)["manifest_count"] == 2
    names = sorted(str(p.relative_to(tmp_path / "run")) for p in (tmp_path / "run").rglob("*.png"))
    assert names == ["final/Icon_Item/06_Icon_Item_Thing1_Default_001.png", "final/Icon_Item/06_Icon_Item_Thing2_Default_002.png", "qa/bbox-review.png"]
    assert not list((tmp_path / "run").rglob("*.part"))
    seen = files.packed_images(files.images(spark, str(tmp_path / "run/final"), recursive=True)).where("error IS NULL").select("width", "height").collect()
    assert sorted(map(tuple, seen)) == [(26, 28), (32, 36)]
    with pytest.raises(Exception, match="already exists"):
        main(arguments)
    (tmp_path / "boxes.json").write_text(json.dumps(corrections | {"approved": False}))
    assert main([*arguments, "--force"]) == 2
    with pytest.raises(Exception, match="not below the root"):
        files.write_pngs(spark.createDataFrame([("../x.png", 1, 1, bytes(4))], "file string, width int, height int, rgba binary"), str(tmp_path))


def test_catalog_merges_by_key(tmp_path, capsys):
    entry = lambda name, **more: {"id": name, "category": "Button", "semantic_name": name, "output": f"{name}.png"} | more
    merge = lambda k, assets, *more: ((tmp_path / "m.json").write_text(json.dumps({"assets": assets})), main(["catalog", "--manifest", str(tmp_path / "m.json"), "--source-run", f"run{k}", "--output", str(tmp_path / f"c{k}"), *more]), json.loads(capsys.readouterr().out))[2]
    assert merge(1, [entry("Buy"), entry("Sell", qa="fail"), entry("Ask")]) == {"ok": True, "added": 2, "updated": 0, "total": 2}
    assert merge(2, [entry(" buy ", output="new.png"), entry("Sell"), entry("sell", output="last.png")], "--catalog", str(tmp_path / "c1")) == {"ok": True, "added": 1, "updated": 2, "total": 3}
    rows = [json.loads(line) for part in sorted((tmp_path / "c2").glob("part-*")) for line in part.read_text().splitlines()]
    assert [(r["asset_key"], r["output"], r["source_run"]) for r in rows] == [("Button|ask|default", "Ask.png", "run1"), ("Button|buy|default", "new.png", "run2"), ("Button|sell|default", "last.png", "run2")]
