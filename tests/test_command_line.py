"""The command line over files: JSON on stdout, exit code 2 where the result isn't ok, results not overwritten unasked."""

import json

import numpy as np
import pytest

from packloom.__main__ import main
from packloom.sources import files


def rows_of(path):
    return [json.loads(line) for part in sorted(path.glob("part-*")) for line in part.read_text().splitlines()]


def test_plan(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text(json.dumps({"project_id": "Bag", "categories": [{"category": "Button", "assets": [{"semantic_name": "Buy"}]}]}))
    arguments = ["plan", "--requests", str(tmp_path / "in"), "--output", str(tmp_path / "out")]
    assert main(arguments) == 0
    assert json.loads(capsys.readouterr().out) == {"ok": True, "jobs": 1, "assets": 1, "issues": 0}
    assert rows_of(tmp_path / "out/jobs")[0]["job_id"] == "button-sheet-01"
    with pytest.raises(Exception, match="already exists"):
        main(arguments)
    (tmp_path / "in/b.json").write_text(json.dumps({"project_id": "Shop", "categories": [{"category": "Hat", "assets": [{"semantic_name": "Buy"}]}]}))
    assert main([*arguments, "--force"]) == 2
    assert [r["code"] for r in rows_of(tmp_path / "out/issues")] == ["unsupported-category"]


def test_validate(spark, tmp_path, capsys):
    picture = np.zeros((16, 16, 4), np.uint8)
    picture[4:12, 4:12] = (200, 30, 40, 255)
    folder = tmp_path / "run/final/Icon_Item"
    folder.mkdir(parents=True)
    names = [f"06_Icon_Item_Item_Default_{k:03d}.png" for k in (1, 2)]
    (folder / names[0]).write_bytes(files.png(16, 16, picture.tobytes()))
    (folder / "notes.txt").write_text("no image")
    assets = [{"id": n[:-4], "job_id": "j", "category": "Icon_Item", "output": f"final/Icon_Item/{n}", "width": 16, "height": 16, "category_index": k + 1} for k, n in enumerate(names)]
    (tmp_path / "manifest.json").write_text(json.dumps({"project_id": "bag", "assets": assets}))
    arguments = ["validate", "--manifest", str(tmp_path / "manifest.json"), "--asset-root", str(tmp_path / "run"), "--output", str(tmp_path / "qa"), "--strict-files"]
    assert main(arguments) == 2
    report = json.loads(capsys.readouterr().out)
    assert (report["ok"], report["manifest_count"], report["valid_assets"], report["fail_count"]) == (False, 2, 1, 1)
    assert [(r["code"], r["asset_id"]) for r in rows_of(tmp_path / "qa/issues")] == [("missing-file", names[1][:-4])]
    (folder / names[1]).write_bytes(files.png(16, 16, picture.tobytes()))
    assert main([*arguments, "--force"]) == 0
    (folder / "stray.png").write_bytes(b"no image either")
    assert main([*arguments, "--force"]) == 2
    assert [(r["code"], r["files"]) for r in rows_of(tmp_path / "qa/issues")] == [("unexpected-files", ["final/Icon_Item/stray.png"])]
