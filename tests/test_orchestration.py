"""Gates of a delivery in their order, resumption with its history, and what a rollback may remove."""

import pytest

from packloom.operators import orchestration

FACTS = {"hygiene_ok": True, "pending_replacements": 0, "gate_failures": 0, "retry_items": 0, "missing_inputs": 0, "prior_status": None, "has_manifest": False, "force": False, "candidate_ready": False, "result_ok": None, "delivery_status": None}
SCHEMA = "hygiene_ok boolean, pending_replacements long, gate_failures long, retry_items long, missing_inputs long, prior_status string, has_manifest boolean, force boolean, candidate_ready boolean, result_ok boolean, delivery_status string"

CASES = [
    ({}, ("ready-for-processing", True, "run", False)),
    ({"hygiene_ok": False, "pending_replacements": 1, "missing_inputs": 3}, ("configuration-invalid", False, "clean-run-directory", False)),
    ({"pending_replacements": 1, "gate_failures": 2}, ("awaiting-regeneration", True, "replace-inputs", False)),
    ({"gate_failures": 2, "missing_inputs": 1}, ("failed", False, "review", False)),
    ({"gate_failures": 2, "retry_items": 1}, ("awaiting-regeneration", True, "replace-inputs", False)),
    ({"missing_inputs": 1, "prior_status": "complete", "has_manifest": True}, ("awaiting-generation", True, "generate-inputs", False)),
    ({"prior_status": "complete", "has_manifest": True}, ("complete", True, "review", True)),
    ({"prior_status": "complete", "has_manifest": True, "delivery_status": "unity-blocked"}, ("unity-blocked", False, "repair-delivery", False)),
    ({"prior_status": "complete", "has_manifest": True, "delivery_status": "odd"}, ("unity-failed", False, "repair-delivery", False)),
    ({"prior_status": "failed", "has_manifest": True}, ("failed", False, "force-run", False)),
    ({"has_manifest": True}, ("failed", False, "force-run", False)),
    ({"has_manifest": True, "force": True}, ("ready-for-processing", True, "run", False)),
    ({"prior_status": "complete", "has_manifest": True, "candidate_ready": True, "result_ok": True}, ("complete", True, "review", False)),
    ({"result_ok": True, "delivery_status": "configuration-invalid"}, ("configuration-invalid", False, "repair-delivery", False)),
    ({"result_ok": False}, ("failed", False, "review", False)),
    ({"result_ok": False, "retry_items": 2}, ("awaiting-regeneration", True, "replace-inputs", False)),
]


def test_the_first_gate_that_holds_decides(spark):
    rows = spark.createDataFrame([(k, *(FACTS | given).values()) for k, (given, _) in enumerate(CASES)], "k int, " + SCHEMA)
    found = {r.k: tuple(r.n) for r in rows.select("k", orchestration.next_status().alias("n")).collect()}
    assert found == {k: want for k, (_, want) in enumerate(CASES)}


def test_observations_of_runs(spark):
    jobs = spark.createDataFrame([("r", "a"), ("r", "b"), ("s", "a"), ("t", "a")], "run string, job string")
    inputs = spark.createDataFrame([("r", "a", "x", "1"), ("r", "b", "y", None), ("s", "a", "x", "2"), ("t", "a", "x", "9")], "run string, job string, path string, sha256 string")
    planned = spark.createDataFrame([("r", "x", "1"), ("r", "y", "5"), ("s", "x", "1"), ("s", "x", "1"), ("u", "x", "1")], "run string, path string, sha256 string")
    hygiene, gates = spark.createDataFrame([("t",), ("t",)], "run string"), spark.createDataFrame([("s", "a"), ("s", "a")], "run string, job string")
    found = sorted(tuple(r) for r in orchestration.observed(jobs, inputs, hygiene, planned, gates, "run").collect())
    # A file that isn't there has not been replaced; all planned ones of s have changed.
    assert found == [("r", True, 2, False, 0, 1), ("s", True, 0, True, 2, 0), ("t", False, 0, False, 0, 0)]
    assert orchestration.observed(jobs.where("false"), inputs, hygiene, planned, gates, "run").collect() == []


def test_history_grows_with_changes_alone(spark):
    history = spark.createDataFrame([], "run string, seq int, status string, safe_stage string, signature string")
    steps = [("awaiting-generation", None), ("awaiting-generation", None), ("awaiting-generation", "1"), ("assets-complete", "1"), ("unity-failed", "1")]
    for seq, (status, sha) in enumerate(steps):
        states = spark.createDataFrame([("r", status, seq)], "run string, status string, seq int")
        inputs = spark.createDataFrame([("r", "b", "2"), ("r", "a", sha)], "run string, path string, sha256 string")
        state, after = orchestration.resumable(states, inputs, history, "run")
        rows = after.collect()
        row = state.collect()[0]
        assert (row.input_count, row.ready_input_count) == (2, 1 + (sha is not None))
        history = spark.createDataFrame(rows, history.schema) if rows else history
    assert [(r.seq, r.status, r.safe_stage) for r in history.orderBy("seq").collect()] == [(0, "awaiting-generation", "generation"), (2, "awaiting-generation", "generation"), (3, "assets-complete", "assets-complete"), (4, "unity-failed", "assets-complete")]
    long = spark.createDataFrame([("r", k, "x", "x", str(k)) for k in range(150)], history.schema)
    kept = [r.seq for r in orchestration.resumable(spark.createDataFrame([("r", "y", 150)], "run string, status string, seq int"), inputs, long, "run")[1].collect()]
    assert sorted(kept) == list(range(51, 151))


@pytest.mark.parametrize(("root", "made", "bad"), [("Assets/_Project/UI/Sprites/Bag", ["Assets/_Project/UI/a.prefab"], []), ("Assets/_Project/UI/Sprites/../../x", [], ["Assets/_Project/UI/Sprites/../../x"]), ("Assets/_Project/UI/Sprites", [], ["Assets/_Project/UI/Sprites"]), ("Assets/_Project/UI/Sprites/Bag", ["Assets/Other/a.prefab", "/etc/passwd"], ["/etc/passwd", "Assets/Other/a.prefab"])])
def test_a_rollback_stays_in_its_folders(spark, root, made, bad):
    manifests = spark.createDataFrame([("p", root, made), ("other", "Assets/_Project/UI/Sprites/Bag", None)], "project string, sprite_root string, created_assets array<string>")
    names = ["Assets/_Project/UI/Sprites/Bag/a.png", "Assets/_Project/UI/Sprites/Bag.meta", "Assets/_Project/UI/Sprites/Bagger/a.png", "Assets/_Project/UI/a.prefab", "Assets/_Project/UI/a.prefab.meta", "Assets/_Project/UI/b.prefab", "Assets/Other/a.prefab"]
    present = spark.createDataFrame([("p", n) for n in names] + [("other", names[0])], "project string, path string")
    gone, refused = orchestration.rollback_set(manifests, present, "project")
    assert sorted(r.path for r in refused.collect()) == bad
    mine = sorted(r.path for r in gone.where("project = 'p'").collect())
    assert mine == ([] if bad else sorted([names[0], names[1], names[3], names[4]]))
    assert [r.path for r in gone.where("project = 'other'").collect()] == [names[0]]
