import pytest
from pyspark.sql import functions as F

from fixtures import rows
from jsonstrata.plans import turns
from jsonstrata.plans.turns import load_turn, waiting_files
from jsonstrata.sinks import files
from jsonstrata.sources import dropdir
from test_load import make_plan
from test_sources import drop, names

LIMITS = {"max_file_bytes": 100, "max_files": 2}


@pytest.fixture
def folder(tmp_path):
    folder = tmp_path / "drop"
    folder.mkdir()
    for i in range(3):
        drop(folder, f"f{i}.json", f'{{"_extract_id":"A{i}"}}', 300 - i)
    return folder


def loaded(spark, plan):
    return sorted(r[0] for r in rows(plan.raw("prod").read(spark).select("id")))


def test_turns_go_on_from_the_position(spark, prefix, folder):
    plan = make_plan(spark, prefix)
    assert load_turn(spark, str(folder), plan, "t0", **LIMITS) == 2
    assert load_turn(spark, str(folder), plan, "t0", **LIMITS) == 0
    assert loaded(spark, plan) == ["A0", "A1"]
    assert names(waiting_files(spark, str(folder), plan)) == ["f2.json"]
    # What was changed long before the position isn't even listed, unless in a sweep.
    drop(folder, "late.json", '{"_extract_id":"L"}', 350)
    drop(folder, "later.json", '{"_extract_id":"M"}', 90_000)
    assert sorted(names(waiting_files(spark, str(folder), plan))) == ["f2.json", "late.json"]
    assert names(waiting_files(spark, str(folder), plan, look_back=20)) == ["f2.json"]
    assert load_turn(spark, str(folder), plan, "t1", **LIMITS) == 2
    assert load_turn(spark, str(folder), plan, "t2", **LIMITS) == 0
    assert load_turn(spark, str(folder), plan, "t2", sweep=True, **LIMITS) == 1
    assert loaded(spark, plan) == ["A0", "A1", "A2", "L", "M"]


def test_a_file_changed_in_the_second_of_the_bound_is_listed(spark, prefix, folder):
    plan = make_plan(spark, prefix)
    load_turn(spark, str(folder), plan, "t0", **LIMITS)  # the position is 299 seconds before
    drop(folder, "bound.json", "{}", 309)
    assert "bound.json" in names(waiting_files(spark, str(folder), plan, look_back=10))


def test_a_turn_that_fails_leaves_no_trace(spark, prefix, folder, monkeypatch):
    plan = make_plan(spark, prefix)

    def fail(*_args, **_more):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(turns, "load_batch", fail)
        with pytest.raises(RuntimeError):
            load_turn(spark, str(folder), plan, "t0", **LIMITS)
    assert len(names(waiting_files(spark, str(folder), plan))) == 3
    assert load_turn(spark, str(folder), plan, "t0", **LIMITS) == 2


def test_archive_by_day(spark, prefix, folder, tmp_path, monkeypatch):
    plan = make_plan(spark, prefix)
    done = tmp_path / "done"
    drop(folder, "big.json", "x" * 101, 400)
    with monkeypatch.context() as patch:
        patch.setattr(turns, "_archive", lambda *_: None)  # stopped after publishing
        load_turn(spark, str(folder), plan, "t0", archive_dir=str(done), **LIMITS)
    load_turn(spark, str(folder), plan, "t0", archive_dir=str(done), **LIMITS)
    load_turn(spark, str(folder), plan, "t1", archive_dir=str(done), **LIMITS)
    # A file of a name and a day that the archive has is kept beside the first.
    drop(folder, "f1.json", '{"_extract_id":"B1"}', 100)
    load_turn(spark, str(folder), plan, "t2", archive_dir=str(done), **LIMITS)
    found = sorted(p.relative_to(done).as_posix() for p in done.rglob("*.json"))
    day = "day=2023-11-14"
    assert {f for f in found if not f.endswith("-f1.json")} == {f"{day}/f{i}.json" for i in range(3)} | {f"rejected/{day}/big.json"}
    assert len(found) == 5 and not list(folder.glob("*.json"))
    assert loaded(spark, plan) == ["A0", "A1", "A2", "B1"]
    refused = plan.quarantine.read(spark).where("tag = 'files'")
    assert [r["reason"] for r in refused.collect()] == ["file has more than 100 bytes"]
    assert plan.intake.read(spark).where(F.col("reason").isNotNull()).count() == 1


def test_batches_of_turns_are_joined_up(spark, prefix, folder):
    plan = make_plan(spark, prefix)
    for turn in ("t0", "t1"):
        load_turn(spark, str(folder), plan, turn, **LIMITS)
    plan.compact(spark, ["t0", "t1"], "day1")
    assert load_turn(spark, str(folder), plan, "t1", **LIMITS) == 0
    assert names(waiting_files(spark, str(folder), plan, sweep=True)) == []
    assert loaded(spark, plan) == ["A0", "A1", "A2"]


@pytest.mark.parametrize("named", [0, 1_000])
def test_many_files_are_taken_without_a_path_each(spark, prefix, folder, tmp_path, monkeypatch, named):
    monkeypatch.setattr(dropdir, "NAMED_FILES", named)
    opened = []
    literal = dropdir._literal
    monkeypatch.setattr(dropdir, "_literal", lambda paths: opened.append(len(paths)) or literal(paths))
    plan, done = make_plan(spark, prefix), str(tmp_path / "done")
    drop(folder, "a{b}[c] d.json", '{"_extract_id":"X"}', 301)
    drop(folder, "big.json", "x" * 101, 302)
    for turn, left in [("t0", 2), ("t1", 2), ("t2", 1), ("t3", 0)]:
        assert load_turn(spark, str(folder), plan, turn, archive_dir=done, **LIMITS) == left
    assert loaded(spark, plan) == ["A0", "A1", "A2", "X"]
    assert opened == ([] if named == 0 else [2, 2, 1])
    assert not list(folder.glob("*.json")) and len(list((tmp_path / "done").rglob("*.json"))) == 5


@pytest.mark.parametrize("local", [True, False])
def test_the_driver_moves_no_files_of_a_store_that_tasks_open(spark, folder, tmp_path, monkeypatch, local):
    if not local:
        monkeypatch.setattr(files, "local_path", lambda *_: None)
    asked = []
    pool = files.ThreadPoolExecutor
    monkeypatch.setattr(files, "ThreadPoolExecutor", lambda n: asked.append(n) or pool(n))
    done = tmp_path / "done"
    moves = spark.createDataFrame([(str(folder / f"f{i}.json"), f"{done}/day=1/f{i}.json") for i in range(3)], "source string, target string")
    files.move_all(spark, moves, [str(folder), str(done)], str(tmp_path / "draft"), 2)
    assert bool(asked) != local
    assert sorted(p.name for p in done.rglob("*.json")) == ["f0.json", "f1.json", "f2.json"] and not list(folder.glob("*.json"))
    assert not (tmp_path / "draft").exists()
