"""Restart points and joint publication, with runs that fail at every point."""

from __future__ import annotations

import json
import os

import pytest

from affinity import resume
from affinity.params import RecParams
from affinity.plans.job import run_job
from affinity.resume import Files, finish_publication, job_root, replace_outputs, resumable_stages
from affinity.session import scratch_path, write_stage

PARAMS = RecParams(0.5, 0.1, 10, 1.0, 5, 5, 5)
STEPS = ["user_items", "item_popularity", "link_sums", "nhood_graph", "item_recs"]
OUTPUTS = ("item_item_recommendation", "user_item_recommendation")


class Killed(Exception):
    pass


def local(path):
    return path.removeprefix("file://").removeprefix("file:")


def inputs(spark, buys):
    paths = [scratch_path(spark, n) for n in ("purchases", "wishlists")]
    rows = [{"row_id": i, "movie_name": m, "user_id": u} for i, (u, m) in enumerate(buys)]
    for p, part in zip(paths, (rows, rows[:2])):
        os.makedirs(local(p))
        with open(f"{local(p)}/part-0.json", "w") as f:
            f.writelines(json.dumps(r) + "\n" for r in part)
    return paths


BUYS = [(f"u{i}", x) for i in range(8) for x in "ABCDEFGH"[i % 4 : i % 4 + 3]]


def contents(spark, out):
    return {n: sorted(r[0] for r in spark.read.text(f"{out}/{n}").collect()) for n in OUTPUTS}


def killer(steps, at):
    def on_step(name, reused):
        steps.append((name, reused))
        if name == at:
            raise Killed(name)

    return on_step


@pytest.mark.parametrize("at", STEPS)
def test_a_killed_run_is_taken_up_at_its_last_step(spark, at):
    p, w = inputs(spark, BUYS)
    whole, out = scratch_path(spark, "whole"), scratch_path(spark, "out")
    steps = []
    run_job(spark, p, w, whole, PARAMS, on_step=killer(steps, None))
    assert steps == [(s, False) for s in STEPS]
    with pytest.raises(Killed):
        run_job(spark, p, w, out, PARAMS, on_step=killer([], at))
    assert not os.path.exists(local(f"{out}/{OUTPUTS[0]}"))
    steps = []
    run_job(spark, p, w, out, PARAMS, on_step=killer(steps, None))
    done = STEPS.index(at) + 1
    assert steps == [(s, i < done) for i, s in enumerate(STEPS)]
    assert contents(spark, out) == contents(spark, whole)
    # A finished job leaves no restart points.
    assert Files(spark).names(job_root(spark)) == []


def test_a_resumed_run_does_not_expand_pairs(spark, monkeypatch):
    p, w = inputs(spark, BUYS)
    out = scratch_path(spark, "out")
    with pytest.raises(Killed):
        run_job(spark, p, w, out, PARAMS, on_step=killer([], "link_sums"))
    written, write = [], resume.JobStages.stage

    def stage(self, df, name):
        before = self.resuming
        table = write(self, df, name)
        if not self.resuming or not before:
            written.append(df._jdf.queryExecution().optimizedPlan().toString())
        return table

    monkeypatch.setattr(resume.JobStages, "stage", stage)
    run_job(spark, p, w, out, PARAMS)
    # What is computed reads the sums; the pair join and the raw signals are in none of it.
    assert len(written) == 2 and not any("least(" in plan for plan in written)
    assert not any("movie_name" in plan for plan in written)


def test_other_inputs_or_parameters_start_anew(spark):
    p, w = inputs(spark, BUYS)
    out = scratch_path(spark, "out")

    def killed(params, at="nhood_graph"):
        steps = []
        with pytest.raises(Killed):
            run_job(spark, p, w, out, params, on_step=killer(steps, at))
        return [reused for _, reused in steps]

    assert killed(PARAMS) == [False] * 4
    assert killed(PARAMS) == [True] * 4
    assert killed(PARAMS.with_(bayesian_prior=2.0)) == [False] * 4
    with open(f"{local(p)}/part-1.json", "w") as f:
        f.write(json.dumps({"row_id": 9, "movie_name": "Z", "user_id": "u1"}) + "\n")
    assert killed(PARAMS.with_(bayesian_prior=2.0)) == [False] * 4
    steps = []
    run_job(spark, p, w, out, PARAMS.with_(bayesian_prior=2.0), on_step=killer(steps, None))
    assert [reused for _, reused in steps] == [True] * 4 + [False]
    assert any(line.startswith("Z\t") for line in contents(spark, out)[OUTPUTS[0]])


def test_a_table_without_a_manifest_is_computed_again_with_all_behind_it(spark):
    df = spark.range(5).toDF("x")

    def run(fail=False):
        steps = []
        with resumable_stages(spark, "no-manifest", "f", lambda name, reused: steps.append(reused)) as stages:
            a = write_stage(df, "a")
            b = write_stage(a.selectExpr("x + 1 AS x"), "b")
            c = write_stage(b.selectExpr("x * 2 AS x"), "c")
            assert sorted(r.x for r in c.collect()) == [2, 4, 6, 8, 10]
            if fail:
                raise Killed
        return steps, stages

    for _ in range(2):
        with pytest.raises(Killed):
            run(fail=True)
    files = Files(spark)
    files.delete(f"{job_root(spark)}/no-manifest/002-b/{resume.MANIFEST}")
    steps, stages = run()
    assert steps == [True, False, False] and not files.exists(stages.folder)


def test_a_failed_writer_leaves_both_old_outputs(spark):
    base = scratch_path(spark, "pub")
    one = lambda x: lambda p: spark.createDataFrame([(x,)], "v string").write.text(p)

    def fails(p):
        one("half")(p)
        raise Killed

    replace_outputs(spark, base, {"a": one("old a"), "b": one("old b")})
    with pytest.raises(Killed):
        replace_outputs(spark, base, {"a": one("new a"), "b": fails})
    assert [spark.read.text(f"{base}/{n}").collect()[0][0] for n in "ab"] == ["old a", "old b"]
    assert not [n for n in os.listdir(local(base)) if n.startswith("_publish")]


@pytest.mark.parametrize("renames", range(1, 7))
def test_an_interrupted_publication_is_finished(spark, monkeypatch, renames):
    """Killed at every rename: before the journal all is old, behind it all becomes new."""
    base = scratch_path(spark, "pub")
    one = lambda x: lambda p: spark.createDataFrame([(x,)], "v string").write.text(p)
    replace_outputs(spark, base, {"a": one("old"), "b": one("old")})
    rename, left = Files.rename, [renames]

    def dies(self, path, to):
        left[0] -= 1
        if left[0] == 0:
            raise Killed
        rename(self, path, to)

    with monkeypatch.context() as m:
        m.setattr(Files, "rename", dies)
        m.setattr(Files, "delete", lambda self, path: None)
        if renames <= 5:
            with pytest.raises(Killed):
                replace_outputs(spark, base, {"a": one("new"), "b": one("new")})
        else:
            replace_outputs(spark, base, {"a": one("new"), "b": one("new")})
    finish_publication(spark, base, drop_unfinished=True)
    want = "old" if renames == 1 else "new"
    assert [[r[0] for r in spark.read.text(f"{base}/{n}").collect()] for n in "ab"] == [[want], [want]]
    assert sorted(n for n in os.listdir(local(base)) if not n.startswith(".")) == ["a", "b"]


def test_a_failed_job_leaves_both_old_outputs(spark, monkeypatch):
    from affinity.plans import job

    p, w = inputs(spark, BUYS)
    out = scratch_path(spark, "out")
    run_job(spark, p, w, out, PARAMS)
    old = contents(spark, out)
    write = job.write_text

    def fails(df, path):
        if "user" in df.columns:
            raise Killed
        write(df, path)

    monkeypatch.setattr(job, "write_text", fails)
    with pytest.raises(Killed):
        run_job(spark, p, w, out, PARAMS.with_(num_recs_per_item=1))
    assert contents(spark, out) == old
    monkeypatch.undo()
    steps = []
    run_job(spark, p, w, out, PARAMS.with_(num_recs_per_item=1), on_step=killer(steps, None))
    assert steps == [(s, True) for s in STEPS] and contents(spark, out) != old


def test_a_store_can_read_what_it_replaces(spark):
    from affinity.sources import store_parquet, store_text

    path = scratch_path(spark, "self")
    store_parquet(spark.range(3).toDF("x"), path)
    store_parquet(spark.read.parquet(path).selectExpr("x + 10 AS x"), path)
    assert sorted(r.x for r in spark.read.parquet(path).collect()) == [10, 11, 12]
    store_text(spark.read.parquet(path), path)
    assert sorted(r[0] for r in spark.read.text(path).collect()) == ["10", "11", "12"]
