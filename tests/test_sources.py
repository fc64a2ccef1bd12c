"""Sources and sinks: JSON lines with declared schemas, tab text and Parquet round trips."""

import json
import os

import pytest
from pyspark.sql import functions as F

from affinity.session import scratch_path
from affinity.sources import (
    PURCHASE_SCHEMA,
    inventory_in_stock,
    inventory_metadata,
    load_inventory,
    load_purchases,
    load_text,
    load_wishlists,
    purchase_signals,
    store_parquet,
    store_text,
    wishlist_signals,
)


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def _write_lines(path, objs):
    path = _local(path)
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.json"), "w") as f:
        for o in objs:
            f.write(json.dumps(o) + "\n")


def test_json_signals_with_declared_schema(spark):
    p = scratch_path(spark, "purch")
    w = scratch_path(spark, "wish")
    _write_lines(p, [
        {"row_id": 1, "movie_id": "m1", "movie_name": "Alien", "user_id": "u1", "purchase_price": 5},
        {"row_id": 2, "movie_id": "m2", "movie_name": "Heat", "user_id": "u2"},
    ])
    _write_lines(w, [{"row_id": 3, "movie_id": "m1", "movie_name": "Alien", "user_id": "u2", "extra": 1}])
    purchases = load_purchases(spark, p)
    assert purchases.schema == PURCHASE_SCHEMA
    sig = purchase_signals(purchases).unionByName(wishlist_signals(load_wishlists(spark, w)))
    assert sorted(tuple(r) for r in sig.collect()) == [
        ("u1", "Alien", 1.0), ("u2", "Alien", 0.5), ("u2", "Heat", 1.0)
    ]


def test_inventory_genres_explode_and_stock(spark):
    p = scratch_path(spark, "inv")
    _write_lines(p, [
        {"genres": ["Drama"], "movie_title": "A", "stock": 3},
        {"genres": ["Comedy", "Drama"], "movie_title": "B", "stock": 0},
        {"genres": ["Comedy"], "movie_title": "A", "stock": 1},
    ])
    inv = load_inventory(spark, p)
    md = sorted(tuple(r) for r in inventory_metadata(inv).collect())
    assert md == [("A", "Comedy"), ("A", "Drama"), ("B", "Comedy"), ("B", "Drama")]
    assert sorted(r["item"] for r in inventory_in_stock(inv).collect()) == ["A"]


def test_text_and_parquet_sinks_overwrite(spark):
    df = spark.createDataFrame(
        [("a", "b", 0.1, None, 1), ("a", "c", 1.0 / 3.0, 2.5, 2)],
        "item_A string, item_B string, weight double, raw_weight double, rank int",
    )
    t = scratch_path(spark, "txt")
    store_text(df, t)
    store_text(df.where("rank = 1"), t)
    back = load_text(spark, t, df.schema)
    assert [tuple(r) for r in back.collect()] == [("a", "b", 0.1, None, 1)]
    line = spark.read.text(t).collect()[0][0]
    assert line.split("\t")[:3] == ["a", "b", "0.1"]
    q = scratch_path(spark, "pq")
    store_parquet(df, q)
    store_parquet(df, q)
    assert sorted(tuple(r) for r in spark.read.parquet(q).collect()) == sorted(tuple(r) for r in df.collect())


TITLES = [" a ", "", None, "tab\there", "line\nend\r", 'say "x"', "back\\slash \\N \\t", "\\N", "ü", "\t", "1,2"]


def test_text_store_keeps_every_string(spark):
    rows = [(t, u, 0.1 * i, None if i % 2 else i) for i, t in enumerate(TITLES) for u in (t, "x")]
    df = spark.createDataFrame(rows, "a string, b string, w double, n int")
    path = scratch_path(spark, "txt")
    store_text(df, path)
    back = load_text(spark, path, df.schema)
    assert sorted(map(repr, map(tuple, back.collect()))) == sorted(map(repr, rows))
    assert len(spark.read.text(path).collect()) == len(rows)


def test_bad_lines_are_errors(spark):
    path = scratch_path(spark, "txt")
    df = spark.createDataFrame([("a", "b")], "a string, b string")
    store_text(df, path)
    for schema in ("a string", "a string, n int"):
        with pytest.raises(Exception, match="expected 1 fields|is no int"):
            load_text(spark, path, spark.createDataFrame([], schema).schema).collect()
    p = scratch_path(spark, "bad")
    _write_lines(p, [{"row_id": 1, "movie_name": "A", "user_id": "u"}])
    with open(os.path.join(_local(p), "part-1.json"), "w") as f:
        f.write("{not json\n")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        load_purchases(spark, p).collect()


def test_job_keeps_awkward_titles_and_leaves_no_staged_tables(spark):
    from affinity.params import RecParams
    from affinity.plans.job import run_job
    from affinity.session import ensure_checkpoint_dir

    base = _local(ensure_checkpoint_dir(spark))
    p, w, out = (scratch_path(spark, n) for n in ("jp", "jw", "jout"))
    titles = [" a ", "tab\there", "line\nend", 'say "x"']
    buys = [(f"u{i}", t) for i in range(4) for t in titles[: 2 + i % 3]]
    _write_lines(p, [{"row_id": i, "movie_name": m, "user_id": u} for i, (u, m) in enumerate(buys)])
    _write_lines(w, [{"row_id": 99, "movie_name": titles[3], "user_id": "u3"}])
    before = set(os.listdir(base))
    paths = run_job(spark, p, w, out, RecParams(0.5, 0.0, 10, 1.0, 5, 5, 5))
    assert set(os.listdir(base)) - before == {os.path.basename(out)}
    schema = spark.createDataFrame([], "item_A string, item_B string, weight double, raw_weight double, rank int").schema
    got = load_text(spark, paths["item_item_recommendation"], schema).collect()
    assert {r["item_A"] for r in got} == set(titles) and len(got) == 12


def test_unset_shared_folder_is_an_error_on_a_cluster(spark):
    from types import SimpleNamespace

    from affinity.session import ensure_checkpoint_dir

    for master in ("local-cluster[2,1,1024]", "spark://host:7077", "yarn"):
        sc = SimpleNamespace(getCheckpointDir=lambda: None, master=master)
        fake = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d: d))
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            ensure_checkpoint_dir(fake)


def test_example_job_end_to_end(spark):
    from affinity.params import RecParams
    from affinity.plans.job import run_job

    p = scratch_path(spark, "jp")
    w = scratch_path(spark, "jw")
    buys = [("u1", "A"), ("u1", "B"), ("u2", "A"), ("u2", "B"), ("u2", "C"), ("u3", "B"), ("u3", "C")]
    _write_lines(p, [{"row_id": i, "movie_id": m, "movie_name": m, "user_id": u, "purchase_price": 3}
                     for i, (u, m) in enumerate(buys)])
    _write_lines(w, [{"row_id": 99, "movie_id": "C", "movie_name": "C", "user_id": "u1"}])
    params = RecParams(0.5, 0.1, 10, 1.0, 5, 5, 5)
    for fmt in ("text", "parquet"):
        out = scratch_path(spark, "jout")
        paths = run_job(spark, p, w, out, params, fmt=fmt)
        run_job(spark, p, w, out, params, fmt=fmt)  # overwrites
        if fmt == "text":
            lines = spark.read.text(paths["user_item_recommendation"]).collect()
            assert lines and all(len(r[0].split("\t")) == 7 for r in lines)
        else:
            ui = spark.read.parquet(paths["user_item_recommendation"])
            got = {(r["user"], r["item"]) for r in ui.collect()}
            assert ("u3", "A") in got and ("u1", "C") not in got


# ----------------------------------------------------------------------------- quarantine

GOOD = [{"row_id": 1, "movie_name": "A", "user_id": "u1"}, {"row_id": 2, "movie_name": "B", "user_id": "u2", "more": [1]}]
BAD = ["{not json", "[1, 2]", '"text"', "7", '{"row_id": "x"}', '{"row_id": 1', "null", "\x00"]


def _mixed(spark, bad, good=GOOD):
    path = scratch_path(spark, "mixed")
    os.makedirs(_local(path))
    with open(os.path.join(_local(path), "part-0.json"), "w") as f:
        f.write("\n\n  \n".join([*(json.dumps(r) for r in good), *bad]) + "\n")
    return path


def test_quarantine_stores_bad_lines_and_keeps_the_others(spark):
    from affinity.sources import Quarantine

    path, folder = _mixed(spark, BAD), scratch_path(spark, "quarantine")
    got = load_purchases(spark, path, Quarantine(folder, max_lines=8, max_share=0.8))
    want = load_purchases(spark, _mixed(spark, []))
    assert got.schema == want.schema and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    stored = spark.read.parquet(f"{folder}/purchases").collect()
    assert sorted(r["line"] for r in stored) == sorted(BAD)
    assert {os.path.basename(r["file"]) for r in stored} == {"part-0.json"}


@pytest.mark.parametrize("bounds", [{"max_lines": 7, "max_share": 1.0}, {"max_lines": 99, "max_share": 0.79}])
def test_too_many_bad_lines_end_the_read_and_are_stored(spark, bounds):
    from affinity.sources import Quarantine, TooManyBadLines

    folder = scratch_path(spark, "quarantine")
    with pytest.raises(TooManyBadLines, match="8 of 10 lines"):
        load_purchases(spark, _mixed(spark, BAD), Quarantine(folder, **bounds))
    assert spark.read.parquet(f"{folder}/purchases").count() == 8


def test_quarantine_of_clean_and_empty_sources_is_empty(spark):
    from affinity.sources import Quarantine

    for good in (GOOD, []):
        folder = scratch_path(spark, "quarantine")
        got = load_purchases(spark, _mixed(spark, [], good), Quarantine(folder, 0, 0.0))
        assert got.count() == len(good) and spark.read.parquet(f"{folder}/purchases").count() == 0


def test_job_with_quarantine_equals_the_job_on_clean_lines(spark):
    from affinity.params import RecParams
    from affinity.plans.job import run_job
    from affinity.sources import Quarantine

    buys = [{"row_id": i, "movie_name": m, "user_id": f"u{i % 5}"} for i, m in enumerate("ABCABDBCDACD")]
    clean, broken, none = _mixed(spark, [], buys), _mixed(spark, BAD[:2], buys), _mixed(spark, [], [])
    out = [scratch_path(spark, "jout") for _ in range(2)]
    p = RecParams(0.5, 0.0, 10, 1.0, 5, 5, 5)
    run_job(spark, clean, none, out[0], p)
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        run_job(spark, broken, none, out[1], p)
    paths = run_job(spark, broken, none, out[1], p, quarantine=Quarantine(scratch_path(spark, "q"), 5, 0.5))
    for name, path in paths.items():
        rows = [sorted(r[0] for r in spark.read.text(x).collect()) for x in (path, f"{out[0]}/{name}")]
        assert rows[0] == rows[1] and rows[0]
