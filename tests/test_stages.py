"""Life of scratch folders: kept while a held result reads them, gone when it is stored."""

from __future__ import annotations

import os

import pytest

from conftest import SF_SMALL

import __spark_entry__ as E
from affinity.params import PARAMS_T
from affinity.plans import pipelines
from affinity.session import ensure_checkpoint_dir, store_result, temporary_stages, write_stage
from affinity.sources import signals_tpch


def folders(spark) -> set[str]:
    base = ensure_checkpoint_dir(spark).removeprefix("file://").removeprefix("file:")
    return set(os.listdir(base))


@pytest.mark.parametrize(
    "key",
    ["json_signals", "text_sink_roundtrip", "bayes_links", "diversified_links", "available_recs_mapped_lists", "item_item_recs_in_stock", "user_item_recs", "remove_bots"],
)
def test_nothing_is_left_when_a_query_is_stored(spark, key):
    before = folders(spark)
    want = sorted(map(repr, map(tuple, E.queries()[key](spark, SF_SMALL).collect())))
    left = folders(spark)
    assert left > before
    got = store_result(spark, lambda: E.queries()[key](spark, SF_SMALL), lambda df: df.collect())
    assert sorted(map(repr, map(tuple, got))) == want
    assert folders(spark) == left


def test_tables_that_led_to_the_results_go_before_they_are_stored(spark):
    with temporary_stages(spark) as scope:
        item_recs, user_recs = pipelines.recommend(signals_tpch(spark, SF_SMALL), PARAMS_T)
        kinds = lambda: sorted(p.rpartition("/")[2].rpartition("-")[0] for p in scope.paths)
        assert kinds() == ["item_popularity", "item_recs", "nhood_graph", "user_items"]
        scope.hold(item_recs)
        scope.hold(user_recs)
        scope.trim()
        assert kinds() == ["item_recs", "user_items"]
        n_users = user_recs.count()
        scope.release(user_recs)
        assert kinds() == ["item_recs"] and n_users > 0
        assert item_recs.count() > 0
        scope.release(item_recs)
        assert kinds() == [] and not {f for f in folders(spark) if f.startswith("item_recs")} & set(kinds())


def test_a_table_that_two_results_read_stays_for_the_second(spark):
    before = folders(spark)
    with temporary_stages(spark) as scope:
        a = write_stage(spark.range(10), "a")
        one, two = scope.hold(a.where("id < 5")), scope.hold(a.join(write_stage(spark.range(3), "b"), "id"))
        scope.release(one)
        assert len(scope.paths) == 2 and two.count() == 3
        scope.release(two)
        assert scope.paths == []
    assert folders(spark) == before


def test_a_failed_block_leaves_nothing(spark):
    before = folders(spark)
    with pytest.raises(RuntimeError):
        with temporary_stages(spark):
            write_stage(spark.range(10), "a")
            raise RuntimeError
    assert folders(spark) == before
