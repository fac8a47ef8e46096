"""Plan-shape guards: what the physical plans of the registered queries must
(and must not) contain, so a regression to a cross join, a global sort for a
top-N, or an unpruned scan is caught."""

import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
ML = {"als_fit", "recommend_user", "similar_songs", "train_theme_classifier",
      "classify_tracks", "collection_classifier", "word2vec_expand", "collection_word2vec", "embedding_expand"}


def plan(spark, key):
    return E.queries()[key](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(set(E.queries()) - ML))
def test_no_cross_products(spark, key):
    p = plan(spark, key)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


@pytest.mark.parametrize("key", ["top_tracks", "top_tracks_by_genre", "theme_top_tracks", "sample_n"])
def test_top_n_is_take_ordered(spark, key):
    assert "TakeOrderedAndProject" in plan(spark, key)


@pytest.mark.parametrize("key", ["top_tracks_per_genre", "top_tracks_per_theme", "weak_labels",
                                 "exclude_seen", "vector_topk"])
def test_per_group_top_n_has_partial_limit(spark, key):
    assert "WindowGroupLimit" in plan(spark, key) and "Partial" in plan(spark, key)


def test_pruned_scan_reads_only_needed_columns(spark):
    import re

    p = plan(spark, "scan_pruned")
    fields = re.search(r"ReadSchema: struct<([^>]*)>", p).group(1).split(",")
    assert sorted(f.split(":")[0] for f in fields) == ["majority_genre", "play_count", "title", "track_id"]


def test_python_udf_only_in_fuzzy_matching(spark):
    for key in sorted(set(E.queries()) - ML):
        p = plan(spark, key)
        if "EvalPython" in p:
            assert key in {"resolve_genre", "top_tracks_by_genre", "fuzzy_vocab_match", "collection_baseline"}, key
        assert "BatchEvalPython" not in p, key  # never row-at-a-time
