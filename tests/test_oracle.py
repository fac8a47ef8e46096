"""Every registered query against its DuckDB oracle at sf0.001 (the driver's gate, smaller)."""

import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    return v


def _rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF)
    got = df.collect()
    cur = duck.execute(E.oracle_sql()[key])
    cols = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert _rows(df.columns, got) == _rows(cols, cur.fetchall())


def test_every_key_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["artist_name", "title", "play_count", "index_number"]
    assert 0 < df.count() <= 20


def test_baseline_exact_match_equals_theme_top_tracks(spark):
    """With cutoff 1.0 the fuzzy step is exact equality, so the baseline
    collection must equal the plain top-N per theme over the expanded keywords."""
    from tunelake.operators import keywords as kw
    from tunelake.operators import lyrics as ly
    from tunelake.plans import catalog
    from tunelake.plans.themed import collection_baseline
    from tunelake.sources import testdata as td

    vocab = td.vocabulary(spark, SF)
    lyr, lex, syn = td.lyrics(spark, SF, vocab), td.lexicon(spark, SF, vocab), td.synsets(spark, SF, vocab)
    merged = catalog.merged(spark, SF)
    a = collection_baseline(lyr, vocab, lex, syn, merged, 20, cutoff=1.0)
    b = ly.top_tracks_per_theme(ly.theme_scores(lyr, kw.expand_theme_terms(lex, syn)), merged, 20)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert a.count() > 0
