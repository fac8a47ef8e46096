"""DuckDB twins of the adapter views (tunelake.sources.testdata), as CTEs.

Each registered query's oracle is ``WITH <needed adapters> SELECT ...`` over the
driver's pre-registered tables.
"""

from __future__ import annotations

ADAPTERS: dict[str, tuple[str, tuple[str, ...]]] = {
    "triplets": ("""
SELECT concat('U', CAST(o_custkey AS VARCHAR)) AS user_id,
       concat(CASE WHEN l_partkey % 7 = 0 THEN 'SOX' ELSE 'SO' END, CAST(l_partkey AS VARCHAR)) AS song_id,
       CAST(l_quantity AS BIGINT) AS play_count
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""", ()),
    "tracks": ("""
SELECT concat('TR', CAST(p_partkey AS VARCHAR)) AS track_id,
       concat(CASE WHEN p_partkey % 11 = 0 THEN 'SOY' ELSE 'SO' END, CAST(p_partkey AS VARCHAR)) AS song_id,
       p_brand AS artist_name, p_name AS title
FROM part
UNION ALL
SELECT concat('TRB', CAST(p_partkey AS VARCHAR)),
       concat(CASE WHEN p_partkey % 11 = 0 THEN 'SOY' ELSE 'SO' END, CAST(p_partkey AS VARCHAR)), p_brand, p_name
FROM part WHERE p_size % 5 = 0""", ()),
    "genres": ("""
SELECT concat(CASE WHEN p_size <= 40 THEN 'TR' ELSE 'TRX' END, CAST(p_partkey AS VARCHAR)) AS track_id,
       p_type AS majority_genre,
       CASE WHEN p_size % 3 = 0 THEN '' ELSE p_brand END AS minority_genre
FROM part""", ()),
    "song_plays": ("""
SELECT song_id, CAST(SUM(play_count) AS BIGINT) AS play_count FROM triplets GROUP BY song_id""", ("triplets",)),
    "merged": ("""
SELECT t.track_id, t.song_id, t.title, t.artist_name,
       COALESCE(g.majority_genre, '') AS majority_genre, COALESCE(g.minority_genre, '') AS minority_genre,
       COALESCE(p.play_count, 0) AS play_count
FROM tracks t LEFT JOIN song_plays p ON t.song_id = p.song_id LEFT JOIN genres g ON t.track_id = g.track_id""",
               ("tracks", "song_plays", "genres")),
    "tokens": ("""
SELECT doc_id, w FROM (SELECT doc_id, unnest(string_split_regex(lower(text), '[^\\p{L}]+')) AS w
                       FROM documents) q WHERE w <> ''""", ()),
    "vocabulary": ("""
SELECT w AS word, CAST(row_number() OVER (ORDER BY c DESC, w) AS BIGINT) AS word_id
FROM (SELECT w, count(*) AS c FROM tokens GROUP BY w) q""", ("tokens",)),
    "lyrics": ("""
SELECT concat('TR', CAST(t.doc_id AS VARCHAR)) AS track_id, t.doc_id AS mxm_track_id,
       v.word_id, v.word, count(*) AS cnt
FROM tokens t JOIN vocabulary v ON t.w = v.word GROUP BY t.doc_id, v.word_id, v.word""", ("tokens", "vocabulary")),
    "lexicon": ("""
SELECT CASE word_id % 100 WHEN 0 THEN 'love' WHEN 1 THEN 'war' WHEN 2 THEN 'happiness'
            WHEN 3 THEN 'loneliness' ELSE 'money' END AS theme, word AS term
FROM vocabulary WHERE word_id BETWEEN 101 AND 500 AND word_id % 100 < 5""", ("vocabulary",)),
    "synsets": ("""
SELECT word_id // 10 AS synset_id, word AS lemma FROM vocabulary
UNION ALL SELECT -1 - word_id // 7, word FROM vocabulary""", ("vocabulary",)),
    "theme_scores": ("""
SELECT x.theme, l.track_id, CAST(SUM(l.cnt) AS BIGINT) AS score
FROM lyrics l JOIN lexicon x ON l.word = x.term GROUP BY x.theme, l.track_id
HAVING SUM(l.cnt) <> 0""", ("lyrics", "lexicon")),
    "interactions": ("""
SELECT user_id, song_id, CAST(SUM(play_count) AS BIGINT) AS play_count
FROM triplets WHERE play_count > 0 GROUP BY user_id, song_id""", ("triplets",)),
    "tt": ("""
SELECT user_id, song_id, play_count,
       CASE WHEN substr(md5(concat('42:', user_id, '|', song_id)), 1, 8) < '33333333' THEN 1 ELSE 0 END AS is_test
FROM interactions""", ("interactions",)),
}


def with_adapters(body: str, *names: str) -> str:
    """``WITH`` the named adapters (and what they need, in order) + ``body``.

    A body starting with ``, name AS (...)`` adds its own CTEs after the adapters.
    """
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in ADAPTERS[n][1]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body.strip()
    ctes = ",\n".join(f"{n} AS ({ADAPTERS[n][0].strip()})" for n in order)
    return f"WITH {ctes}\n{body.strip()}"
