"""The registered queries as DuckDB SQL over the same tables."""

from __future__ import annotations

# ---- adapters

_EVENT_LISTENS = """
k AS (SELECT *, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INTEGER) AS k FROM events),
listens AS (
  SELECT event_id,
         CASE WHEN k % 20 = 0 THEN '' ELSE 'mb-' || CAST(k % 20 AS VARCHAR) END AS artist_mbids,
         'a-' || CAST(k % 20 AS VARCHAR) AS artist_msid,
         'artist_' || CAST(k % 20 AS VARCHAR) AS artist_name,
         ts AS listened_at,
         CASE event_type WHEN 'error' THEN NULL WHEN 'signup' THEN '' ELSE 'rm-' || CAST(k AS VARCHAR) END
           AS recording_mbid,
         'r-' || CAST(k AS VARCHAR) AS recording_msid,
         'relm-' || CAST(k % 40 AS VARCHAR) AS release_mbid,
         CASE WHEN k % 10 <> 0 THEN 'rel-' || CAST(k % 40 AS VARCHAR) END AS release_msid,
         'release_' || CAST(k % 40 AS VARCHAR) AS release_name,
         event_type AS tags,
         'track_' || CAST(k AS VARCHAR) AS track_name,
         'user_' || CAST(user_id AS VARCHAR) AS user_name
    FROM k
)"""


def _order_listens(msid: str = "'r-' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR)") -> str:
    return f"""
listens AS (
  SELECT '' AS artist_mbids, 'a-' || CAST(l_suppkey AS VARCHAR) AS artist_msid, s_name AS artist_name,
         o_orderdate AS listened_at, '' AS recording_mbid, {msid} AS recording_msid,
         '' AS release_mbid, p_brand AS release_msid, p_brand AS release_name, l_returnflag AS tags,
         p_name AS track_name, c_name AS user_name
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN part ON l_partkey = p_partkey
    JOIN supplier ON l_suppkey = s_suppkey
)"""


_ORDER_LISTENS = _order_listens()
_FAN_OUT_LISTENS = _order_listens("'r-' || CAST(l_partkey AS VARCHAR)")

_EVENT_RELATION = """
a AS (SELECT event_id, 'artist_' || CAST(CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INTEGER) % 20 AS VARCHAR)
        AS name FROM events),
relation AS (
  SELECT least(a.name, b.name) AS artist_name_0, greatest(a.name, b.name) AS artist_name_1, count(*) AS "count"
    FROM a JOIN a AS b ON b.event_id = a.event_id + 1
   WHERE a.name <> b.name
   GROUP BY 1, 2
)"""

_ORDER_RELATION = """
a AS (SELECT l_orderkey, l_linenumber, l_suppkey, s_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
edges AS (
  SELECT least(a.l_suppkey, b.l_suppkey) AS s0, greatest(a.l_suppkey, b.l_suppkey) AS s1, count(*) AS "count"
    FROM a JOIN a AS b ON b.l_orderkey = a.l_orderkey AND b.l_linenumber = a.l_linenumber + 1
   WHERE a.l_suppkey <> b.l_suppkey
   GROUP BY 1, 2
),
relation AS (
  SELECT x.s_name AS artist_name_0, y.s_name AS artist_name_1, "count"
    FROM edges JOIN supplier x ON s0 = x.s_suppkey JOIN supplier y ON s1 = y.s_suppkey
)"""

_TEXT_COLUMNS = """artist_mbids, artist_msid, artist_name,
       strftime(listened_at, '%Y-%m-%d %H:%M:%S') AS listened_at,
       recording_mbid, recording_msid, release_mbid, release_msid, release_name, tags, track_name, user_name"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(part.strip() for part in ctes) + "\n"


# ---- shared steps

_USERS = """
users AS (
  SELECT user_name, row_number() OVER (ORDER BY user_name NULLS FIRST) AS user_id
    FROM (SELECT DISTINCT user_name FROM listens)
)"""
_RECORDINGS = """
recordings AS (
  SELECT *, row_number() OVER (ORDER BY track_name NULLS FIRST, recording_msid NULLS FIRST, artist_name NULLS FIRST,
           artist_msid NULLS FIRST, release_name NULLS FIRST, release_msid NULLS FIRST) AS recording_id
    FROM (SELECT DISTINCT track_name, recording_msid, artist_name, artist_msid, release_name, release_msid FROM listens)
)"""
_PLAYCOUNTS = """
playcounts AS (
  SELECT user_id, recording_id, count(recording_id) AS "count"
    FROM listens JOIN users USING (user_name) JOIN recordings USING (recording_msid)
   GROUP BY user_id, recording_id
)"""
_MBID = """
subset AS (SELECT * FROM listens WHERE year(listened_at) = 2024 AND recording_mbid <> ''),
users AS (
  SELECT user_name, row_number() OVER (ORDER BY user_name) AS user_id FROM (SELECT DISTINCT user_name FROM subset)
),
recordings AS (
  SELECT recording_mbid, track_name, row_number() OVER (ORDER BY recording_mbid, track_name) AS recording_id
    FROM (SELECT DISTINCT recording_mbid, track_name FROM subset)
),
playcounts AS (
  SELECT count(s.recording_mbid) AS play_count, user_id, recording_id
    FROM subset s JOIN recordings r ON s.recording_mbid = r.recording_mbid JOIN users u ON s.user_name = u.user_name
   GROUP BY user_id, recording_id
)"""
_UNDIRECTED = """
undirected AS (
  SELECT artist_name_0 AS artist_name, artist_name_1 AS similar_artist_name, "count" FROM relation
   UNION
  SELECT artist_name_1, artist_name_0, "count" FROM relation
)"""


def _similar(limit: int) -> str:
    return (
        _UNDIRECTED
        + f""",
similar_artist AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY artist_name ORDER BY "count" DESC, similar_artist_name) AS rank
      FROM undirected) WHERE rank <= {limit}
)"""
    )


def _top(now: str | None, limit: int) -> str:
    where = f"WHERE listened_at >= TIMESTAMP '{now}' - INTERVAL 7 DAY AND listened_at < TIMESTAMP '{now}'" if now else ""
    return f"""
counts AS (
  SELECT user_name, artist_name, artist_msid, count(artist_msid) AS "count"
    FROM listens {where} GROUP BY ALL
),
top_artist AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY user_name ORDER BY "count" DESC, artist_name, artist_msid) AS rank
      FROM counts) WHERE rank <= {limit}
)"""


_REACHED = """
user_similar AS (
  SELECT DISTINCT t.user_name, t.artist_name, s.similar_artist_name
    FROM top_artist t JOIN similar_artist s ON t.artist_name = s.artist_name
),
with_relation AS (SELECT DISTINCT user_name, artist_name FROM user_similar),
net_similar AS (
  SELECT DISTINCT user_name, similar_artist_name AS artist_name FROM user_similar u
   WHERE NOT EXISTS (SELECT 1 FROM top_artist t
                      WHERE t.user_name = u.user_name AND t.artist_name = u.similar_artist_name)
)"""

_EVENT_CANDIDATES = (_EVENT_LISTENS, _EVENT_RELATION, _similar(3), _top("2024-01-31 00:00:00", 5), _REACHED)
_ORDER_CANDIDATES = (_ORDER_LISTENS, _ORDER_RELATION, _similar(10), _top("1998-06-15 00:00:00", 20), _REACHED)


def _recordings_of(artists: str) -> str:
    return f"""SELECT user_id, recording_id
  FROM {artists} JOIN users USING (user_name) JOIN recordings USING (artist_name)"""


_SPLIT = """
buckets AS (
  SELECT *, CAST('0x' || substr(md5(CAST(user_id AS VARCHAR) || '-' || CAST(recording_id AS VARCHAR) || '-45'), 1, 8)
           AS BIGINT) % 6 AS bucket
    FROM playcounts
),
parts AS (
  SELECT *, CASE WHEN bucket < 4 THEN 'training' WHEN bucket < 5 THEN 'validation' ELSE 'test' END AS split FROM buckets
)"""
# The candidates that a model of the training data can score; playlists take 30 of a set.
_PLAYLIST_AUDIT = (
    _with(*_EVENT_CANDIDATES, _USERS, _RECORDINGS, _PLAYCOUNTS, _SPLIT)
    + f"""SELECT user_id, "set", count(*) AS n_candidates, least(count(*), 30) AS n_listed,
       true AS ranks_complete, true AS scores_right, true AS none_better
  FROM (SELECT *, 'top_artist' AS "set" FROM ({_recordings_of("with_relation")})
        UNION ALL SELECT *, 'similar_artist' FROM ({_recordings_of("net_similar")}))
 WHERE user_id IN (SELECT user_id FROM parts WHERE split = 'training')
   AND recording_id IN (SELECT recording_id FROM parts WHERE split = 'training')
 GROUP BY 1, 2"""
)


def _kept(keys: list[str], number: str) -> str:
    """Keys of the listens up to a day numbered first, those that come later after them."""
    names = ", ".join(keys)
    return f"""SELECT {names}, row_number() OVER (ORDER BY first_day >= TIMESTAMP '1998-06-15', {names}) AS {number}
  FROM (SELECT {names}, min(listened_at) AS first_day FROM listens GROUP BY {names})"""


def _status(requested: str) -> str:
    return f"""SELECT user_name,
       CASE WHEN user_name NOT IN (SELECT user_name FROM users) THEN 'unknown_user'
            WHEN user_name NOT IN (SELECT user_name FROM top_artist) THEN 'no_listens'
            WHEN user_name NOT IN (SELECT user_name FROM with_relation) THEN 'no_similar_artists'
            WHEN user_name NOT IN (SELECT user_name FROM net_similar) THEN 'similar_artists_are_top_artists'
            WHEN user_name NOT IN (SELECT user_name FROM net_similar JOIN recordings USING (artist_name))
              THEN 'no_similar_recordings'
            ELSE 'ok' END AS status
  FROM (SELECT DISTINCT {requested} AS user_name FROM customer)"""


_REQUESTED = "'user_' || CAST(c_custkey - 1 AS VARCHAR)"


def _counts(entry: str, counted: str) -> str:
    return f"SELECT user_name, {entry}, count({counted}) AS listen_count FROM listens GROUP BY user_name, {entry}"


_ARTIST = "artist_name, artist_msid, artist_mbids"
_RELEASE = f"release_name, release_msid, release_mbid, {_ARTIST}"
_RECORDING = f"track_name, recording_msid, recording_mbid, {_ARTIST}, release_name, release_msid, release_mbid"


def _pages(counts: str, ties: str, entries: str, size: str, name: str, page_size: int) -> str:
    return f""",
counted AS ({counts}),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY user_name ORDER BY listen_count DESC, {ties}) AS position,
         count(*) OVER (PARTITION BY user_name) AS n
    FROM counted
)
SELECT user_name, (position - 1) // {page_size} AS page,
       string_agg({name} || '=' || CAST(listen_count AS VARCHAR), ',' ORDER BY position) AS {entries}, n AS {size}
  FROM placed GROUP BY user_name, (position - 1) // {page_size}, n"""


def _nulls_first(columns: str) -> str:
    return ", ".join(f"{name.strip()} NULLS FIRST" for name in columns.split(","))


_WINDOW_SQL = "listened_at >= TIMESTAMP '{start}' AND listened_at < TIMESTAMP '{end}'"
# 180 days before 1998-06-15 is in December 1997; months are taken whole.
_TRAINING_MONTHS = _WINDOW_SQL.format(start="1997-12-01 00:00:00", end="1998-07-01 00:00:00")

_FLAT_RAW = """
k AS (SELECT *, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INTEGER) AS k FROM events),
flat AS (
  SELECT CASE WHEN event_type = 'error' THEN '' ELSE 'mb-' || CAST(k % 20 AS VARCHAR) || ',x' END AS artist_mbids,
         'a-' || CAST(k % 20 AS VARCHAR) AS artist_msid, 'artist_' || CAST(k % 20 AS VARCHAR) AS artist_name,
         CAST(floor(epoch(ts)) AS BIGINT) AS listened_at, '' AS recording_mbid,
         'r-' || CAST(k AS VARCHAR) AS recording_msid, '' AS release_mbid, '' AS release_msid,
         CASE WHEN event_type IN ('view', 'error') THEN '' ELSE 'release_' || CAST(k % 40 AS VARCHAR) END AS release_name,
         CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS tags,
         'track_' || CAST(k AS VARCHAR) AS track_name, 'user_' || CAST(user_id AS VARCHAR) AS user_name
    FROM k
)"""

ORACLES: dict[str, str] = {
    "user_artists": _with(_EVENT_LISTENS) + _counts(_ARTIST, "artist_name"),
    "user_recordings": _with(_EVENT_LISTENS) + _counts(_RECORDING, "recording_msid"),
    "user_releases": _with(_EVENT_LISTENS) + _counts(_RELEASE, "release_msid"),
    "order_user_artists": _with(_ORDER_LISTENS) + _counts(_ARTIST, "artist_name"),
    "order_user_releases": _with(_ORDER_LISTENS) + _counts(_RELEASE, "release_msid"),
    "user_artist_summary": _with(_EVENT_LISTENS)
    + f"""SELECT user_name, count(*) AS artist_count, CAST(sum(listen_count) AS BIGINT) AS total_listens
  FROM ({_counts(_ARTIST, "artist_name")}) GROUP BY user_name""",
    "user_stats_all": _with(_EVENT_LISTENS)
    + _pages(
        _counts(_ARTIST, "artist_name"), _nulls_first(_ARTIST), "artist_stats", "artist_count", "artist_name", 10000
    ),
    "user_recording_pages": _with(_ORDER_LISTENS)
    + _pages(
        _counts(_RECORDING, "recording_msid"),
        _nulls_first(_RECORDING),
        "recording_stats",
        "recording_count",
        "recording_msid",
        10,
    ),
    "user_release_pages": _with(_EVENT_LISTENS)
    + _pages(
        _counts(_RELEASE, "release_msid"), _nulls_first(_RELEASE), "release_stats", "release_count", "release_name", 7
    ),
    "artist_popularity": _with(_EVENT_LISTENS)
    + """SELECT nullif(artist_mbids, '') AS artist_mbid, count(nullif(artist_mbids, '')) AS cnt
  FROM listens GROUP BY 1""",
    "artist_popularity_csv": _with(_EVENT_LISTENS)
    + """SELECT nullif(artist_mbids, '') AS artist_mbid, count(nullif(artist_mbids, '')) AS cnt
  FROM listens GROUP BY 1""",
    "artist_popularity_order": _with(_EVENT_LISTENS)
    + """SELECT *, row_number() OVER (ORDER BY cnt DESC, artist_mbid NULLS FIRST) AS position
  FROM (SELECT nullif(artist_mbids, '') AS artist_mbid, count(nullif(artist_mbids, '')) AS cnt FROM listens GROUP BY 1)""",
    "order_stats_from_months": _with(
        _ORDER_LISTENS.replace("JOIN supplier ON l_suppkey = s_suppkey", "JOIN supplier ON l_suppkey = s_suppkey"
                               " WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-07-01'")
    )
    + _pages(
        _counts(_ARTIST, "artist_name"), _nulls_first(_ARTIST), "artist_stats", "artist_count", "artist_name", 10000
    ),
    "month_range_scan": _with(_ORDER_LISTENS) + f"SELECT {_TEXT_COLUMNS} FROM listens WHERE {_TRAINING_MONTHS}",
    "month_table_scan": _with(_ORDER_LISTENS) + f"SELECT {_TEXT_COLUMNS} FROM listens WHERE {_TRAINING_MONTHS}",
    "recent_listens": _with(_EVENT_LISTENS)
    + f"SELECT {_TEXT_COLUMNS} FROM listens WHERE "
    + _WINDOW_SQL.format(start="2024-01-24 00:00:00", end="2024-01-31 00:00:00"),
    "year_nonblank_listens": _with(_EVENT_LISTENS)
    + f"SELECT {_TEXT_COLUMNS} FROM listens AS l WHERE year(l.listened_at) = 2024 AND recording_mbid <> ''",
    "listens_projection": _with(_EVENT_LISTENS)
    + """SELECT strftime(listened_at, '%Y-%m-%d %H:%M:%S') AS listened_at, track_name, recording_msid, user_name
  FROM listens""",
    "date_helpers": """
SELECT o_orderkey,
       strftime(date_trunc('month', o_orderdate) + INTERVAL 12 DAY, '%Y-%m-%d %H:%M:%S') AS day_13,
       strftime(o_orderdate - INTERVAL 3 MONTH, '%Y-%m-%d %H:%M:%S') AS months_back,
       strftime(o_orderdate + INTERVAL 3 MONTH, '%Y-%m-%d %H:%M:%S') AS months_ahead,
       strftime(o_orderdate - INTERVAL 3 DAY, '%Y-%m-%d %H:%M:%S') AS days_back,
       strftime(o_orderdate + INTERVAL 3 DAY, '%Y-%m-%d %H:%M:%S') AS days_ahead
  FROM orders""",
    "flatten_raw_listens": _with(_FLAT_RAW) + "SELECT * FROM flat",
    "import_raw_listens": _with(_FLAT_RAW) + "SELECT * FROM flat",
    "sql_user_counts": _with(_EVENT_LISTENS)
    + "SELECT user_name, count(*) AS listens FROM listens WHERE artist_name <> 'artist_1' GROUP BY user_name",
    "users_dim": _with(_EVENT_LISTENS, _USERS) + "SELECT * FROM users",
    "recordings_dim": _with(_EVENT_LISTENS, _RECORDINGS) + "SELECT * FROM recordings",
    "order_users_dim": _with(_ORDER_LISTENS, _USERS) + "SELECT * FROM users",
    "order_recordings_dim": _with(_ORDER_LISTENS, _RECORDINGS) + "SELECT * FROM recordings",
    "user_id_lookup": _with(_EVENT_LISTENS, _USERS)
    + f"SELECT user_name, user_id FROM users WHERE user_name IN (SELECT {_REQUESTED} FROM customer)",
    "unknown_users": _with(_EVENT_LISTENS, _USERS)
    + f"""SELECT DISTINCT {_REQUESTED} AS user_name FROM customer
 WHERE {_REQUESTED} NOT IN (SELECT user_name FROM users)""",
    "playcounts": _with(_EVENT_LISTENS, _USERS, _RECORDINGS, _PLAYCOUNTS) + "SELECT * FROM playcounts",
    "order_playcounts": _with(_ORDER_LISTENS, _USERS, _RECORDINGS, _PLAYCOUNTS) + "SELECT * FROM playcounts",
    "order_playcounts_fan_out": _with(_FAN_OUT_LISTENS, _USERS, _RECORDINGS, _PLAYCOUNTS)
    + """SELECT user_id, count(*) AS recordings, CAST(sum("count") AS BIGINT) AS listens, max(recording_id) AS last_id
  FROM playcounts GROUP BY user_id""",
    "mbid_recording_ids": _with(_EVENT_LISTENS, _MBID) + "SELECT * FROM recordings",
    "mbid_playcounts": _with(_EVENT_LISTENS, _MBID) + "SELECT * FROM playcounts",
    "mbid_playcount_audit": _with(_EVENT_LISTENS, _MBID)
    + """SELECT play_count, user_name, user_id, recording_id, track_name
  FROM playcounts JOIN users USING (user_id) JOIN recordings USING (recording_id)""",
    "mbid_playcounts_order": _with(_EVENT_LISTENS, _MBID)
    + "SELECT *, row_number() OVER (ORDER BY user_id, play_count DESC, recording_id) AS position FROM playcounts",
    "mbid_playcount_audit_order": _with(_EVENT_LISTENS, _MBID)
    + """SELECT play_count, user_name, user_id, recording_id, track_name,
       row_number() OVER (ORDER BY play_count DESC, user_id, recording_id) AS position
  FROM playcounts JOIN users USING (user_id) JOIN recordings USING (recording_id)""",
    "mbid_playcount_audit_of_user": _with(_EVENT_LISTENS, _MBID)
    + """SELECT play_count, user_name, user_id, recording_id, track_name
  FROM playcounts JOIN users USING (user_id) JOIN recordings USING (recording_id) WHERE user_name = 'user_1'""",
    "order_users_kept_ids": _with(_ORDER_LISTENS) + _kept(["user_name"], "user_id"),
    "order_recordings_kept_ids": _with(_ORDER_LISTENS)
    + _kept(["track_name", "recording_msid", "artist_name", "artist_msid", "release_name", "release_msid"], "recording_id"),
    "table_counts": _with(_EVENT_LISTENS, _USERS, _RECORDINGS, _PLAYCOUNTS)
    + """SELECT 'listens' AS table_name, count(*) AS row_count FROM listens
UNION ALL SELECT 'users', count(*) FROM users
UNION ALL SELECT 'recordings', count(*) FROM recordings
UNION ALL SELECT 'playcounts', count(*) FROM playcounts""",
    "undirected_relations": _with(_EVENT_RELATION, _UNDIRECTED) + "SELECT * FROM undirected",
    "order_undirected_relations": _with(_ORDER_RELATION, _UNDIRECTED) + "SELECT * FROM undirected",
    "similar_artists": _with(_EVENT_RELATION, _similar(3)) + "SELECT * FROM similar_artist",
    "order_similar_artists": _with(_ORDER_RELATION, _similar(10)) + "SELECT * FROM similar_artist",
    "top_artists": _with(*_EVENT_CANDIDATES) + "SELECT * FROM top_artist",
    "order_top_artists": _with(_ORDER_LISTENS, _top(None, 20)) + "SELECT * FROM top_artist",
    "top_artists_with_relation": _with(*_EVENT_CANDIDATES) + "SELECT * FROM with_relation",
    "net_similar_artists": _with(*_EVENT_CANDIDATES) + "SELECT * FROM net_similar",
    "similar_artist_report": _with(*_EVENT_CANDIDATES)
    + """SELECT user_name, artist_name, string_agg(similar_artist_name, ',' ORDER BY rank) AS similar_artists
  FROM (SELECT DISTINCT user_name, artist_name FROM top_artist) JOIN similar_artist USING (artist_name)
 GROUP BY user_name, artist_name""",
    "top_artist_candidates": _with(*_EVENT_CANDIDATES, _USERS, _RECORDINGS) + _recordings_of("with_relation"),
    "similar_artist_candidates": _with(*_EVENT_CANDIDATES, _USERS, _RECORDINGS) + _recordings_of("net_similar"),
    "candidate_sets": _with(*_EVENT_CANDIDATES, _USERS, _RECORDINGS)
    + f"""SELECT *, 'top_artist' AS "set" FROM ({_recordings_of("with_relation")})
UNION ALL SELECT *, 'similar_artist' FROM ({_recordings_of("net_similar")})""",
    "order_top_artist_candidates": _with(*_ORDER_CANDIDATES, _USERS, _RECORDINGS) + _recordings_of("with_relation"),
    "order_similar_artist_candidates": _with(*_ORDER_CANDIDATES, _USERS, _RECORDINGS) + _recordings_of("net_similar"),
    "user_status": _with(*_EVENT_CANDIDATES, _USERS, _RECORDINGS) + _status(_REQUESTED),
    "order_user_status": _with(*_ORDER_CANDIDATES, _USERS, _RECORDINGS) + _status("c_name"),
    "hash_split_counts": _with(_EVENT_LISTENS, _USERS, _RECORDINGS, _PLAYCOUNTS, _SPLIT)
    + """SELECT split, count(*) AS row_count, CAST(sum("count") AS BIGINT) AS listens FROM parts GROUP BY split""",
    "als_normal_equations": _with(_EVENT_LISTENS, _USERS, _RECORDINGS, _PLAYCOUNTS, _SPLIT)
    + "SELECT user_id, count(*) AS n_ratings, true AS satisfied FROM parts WHERE split = 'training' GROUP BY user_id",
    "als_grid_audit": _with(_EVENT_LISTENS, _USERS, _RECORDINGS, _PLAYCOUNTS, _SPLIT)
    + """SELECT CAST(rank AS BIGINT) AS rank, CAST(lmbda AS DOUBLE) AS lmbda, CAST(num_iterations AS BIGINT) AS num_iterations,
       count(*) AS n_validation,
       count(*) FILTER (user_id IN (SELECT user_id FROM parts WHERE split = 'training')
                        AND recording_id IN (SELECT recording_id FROM parts WHERE split = 'training')) AS n_scored,
       true AS consistent
  FROM parts, (VALUES (8), (12)) r(rank), (VALUES (0.1), (10.0)) l(lmbda), (VALUES (10), (20)) i(num_iterations)
 WHERE split = 'validation' GROUP BY 1, 2, 3""",
    "als_recommendations_audit": _PLAYLIST_AUDIT,
    "als_artist_recommendations_audit": _PLAYLIST_AUDIT,
    "dispatch_results": _with(_EVENT_LISTENS)
    + """SELECT event_id AS request_id,
       CASE event_type WHEN 'view' THEN 'ok' WHEN 'purchase' THEN 'ok' WHEN 'signup' THEN 'failed'
                       WHEN 'click' THEN 'unknown_query' ELSE 'bad_request' END AS status,
       CASE event_type WHEN 'view' THEN (SELECT count(DISTINCT user_name) FROM listens)
                       WHEN 'purchase' THEN coalesce(artists, 0)
                       ELSE 0 END AS result_rows
  FROM events LEFT JOIN (SELECT user_name, count(DISTINCT artist_msid) AS artists FROM listens GROUP BY user_name)
    ON user_name = 'user_' || CAST(user_id AS VARCHAR)""",
    "published_user_stats": _with(_EVENT_LISTENS)
    + f""",
counted AS ({_counts(_ARTIST, "artist_name")})
SELECT user_name, count(*) AS artist_count,
       string_agg(artist_name || '=' || CAST(listen_count AS VARCHAR), ',' ORDER BY listen_count DESC, artist_name)
         AS artist_stats
  FROM counted GROUP BY user_name""",
    "dispatch_stream": """
SELECT CASE event_type WHEN 'view' THEN 'ok' WHEN 'purchase' THEN 'ok' WHEN 'signup' THEN 'failed'
                       WHEN 'click' THEN 'unknown_query' ELSE 'bad_request' END AS status,
       CASE event_type WHEN 'view' THEN 'stats.user.all' WHEN 'purchase' THEN 'stats.user.artists'
                       WHEN 'signup' THEN 'stats.user.all' WHEN 'click' THEN 'stats.unknown' ELSE '' END AS query,
       count(*) AS requests
  FROM events GROUP BY 1, 2""",
}
