"""Candidate sets against a plain per-user computation."""

import random
from collections import Counter, defaultdict

import pytest

from turntable.operators import candidates, dimensions
from turntable.sources.tables import materialise

LISTEN = "user_name string, artist_name string, artist_msid string"
RELATION = "artist_name_0 string, artist_name_1 string, count long"


def as_set(df):
    return {tuple(row) for row in df.collect()}


def test_undirected_keeps_reciprocal_edges_of_other_counts(spark):
    relation = spark.createDataFrame([("A", "B", 5), ("B", "A", 7), ("B", "A", 5)], RELATION)
    assert as_set(candidates.undirected(relation)) == {("A", "B", 5), ("B", "A", 5), ("A", "B", 7), ("B", "A", 7)}
    assert candidates.undirected(relation).count() == 4


def test_undirected_with_missing_names_and_loops(spark):
    edges = [("A", None, 1), (None, "A", 1), (None, None, 2), (None, None, 2), ("B", "B", 3), ("B", "A", 4), ("A", "B", 4), ("A", "B", None)]
    both = candidates.undirected(spark.createDataFrame(edges, RELATION)).collect()
    assert sorted(map(tuple, both), key=str) == sorted({way for a, b, n in edges for way in ((a, b, n), (b, a, n))}, key=str)


def test_one_name_under_several_msids_takes_several_places(spark):
    plays = [("u", "A", "a1")] * 3 + [("u", "A", "a2")] * 2 + [("u", "B", "b")]
    top = candidates.top_artists(spark.createDataFrame(plays, LISTEN), 2)
    assert as_set(top.select("artist_name", "artist_msid", "count", "rank")) == {("A", "a1", 3, 1), ("A", "a2", 2, 2)}


def naive(plays, relation, recordings, users, requested, top_limit, similar_limit):
    """One user at a time, in plain Python."""
    edges = {(a, b, n) for a, b, n in relation} | {(b, a, n) for a, b, n in relation}
    top_set, similar_set, status = set(), set(), {}
    for name in requested:
        if name not in users:
            status[name] = candidates.UNKNOWN_USER
            continue
        counts = Counter((artist, msid) for user, artist, msid in plays if user == name)
        top = {a for (a, m), _ in sorted(counts.items(), key=lambda e: (-e[1], e[0]))[:top_limit]}
        if not top:
            status[name] = candidates.NO_LISTENS
            continue
        similar = defaultdict(list)
        for a, b, n in sorted(edges, key=lambda e: (-e[2], e[1])):
            if a in top and len(similar[a]) < similar_limit:
                similar[a].append(b)
        similar = {a: names for a, names in similar.items() if names}
        if not similar:
            status[name] = candidates.NO_SIMILAR_ARTISTS
            continue
        top_set |= {(users[name], r) for artist, r in recordings if artist in similar}
        net = {b for names in similar.values() for b in names} - top
        if not net:
            status[name] = candidates.SIMILAR_ARE_TOP
            continue
        found = {(users[name], r) for artist, r in recordings if artist in net}
        similar_set |= found
        status[name] = candidates.COMPLETE if found else candidates.NO_SIMILAR_RECORDINGS
    return top_set, similar_set, status


def set_based(spark, plays, relation, recordings, users, requested, top_limit, similar_limit):
    listens = spark.createDataFrame(plays, LISTEN)
    users_df = spark.createDataFrame(list(users.items()), "user_name string, user_id int")
    recordings_df = spark.createDataFrame(recordings, "artist_name string, recording_id int")
    requested_df = spark.createDataFrame([(name,) for name in requested], "user_name string")
    known = dimensions.user_ids(requested_df, users_df).select("user_name")
    top = materialise(candidates.top_artists(listens.join(known, "user_name", "left_semi"), top_limit))
    similar = materialise(candidates.similar_artists(spark.createDataFrame(relation, RELATION), similar_limit))
    with_relation = candidates.top_artists_with_relation(top, similar)
    net = candidates.net_similar_artists(top, similar)
    sets = []
    for artists in (with_relation, net):
        found = candidates.candidate_recordings(
            materialise(dimensions.with_user_id(artists, users_df)), recordings_df
        )
        rows = found.collect()
        assert len(rows) == len(set(rows))
        sets.append({tuple(row) for row in rows})
    status = candidates.user_status(requested_df, users_df, top, with_relation, net, recordings_df)
    return (*sets, dict(status.collect()))


def test_documented_cases(spark):
    plays = [
        *[("complete", "Alpha", "1")] * 2,
        ("single letter", "Z", "z"),
        ("no relation", "Lonely", "2"),
        ("similar are top", "Alpha", "1"),
        ("similar are top", "Beta", "3"),
        ("similar are top", "Gamma", "4"),
        ("no recordings", "Quiet", "5"),
        ('O\'Brien "X"', "Alpha", "1"),
    ]
    relation = [("Alpha", "Beta", 5), ("Beta", "Alpha", 7), ("Gamma", "Alpha", 2), ("Z", "Yon", 1), ("Quiet", "Silent", 1)]
    recordings = [("Alpha", 1), ("Alpha", 2), ("Beta", 3), ("Gamma", 4), ("Z", 5), ("Lonely", 6), ("Quiet", 7), ("A", 8), ("Yon", 9)]
    names = [*dict.fromkeys(play[0] for play in plays), "idle"]
    users = {name: i for i, name in enumerate(names, 10)}
    requested = [*names, "nobody"]
    top_set, similar_set, status = set_based(spark, plays, relation, recordings, users, requested, 20, 10)
    assert status == {
        "complete": "ok",
        "single letter": "ok",
        "no relation": "no_similar_artists",
        "similar are top": "similar_artists_are_top_artists",
        "no recordings": "no_similar_recordings",
        'O\'Brien "X"': "ok",
        "idle": "no_listens",
        "nobody": "unknown_user",
    }
    assert (top_set, similar_set, status) == naive(plays, relation, recordings, users, requested, 20, 10)
    of = {name: {r for user, r in top_set if user == users[name]} for name in names}
    assert of["single letter"] == {5} and of["no relation"] == set() and of["similar are top"] == {1, 2, 3, 4}
    assert not {r for user, r in similar_set if user == users["similar are top"]}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sets_equal_the_per_user_loop(spark, seed):
    rng = random.Random(seed)
    artists = [f"artist {i}" for i in range(15)]
    # Two thirds of the plays belong to one artist, a third to one user.
    plays = []
    for i in range(400):
        artist = artists[0] if rng.random() < 0.6 else rng.choice(artists)
        user = "hot" if i % 3 == 0 else f"u{rng.randrange(25)}"
        plays.append((user, artist, f"{artist}/{rng.randrange(2)}"))
    relation = [(*rng.sample(artists[:12], 2), rng.randrange(1, 6)) for _ in range(30)]
    recordings = [(rng.choice(artists), i) for i in range(1, 120)]
    users = {name: i for i, name in enumerate(["hot", *[f"u{i}" for i in range(24)], "idle"], 1)}
    requested = [*users, "u24", "nobody"]
    arguments = (plays, relation, recordings, users, requested, 4, 2)
    assert set_based(spark, *arguments) == naive(*arguments)


def test_report_lists_similar_artists_in_order(spark):
    top = spark.createDataFrame([("u", "A"), ("u", "A"), ("u", "C"), ("v", "B")], "user_name string, artist_name string")
    relation = spark.createDataFrame([("A", "B", 5), ("A", "D", 9), ("E", "A", 5), ("F", "A", 1)], RELATION)
    similar = candidates.similar_artists(relation, 3)
    report = {(r.user_name, r.artist_name): r.similar_artists for r in candidates.similar_artist_report(top, similar).collect()}
    assert report == {("u", "A"): ["D", "B", "E"], ("v", "B"): ["A"]}
    assert {r[0] for r in candidates.similar_artists_of(similar, "A").collect()} == {"D", "B", "E"}
