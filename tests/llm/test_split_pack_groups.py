"""Splitting, packing and grouping against brute force and exact round trips."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm import groups, packing, split
from quire.operators import skew

TEXTS = st.text(alphabet="ab. \n", max_size=600)


@given(TEXTS, st.integers(10, 80), st.integers(0, 4))
@settings(max_examples=200, deadline=None)
def test_pieces_cover_the_text_within_the_limit(text, limit, overlap):
    cuts = split.spans(text, limit, overlap)
    assert cuts[0][0] == 0 and cuts[-1][1] == len(text)
    for (a, z), (b, y) in zip(cuts, cuts[1:]):
        assert a < b <= z < y or (overlap == 0 and b == z)
        assert min(overlap, z - a - 1) <= z - b <= max(2 * overlap, 0)
    assert all(z - a <= limit for a, z in cuts)
    whole = "".join(text[max(a, cuts[i - 1][1] if i else 0) : z] for i, (a, z) in enumerate(cuts))
    assert whole == text


@given(st.lists(st.integers(0, 4), min_size=1, max_size=200), st.data())
@settings(max_examples=100, deadline=None)
def test_range_maximum_takes_the_rightmost(strength, data):
    s = np.array(strength, np.int8)
    lo = data.draw(st.integers(0, len(s) - 1))
    hi = data.draw(st.integers(lo, len(s) - 1))
    best = max(range(lo, hi + 1), key=lambda i: (s[i], i))
    assert split.StrongestCut(s).query(lo, hi) == best


def test_boundaries_are_preferred():
    text = "a" * 700 + ". " + "b" * 500 + "\n\n" + "c" * 200 + " d" * 400
    (_, end), *_ = split.spans(text)
    assert text[end - 2 : end] == "\n\n"
    assert split.spans("x" * 4000)[0] == (0, 1500)
    with pytest.raises(ValueError):
        split.spans("x", 100, 50)


def test_long_texts_need_small_tables(monkeypatch):
    rng = random.Random(2)
    text = "".join(rng.choice("ab. \n") for _ in range(20_000))
    whole = split.spans(text, 100, 10)
    monkeypatch.setattr(split, "STRETCH", 250)
    assert split.spans(text, 100, 10) == whole
    assert max(len(r) for r in split.StrongestCut(np.zeros(10_000, np.int8), 101).rows) == 10_000 and len(split.StrongestCut(np.zeros(10_000, np.int8), 101).rows) == 7


def test_pieces_of_one_key_with_two_texts(spark):
    df = spark.createDataFrame([("a", "word " * 400), ("a", "other " * 400), ("a", "short")], "id string, text string")
    rows = split.split_texts(df, ["id"], "text").collect()
    assert len({r.text_hash for r in rows}) == 3
    for h in {r.text_hash for r in rows}:
        assert sorted(r.piece_no for r in rows if r.text_hash == h) == list(range(next(r.n_pieces for r in rows if r.text_hash == h)))


def test_split_frame(spark):
    df = spark.createDataFrame([("a", "short", 1), ("b", "word " * 1000, 2), ("c", None, 3), ("d", "", 4), ("e", "ü" * 1500, 5), ("f", "ü" * 1501, 6)], "id string, text string, piece int")
    rows = split.split_texts(df, ["id"], "text").collect()
    n = {i: [r.n_pieces for r in rows if r.id == i] for i in "abcdef"}
    assert n["a"] == [1] and n["c"] == [] and n["d"] == [1] and n["e"] == [1] and n["f"] == [2, 2] and len(n["b"]) == n["b"][0] > 3
    assert split.split_texts(df.limit(0), ["id"], "text").count() == 0


def _best_fit(sizes, capacity):
    bins = []
    for x in sorted(sizes, reverse=True):
        fit = [r for r in bins if r >= x]
        if fit:
            bins.remove(min(fit))
            bins.append(min(fit) - x)
        else:
            bins.append(capacity - x)
    return len(bins)


@given(st.lists(st.integers(1, 64), max_size=200), st.integers(64, 100))
@settings(max_examples=100, deadline=None)
def test_packing_equals_plain_best_fit(sizes, capacity):
    bins, at = packing.best_fit_decreasing(np.array(sizes, np.int64), capacity)
    used = {}
    for b, a, s in sorted(zip(bins, at, sizes)):
        assert a == used.get(b, 0)
        used[b] = a + s
        assert used[b] <= capacity
    assert len(used) == _best_fit(sizes, capacity)


def test_pack_frame(spark):
    df = spark.createDataFrame([(1, 5000), (2, 0), (3, None), (4, 2048), (5, 96), (6, 900), (7, 900)], "doc_id long, n_tokens long")
    rows = packing.pack(df, "doc_id").collect()
    by = {d: sorted((r.part_no, r.n_tokens) for r in rows if r.doc_id == d) for d in range(1, 8)}
    assert by[1] == [(0, 2048), (1, 2048), (2, 904)] and by[4] == [(0, 2048)]
    assert all(r.sequence_id is None and r.n_tokens == 0 for r in rows if r.doc_id in (2, 3))
    room = {}
    for r in rows:
        if r.sequence_id:
            room[r.sequence_id] = room.get(r.sequence_id, 0) + r.n_tokens
    assert max(room.values()) <= 2048 and len(room) == 5
    assert packing.pack(df.limit(0), "doc_id").count() == 0
    named = packing.pack(df.selectExpr("concat('d', doc_id) as doc_id", "n_tokens"), "doc_id").collect()
    assert len(named) == len(rows)


def test_pack_in_shards(spark):
    df = spark.range(500).selectExpr("id as doc_id", "id % 300 + 1 as n_tokens")
    rows = packing.pack(df, "doc_id", shard_items=100).collect()
    assert len(rows) == 500 and len({r.sequence_id.split("-")[0] for r in rows}) == 5


def test_pack_of_books_and_repeated_keys(spark):
    # full parts never meet in a shard, and rows of one key stay apart
    df = spark.createDataFrame([(1, 2048 * 300 + 5), (1, 2048 * 300 + 5), (2, 4096), (3, 10)], "doc_id long, n_tokens long")
    rows = packing.pack(df, "doc_id", shard_items=2).collect()
    room = {}
    for r in rows:
        room[r.sequence_id] = room.get(r.sequence_id, 0) + r.n_tokens
    assert len(rows) == 605 and max(room.values()) <= 2048 and sum(v == 2048 for v in room.values()) == 602


def test_token_counts(spark):
    df = spark.createDataFrame([(1, "the bank"), (2, None), (3, ""), (4, "<|endoftext|>")], "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in packing.token_counts(df, "doc_id", "text").collect()}
    assert got[1] == 2 and got[2] == got[3] == 0 and got[4] > 1


def _components(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        ra, rb = find(a), find(b)
        root[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in root}


def test_groups_equal_union_find(spark):
    rng = random.Random(3)
    chain = [(f"c{i:03}", f"c{i + 1:03}") for i in range(60)]
    star = [("hub", f"s{i}") for i in range(40)]
    loose = [(f"r{rng.randrange(80)}", f"r{rng.randrange(80)}") for _ in range(50)]
    raw = chain + star + loose + [(b, a) for a, b in loose] + [("X ", " x"), (None, "a"), ("", "b"), (" Hub", "C000 ")]
    df = spark.createDataFrame(raw, "source_id string, target_id string")
    pairs = groups.matched_pairs(df, "source_id", "target_id")
    got = {r.node_id: r.group_id for r in groups.connected_groups(pairs).collect()}
    norm = lambda x: (x or "").strip().lower()
    want = _components([(norm(a), norm(b)) for a, b in raw if norm(a) and norm(b) and norm(a) != norm(b)])
    assert got == want


def test_groups_of_nothing(spark):
    df = spark.createDataFrame([("a", "a")], "source_id string, target_id string")
    assert groups.connected_groups(groups.matched_pairs(df, "source_id", "target_id")).count() == 0


def test_groups_with_hot_vertices_and_clusters(spark, monkeypatch):
    monkeypatch.setattr(skew, "FAIR_SHARE", 50)
    raw = [("hub", f"s{i:03}") for i in range(300)] + [(f"s{i:03}", f"t{i:03}") for i in range(300)] + [(f"u{i}", f"v{i}") for i in range(100)]
    pairs = groups.matched_pairs(spark.createDataFrame(raw, "source_id string, target_id string"), "source_id", "target_id")
    got = {r.node_id: r.group_id for r in groups.connected_groups(pairs).collect()}
    assert got == _components(raw)


def test_growth_takes_the_first_centre():
    # a path 0..9 with one early start at 0: all join it but the last, whose own start is before
    a, b = np.arange(9), np.arange(1, 10)
    at = np.zeros(10)
    at[0], at[9] = -20.0, -12.0
    got, centre = groups.grown(a, b, at, np.arange(10))
    assert centre.tolist() == [0] * 9 + [9] and got.tolist() == [-20.0 + i for i in range(9)] + [-12.0]


@pytest.mark.parametrize("block", [500_000, 1_500])
def test_groups_of_a_long_path(spark, monkeypatch, block):
    monkeypatch.setattr(groups, "BLOCK_EDGES", block)
    rng = random.Random(4)
    names = [f"n{i:05}" for i in range(5001)]
    rng.shuffle(names)
    raw = list(zip(names, names[1:])) + [("hub", f"s{i:04}") for i in range(1500)] + [("s0003", "other")]
    rng.shuffle(raw)
    pairs = groups.matched_pairs(spark.createDataFrame(raw, "source_id string, target_id string"), "source_id", "target_id")
    sizes = []
    out = groups.connected_groups(pairs, sizes)
    assert {r.node_id: r.group_id for r in out.collect()} == _components(raw)
    # clusters grow as far as the shifts let them: a level cuts half of RATE of the path
    assert sizes[0] == len(raw) and 0.25 * groups.RATE < sizes[1] / 5000 < groups.RATE and len(sizes) < 8
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange") < 30
