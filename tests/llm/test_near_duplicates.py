"""MinHash near-duplicates and components against brute force."""

import random
import re
from collections import Counter, defaultdict

import pytest

from tidemark.llm import minhash
from tidemark.llm.common import table
from tidemark.llm.components import connected_components

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(docs):
    """doc_id -> (n_shingles, component)."""
    sets = [(i, shingles(t)) for i, t in docs]
    parent = {i: i for i, _ in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    places = defaultdict(list)
    for n, (_, s) in enumerate(sets):
        for g in s:
            places[g].append(n)
    both = Counter()
    for p in places.values():
        for a in range(len(p)):
            for b in range(a):
                both[p[b], p[a]] += 1
    for (a, b), n in both.items():
        if 100 * n >= 75 * (len(sets[a][1]) + len(sets[b][1]) - n):
            x, y = find(sets[a][0]), find(sets[b][0])
            parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets}


def check(spark, docs):
    got = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    want = brute(docs)
    assert len(got) == len(docs)
    for r in got:
        assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]], r
        assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_corpus(spark, sf):
    check(spark, [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").collect()])


@pytest.mark.parametrize("edits", [2, 5])
def test_a_large_group_of_near_copies(spark, edits, monkeypatch):
    """Copies of one text whose similarities lie around the threshold, in blocks that are smaller than the group."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rng = random.Random(edits)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    docs = []
    for i in range(120):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        docs.append((i, " ".join(w)))
    check(spark, docs)


def test_edges(spark):
    docs = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  two"), (6, "a b c d e"), (7, "A B c d e"), (8, "x " * 50_000), (9, "x " * 49_000), (10, "x")]
    check(spark, docs)


def test_repeated_and_null_ids_and_other_columns(spark):
    t = "the same five words stand here again and again"
    rows = [(1, t, 0, "k"), (1, t, 0, "k"), (2, t, 1, "k"), (None, t, 1, "k")]
    out = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, component_id int, key string")).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in out if r["doc_id"] is not None) == [(1, 1, True), (1, 1, True), (2, 1, False)]
    assert [(r["component_id"], r["kept"]) for r in out if r["doc_id"] is None] == [(None, True)]
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 360)] + [(400, 400), (None, 1)] + [(500, i) for i in range(501, 900)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_texts_that_are_compared_with_none_are_not_moved(spark):
    """Without broadcasts of ids, less is shuffled than the lone texts' bytes."""
    rng = random.Random(11)
    text = lambda: " ".join(f"{rng.getrandbits(40):x}" for _ in range(2_000))
    docs, near = [(i, text()) for i in range(300)], text()
    docs += [(1000 + i, f"{near} x{i}") for i in range(4)] + [(2000, f"{near[: len(near) // 2]} {text()}")]
    store, jvm = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._jvm
    none = spark.sparkContext._gateway.new_array(jvm.double, 0)

    def shuffled():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        stages = store.stageList(jvm.java.util.ArrayList(), False, False, none, jvm.java.util.ArrayList())
        return {(x.stageId(), x.attemptId()): x.shuffleWriteBytes() for x in (stages.apply(i) for i in range(stages.size()))}

    before, limit = shuffled(), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        check(spark, docs)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    moved = sum(n for stage, n in shuffled().items() if stage not in before)
    assert moved < 0.5 * sum(len(t) for _, t in docs), moved
