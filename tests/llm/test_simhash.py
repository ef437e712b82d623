"""SimHash near duplicates: fingerprints and components against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from rillflow.llm import simhash as S
from rillflow.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text, shingle=3):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(text)
    parts = [" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots_of(points, reach):
    """Smallest point reachable, by comparing all pairs."""
    points = sorted(set(points))
    root = {p: p for p in points}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    arr = np.array(points, np.uint64)
    for i, p in enumerate(points):
        for j in np.flatnonzero(np.bitwise_count(arr[:i] ^ arr[i]) <= reach):
            a, b = find(points[j]), find(p)
            root[max(a, b)] = min(a, b)
    return {p: find(p) for p in points}


def brute(rows, reach=2):
    fp = [fingerprint(t) for _, t in rows]
    root = roots_of(fp, reach)
    least = {}
    for (d, _), f in zip(rows, fp):
        if d is not None:
            least[root[f]] = min(d, least.get(root[f], d))
    return sorted(((d, f"{f:016x}", least.get(root[f])) for (d, _), f in zip(rows, fp)), key=repr)


def got(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=repr)


TEXTS = [None, "", " \n", "One", "one two", "ONE two three", "one two three four É é", "a b c " * 4000, "a\x0bb\x0cc\rd",
         "Ärger und Öl \xa0 x", "one  two\nthree"]


def test_fingerprints():
    out = S.fingerprints_of(pa.array(TEXTS), 3)
    assert [int(x) for x in out] == [fingerprint(t) for t in TEXTS]


def test_odd_rows(spark, make_docs):
    rows = list(enumerate(TEXTS)) + [(None, "one two"), (None, "no id here at all"), (3, "One"), (40, "one")]
    docs = make_docs(rows, ["1 AS fp", "'x' AS component_id"])
    assert got(S.near_duplicates(docs)) == brute(rows)
    assert got(S.near_duplicates(docs.filter("false"))) == []
    kept = S.simhash_stage(spark, docs, "")
    assert kept.columns == docs.columns
    want = brute(rows)
    n_without_id = len({f for d, f, c in want if c is None})
    assert kept.count() == len({c for _, _, c in want if c is not None}) + n_without_id
    assert sorted(r.doc_id for r in kept.filter("doc_id IS NOT NULL").collect()) == sorted(
        {c for _, _, c in want if c is not None})


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert got(S.op4_simhash(spark, sf)) == brute(rows)


def cloud(seed, n, centres):
    """Random points, and around some centres many points a few bits away."""
    r = random.Random(seed)
    pts = {r.getrandbits(64) for _ in range(n)}
    for _ in range(centres):
        c = r.getrandbits(64)
        for _ in range(n // centres):
            x = c
            for _ in range(r.randrange(7)):
                x ^= 1 << r.randrange(64)
            pts.add(x)
    return np.array(sorted(pts), np.uint64)


@pytest.mark.parametrize("block", [64, 16_384])
def test_links_of_dense_and_sparse_points(spark, monkeypatch, block):
    monkeypatch.setattr(S, "LEAF", 100)  # many leaves
    monkeypatch.setattr(S, "BLOCK", block)  # and, with the small one, many blocks in a leaf
    pts = cloud(5, 1500, 3)
    df = spark.createDataFrame([(int(x),) for x in pts.view(np.int64)], "fp bigint").repartition(3)
    found = S.links(df, 2).collect()
    pairs = [(r.a, r.b) for r in found]
    mine = components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()
    group = {r.node: r.root for r in mine}
    want = roots_of([int(x) for x in pts], 2)
    by_mine, by_want = {}, {}
    for x, s in zip(pts, pts.view(np.int64)):
        by_mine.setdefault(group.get(int(s), int(s)), set()).add(int(x))
        by_want.setdefault(want[int(x)], set()).add(int(x))
    assert sorted(map(sorted, by_mine.values())) == sorted(map(sorted, by_want.values()))


def test_every_near_pair_meets_in_a_home_leaf():
    pts = cloud(9, 3000, 4)
    nodes = S.fit_tree(pts[::3], 40 * S.LEAF, 2)
    homes, seen = {}, {}
    for leaf, at, home in S.send(pts, nodes, 2):
        for i, h in zip(at, home):
            seen.setdefault(i, set()).add(leaf)
            if h:
                assert i not in homes
                homes[i] = leaf
    assert len(homes) == len(pts)
    for i in range(len(pts)):
        for j in np.flatnonzero(np.bitwise_count(pts[:i] ^ pts[i]) <= 2):
            assert homes[j] in seen[i] or homes[i] in seen[j]


def test_components_of_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 500)]
    df = spark.createDataFrame(path + star + [(5, 5)] + path[:10], "a bigint, b bigint")
    got = {r.node: r.root for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, **{1000 + i: 1000 for i in range(1, 500)}}
    assert components(df.filter("false")).count() == 0


def test_stage_keeps_one_document_of_each_component(spark, make_docs):
    """Ids that repeat over unrelated texts lose nothing, and dealing the rows anew changes nothing."""
    a, b, c, d = ("alpha beta gamma delta one two", "winter came early to the hills that year", "a third text about rivers and stones here", "numbers and letters meet in the fourth one")
    rows = [(1, a), (1, b), (1, c), (2, d), (3, b), (None, a), (None, "only without an id " * 3), (1, c)]
    docs = make_docs(rows, ["'x' AS __sim_id", "2 AS OF_TEXT", "3 AS Root", "4 AS fp"])
    want = sorted([(1, a), (1, b), (1, c), (2, d), (None, "only without an id " * 3)], key=repr)
    for given in (docs, docs.repartition(7), docs.orderBy("text")):
        out = S.simhash_stage(spark, given, "")
        assert out.columns == docs.columns
        kept = out.collect()
        assert sorted(((r.doc_id, r.text) for r in kept), key=repr) == want
        assert {(r["__sim_id"], r["OF_TEXT"], r["Root"], r["fp"]) for r in kept} == {("x", 2, 3, 4)}
