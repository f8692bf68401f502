"""Components against brute force over all pairs; signature quality; odd rows."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from qalake.llm import minhash
from qalake.llm.common import connected_components
from qalake.llm.minhash import keep_one, near_duplicates, shingle_sets, super_min_hash

from .data import documents, odd_documents, words

SPACE = "[^\x20\x09-\x0d]+"


def shingles(text, k):
    w = re.findall(SPACE, re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return frozenset([tuple(w)] if 0 < len(w) < k else [tuple(w[i:i + k]) for i in range(len(w) - k + 1)])


def brute(docs, k):
    sets = {}
    for i, t in docs:
        sets.setdefault(i, []).append(shingles(t, k))
    ids = sorted(sets)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and any(s and 100 * len(s & t) >= 80 * len(s | t) for s in sets[a] for t in sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("k", [2, 5])
def test_against_brute_force(spark, k):
    rows = odd_documents()
    rng = random.Random(8)
    base = words(rng, 200).split(" ")
    for n in range(60):  # a large group of near copies and a chain whose ends are far apart
        w = list(base)
        for j in range(n % 9):
            w[rng.randrange(len(w))] = f"w{j}"
        rows.append((1000 + n, " ".join(w), "en", "s", 0, 1.0, 7, "z"))
    for n in range(12):
        w = list(base)
        w[:6 * n] = [f"c{j}" for j in range(6 * n)]
        rows.append((2000 + n, " ".join(w), "en", "s", 0, 1.0, 7, "z"))
    docs = [(r[0], r[1]) for r in rows if r[0] is not None]
    want = brute(docs, k)
    got = near_duplicates(documents(spark, rows), words=k).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert r["component_id"] == want[r["doc_id"]] and r["kept"] == (r["doc_id"] == r["component_id"])
    sizes = {r["doc_id"]: r["n_shingles"] for r in got}
    assert all(sizes[i] == len(shingles(t, k)) for i, t in docs)
    kept = sorted(r["doc_id"] for r in keep_one(documents(spark, rows), words=k).where("doc_id is not null").collect())
    assert kept == sorted(i for i, _ in docs if want[i] == i)
    assert keep_one(documents(spark, rows), words=k).columns == documents(spark, []).columns


def test_signatures_estimate_similarity():
    rng = random.Random(1)
    texts, sims = [], []
    for _ in range(150):
        w = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([8, 40, 400]))]
        v = [x if rng.random() < 0.9 else f"v{rng.randrange(10**6)}" for x in w]
        texts += [" ".join(w), " ".join(v)]
        a, b = shingles(texts[-2], 1), shingles(texts[-1], 1)
        sims.append(len(a & b) / len(a | b))
    h, off = shingle_sets(pa.array(texts), 1)
    s = super_min_hash(h, off, 96)
    err = (s[::2] == s[1::2]).mean(1) - np.array(sims)
    assert abs(err.mean()) < 0.01 and np.sqrt((err ** 2).mean()) < 0.05  # plain MinHash: about 0.04


def test_signature_equals_the_element_by_element_form():
    from qalake.llm.common import U64, mix64
    h, off = shingle_sets(pa.array(["a b c d e f", "q", "", "the cat sat on the mat and ran off"]), 1)
    got = super_min_hash(h, off, 16)
    for r in range(4):
        best = [np.iinfo(np.int64).max] * 16
        for x in h[off[r]:off[r + 1]]:
            perm = list(range(16))
            for j in range(16):
                d = int(mix64(np.array([(int(x) + (j + 1) * 0x9E3779B97F4A7C15) % (1 << 64)], U64))[0])
                k = j + (d & 0xFFFF) % (16 - j)
                perm[j], perm[k] = perm[k], perm[j]
                best[perm[j]] = min(best[perm[j]], (j << 47) | (d >> 17))
        assert got[r].tolist() == best


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, 9), (9, 7), (1, 50), (60, 50)] + [(3, k) for k in range(200, 260)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    want = {i: 100 for i in range(100, 161)} | {5: 5, 9: 5, 7: 5, 1: 1, 50: 1, 60: 1, 3: 3} | {k: 3 for k in range(200, 260)}
    assert got == want
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_empty_table(spark):
    assert near_duplicates(documents(spark, [])).count() == 0
    assert keep_one(documents(spark, [])).count() == 0


def test_one_id_on_different_texts_joins_their_groups(spark):
    rng = random.Random(2)
    one, two, three = (words(rng, 60) for _ in range(3))
    rows = [(3, one), (4, two), (5, one), (5, two), (5, three), (9, three), (7, words(rng, 60)), (None, one), (None, two)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=2).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got if r["doc_id"] is not None) == [
        (3, 3), (4, 3), (5, 3), (5, 3), (5, 3), (7, 7), (9, 3)]
    assert all(r["component_id"] is None for r in got if r["doc_id"] is None)


def edited_copies(n=2000, length=120, seed=12):
    """Copies of one text whose similarities to it run from about 0.7 to 0.85 (two-word shingles)."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(length)]
    out = []
    for i in range(n):
        w = list(base)
        for at in rng.sample(range(length), rng.randint(4, 11)):
            w[at] = f"e{rng.randrange(6)}"
        out.append((i, " ".join(w)))
    return out


@pytest.mark.parametrize("chunk", [minhash.CHUNK, 100])
def test_a_large_group_around_the_similarity(spark, monkeypatch, chunk):
    rows = edited_copies()
    sets = [shingles(t, 2) for _, t in rows]
    h, off = shingle_sets(pa.array([t for _, t in rows]), 2)
    same = minhash.shared_counts(np.repeat(np.arange(len(rows)), np.diff(off)), h, len(rows))
    assert all(same[i, i + 1] == len(sets[i] & sets[i + 1]) for i in range(0, 400, 7))
    size = np.diff(off)
    link = np.triu(100 * same >= 80 * (size[:, None] + size - same), 1)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in zip(*map(np.ndarray.tolist, np.nonzero(link))):
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    monkeypatch.setattr(minhash, "CHUNK", chunk)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(frame, words=2).collect()}
    assert got == {i: find(i) for i in range(len(rows))}
    assert 1 < len(set(got.values())) < len(rows)


def test_tiles_find_links_that_no_leader_has(spark):
    """Pairs of similar copies whose buckets' leaders are unlike both."""
    rng = random.Random(4)
    base = [f"b{i}" for i in range(100)]
    rows = []
    for i in range(60):
        w = list(base)
        for at in rng.sample(range(100), 14):
            w[at] = f"x{i}_{at}"
        v = list(w)
        v[rng.randrange(100)] = "once"
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(v))]
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=2).collect()}
    assert got == brute(rows, 2)


@pytest.mark.parametrize("chunk", [512, 40])
def test_tiles_leave_out_pairs_of_the_largest_component(spark, monkeypatch, chunk):
    """Every two members of different components meet once; the largest component's never among themselves."""
    monkeypatch.setattr(minhash, "CHUNK", chunk)
    part = {i: 0 if i < 900 else i // 3 for i in range(1000)}
    rows = [(7, i, p, 50) for i, p in part.items()] + [(8, i, 0, 50) for i in range(300)] + [(9, 1, 0, 50), (9, 2000, 2000, 50)]
    tiles = minhash._tiles(minhash._mixed(spark.createDataFrame(rows, "key long, cid long, part long, n long"))).collect()
    met = {}
    for t in tiles:
        met.setdefault((t["key"], t["i"], t["j"]), []).append(t)
    assert {k for k, _, _ in met} == {7, 9}  # a bucket of one component needs no tile
    pairs = [(a["cid"], b["cid"]) for (k, i, j), ts in met.items() if k == 7 for a in ts for b in ts
             if a["cid"] < b["cid"] and part[a["cid"]] != part[b["cid"]] and (i == j or a["chunk"] != b["chunk"])]
    assert len(pairs) == len(set(pairs)) == sum(part[a] != part[b] for a in part for b in range(a + 1, 1000))
    own, others = -(-900 // chunk), -(-100 // chunk)
    assert len([t for t in tiles if t["key"] == 7]) == 900 * others + 100 * (own + others)
