"""Targets against the step-by-step resharing; the mix against its contract."""

import re

import pytest

from qalake.llm.mixing import mix, mixed_documents

from .data import documents, odd_documents


def size(text):
    return len(re.findall("[^\x20\x09-\x0d]+", text or ""))


def reshare(rows):
    sizes = {}
    for _, t, _, s, *_ in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, out, free = sum(sizes.values()), {}, set(order)
    while free:
        share = (total - sum(out.values())) / sum(weight[s] for s in free)
        over = [s for s in free if share * weight[s] > 3 * sizes[s]]
        for s in over or list(free):
            out[s] = 3 * sizes[s] if over else share * weight[s]
            free.discard(s)
    return sizes, out


def check(rows, got):
    sizes, target = reshare(rows)
    taken, most = {}, 0
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        assert r["taken"] == r["n_copies"] * r["size"] <= 3 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        most = max(most, r["size"])
    assert sum(taken.values()) <= sum(sizes.values())
    for s in sizes:
        assert abs(taken[s] - target[s]) <= most


def test_odd_rows(spark):
    rows = odd_documents()
    got = mix(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    assert sorted(r["size"] for r in got) == sorted(size(r[1]) for r in rows)
    check(rows, got)
    again = mix(documents(spark, rows).repartition(5)).collect()
    key = lambda r: (str(r["doc_id"]), r["size"], r["taken"], r["finish_time"] or 0)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_capped_sources_and_copies(spark):
    rows = [(i, "w " * (10 if s == "big" else 1), "en", s, 0, 1.0, 7, "z")
            for i, s in enumerate(["big"] * 300 + ["a"] * 5 + ["c"] * 40 + [None] * 9)]
    got = mix(documents(spark, rows)).collect()
    check(rows, got)
    assert {r["n_copies"] for r in got if r["source"] in ("a", "c", None)} <= {2, 3}
    copies = mixed_documents(documents(spark, rows))
    assert copies.columns == documents(spark, []).columns
    n = {r["doc_id"]: r["n_copies"] for r in got}
    assert {r["doc_id"]: r["count"] for r in copies.groupBy("doc_id").count().collect()} == {i: k for i, k in n.items() if k}


def test_given_weights(spark):
    rows = [(i, "w w", "en", "ab"[i % 2], 0, 1.0, 7, "z") for i in range(400)]
    w = spark.createDataFrame([("a", 3.0), ("b", 1.0)], "source string, weight double")
    got = mix(documents(spark, rows), w).collect()
    assert sum(r["taken"] for r in got if r["source"] == "a") == pytest.approx(600, abs=4)


def test_empty_table(spark):
    assert mix(documents(spark, [])).count() == 0
    assert mixed_documents(documents(spark, [])).count() == 0
    only = [(1, None, None, None, None, None, None, None), (2, " ", None, "s", None, None, None, None)]
    assert [r["taken"] for r in mix(documents(spark, only)).collect()] == [0, 0]


def brute_mix(rows, seed=42):
    """The order by finish time, walked through copy by copy: {(doc, text, source, number): copies}."""
    from pyspark.sql import functions as F
    spark = __import__("pyspark.sql", fromlist=["SparkSession"]).SparkSession.getActiveSession()
    sizes, target = reshare(rows)
    seen, places = {}, []
    for r in rows:
        k = (r[0], r[1], r[3])
        places.append((*k, seen.setdefault(k, 0)))
        seen[k] += 1
    frame = spark.createDataFrame(places, "doc_id long, text string, source string, number long")
    hashes = frame.withColumn("h", F.xxhash64(F.lit(seed), "doc_id", F.xxhash64("text"), "number")).collect()
    copies = []
    for s in sizes:
        own, at = sorted((r for r in hashes if r["source"] == s), key=lambda r: (r["h"] % 4096, r["h"])), 0
        for r in own:
            n = size(r["text"])
            at += n
            copies += [((at + k * sizes[s]) / target[s], n, tuple(r)[:4]) for k in range(3) if n and target[s]]
    copies.sort(key=lambda c: c[0])
    out, used, i = {}, 0, 0
    while i < len(copies):  # copies of one time go together
        j = i
        while j < len(copies) and copies[j][0] == copies[i][0]:
            j += 1
        words = sum(c[1] for c in copies[i:j])
        if used + words > sum(sizes.values()):
            break
        for _, _, k in copies[i:j]:
            out[k] = out.get(k, 0) + 1
        used, i = used + words, j
    return out


def test_order_and_taken_words_against_a_walk(spark):
    rows = odd_documents(n=90)
    want = brute_mix(rows)
    got = mix(documents(spark, rows)).collect()
    text_of = {r["h"]: r["text"] for r in documents(spark, rows).selectExpr("xxhash64(text) AS h", "text").collect()}
    assert {(r["doc_id"], text_of[r["text_hash"]], r["source"], r["number"]): r["n_copies"] for r in got if r["n_copies"]} == want


def test_null_and_repeated_ids_keep_the_targets(spark):
    rows = [(None if i % 3 else i % 7, "w " * (1 + i % 9), "en", "ab"[i % 2], i, 1.0, 7, "z") for i in range(400)]
    rows += [(None, "w w", "en", "c", 0, 1.0, 7, "z")] * 200  # one row, many times
    got = mix(documents(spark, rows)).collect()
    check(rows, got)
    out = mixed_documents(documents(spark, rows)).collect()
    taken = {}
    for r in out:
        taken[r["source"]] = taken.get(r["source"], 0) + size(r["text"])
    plan = {}
    for r in got:
        plan[r["source"]] = plan.get(r["source"], 0) + r["taken"]
    assert taken == plan
    assert documents(spark, out).exceptAll(documents(spark, rows * 3)).count() == 0
