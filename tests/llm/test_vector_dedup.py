"""Links and components against brute force; recall; odd vectors."""

import numpy as np

from qalake.llm.vector_dedup import near_duplicates

SCHEMA = "vec_id long, embedding array<float>, label int, cid string, x int"


def brute(ids, x, threshold=0.95):
    u = x / np.linalg.norm(x, axis=1)[:, None]
    a = u @ u.T >= threshold
    np.fill_diagonal(a, False)
    label = np.array(ids)
    while True:
        new = np.array([min(label[i], label[a[i]].min()) if a[i].any() else label[i] for i in range(len(ids))])
        if (new == label).all():
            return {i: (int(n), int(c)) for i, n, c in zip(ids, a.sum(1), label)}
        label = new


def run(spark, rows):
    return near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()


def groups(seed=0, dim=32):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(60, dim))
    x = [b + rng.normal(size=dim) * 0.05 for b in base for _ in range(3)] + [b.copy() for b in base[:20]]
    x += [base[0] + rng.normal(size=dim) * 0.1 for _ in range(150)]  # a large group
    x += [base[1] * 2] * 40  # equal directions and equal vectors
    return np.array(x, np.float32)


def test_against_brute_force(spark):
    x = groups()
    ids = list(range(len(x)))
    want = brute(ids, x.astype(float))
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in run(spark, [(i, v.tolist(), 0, "c", 1) for i, v in zip(ids, x)])}
    links = sum(n for n, _ in want.values())
    assert sum(n for n, _ in got.values()) >= 0.9 * links
    assert all(got[i][0] <= want[i][0] for i in ids)  # none below the threshold
    assert sum(got[i] == want[i] for i in ids) >= 0.99 * len(ids)


def test_recall_on_the_table(spark):
    t = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    p = t.toPandas().sort_values("vec_id")
    want = brute(p["vec_id"].tolist(), np.array(p["embedding"].tolist(), float))
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_duplicates(t).collect()}
    assert sum(n for n, _ in got.values()) >= 0.9 * sum(n for n, _ in want.values())


def test_unusable_rows(spark):
    v = [1.0, 0.0, 0.0]
    rows = [(4, v, 0, "c", 1), (2, v, 0, "c", 1), (9, [2.0, 0.0], 0, "c", 1), (5, None, 0, "c", 1), (6, [0.0] * 3, 0, "c", 1),
            (7, [1.0, None, 0.0], 0, "c", 1), (8, [float("nan")] * 3, 0, "c", 1), (None, v, 0, "c", 1), (3, [], 0, "c", 1),
            (1, [-1.0, 0.0, 0.0], 0, "c", 1), (10, [1e-30, 0.0, 0.0], None, None, None)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in run(spark, rows)}
    assert got == {4: (3, 2, False), 2: (3, 2, True), 9: (3, 2, False), 10: (3, 2, False), 5: (0, 5, True), 6: (0, 6, True),
                   7: (0, 7, True), 8: (0, 8, True), 3: (0, 3, True), 1: (0, 1, True), None: (0, None, True)}


def test_empty_table(spark):
    assert run(spark, []) == []
    assert len(run(spark, [(1, None, 0, "c", 1)])) == 1


def test_one_id_on_different_vectors_joins_their_groups(spark):
    e = np.eye(4, dtype=np.float32).tolist()
    rows = [(i, v, 0, "c", 1) for i, v in ((3, e[0]), (4, e[1]), (5, e[0]), (5, e[1]), (5, e[2]), (9, e[2]), (7, e[3]), (None, e[0]))]
    got = sorted((r["vec_id"], r["component_id"]) for r in run(spark, rows) if r["vec_id"] is not None)
    assert got == [(3, 3), (4, 3), (5, 3), (5, 3), (5, 3), (7, 7), (9, 3)]
