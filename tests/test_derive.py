"""The maintained post-to-tag relation equals the full one; what did not change stays as it is on disk."""

import os
import random

import pytest

from qalake.operators import derive, snapshots

NAMES = [f"t{k}" for k in range(12)]


def frames(spark, posts, tags):
    return (spark.createDataFrame(list(posts.items()), "id int, tags string"),
            spark.createDataFrame([(v, k) for k, v in tags.items()], "id int, tag_name string"))


def full(posts, tags):
    return sorted((i, tags[n], n) for i, t in posts.items() for n in (t or "").strip("|").split("|") if n in tags)


def stored(found):
    return sorted(map(tuple, found.relation.collect()))


def files(path):
    return {os.path.relpath(os.path.join(r, f), path) for r, _, fs in os.walk(f"{path}/relation") for f in fs if f.startswith("part-")}


def some_tags(rng):
    return rng.choice([None, "", "|" + "|".join(rng.sample(NAMES + ["unknown"], rng.randint(1, 4))) + "|"])


def test_inserts_updates_and_deletes(spark, tmp_path):
    rng, path = random.Random(9), str(tmp_path / "kept")
    tags = {n: k + 1 for k, n in enumerate(NAMES[:10])}
    posts = {i: some_tags(rng) for i in rng.sample(range(2000), 600)}
    update = lambda: derive.maintain_post_tags(spark, *frames(spark, posts, tags), path, width=100)
    first = update()
    assert stored(first) == full(posts, tags) and first.spans == sorted({i // 100 for i in posts})
    was = files(path)
    assert update().spans == [] and files(path) == was
    for step in range(3):
        for i in rng.sample(sorted(posts), 3):
            posts[i] = some_tags(rng)
        gone = rng.choice(sorted(posts))
        del posts[gone]
        posts[2100 + step] = "|t1|t2|"
        now = update()
        assert stored(now) == full(posts, tags)
        kept = {f for f in was if int(f.split("span=")[1].split("/")[0]) not in now.spans}
        assert 0 < len(now.spans) <= 6 and kept and kept <= files(path)
        was = files(path)


def test_tags_that_come_go_and_change(spark, tmp_path):
    path = str(tmp_path / "kept")
    posts = {i: f"|t{i // 100}|" for i in range(1000)}
    tags = {n: k + 1 for k, n in enumerate(NAMES[:5])}
    update = lambda: derive.maintain_post_tags(spark, *frames(spark, posts, tags), path, width=100)
    assert stored(update()) == full(posts, tags)
    tags["t7"], tags["t2"] = 70, 20
    del tags["t1"]
    got = update()
    assert got.spans == [1, 2, 7] and stored(got) == full(posts, tags)
    assert not os.path.exists(f"{path}/relation/span=1")


def test_a_stopped_update_is_done_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "kept")
    posts, tags = {i: "|t1|" for i in range(300)}, {"t1": 1, "t2": 2}
    update = lambda: derive.maintain_post_tags(spark, *frames(spark, posts, tags), path, width=100)
    update()
    posts[150] = "|t2|"
    monkeypatch.setattr(snapshots.paths, "write_new", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        update()
    monkeypatch.undo()
    got = update()
    assert got.spans == [1] and stored(got) == full(posts, tags)


def test_repeated_pairs_are_refused_and_empty_inputs_work(spark, tmp_path):
    tags = {"t1": 1}
    posts, dim = frames(spark, {1: "|t1|t1|"}, tags)
    with pytest.raises(ValueError, match="duplicate"):
        derive.maintain_post_tags(spark, posts, dim, str(tmp_path / "a"))
    none = derive.maintain_post_tags(spark, posts.limit(0), dim, str(tmp_path / "b"))
    assert none.spans == [] and none.relation.count() == 0
    assert derive.maintain_post_tags(spark, posts, dim, str(tmp_path / "b"), check_unique=False).relation.count() == 2


def test_many_spans_share_a_bounded_number_of_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(derive, "FOLDERS", 8, raising=False)
    path, tags = str(tmp_path / "kept"), {"t1": 1, "t2": 2}
    posts = {i: "|t1|" for i in range(400)}
    update = lambda: derive.maintain_post_tags(spark, *frames(spark, posts, tags), path, width=10)
    assert stored(update()) == full(posts, tags) and len(os.listdir(f"{path}/relation")) <= 10
    was = files(path)
    posts[123] = "|t1|t2|"
    for i in range(350, 400):
        posts[i] = None
    got = update()
    assert got.spans == [10, 35] and stored(got) == full(posts, tags)
    assert {f for f in was if "span=10/" not in f and "span=35/" not in f} <= files(path)
    posts.update({i: "|t2|" for i in range(400, 2400)})  # spans outgrow their folders
    assert stored(update()) == full(posts, tags) and len(os.listdir(f"{path}/relation")) <= 10
