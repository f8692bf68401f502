import hashlib
import os

from pyspark.sql import functions as F

from qalake import paths
from qalake.sources import pieces


def _digests(spark, stream: bytes, piece_len: int):
    rows = [(i, hashlib.sha1(stream[i * piece_len:(i + 1) * piece_len]).hexdigest())
            for i in range(len(stream) // piece_len)]
    return spark.createDataFrame(rows, "piece_idx long, digest string")


def _run(spark, files: dict[str, bytes], on_disk: dict[str, bytes], tmp_path, piece_len=8):
    stream = b"".join(files.values())
    offs, pos = [], 0
    for name, data in files.items():
        offs.append((name, pos, len(data)))
        pos += len(data)
    entries = spark.createDataFrame(offs, "name string, offset long, length long")
    present = []
    for name, data in on_disk.items():
        p = tmp_path / name
        p.write_bytes(data)
        present.append((name, str(p)))
    present_df = spark.createDataFrame(present, "name string, path string")
    summary, bad = pieces.verify_pieces(entries, present_df, _digests(spark, stream, piece_len), piece_len)
    return ({r["name"]: (r["status"], r["n_bad"], r["first_bad"]) for r in summary.collect()},
            sorted((r["name"], r["piece_idx"]) for r in bad.collect()))


def test_match_corrupt_missing(spark, tmp_path):
    a, b = bytes(range(16)), bytes(range(100, 116))
    got, _ = _run(spark, {"a": a, "b": b}, {"a": a, "b": b}, tmp_path)
    assert got == {"a": ("ok", 0, None), "b": ("ok", 0, None)}
    bad_b = b[:9] + b"X" + b[10:]  # byte 9 of b = stream byte 25: piece 3
    got, bad = _run(spark, {"a": a, "b": b}, {"a": a, "b": bad_b}, tmp_path)
    assert got["b"] == ("mismatch", 1, 3) and bad == [("b", 3)]
    got, _ = _run(spark, {"a": a, "b": b}, {"a": a}, tmp_path)
    assert got["b"] == ("missing", 0, None)


def test_partial_pieces_are_skipped(spark, tmp_path):
    # 20-byte file: pieces 0 and 1 are whole, bytes 16..19 are a partial tail
    a = bytes(range(20))
    tail_changed = a[:18] + b"ZZ"
    got, _ = _run(spark, {"a": a}, {"a": tail_changed}, tmp_path)
    assert got["a"] == ("ok", 0, None)
    # a file starting mid-piece: its leading partial piece is skipped too
    got, _ = _run(spark, {"x": bytes(5), "y": bytes(range(1, 20))},
                  {"x": bytes(5), "y": b"\xff" + bytes(range(2, 20))}, tmp_path)
    assert got["y"] == ("ok", 0, None)


def test_running_offsets_match_cumulative_sum(spark):
    rows = [(i, (i * 37) % 11 + 1) for i in range(0, 300, 3)]
    df = spark.createDataFrame(rows, "idx long, len long")
    got = {r["idx"]: r["offset"] for r in pieces.running_offsets(df, "idx", "len", bucket=16).collect()}
    acc, want = 0, {}
    for i, n in rows:
        want[i] = acc
        acc += n
    assert got == want


def test_file_pieces_bounds(spark):
    e = spark.createDataFrame([("f", 5, 20)], "name string, offset long, length long")
    got = sorted((r["piece_idx"], r["pos"]) for r in pieces.file_pieces(e, 8).collect())
    assert got == [(1, 3), (2, 11)]  # bytes 8..23 of the stream; 24..24 is partial
    assert pieces.file_pieces(e.withColumn("length", F.lit(4)), 8).count() == 0


def test_binary_files_split_and_cut_anywhere(spark, tmp_path):
    import random
    rng = random.Random(3)
    data = {"a": rng.randbytes(200_000), "b": b"\n" * 5000, "c": b"x" * 30_000, "d": b"", "e": rng.randbytes(3) + b"\n", "f": rng.randbytes(90_001)}
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got, bad = _run(spark, data, data, tmp_path, piece_len=1000)
        assert bad == [] and all(v[0] == "ok" for v in got.values())
        hurt = dict(data, a=data["a"][:150_500] + b"\n" + data["a"][150_501:], c=data["c"][:-1001], f=data["f"][:7] + data["f"][8:] + b"!")
        hurt["a"] = hurt["a"] if hurt["a"] != data["a"] else data["a"][:150_500] + b"x" + data["a"][150_501:]
        got, bad = _run(spark, data, hurt, tmp_path, piece_len=1000)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])
    stream, at = b"".join(data.values()), 0
    want = set()
    for name, x in data.items():
        for k in range(-(-at // 1000), (at + len(x)) // 1000):
            if hurt[name][k * 1000 - at:(k + 1) * 1000 - at] != stream[k * 1000:(k + 1) * 1000]:
                want.add((name, k))
        at += len(x)
    assert set(bad) == want and {n for n, _ in want} == {"a", "c", "f"} and got["b"][0] == "ok"


def test_wanted_files_only_and_other_schemes(spark, tmp_path):
    a, b = bytes(range(32)), bytes(range(100, 132))
    entries = spark.createDataFrame([("a", 0, 32), ("b", 32, 32)], "name string, offset long, length long")
    (tmp_path / "a").write_bytes(a)
    (tmp_path / "b").write_bytes(b[::-1])
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.pieces.link./top", f"file://{tmp_path}")
    present = spark.createDataFrame([("a", "viewfs://pieces/top/a"), ("b", f"file://{tmp_path}/b")], "name string, path string")
    digests = _digests(spark, a + b, 8)
    summary, bad = pieces.verify_pieces(entries, present, digests, 8)
    assert {r["name"]: (r["status"], r["n_bad"]) for r in summary.collect()} == {"a": ("ok", 0), "b": ("mismatch", 4)}
    summary, bad = pieces.verify_pieces(entries, present, digests, 8, wanted=spark.createDataFrame([("a",)], "name string"))
    assert [(r["name"], r["status"]) for r in summary.collect()] == [("a", "ok")] and bad.count() == 0
    plan = bad._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_files_are_read_in_rounds_of_bounded_number(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pieces, "LISTED", 10, raising=False)
    read, line_places = [], pieces.line_places
    monkeypatch.setattr(pieces, "line_places", lambda s, files: (read.append(list(files)), line_places(s, files))[1])
    data = {f"f{i}": bytes([65 + i % 26]) * (17 + i % 5) + b"\n" for i in range(60)}
    hurt = data | {"f7": data["f7"].lower(), "f30": data["f30"].lower()}
    before = spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")
    got, bad = _run(spark, data, hurt, tmp_path)
    assert {n for n, _ in bad} == {"f7", "f30"} == {n for n, v in got.items() if v[0] != "ok"}
    assert len(read) > 3 and max(map(len, read)) < 30  # dealt by hash: about 10 each
    assert len({f for files in read for f in files}) == sum(map(len, read))  # no file twice
    assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism") == before


def test_a_walk_reads_folders_as_it_goes(spark, tmp_path, monkeypatch):
    for i in range(40):
        (tmp_path / f"d{i}" / "deep").mkdir(parents=True)
        (tmp_path / f"d{i}" / "deep" / "f").write_text("x" * i)
    seen, scandir = [], os.scandir

    class Counted:
        def __init__(self, path):
            self.entries = scandir(path)

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.entries.close()

        def __iter__(self):
            for e in self.entries:
                seen.append(e.name)
                yield e

    monkeypatch.setattr(paths.os, "scandir", Counted)
    found = paths.walk(spark, str(tmp_path))
    first = next(found)
    assert len(seen) <= 3  # a folder, the one in it, and the file
    assert {(r, n) for _, r, n in [first, *found]} == {(f"d{i}/deep/f", i) for i in range(40)}
