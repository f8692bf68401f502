"""Piece-hash verification of downloaded dump files (S20).

A torrent concatenates its files (in list order) into one byte stream cut
into pieces of ``piece_len`` bytes, each with a SHA-1 digest. A file is
checked on the pieces that lie entirely inside it; its leading and trailing
partial pieces need bytes of neighbouring files and are skipped. A listed
file that is not on disk is reported missing.

As Spark jobs: file offsets are a distributed prefix sum of the lengths;
pieces are generated per file; digests are compared by a join on the piece
index. The bytes are read by Spark's own line reader, on any path it reads: it
splits large files, keeps every byte between two newline bytes, and says where a
split starts, so a prefix sum of the lines' lengths gives each line its place in
the file. Lines are cut at piece borders, and a piece is put together from its
parts (compressed files have a newline in every few hundred bytes). Files are read
in rounds, so that the driver never holds the entries of more than ``LISTED``, about. The report is
a per-file summary plus one row per bad piece - no list of a file's pieces is
ever collected into one value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import paths
from ..functions.pg import idiv
from ..session import SHUFFLES_GO, scratch_path, session_settings
from .files import LISTED

#: While files are read in rounds: their entries are not kept, they are listed in few tasks, and a round's shuffles go when it ends.
ROUND_SETTINGS = {"spark.sql.hive.filesourcePartitionFileCacheSize": "0",
                  "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64", **SHUFFLES_GO}
DIGEST_SCHEMA = "name string, piece_idx long, actual string"


def running_offsets(df: DataFrame, order_col: str, len_col: str, bucket: int = 1 << 16) -> DataFrame:
    """Add ``offset`` = sum of ``len_col`` over all rows before this one in
    ``order_col`` order (an integer, unique). Two phases: per-bucket totals
    (small) get a prefix sum in one task, rows inside a bucket a partitioned
    running sum - no window ever sees all rows in one task."""
    b = df.withColumn("_b", idiv(F.col(order_col), F.lit(bucket)))
    totals = b.groupBy("_b").agg(F.sum(len_col).alias("_bt"))
    wb = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = totals.select("_b", (F.sum("_bt").over(wb) - F.col("_bt")).alias("_before"))
    wi = (Window.partitionBy("_b").orderBy(order_col)
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (b.join(before, "_b")
            .withColumn("offset", (F.col("_before") + F.sum(len_col).over(wi) - F.col(len_col))
                        .cast("long"))
            .drop("_b", "_before"))


def file_pieces(entries: DataFrame, piece_len: int) -> DataFrame:
    """(name, piece_idx, pos) of the pieces fully inside each file, pos being
    the piece's start inside the file. ``entries``: name, offset, length."""
    L = F.lit(piece_len)
    first = idiv(F.col("offset") + L - 1, L)
    end = idiv(F.col("offset") + F.col("length"), L)
    return (entries.where(end > first)
            .select("name", F.explode(F.sequence(first, end - 1)).alias("piece_idx"), "offset")
            .select("name", "piece_idx", (F.col("piece_idx") * L - F.col("offset")).alias("pos")))


def line_places(spark: SparkSession, files: list[str]) -> DataFrame:
    """(path, start, data) of the lines of files, newline included: where each begins in its file, and its bytes."""
    lines = spark.read.option("lineSep", "\n").text(files).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("total"), F.monotonically_increasing_id().alias("seq"),
        F.concat(F.col("value").cast("binary"), F.lit(b"\n")).alias("data"))
    lines = lines.withColumn("size", F.octet_length("data"))
    blocks = lines.groupBy("path", "block").agg(F.sum("size").alias("n"))  # one row per split
    before = blocks.select("path", "block", (F.sum("n").over(Window.partitionBy("path").orderBy("block")) - F.col("n")).alias("before"))
    inside = F.sum("size").over(Window.partitionBy("path", "block").orderBy("seq")) - F.col("size")
    placed = lines.withColumn("inside", inside).join(before, ["path", "block"]).withColumn("start", F.col("before") + F.col("inside"))
    # the last line of a file need not end in a newline
    data = F.substring("data", F.lit(1), F.least(F.col("size").cast("long"), F.col("total") - F.col("start")).cast("int"))
    return placed.select("path", "start", data.alias("data"))


def _plain(path: Column) -> Column:
    """A path with one slash behind its scheme (``file:///a`` and ``file:/a`` are one)."""
    named = F.when(path.contains(":"), path).otherwise(F.concat(F.lit("file:"), path))
    return F.regexp_replace(named, "^file:/*", "file:/")


def piece_digests(spark: SparkSession, located: DataFrame, piece_len: int) -> DataFrame:
    """(name, piece_idx, actual): SHA-1 of the pieces (name, piece_idx, pos, path) as far as their files hold them.

    Spark lists the files of a scan on the driver. So files are dealt by path over rounds of about
    ``LISTED``; a round's digests are written before the next one is listed.
    """
    kept, dealt, out = (scratch_path(spark, f"pieces-{what}") for what in ("files", "dealt", "digests"))
    located.withColumn("plain", _plain(F.col("path"))).groupBy("name", "plain").agg(
        F.min("path").alias("path"), F.min("pos").alias("first_pos"), F.min("piece_idx").alias("first_idx"),
        F.max("piece_idx").alias("last_idx")).write.parquet(kept)
    per_file = spark.read.parquet(kept)  # files that hold a whole piece
    rounds = -(-per_file.count() // LISTED)
    if not rounds:
        return spark.createDataFrame([], DIGEST_SCHEMA)
    (per_file.withColumn("round", F.pmod(F.xxhash64("plain"), F.lit(rounds))).repartition("round")
     .write.partitionBy("round").parquet(dealt))
    with session_settings(spark, ROUND_SETTINGS):
        for e in paths.children(spark, dealt):
            if e.name.startswith("round="):
                _round_digests(spark, spark.read.schema(per_file.schema).parquet(f"{dealt}/{e.name}"), piece_len).write.parquet(f"{out}/{e.name}")
    return spark.read.schema(DIGEST_SCHEMA + ", round int").parquet(out).drop("round")


def _round_digests(spark: SparkSession, per_file: DataFrame, piece_len: int) -> DataFrame:
    """The digests of one round's files."""
    files = [r["path"] for r in per_file.groupBy("plain").agg(F.min("path").alias("path")).collect()]  # LISTED, about
    lines = line_places(spark, files).withColumn("plain", _plain(F.col("path"))).drop("path")
    lines = lines.join(per_file.drop("path"), "plain")
    end, L = F.col("start") + F.octet_length("data"), F.lit(piece_len)
    low = F.greatest(idiv(F.greatest(F.col("start") - F.col("first_pos"), F.lit(0)), L), F.lit(0))
    high = F.least(idiv(end - 1 - F.col("first_pos"), L), F.col("last_idx") - F.col("first_idx"))
    parts = (lines.where((end > F.col("first_pos")) & (low <= high))
             .select("name", "start", "data", "first_idx", "first_pos", end.alias("end"), F.explode(F.sequence(low, high)).alias("k")))
    a = F.greatest(F.col("start"), F.col("first_pos") + F.col("k") * L)
    b = F.least(F.col("end"), F.col("first_pos") + (F.col("k") + 1) * L)
    cut = F.substring("data", (a - F.col("start") + 1).cast("int"), (b - a).cast("int"))
    parts = parts.select("name", (F.col("first_idx") + F.col("k")).alias("piece_idx"), F.struct(a.alias("at"), F.hex(cut).alias("hex")).alias("part"))
    whole = F.unhex(F.array_join(F.transform(F.sort_array(F.collect_list("part")), lambda p: p["hex"]), ""))  # one piece
    return parts.groupBy("name", "piece_idx").agg(F.sha1(whole).alias("actual"))


def verify_pieces(entries: DataFrame, present: DataFrame, digests: DataFrame, piece_len: int,
                  wanted: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Check files against piece digests.

    entries: (name, offset, length) of every listed file; present: (name,
    path) of the files that are there; digests: (piece_idx, digest) hex SHA-1;
    wanted: (name) of the files to check (all). Returns (summary(name, status,
    n_bad, first_bad), bad(name, piece_idx)). status is 'missing', 'mismatch' or
    'ok'; a piece that its file does not hold in full is bad.
    """
    if wanted is not None:
        entries = entries.join(wanted.select("name").distinct(), "name", "left_semi")
    located = file_pieces(entries, piece_len).join(present, "name")
    hashed = piece_digests(entries.sparkSession, located, piece_len)
    bad = (located.select("name", "piece_idx").join(hashed, ["name", "piece_idx"], "left").join(digests, "piece_idx", "left")
           .where(~F.lower("digest").eqNullSafe(F.col("actual")) | F.col("digest").isNull()).select("name", "piece_idx"))
    per_file = bad.groupBy("name").agg(F.count(F.lit(1)).alias("n_bad"),
                                       F.min("piece_idx").alias("first_bad"))
    summary = (entries.select("name").distinct()
               .join(present.select("name", F.lit(True).alias("_here")), "name", "left")
               .join(per_file, "name", "left")
               .select("name",
                       F.when(F.col("_here").isNull(), "missing")
                       .when(F.col("n_bad") > 0, "mismatch").otherwise("ok").alias("status"),
                       F.coalesce("n_bad", F.lit(0)).cast("long").alias("n_bad"),
                       "first_bad"))
    return summary, bad
