"""Mixing sources to target weights by weighted fair queueing.

Every source has a target number of words. Its documents are shuffled (by a
hash of their id, text and occurrence), and each copy of a document gets a virtual finish time: the
words its source has given by then, divided by the source's target. Sorting all
copies by that time interleaves the sources in proportion to their targets, and
the mix is the start of that order that fits the total budget. A source whose
target exceeds its size starts over, up to ``max_copies`` passes.

Targets: the sources share the total by weight; a source's target stops at
``max_copies`` times its size, and the excess is shared again by weight.

Cumulative sums are taken in two steps, inside hash ranges of a source and over
the ranges' totals, and the global cut likewise over time ranges, so no task
sorts a whole source or the whole mix.

Edge cases. Null texts have size 0; documents of size 0 are never taken. A null
source is a source of its own, last in order. Rows of equal id, text and source are
numbered and take their places one by one, null ids like any other. Empty tables give empty
results. Other columns do not take part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qalake.llm.common import materialize

#: Ranges of the hash order within a source, and of the virtual time; ranges in which equal rows are numbered.
HASH_RANGES, TIME_RANGES, NUMBER_RANGES = 4096, 65536, 1024
WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def default_weights(sources: DataFrame) -> DataFrame:
    """Weights 1, 2, 3 and again, over the sources by code point with null last."""
    order = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source
    return sources.withColumn("weight", ((F.row_number().over(order) - 1) % 3 + 1).cast("double"))


def targets(sources: DataFrame, max_copies: int = 3) -> DataFrame:
    """Add ``target`` to rows (source, source_size, weight): the shares of all sizes with capped sources.

    With sources in order of cap / weight, those below the final level are a
    start of that order; the level is the rest of the total over the rest of the weights.
    """
    cap = F.col("source_size") * max_copies
    ratio = Window.orderBy(F.col("_ratio"), F.col("source").asc_nulls_last())
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    rows = (sources.withColumn("_cap", cap.cast("double")).withColumn("_ratio", F.col("_cap") / F.col("weight"))
            .withColumn("_total", F.sum("source_size").over(every).cast("double"))
            .withColumn("_rest", F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
            .withColumn("_weights", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
            .withColumn("_level", F.col("_rest") / F.col("_weights")))
    # the first such level is the final one; those after it are lower
    level = F.max(F.when(F.col("_level") <= F.col("_ratio"), F.col("_level"))).over(every)
    return rows.withColumn("target", F.least(F.col("_cap"), level * F.col("weight"))).select(*sources.columns, "target")


def _same(left: dict[str, str]) -> Column:
    """Equality of columns by name, nulls included."""
    out = F.lit(True)
    for a, b in left.items():
        out = out & F.col(a).eqNullSafe(F.col(b))
    return out


def _numbered(rows: DataFrame, by: list[str], number: str) -> DataFrame:
    """The rows with their number among the rows that are equal in ``by`` (from 0).

    Only repeated rows are counted through, in two steps: inside ranges of the rows, and over the ranges' counts.
    """
    keys = {f"__{c}": c for c in by}
    several = (rows.groupBy(*by).count().where(F.col("count") > 1)
               .select(*(F.col(c).alias(k) for k, c in keys.items())))
    if not several.limit(1).count():
        return rows.withColumn(number, F.lit(0).cast("long"))
    once = rows.join(several, _same(keys), "left_anti").withColumn(number, F.lit(0).cast("long"))
    # a written table: each row keeps its place
    again = materialize(rows.join(several, _same(keys), "left_semi").withColumn("__row", F.monotonically_increasing_id()), "mix-repeated")
    again = again.withColumn("__part", F.pmod(F.xxhash64("__row"), F.lit(NUMBER_RANGES)))
    counts = again.groupBy(*by, "__part").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(*by).orderBy("__part")) - F.col("__n")
    counts = counts.select(*(F.col(c).alias(k) for k, c in keys.items()), F.col("__part").alias("__p"), before.alias("__before"))
    inside = F.row_number().over(Window.partitionBy(*by, "__part").orderBy("__row")) - 1
    placed = again.withColumn("__inside", inside).join(counts, _same({**keys, "__p": "__part"}))
    return once.unionByName(placed.withColumn(number, (F.col("__before") + F.col("__inside")).cast("long")).select(*rows.columns, number))


def mix(docs: DataFrame, weights: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text",
        source: str = "source", max_copies: int = 3, seed: int = 42) -> DataFrame:
    """One row per document: doc_id, source, text_hash, number, size, source_size, target, n_copies, taken, finish_time.

    ``weights`` has (source, weight above 0); without it, ``default_weights``. n_copies is
    the number of copies in the mix, finish_time the virtual time of the first, number
    the row's among those of equal id, text (hash) and source.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.xxhash64(text).alias("text_hash"),
                       word_count(text).alias("size"))
    rows = _numbered(materialize(rows, "mix-sizes"), ["doc_id", "source", "text_hash"], "number")
    rows = rows.withColumn("_hash", F.xxhash64(F.lit(seed), "doc_id", "text_hash", "number"))
    rows = rows.withColumn("_range", F.pmod("_hash", F.lit(HASH_RANGES)))

    ranges = rows.groupBy("source", "_range").agg(F.sum("size").alias("_words"))
    sources = ranges.groupBy("source").agg(F.sum("_words").alias("source_size"))
    if weights is None:
        sources = default_weights(sources)
    else:
        w = weights.select(F.col("source").alias("_s"), F.col("weight").cast("double").alias("weight"))
        sources = sources.join(w, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    sources = targets(sources, max_copies).drop("weight")
    before = F.sum("_words").over(Window.partitionBy("source").orderBy("_range")) - F.col("_words")
    ranges = materialize(
        ranges.withColumn("_before", before).join(
            sources.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
        .select("_s", F.col("_range").alias("_r"), "_before", "source_size", "target"), "mix-ranges")

    inside = Window.partitionBy("source", "_range").orderBy("_hash", "doc_id", "text_hash", "number") \
        .rowsBetween(Window.unboundedPreceding, 0)
    placed = (rows.withColumn("_inside", F.sum("size").over(inside))
              .join(ranges, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_range") == F.col("_r")))
              .withColumn("_end", F.col("_before") + F.col("_inside")))
    # every copy's finish time; only copies that could fit the budget matter (time 1 exhausts it)
    times = F.transform(F.sequence(F.lit(0), F.lit(max_copies - 1)),
                        lambda k: (F.col("_end") + k * F.col("source_size")) / F.col("target"))
    live = (F.col("size") > 0) & (F.col("target") > 0)
    placed = placed.withColumn("_times", F.when(live, times).otherwise(F.array().cast("array<double>")))
    placed = materialize(placed.select("doc_id", "source", "text_hash", "number", "size", "source_size", "target", "_times"), "mix-times")

    n = F.size(F.filter("_times", lambda t: t <= F.lit(_cut_time(placed))))
    return (placed.withColumn("n_copies", n.cast("long"))
            .select("doc_id", "source", "text_hash", "number", "size", "source_size", "target", "n_copies",
                    (F.col("n_copies") * F.col("size")).alias("taken"),
                    F.when(F.col("n_copies") > 0, F.col("_times")[0]).alias("finish_time")))


def _cut_time(placed: DataFrame) -> float:
    """The greatest finish time such that the copies up to it fit the total budget.

    The range of times is cut into slots, then the slot in which the budget ends, and so on
    until that slot is one time; a slot is one row here.
    """
    copies = placed.select("size", F.explode("_times").alias("t"))
    budget, low, high = placed.agg(F.sum("size")).first()[0] or 0, 0.0, 4.0
    cut, used = -1.0, 0
    while True:
        width = (high - low) / TIME_RANGES
        slot = F.least(F.floor((F.col("t") - low) / width), F.lit(TIME_RANGES)).cast("long") if width else F.lit(0).cast("long")
        slots = (copies.where(F.col("t") >= low).withColumn("_slot", slot).groupBy("_slot")
                 .agg(F.sum("size").alias("words"), F.min("t").alias("first"), F.max("t").alias("last")).orderBy("_slot").collect())
        for row in slots:  # TIME_RANGES + 1 at most
            if used + row["words"] > budget:
                break
            cut, used = row["last"], used + row["words"]
        else:
            return cut
        if row["first"] == row["last"]:
            return cut
        low, high = row["first"], row["last"]


def mixed_documents(docs: DataFrame, max_copies: int = 3, doc_id: str = "doc_id", text: str = "text", source: str = "source",
                    **options) -> DataFrame:
    """The mix as documents: each row as many times as the mix takes it."""
    plan = mix(docs, max_copies=max_copies, doc_id=doc_id, text=text, source=source, **options)
    keys = {"__mix_id": "doc_id", "__mix_source": "source", "__mix_text": "text_hash", "__mix_number": "number"}
    chosen = plan.where("n_copies > 0").select(*(F.col(c).alias(k) for k, c in keys.items()),
                                               F.col("n_copies").cast("int").alias("__mix_copies"))
    own = _numbered(docs.withColumn("__mix_hash", F.xxhash64(text)), [doc_id, source, "__mix_hash"], "__mix_row")
    same = _same({"__mix_id": doc_id, "__mix_source": source, "__mix_text": "__mix_hash", "__mix_number": "__mix_row"})
    return (own.join(chosen, same).withColumn("__mix_copy", F.explode(F.sequence(F.lit(1), F.col("__mix_copies"))))
            .select(*docs.columns))
