"""Mixing sources to target weights along a time-varying curriculum, in DataFrame operations only.

Every source has a target, its share of all words by weight, and a schedule: how its weight moves from the
start of training to its end. A source's schedule is a line; integrated, it is the source's cumulative demand
D(t) over training time t in [0, 1], scaled so that D(1) is the target. Documents of a source stand in a drawn
order; a pass over them supplies their words one after another, and passes repeat until the target is met. The
copy that begins at cumulative word c is due when D(t) = c, so its position is t = D^-1(c), and sorting by t
interleaves all sources as the schedules ask.

The running word count of a source would put all its rows into one task. It is taken in two steps instead: rows
fall into runs of the drawn order (ranges of a hash), the sums of runs are added up per source, and only within
a run are rows counted one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm.ragged import free_name

#: A word, as counted everywhere here (fixed value).
WORD = r"[^\x20\x09-\x0D]+"
#: Passes over a source at most.
MOST_PASSES = 3
#: Rows in a run, about; more rows only make more runs.
RUN_ROWS = 20_000
#: How steep schedules are: the weight goes from 1 - TILT to 1 + TILT times its mean, or the other way.
TILT = 0.5


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, most: int = MOST_PASSES) -> DataFrame:
    """source, weight, source_size and target from the columns source and size.

    Sources in code point order, null last, weigh 1, 2, 3, 1, ... They share all words by weight; where a share
    is above ``most`` times a source's size it stops there, and the rest goes to the others by weight until none
    is above. Sources that stop are those of the least size per weight, so running sums over the sources in
    that order give the level at which the others settle. One row per source, whatever the number of rows.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("weight", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("long"))
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = ranked.select(
        "*",
        (F.sum("source_size").over(every) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))).alias("words"),
        (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("weights"),
    )
    # what this source would get if all before it had stopped; as long as that is too much, it stops as well
    share = F.col("words") * F.col("weight") / F.col("weights")
    stops = share > most * F.col("source_size")
    first = F.min(F.when(~stops, F.struct(-F.col("weights"), F.col("words")))).over(every)
    settled = levels.select("source", "weight", "source_size", stops.alias("stops"), first.alias("level"))
    level = F.col("level.words") * F.col("weight") / -F.col("level.col1")
    target = F.when(F.col("stops"), (most * F.col("source_size")).cast("double")).otherwise(level)
    return settled.select("source", "weight", "source_size", target.alias("target"))


def inverse_demand(part: Column, tilt: Column) -> Column:
    """The time at which a source has asked for ``part`` of its target.

    The weight at time t is 1 + tilt (2t - 1) times its mean, so the demand up to t is t + tilt (t^2 - t).
    """
    slope = 1 - tilt
    root = (F.sqrt(F.greatest(slope * slope + 4 * tilt * part, F.lit(0.0))) - slope) / (2 * tilt)
    return F.when(F.abs(tilt) < 1e-9, part).otherwise(root)


def _placed(docs: DataFrame, keep: list[str], most: int, tilt: Column | None) -> DataFrame:
    """row (a struct of the kept columns), size, source_size, target, passes and positions of every document."""
    tilt = F.when(F.col("weight") % 2 == 1, F.lit(TILT)).otherwise(F.lit(-TILT)) if tilt is None else tilt
    digits = 1
    while docs.count() > RUN_ROWS * 16**digits:
        digits += 1
    name = F.coalesce(F.col("source").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    drawn = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(text.cast("binary")))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row") if keep else F.lit(None).alias("row"),
        F.concat(F.col("source").isNull().cast("string"), name).alias("key"),  # as a join key, null is a value
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text")).alias("size"),
        F.md5(drawn.cast("binary")).alias("drawn"),
    ).withColumn("run", F.substring("drawn", 1, digits))
    runs = rows.groupBy("key", "source", "run").agg(F.sum("size").alias("words"))
    # the sums of runs stand for the rows in all that is done per source
    sources = source_targets(runs.select("source", F.col("words").alias("size")), most)
    sources = sources.select(
        F.concat(F.col("source").isNull().cast("string"), F.coalesce("source", F.lit(""))).alias("key"),
        "weight",
        "source_size",
        "target",
    )
    in_order = Window.partitionBy("key").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select("key", "run", F.coalesce(F.sum("words").over(in_order), F.lit(0)).alias("before")).join(sources, "key")
    in_run = Window.partitionBy("key", "run").orderBy("drawn").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.col("before") + F.coalesce(F.sum("size").over(in_run), F.lit(0))
    placed = rows.join(offsets, ["key", "run"]).withColumn("begin", begin)

    def starts(p: int) -> Column:
        return p * F.col("source_size") + F.col("begin")

    passes = sum(
        F.when((F.col("size") > 0) & (2 * starts(p) + F.col("size") <= 2 * F.col("target")), 1).otherwise(0)
        for p in range(most)
    )
    times = F.array(*[inverse_demand(F.try_divide(starts(p).cast("double"), F.col("target")), tilt) for p in range(most)])
    placed = placed.withColumn("passes", passes.cast("int"))
    return placed.select("row", "size", "source_size", "target", "passes", F.slice(times, F.lit(1), F.col("passes")).alias("positions"))


def mix(docs: DataFrame, keep: list[str] | None = None, most: int = MOST_PASSES, tilt: Column | None = None) -> DataFrame:
    """A row per document: how often the mix takes it, and at which training positions.

    Reads doc_id, source and text. Returns ``keep`` (columns of ``docs``, by default doc_id) and mix_size
    (words), mix_source_size, mix_target (both of its source), mix_passes (how often the document is taken) and
    mix_positions (0 to 1, one for each time); where a kept column has one of these names, the mix's has an
    underscore behind it. ``tilt`` (from -1 to 1) is how steep a source's schedule is, an expression of weight; by
    default sources of odd weight grow over training and the others shrink.

    A document is taken whole. In the pass that the target ends in, it is taken while at least half of it is
    still asked for, so a source misses its target by half a document at most. Documents without a word (null
    or empty texts) are never taken. Null sources are one source, null ids are values like others, and repeated
    rows are documents of their own. Documents of one id are told apart by their texts; only rows equal in both
    share a run however many they are.
    """
    keep = ["doc_id"] if keep is None else keep
    own = [F.col(c).alias(free_name(f"mix_{c}", keep)) for c in ("size", "source_size", "target", "passes", "positions")]
    return _placed(docs, keep, most, tilt).select(*[F.col("row").getField(c).alias(c) for c in keep], *own)


def by_first_position(mixed: DataFrame) -> DataFrame:
    """The documents of ``mix`` in the order in which training first meets them, over all partitions; those that it never
    takes last. Adds mix_first and mix_last, the first and the last of their positions."""
    first = F.get("mix_positions", F.lit(0)).alias("mix_first")
    last = F.get("mix_positions", F.col("mix_passes") - 1).alias("mix_last")
    # documents never taken are many and tie in all but themselves, so the sort's ranges go on through a hash of the row
    return mixed.select("*", first, last).orderBy(F.col("mix_first").asc_nulls_last(), "mix_size", F.xxhash64(*mixed.columns))


def in_training_order(mixed: DataFrame) -> DataFrame:
    """A row per time that the mix takes a document, sorted by its training position over all partitions.

    ``mixed`` is the result of ``mix``; its other columns stay, and mix_position is added. Positions that tie
    stand in the order of mix_size; the range sort splits at positions, which are as good as all different.
    """
    copies = mixed.select("*", F.explode("mix_positions").alias("mix_position"))
    return copies.orderBy("mix_position", "mix_size")


def training_documents(docs: DataFrame, most: int = MOST_PASSES) -> DataFrame:
    """The rows of ``docs``, with its columns alone, as often as the mix takes them and in training order. Names of its
    columns don't matter, but for doc_id, source and text, which are read."""
    placed = _placed(docs, docs.columns, most, None)
    copies = placed.select("row", "size", F.explode("positions").alias("position")).orderBy("position", "size")
    return copies.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
