"""Mixing sources to target weights, on DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, let, saved

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
# Words in a block; slots in an output shard; parts of a running sum.
BLOCK = 32
SHARD = 4096
PARTS = 4096
SEED = 20


def _uniform(*key) -> Column:
    """A pseudorandom number in [0, 1) that only depends on the key."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *key), 11) * F.lit(2.0**-53)


def targets(
    sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources in code point order, NULL last, take the weights in turn and share
    the sum of all sizes by them. No target exceeds ``max_repeats`` times the
    size: sources in the order of size to weight fill up first, and what they
    can't take is shared by the others' weights.
    """
    one = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighed = sources.withColumn(
        "weight", F.element_at(cycle, (F.row_number().over(one) - 1) % len(weights) + 1)
    ).withColumn("most", F.col("source_size") * float(max_repeats))
    ratio = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = weighed.select(
        "*",
        (
            (F.sum(F.col("source_size") * 1.0).over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
            / F.sum("weight").over(ratio.rowsBetween(0, Window.unboundedFollowing))
        ).alias("level"),
    ).withColumn("open", F.col("level") * F.col("weight") <= F.col("most"))
    # The level at which the first source in this order is not full.
    water = F.max(F.when(F.col("open"), F.col("level"))).over(everything)
    return level.withColumn("water", water).select(
        "source",
        "source_size",
        F.when(F.col("water").isNull(), F.col("most"))
        .otherwise(F.least("most", F.col("water") * F.col("weight")))
        .alias("target"),
    )


def packed(sized: DataFrame) -> DataFrame:
    """Adds ``start``: the words of the same source before the row, so that
    the rows of a source lie end to end, and ``row``, a number within its part.

    A running sum over a whole source would be one task. Rows are dealt to
    parts by hash, summed within a part, and moved by the total of the parts
    before, of which a source has ``PARTS`` at most. ``sized`` has source, size
    and key, which stands for the row.
    """
    parted = sized.withColumn("part", F.pmod("key", F.lit(PARTS)))
    inside = Window.partitionBy("source", "part").orderBy("key", "size")
    local = parted.withColumn("row", F.row_number().over(inside)).withColumn(
        "within", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    )
    totals = parted.groupBy("source", "part").agg(F.sum("size").alias("total"))
    along = Window.partitionBy("source").orderBy("part")
    moved = totals.withColumn(
        "shift", F.sum("total").over(along.rowsBetween(Window.unboundedPreceding, 0)) - F.col("total")
    ).select(F.col("source").alias("s"), F.col("part").alias("p"), "shift")
    return (
        local.join(moved.hint("merge"), F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
        .withColumn("start", F.col("shift") + F.col("within"))
        .drop("s", "p", "shift", "within")
    )


# Rounds of the permutation, and steps by which it walks back into its range.
_ROUNDS = 6
_WALK = 32


def permuted(index: Column, n: Column, key: Column) -> Column:
    """The place of an index in a pseudorandom permutation of [0, n), a
    different one for each key.

    A Feistel network over a grid of a by b cells, a the root of n rounded up
    and b just large enough, permutes [0, a * b). What falls on the fewer than a
    cells beyond n goes through it again until it does not, which keeps it a
    permutation of [0, n). That takes at most one step more than there are such
    cells; a step fails with a probability below 1 / a.
    """

    def turn(number: int, side: str, other: str, size: Column) -> Callable[[Column], Column]:
        """One side moves by a hash of the other."""

        def body(s: Column) -> Column:
            moved = F.pmod(s[side] + F.pmod(F.xxhash64(F.lit(SEED + 2 + number), key, s[other]), size), size)
            return F.struct(*[(moved if name == side else s[name]).alias(name) for name in "lr"])

        return body

    def network(x: Column, a: Column, b: Column) -> Column:
        state = F.struct(F.pmod(x, a).alias("l"), F.floor((x - F.pmod(x, a)) / a).cast("long").alias("r"))
        for number in range(_ROUNDS):
            state = let(state, turn(number, *(("l", "r", a) if number % 2 == 0 else ("r", "l", b))))
        return let(state, lambda s: s["l"] + a * s["r"])

    def walked(a: Column, b: Column) -> Column:
        steps = F.sequence(F.lit(1), F.lit(_WALK))
        first = network(index, a, b)
        return let(
            first,
            lambda x: F.when(x < n, x).otherwise(
                F.aggregate(steps, x, lambda at, _: F.when(at < n, at).otherwise(network(at, a, b)))
            ),
        )

    root = F.ceil(F.sqrt(n.cast("double"))).cast("long")
    place = let(root, lambda a: let(F.ceil(n / a).cast("long"), lambda b: walked(a, b)))
    return let(place, lambda x: F.when(x < n, x).otherwise(F.raise_error(F.lit("permutation did not end")).cast("long")))


def draws(goals: DataFrame, block_words: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """(shard, source, drawn, first): how many slots of each output shard go to
    a source, and how many of that source come before.

    Every slot of a shard draws its source with the targets as odds, which
    makes the counts of a shard multinomial. Over all shards they miss the
    targets by chance; so a source stops when its whole target is drawn, and a
    last shard (-1 in ``shard``) adds what is missing. Goals has source,
    source_size, target.
    """
    everything = Window.partitionBy()
    # Places on the line [0, 1), as wide as the targets.
    order = Window.orderBy(F.col("source").asc_nulls_last())
    upto = F.sum("target").over(order.rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("target").over(everything)
    blocks = F.ceil(F.col("source_size") / block_words).cast("long")
    lines = goals.where("target > 0").select(
        "source",
        # By the words that a block of this source has: the last one may be short.
        F.greatest(F.lit(1).cast("long"), F.round(F.col("target") * blocks / F.col("source_size")).cast("long")).alias("wanted"),
        blocks.alias("blocks"),
        ((upto - F.col("target")) / total).alias("low"),
        F.when(F.row_number().over(order) == F.count("*").over(everything), 1.0)
        .otherwise(upto / total)
        .alias("high"),
    ).withColumn("wanted", F.least("wanted", F.col("blocks") * MAX_REPEATS))
    # Cells let a number find its source by an equi-join.
    cells = 65536
    spread = lines.select(
        "source",
        "low",
        "high",
        F.explode(
            F.sequence(F.floor(F.col("low") * cells), F.least(F.floor(F.col("high") * cells), F.lit(cells - 1)))
        ).alias("cell"),
    )
    slots = F.sum("wanted")
    shards = (
        lines.agg(F.expr(f"cast((coalesce(sum(wanted), 0) + {shard - 1}) div {shard} as bigint)").alias("n"), slots.alias("slots"))
        .where("n > 0")
        .select("slots", F.explode(F.expr("sequence(0L, n - 1)")).alias("shard"))
        .repartition("shard")
    )
    each = shards.select(
        "shard",
        F.explode(F.expr(f"sequence(shard * {shard}, least((shard + 1) * {shard}, slots) - 1)")).alias("slot"),
    ).withColumn("u", _uniform("slot"))
    drawn = (
        # Slots come out of few rows, which look small enough to be broadcast.
        each.withColumn("cell", F.floor(F.col("u") * cells))
        .hint("merge")
        .join(spread, "cell")
        .where("u >= low AND u < high")
        .groupBy("shard", "source")
        .agg(F.count("*").alias("drawn"))
    )
    along = Window.partitionBy("source").orderBy("shard")
    counted = drawn.withColumn(
        "first", F.sum("drawn").over(along.rowsBetween(Window.unboundedPreceding, 0)) - F.col("drawn")
    )
    by_source = drawn.groupBy("source").agg(F.sum("drawn").alias("all"))
    wanted = lines.select(F.col("source").alias("s"), "wanted", "blocks")
    short = (
        wanted.join(by_source, F.col("s").eqNullSafe(F.col("source")), "left")
        .select(
            F.lit(-1).cast("long").alias("shard"),
            F.col("s").alias("source"),
            (F.col("wanted") - F.coalesce("all", F.lit(0))).alias("drawn"),
            F.coalesce("all", F.lit(0).cast("long")).alias("first"),
            "blocks",
        )
        .where("drawn > 0")
    )
    enough = counted.join(wanted, F.col("source").eqNullSafe(F.col("s"))).select(
        "shard", "source", F.least("drawn", F.col("wanted") - F.col("first")).alias("drawn"), "first", "blocks"
    )
    return enough.where("drawn > 0").unionByName(short)


def times(goals: DataFrame, block_words: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """(source, block, times): how often the mix takes each block that it takes.

    The i-th draw of a source takes the block at place i, modulo its blocks, of
    the source's permutation. A source is used up before anything of it comes
    again.
    """
    parts = F.sequence(F.lit(0).cast("long"), F.expr(f"(drawn - 1) div {shard}"))
    slots = (
        saved(draws(goals, block_words, shard), "draws")
        .select("source", "first", "drawn", "blocks", F.explode(parts).alias("part"))
        .repartition(F.col("source"), F.col("first"), F.col("part"))
        .select(
            "source",
            "blocks",
            F.explode(
                F.expr(f"sequence(first + part * {shard}, first + least(drawn, (part + 1) * {shard}) - 1)")
            ).alias("draw"),
        )
    )
    wanted = slots.groupBy("source", "blocks", F.expr("draw % blocks").alias("place")).agg(F.count("*").alias("times"))
    key = F.xxhash64(F.col("source").isNull(), "source")
    return wanted.select("source", permuted(F.col("place"), F.col("blocks"), key).alias("block"), "times")


def pieces(rows: DataFrame, taken: DataFrame, block_words: int = BLOCK) -> DataFrame:
    """The rows with, for each, the word ranges that the mix takes: arrays of
    (from, words, times), in order, and ``taken``, the sum of words times times.
    ``rows`` has source, part, row, key, size, start."""
    names = [F.col(c) for c in rows.columns]
    spread = rows.where("size > 0").select(
        "source",
        "part",
        "row",
        "start",
        "size",
        F.explode(F.expr(f"sequence(start div {block_words}, (start + size - 1) div {block_words})")).alias("block"),
    )
    hit = (
        spread.join(
            taken.toDF("s", "b", "times").hint("merge"), F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b"))
        )
        .withColumn("from", F.greatest(F.lit(0).cast("long"), F.col("block") * block_words - F.col("start")))
        .withColumn(
            "words",
            F.least(F.col("size"), (F.col("block") + 1) * block_words - F.col("start")) - F.col("from"),
        )
    )
    by_row = hit.groupBy(F.col("source").alias("s"), F.col("part").alias("p"), F.col("row").alias("r")).agg(
        F.array_sort(F.collect_list(F.struct("from", "words", "times"))).alias("pieces"),
        F.sum(F.col("words") * F.col("times")).alias("taken"),
    )
    return rows.join(
        by_row.hint("merge"),
        F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")) & (F.col("row") == F.col("r")),
        "left",
    ).select(*names, "pieces", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    block_words: int = BLOCK,
    shard: int = SHARD,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """A row for each document: source, size, key, source_size, target,
    pieces, taken and the columns in ``keep``.

    ``size`` is the number of words, 0 for a NULL text. A source's words are
    laid end to end and cut into blocks; the mix takes blocks, so that a
    document may be taken in parts, but none is taken more than three times.
    NULL is a source like any other. Documents without words are never taken.
    Equal rows are rows of their own. Nothing but the columns named is read.
    """
    sized = saved(
        docs.select(
            "source",
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            _row_key().alias("key"),
            *keep,
        ),
        "sizes",
    )
    rows = saved(packed(sized), "packed")
    goals = saved(
        targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))), "targets"
    )
    taken = saved(times(goals, block_words, shard), "times")
    out = pieces(rows, taken, block_words)
    g = goals.toDF("s", "source_size", "target")
    return out.join(g, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")


def mixed_documents(docs: DataFrame, block_words: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """The documents that the mix consists of, in the columns of ``docs``: for
    every time that parts of a text are taken, a row whose text holds those
    parts with the white space after each word. ``n_chars`` follows the text.
    """
    found = mix(docs, block_words=block_words, shard=shard).where("taken > 0")
    # Equal rows have one key: the n-th of them takes the n-th plan.
    plans = found.groupBy(F.col("key").alias("__key")).agg(
        F.sort_array(F.collect_list(F.struct("part", "row", "pieces"))).alias("__plans")
    )
    token = F.regexp_extract_all(F.col("text"), F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    nth = Window.partitionBy("__key").orderBy("__key")
    rows = (
        docs.withColumn("__key", _row_key())
        .join(plans, "__key")
        .withColumn("__nth", F.row_number().over(nth))
        .withColumn("__pieces", F.get("__plans", F.col("__nth") - 1)["pieces"])
        .where(F.col("__pieces").isNotNull())
        .withColumn("__token", token)
        .withColumn("__most", F.array_max(F.transform("__pieces", lambda p: p["times"])))
        .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__most"))))
    )
    chosen = F.filter("__pieces", lambda p: p["times"] >= F.col("__copy"))
    text = F.array_join(
        F.flatten(
            F.transform(
                chosen,
                lambda p: F.slice(F.col("__token"), p["from"].cast("int") + 1, p["words"].cast("int")),
            )
        ),
        "",
    )
    out = rows.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def _row_key() -> Column:
    """Stands for a row: equal for rows that are equal here."""
    return F.xxhash64("doc_id", "text", F.col("source").isNull(), "source")
