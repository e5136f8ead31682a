"""What several operators of this package share: written intermediate tables
and connected groups from candidate buckets."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import storage

# Words of the result contracts: runs without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# Deletes the shuffle files of a query when it ends, instead of when the driver
# happens to collect its plan.
_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, label: str, release: bool = False) -> DataFrame:
    """The rows as a table in the shared scratch folder. Later uses read the
    table: they neither repeat the work nor depend on executors that are lost.
    A table without rows keeps its columns. ``release`` deletes the shuffle
    files of the write at once; nothing reads them once the table is there."""
    spark = df.sparkSession
    path = storage.scratch(spark, label)
    before = spark.conf.get(_RELEASE)
    if release:
        spark.conf.set(_RELEASE, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_RELEASE, before)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Deletes tables that ``saved`` has written and nothing reads any more."""
    for table in tables:
        for path in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            storage.delete_tree(table.sparkSession, path)


def words(text: Column) -> Column:
    """The words of a text, in order; none for NULL."""
    return F.coalesce(
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)),
        F.array().cast("array<string>"),
    )


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """An expression in which a value is computed once and used several times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the smallest
    node that it is connected with.

    Alternating stars: every node first hands its larger neighbours, then all
    of its smaller ones, to the smallest neighbour it knows, until every link
    leads to a root. Rounds grow with the logarithm of the longest chain. Each
    step is an aggregate and an equi-join on a node, so that a hub is combined
    before the shuffle and split by adaptive execution after it.
    """
    current = saved(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
        release=True,
    )
    while not current.isEmpty():
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.join(least.select("u", F.least("u", "m").alias("m")), "u")
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        down = saved(large, "links-down", release=True)
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            down.join(least, "u")
            .where(F.col("v") != F.col("m"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        before, current = current, saved(small, "links", release=True)
        dropped(before, down)
        if _all_at_roots(current):
            break
    nodes = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _shared(keys: DataFrame) -> DataFrame:
    """The rows (bucket, id) whose bucket holds another id, too."""
    several = (
        keys.groupBy("bucket")
        .agg(F.min("id").alias("low"), F.max("id").alias("high"))
        .where(F.col("low") != F.col("high"))
        .select("bucket")
    )
    return keys.join(several, "bucket").distinct()


def _all_at_roots(links: DataFrame) -> bool:
    """Whether each node has one link, to a node that has none itself."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("out")).unionByName(
        links.select(F.col("v").alias("node"), F.lit(0).alias("out")).distinct()
    )
    kinds = ends.groupBy("node").agg(F.sum("out").alias("n"), F.min("out").alias("root"))
    return kinds.where((F.col("n") > 1) | ((F.col("n") == 1) & (F.col("root") == 0))).isEmpty()


def in_parts(table: DataFrame, buckets: str, size: int, parts: int) -> list[DataFrame]:
    """(bucket, id): the buckets of each row's list by their place in it, in
    parts of a few places each. Equal buckets must have equal places."""
    each = -(-size // parts)
    cut = [F.slice(buckets, 1 + at, each) for at in range(0, size, each)]
    return [table.select(F.explode(c).alias("bucket"), "id") for c in cut]


def _placed(members: DataFrame, roots: DataFrame | None) -> DataFrame:
    """The rows (bucket, id) with their group, themselves at first."""
    if roots is None:
        return members.withColumn("root", F.col("id"))
    known = members.join(roots, members["id"] == roots["node"], "left")
    return known.select("bucket", "id", F.coalesce("root", "id").alias("root"))


def _stars(placed: DataFrame, sketches: DataFrame, number: int, plausible: Callable[[str, str], Column]) -> DataFrame:
    """The pairs (a, b) of a row and the row that its bucket picks."""
    ranked = placed.withColumn("h", F.xxhash64(F.lit(number), "bucket", "id"))
    leads = (
        ranked.groupBy("bucket")
        .agg(
            F.min_by("id", "h").alias("lead"),
            F.min_by("root", "h").alias("lead_root"),
            F.min("root").alias("low"),
            F.max("root").alias("high"),
        )
        .where(F.col("low") != F.col("high"))
        .select("bucket", "lead", "lead_root")
        .join(sketches.toDF("lead", "lead_sketch"), "lead")
    )
    return (
        placed.join(sketches, "id")
        .join(leads, "bucket")
        .where((F.col("root") != F.col("lead_root")) & plausible("sketch", "lead_sketch"))
        .select(F.least("id", "lead").alias("a"), F.greatest("id", "lead").alias("b"))
    )


def _between(placed: DataFrame, sketches: DataFrame, plausible: Callable[[str, str], Column]) -> DataFrame:
    """The pairs (a, b) of rows of different groups that share a bucket."""
    mixed = (
        placed.groupBy("bucket")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"))
        .where(F.col("low") != F.col("high"))
        .select("bucket")
    )
    several = placed.join(mixed, "bucket").join(sketches, "id").select("bucket", "id", "root", "sketch")
    left = several.toDF("bucket", "left", "left_root", "left_sketch")
    right = several.toDF("bucket", "right", "right_root", "right_sketch")
    return (
        left.join(right, "bucket")
        .where((F.col("left_root") < F.col("right_root")) & plausible("left_sketch", "right_sketch"))
        .select(F.least("left", "right").alias("a"), F.greatest("left", "right").alias("b"))
    )


def _distinct(parts: Sequence[DataFrame], label: str, tested: DataFrame | None) -> DataFrame:
    """The pairs (a, b) of all parts, each once, without those tested before.
    Several parts are written one after another."""
    pairs = [saved(part.distinct(), label, release=True) for part in parts] if len(parts) > 1 else []
    every = reduce(DataFrame.unionByName, pairs or parts).distinct()
    out = saved(every if tested is None else every.join(tested, ["a", "b"], "left_anti"), label, release=True)
    dropped(*pairs)
    return out


def linked_groups(
    keys: Sequence[DataFrame],
    contents: Callable[[DataFrame], DataFrame],
    verify: Callable[[DataFrame, DataFrame], DataFrame],
    plausible: Callable[[str, str], Column],
    rounds: int = 1,
    written: Sequence[DataFrame] = (),
    moves: int = 1,
) -> DataFrame:
    """(node, root) of the groups that verified links make among rows that
    share a bucket. ``keys`` are tables (bucket, id) that have no bucket in
    common; their shuffles lie on disk one after another. ``contents`` gives what is to be
    compared for a table of ids, and a sketch of it; ``plausible`` tells from
    two sketches, by the names of their columns, whether a link is possible;
    ``verify`` takes candidate pairs (a, b), each once, with the contents, and
    returns the pairs that hold. ``written`` are tables that only the keys are
    read from: they are deleted once these are read. Sketches move with the rows
    of the keys' tables dealt to so many ``moves``, one after another.

    In each round a bucket picks one row by hash, and every row of another group
    is held against it, which is linear in the rows. The picks of a row's
    buckets differ, so that even in a family whose members are not all similar
    nearly all are soon connected. Rows that are connected need no further
    comparison; what then still differs within a bucket is compared pair by
    pair, between groups only. So no link between groups is lost, and a bucket
    full of copies of one thing never becomes all of its pairs.
    """
    shared = [saved(_shared(part), "members", release=True) for part in keys]
    members = reduce(DataFrame.unionByName, shared)
    moved = [reduce(DataFrame.unionByName, shared[k::moves]) for k in range(moves)]
    dropped(*written)
    payload = saved(contents(members.select("id").distinct()), "contents", release=True)
    sketches = payload.select("id", "sketch")
    tested = links = roots = None
    for number in range(rounds):
        stars = _distinct([_stars(_placed(part, roots), sketches, number, plausible) for part in moved], "stars", tested)
        found = saved(verify(stars, payload), "star-links", release=True)
        tested = stars if tested is None else tested.unionByName(stars)
        links = found if links is None else links.unionByName(found)
        roots = saved(components(links), "roots", release=True)
    more = verify(_distinct([_between(_placed(part, roots), sketches, plausible) for part in moved], "rest", tested), payload)
    dropped(*shared)
    # Roots stand for their groups: only the new links have to be followed.
    lifted = (
        more.join(roots.toDF("a", "ra"), "a", "left")
        .join(roots.toDF("b", "rb"), "b", "left")
        .select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    )
    upper = saved(components(lifted).toDF("mid", "top"), "upper", release=True)
    known = roots.unionByName(
        upper.join(roots, upper["mid"] == roots["node"], "left_anti").select(
            F.col("mid").alias("node"), F.col("mid").alias("root")
        )
    )
    return known.join(upper, known["root"] == upper["mid"], "left").select(
        "node", F.coalesce("top", "root").alias("root")
    )
