"""Products bought or viewed together.

A basket is a user's lifetime of completed purchases, or the products viewed in
a session. The number of pairs of a basket grows with the square of its size, so
pairs are not simply generated for every basket:

* Rare items first. For the overall best pairs, a lower bound on the count of
  the n-th best pair is taken from the most common items. An item in fewer baskets
  than that cannot be part of a best pair and is left out.
* Giant baskets, however many, generate no item pairs. Each item has its giants as bits of 64-bit words,
  and two items share the bits that both have. Pairs that no other basket holds are found between classes of items
  with the same giants: of a class only the first items by id can rank among the best. Two classes meet in a giant only
  where enough later giants are left in both lists to reach the bound of one of them, the rest of the baskets is counted from the words.
* Other baskets that are larger than a block are cut into blocks, and each pair of
  blocks is a separate row, placed on its own.

All three are exact: the result equals counting every pair of every basket. For the best partners of each item, which
need every pair of the ordinary baskets, items are numbered in the order of their ids, so that pairs are two numbers until the best are known.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.session import dealt, materialize, tasks_for

COMMON_ITEMS = 32
WORD = 64
#: Pairs that a task makes or counts.
PAIRS_OF_TASK = 1_000_000
#: Parts of the baskets of a task.
PARTS = 16


def purchase_baskets(lines: DataFrame) -> DataFrame:
    """Distinct products per user over completed orders."""
    return (
        lines.where(F.col("status") == "completed")
        .select(F.col("user_id").alias("basket"), F.col("product_id").alias("item"))
        .na.drop()
        .distinct()
    )


def view_baskets(viewed: DataFrame) -> DataFrame:
    """Distinct products viewed per session."""
    return viewed.select(F.col("session_id").alias("basket"), F.col("product_id").alias("item")).na.drop().distinct()


def _within(array: str) -> Column:
    """The elements after the current one; for use after ``posexplode`` of a sorted array."""
    return F.slice(array, F.col("pos") + 2, F.size(array))


def _support_bound(baskets: DataFrame, support: DataFrame, n: int) -> int:
    """A lower bound on the count of the n-th best pair, at least 1."""
    common = support.orderBy(F.desc("support"), "item").limit(COMMON_ITEMS).select("item")
    counts = (
        baskets.join(F.broadcast(common), "item")
        .groupBy("basket")
        .agg(F.array_sort(F.collect_list("item")).alias("items"))  # at most COMMON_ITEMS
        .select("items", F.posexplode("items").alias("pos", "a"))
        .select("a", F.explode(_within("items")).alias("b"))
        .groupBy("a", "b")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"))
        .limit(n)
    )
    return counts.agg(F.when(F.count("*") == n, F.min("n")).otherwise(1)).first()[0]


def _width(df: DataFrame, tasks: int | None) -> int:
    """At least the session's shuffle width, kept as it is: few bytes of baskets become many pairs."""
    return max(tasks or 1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _placed(rows: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    """The rows by their keys to tasks, with the ``part`` of a task that they are in: several, so that tasks get about as many rows each."""
    width = _width(rows, tasks)
    return rows.withColumn("part", F.pmod(F.xxhash64(*keys), F.lit(width * PARTS))).repartition(width, "part")


def _small_basket_pairs(light: DataFrame, tasks: int | None = None) -> DataFrame:
    """All pairs of ``entry`` of baskets that fit a block, as ``part, x, y``; entries are ordered by their first field."""
    return (
        _placed(light, tasks, "basket")
        .groupBy("part", "basket")
        .agg(F.array_sort(F.collect_list("entry")).alias("entries"))
        .select("part", "entries", F.posexplode("entries").alias("pos", "x"))
        .select("part", "x", F.explode(_within("entries")).alias("y"))
    )


def _block_pairs(light: DataFrame, large: DataFrame, tasks: int | None = None) -> DataFrame:
    """The same for larger baskets, block against block; ``large`` has the number of blocks."""
    cells = light.join(large, "basket")
    cells = (
        cells.withColumn("block", F.pmod(F.xxhash64("entry"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
        .select(
            "basket",
            F.least("block", "other").alias("lo"),
            F.greatest("block", "other").alias("hi"),
            "block",
            "entry",
        )
    )
    # By all three, so that the blocks of one basket spread over tasks.
    cells = (
        _placed(cells, tasks, "basket", "lo", "hi")
        .groupBy("part", "basket", "lo", "hi")
        .agg(
            F.array_sort(F.collect_list(F.when(F.col("block") == F.col("lo"), F.col("entry")))).alias("left"),
            F.collect_list(F.when((F.col("block") == F.col("hi")) & (F.col("lo") != F.col("hi")), F.col("entry"))).alias(
                "right"
            ),
        )
    )
    partners = F.when(F.col("lo") == F.col("hi"), _within("left")).otherwise(F.col("right"))
    return cells.select("part", "lo", "hi", "left", "right", F.posexplode("left").alias("pos", "x")).select(
        "part", "x", F.explode(partners).alias("y")
    )


def _pair_branches(light: DataFrame, sizes: DataFrame, block: int, largest: int, tasks: int | None = None) -> list[DataFrame]:
    """Pairs of all baskets of ``light`` as ``part, x, y``, by themselves for small and large baskets; ``largest`` is the size of the largest."""
    if largest <= block:
        return [_small_basket_pairs(light, tasks)]
    large = sizes.where(F.col("size") > block).select("basket", F.ceil(F.col("size") / block).alias("blocks"))
    return [_small_basket_pairs(light.join(large, "basket", "left_anti"), tasks), _block_pairs(light, large, tasks)]


def _basket_pairs(light: DataFrame, sizes: DataFrame, block: int, largest: int) -> DataFrame:
    """Pairs of all baskets of ``light`` as ``x, y``."""
    return reduce(DataFrame.unionByName, _pair_branches(light, sizes, block, largest)).select("x", "y")


def _counted(branches: list[DataFrame], tasks: int | None) -> DataFrame:
    """``a, b, n`` of pairs of items. Many pairs are first counted in the tasks that make them, so that a frequent one
    moves at most once for each part, and then by the pair in tasks that their number sets."""
    x, y = F.col("x.item"), F.col("y.item")
    a, b = F.least(x, y).alias("a"), F.greatest(x, y).alias("b")
    if not tasks:
        return reduce(DataFrame.unionByName, branches).groupBy(a, b).agg(F.count("*").alias("n"))
    made = [pairs.groupBy("part", a, b).agg(F.count("*").alias("n")).select("a", "b", "n") for pairs in branches]
    return dealt(reduce(DataFrame.unionByName, made), tasks, "a", "b").groupBy("a", "b").agg(F.sum("n").alias("n"))


def _giant_words(inside: DataFrame) -> DataFrame:
    """The giants of each item as bits: one row per item and word that has any."""
    bit = F.expr(f"shiftleft(1L, cast(giant % {WORD} AS int))")
    word = F.expr(f"giant div {WORD}").alias("word")
    return inside.select("item", word, bit.alias("bit")).groupBy("item", "word").agg(F.bit_or("bit").alias("bits"))


def _shared(pairs: DataFrame, words: DataFrame, x: str, y: str, *keep: Column) -> DataFrame:
    """``x, y`` with the number of giants that hold both, and aggregates of the other columns."""
    left = words.select(F.col("item").alias(x), "word", F.col("bits").alias("x_bits"))
    right = words.select(F.col("item").alias(y), "word", F.col("bits").alias("y_bits"))
    both = F.bit_count(F.col("x_bits").bitwiseAND(F.col("y_bits"))).cast("bigint")
    return (
        pairs.join(left, x, "left")
        .join(right, [y, "word"], "left")
        .groupBy(x, y)
        .agg(*keep, F.coalesce(F.sum(both), F.lit(0)).alias("shared"))
    )


def _needed(classes: DataFrame, words: DataFrame, keep: int) -> DataFrame:
    """``class, need``: the number of giants that its ``keep``-th best partner shares at least, at least 1.

    Items of a class share all its giants. Otherwise the classes in most giants are asked, as each gives a partner.
    """
    common = classes.orderBy(F.desc("giants"), "class").limit(COMMON_ITEMS).select(F.col("class").alias("other"))
    of_common = words.withColumnRenamed("item", "other").join(F.broadcast(common), "other")
    both = F.bit_count(F.col("bits").bitwiseAND(F.col("other_bits"))).cast("bigint")
    best = (
        words.withColumnRenamed("item", "class")
        .join(classes.select("class"), "class", "left_semi")
        .join(of_common.withColumnRenamed("bits", "other_bits"), "word")
        .where("class <> other")
        .groupBy("class", "other")
        .agg(F.sum(both).alias("shared"))
        .groupBy("class")
        .agg(F.sort_array(F.collect_list("shared"), asc=False).alias("counts"))  # at most COMMON_ITEMS
        .select("class", F.get("counts", F.lit(keep - 1)).alias("count"))
    )
    own = F.when(F.col("members") > keep, F.col("giants"))
    return classes.join(best, "class", "left").select("class", F.greatest(own, "count", F.lit(1)).alias("need"))


def _class_pairs(
    classes: DataFrame, inside: DataFrame, needed: DataFrame, words: DataFrame, bound: int, block: int
) -> DataFrame:
    """``c, d, shared`` for classes of which one may have a best partner in the other; ``c <= d``. ``bound`` is the least ``need``."""
    # Giants are numbered by size. Of a class and the first giant it shares with another, ``left`` giants are still to come.
    left = F.row_number().over(Window.partitionBy("class").orderBy(F.desc("giant"))).cast("bigint")
    cells = (
        inside.withColumnRenamed("item", "class")
        .join(needed, "class")
        .withColumn("left", left)
        .where(F.col("left") >= bound)
        .select(F.col("giant").alias("basket"), F.struct("class", "left", "need").alias("entry"))
    )
    cells = materialize(cells, "giant-classes")
    sizes = _sizes(cells)
    largest = sizes.agg(F.max("size")).first()[0] or 0
    met = (
        _basket_pairs(cells, sizes, block, largest)
        .where("least(x.left, y.left) >= least(x.need, y.need)")
        .select(F.least("x.class", "y.class").alias("c"), F.greatest("x.class", "y.class").alias("d"))
        .distinct()
    )
    own = classes.where("members > 1").select(F.col("class").alias("c"), F.col("class").alias("d"), F.col("giants").alias("shared"))
    return _shared(met, words, "c", "d").unionByName(own)


def _giant_candidates(inside: DataFrame, words: DataFrame, keep: int, bound: int | None, block: int) -> DataFrame:
    """``a, b`` of the pairs that rank among the best by the giants alone.

    A pair that no ordinary basket holds is outranked by whatever outranks it here. ``bound`` is the least count of a best pair overall; None asks for
    the best partners of each item.
    """
    entries = F.array_sort(F.collect_list(F.struct("word", "bits")))  # one word for 64 giants
    sets = words.groupBy("item").agg(entries.alias("set"), F.sum(F.bit_count("bits")).alias("giants"))
    classes = sets.groupBy("set").agg(
        F.min("item").alias("class"), F.count("*").alias("members"), F.first("giants").alias("giants")
    )
    of_class = materialize(sets.select("item", "set").join(classes, "set").drop("set"), "giant-items")
    classes = of_class.where("item = class").drop("item")
    if bound is None:
        needed = _needed(classes, words, keep)
    else:
        needed = classes.select("class", F.lit(bound).cast("bigint").alias("need"))
    pairs = _class_pairs(classes, inside, needed, words, bound or 1, block)
    # The first items of each class; one more than asked for, as an item is no partner of itself.
    by_id = F.row_number().over(Window.partitionBy("class").orderBy("item"))
    first = of_class.withColumn("position", by_id).where(F.col("position") <= keep + 1)
    if bound is None:
        both_ways = pairs.unionByName(pairs.where("c <> d").select(F.col("d").alias("c"), F.col("c").alias("d"), "shared"))
        by_shared = F.row_number().over(Window.partitionBy("c").orderBy(F.desc("shared"), "y"))
        best = (
            both_ways.join(first.select(F.col("class").alias("d"), F.col("item").alias("y")), "d")
            .withColumn("position", by_shared)
            .where(F.col("position") <= keep + 1)
            .select("c", "y")
        )
        found = of_class.select(F.col("class").alias("c"), F.col("item").alias("x")).join(best, "c")
    else:
        # Each of these pairs of classes has a pair of items that outranks those of later ones.
        best = pairs.where(F.col("shared") >= bound).orderBy(F.desc("shared"), "c", "d").limit(keep).select("c", "d")
        found = best.join(first.select(F.col("class").alias("c"), F.col("item").alias("x")), "c").join(
            first.select(F.col("class").alias("d"), F.col("item").alias("y")), "d"
        )
    return found.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def _numbered(baskets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The baskets with numbers for items, in the order of their ids, and ``number, item``."""
    number = F.monotonically_increasing_id().alias("number")
    names = materialize(baskets.select("item").distinct().orderBy("item").select(number, "item"), "items")
    return baskets.join(names, "item").select("basket", F.col("number").alias("item")), names


def _sizes(baskets: DataFrame) -> DataFrame:
    return baskets.groupBy("basket").agg(F.count("*").alias("size"))


def _pair_counts(
    baskets: DataFrame, sizes: DataFrame, keep: int, per_item: bool, giant_size: int, block: int
) -> tuple[DataFrame, int | None]:
    """``a, b, baskets`` for every pair that can be among the ``keep`` best, and the tasks that the number of pairs asks for.

    ``per_item`` asks for the best partners of each item instead of the best pairs overall.
    The number of giants and the bound are fetched first, so the usual plan has no branch for giants or blocks.
    """
    giant = F.col("size") > giant_size
    pairs_of = F.when(~giant, F.expr("size * (size - 1) div 2"))
    giants, largest, made = sizes.agg(F.count_if(giant), F.max(F.when(~giant, F.col("size"))), F.sum(pairs_of)).first()
    bound = None
    kept = baskets
    if not per_item:
        support = baskets.groupBy("item").agg(F.count("*").alias("support"))
        bound = _support_bound(baskets, support, keep)
        if bound > 1:
            kept = baskets.join(support.where(F.col("support") >= bound).select("item"), "item", "left_semi")
    light = kept
    if giants:
        number = F.monotonically_increasing_id().alias("giant")  # smaller giants first: fewer classes meet there
        numbers = materialize(sizes.where(giant).orderBy("size", "basket").select("basket", number), "giants")
        inside = materialize(kept.join(numbers, "basket").select("item", "giant"), "giant-rows")
        light = kept.join(numbers, "basket", "left_anti")

    tasks = tasks_for(baskets.sparkSession, made or 0, PAIRS_OF_TASK)
    entries = light.select("basket", F.struct("item").alias("entry"))
    pairs = _counted(_pair_branches(entries, sizes, block, largest or 0, tasks), tasks)
    if not giants:
        return pairs.withColumnRenamed("n", "baskets"), tasks
    words = materialize(_giant_words(inside), "giant-words")
    candidates = _giant_candidates(inside, words, keep, bound, block).withColumn("n", F.lit(0).cast("bigint"))
    once = pairs.unionByName(candidates).groupBy("a", "b").agg(F.max("n").alias("n"))
    counted = _shared(once, words, "a", "b", F.first("n").alias("n"))
    return counted.select("a", "b", (F.col("n") + F.col("shared")).alias("baskets")), tasks


def top_pairs(baskets: DataFrame, n: int = 10, giant_size: int = 2_000, block: int = 500) -> DataFrame:
    """The ``n`` pairs found in most baskets; ties go by id."""
    baskets = materialize(baskets, "baskets")
    return (
        _pair_counts(baskets, _sizes(baskets), n, False, giant_size, block)[0]
        .orderBy(F.desc("baskets"), "a", "b")
        .limit(n)
        .select(F.col("a").alias("product_a"), F.col("b").alias("product_b"), F.col("baskets").alias("pair_count"))
    )


def best_partners(baskets: DataFrame, n: int = 3, giant_size: int = 2_000, block: int = 500) -> DataFrame:
    """For every item the ``n`` items it shares most baskets with; ties go by id."""
    baskets = materialize(baskets, "baskets")
    numbered, names = _numbered(baskets)
    pairs, tasks = _pair_counts(numbered, _sizes(baskets), n, True, giant_size, block)
    sides = F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")), F.struct(F.col("b").alias("x"), F.col("a").alias("y"))))
    position = F.row_number().over(Window.partitionBy("x").orderBy(F.desc("baskets"), "y"))
    both = pairs.select(sides.alias("side"), "baskets").select("side.*", "baskets")
    return (
        # each pair has two sides; an item has a row for each of its partners at most
        dealt(both, tasks and 2 * tasks, "x")
        .withColumn("position", position.cast("bigint"))
        .where(F.col("position") <= n)
        .join(names.select(F.col("number").alias("x"), F.col("item").alias("product_id")), "x")
        .join(names.select(F.col("number").alias("y"), F.col("item").alias("other_id")), "y")
        .select("product_id", "position", "other_id", F.col("baskets").alias("pair_count"))
    )
