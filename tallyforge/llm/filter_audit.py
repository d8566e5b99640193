"""What each of five filters removes, alone and after others, in every order of application.

The filters of a text (a null counts as empty; words are runs of anything but ASCII white space):

    A  fewer than ``least_words`` words
    B  distinct words less than ``least_distinct`` in a hundred words
    C  capitals A-Z more than ``most_capitals`` in a hundred code points
    D  a character of ``forbidden``
    E  the text of any row with a smaller key, removed or not

1.  A to D are a bit mask per row, made in one scan by built-in expressions.
2.  E is an existential self-join.  Hashes that occur once cannot repeat a text, so only rows of
    repeated hashes are kept, with their texts.  Their smallest key per text is combined before its
    shuffle; each row is then left-semi joined on hash, exact text and smaller key.  A text with many
    copies is dealt over as many slots as its count asks for, so a group of copies is spread evenly.
3.  The ids E finds and those of the other failures are united and aggregated to one mask per row.
4.  Rows are counted per part and mask: 32 cells a part.  All 120 orders follow from these cells, as
    what an order keeps depends on the set of filters applied, not on the rows.

Defined results.  A null key has no smaller key and is no smaller key, so E never marks its row; it
counts in every other way and has no label.  Rows that repeat a key, a part and a text count once
each; E marks none of them for the others.  A label table that repeats a key counts a row as good or
toxic if any of its labels says so.  A null part is the empty string.  Texts of any length are taken
whole.  An empty table gives no rows.  Other columns of either table are ignored, whatever their
names.  Two rows of one key and part whose texts differ but share a 64-bit hash would share their mask.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import need
from tallyforge.operators.materialize import materialize

FILTERS = "ABCDE"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Copies of a text that one slot of the self-join takes.
COPIES_PER_SLOT = 1_000


def _bit(letter: str) -> int:
    return 1 << FILTERS.index(letter)


def failing_alone(
    text: Column, least_words: int = 200, least_distinct: int = 50, most_capitals: int = 2, forbidden: str = "#$%&*|"
) -> Column:
    """The mask of A to D for a text that is not null."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def by_words(w: Column) -> Column:
        few = F.when(F.size(w) < least_words, _bit("A")).otherwise(0)
        same = 100 * F.size(F.array_distinct(w)) < least_distinct * F.size(w)
        return few + F.when(same, _bit("B")).otherwise(0)

    # The words of a row are made once, though two filters read them.
    counted = F.get(F.transform(F.array(words), by_words), 0)
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    loud = 100 * capitals.cast("bigint") > most_capitals * F.length(text).cast("bigint")
    odd = F.lit(False)
    for character in forbidden:
        odd = odd | F.contains(text, F.lit(character))
    return counted + F.when(loud, _bit("C")).otherwise(0) + F.when(odd, _bit("D")).otherwise(0)


def repeating(rows: DataFrame) -> DataFrame:
    """Of (key, part, text, hash), the rows whose text a smaller key has, without the text."""
    repeated = rows.groupBy("hash").agg(F.count("*").alias("copies")).where("copies > 1")
    suspects = materialize(rows.where("key is not null").join(repeated, "hash"), "suspects")
    slots = F.ceil(F.col("copies") / COPIES_PER_SLOT).cast("bigint")
    first = suspects.groupBy("hash", "text", "copies").agg(F.min("key").alias("least"), F.count("*").alias("n"))
    first = first.where("n > 1").select(
        F.col("hash").alias("hash_"), F.col("text").alias("text_"), "least",
        F.explode(F.sequence(F.lit(0).cast("bigint"), slots - 1)).alias("slot_"),
    )
    suspects = suspects.withColumn("slot", F.pmod(F.xxhash64("key"), slots))
    same = (F.col("hash") == F.col("hash_")) & (F.col("slot") == F.col("slot_")) & (F.col("text") == F.col("text_"))
    found = suspects.join(first, same & (F.col("least") < F.col("key")), "left_semi")
    return found.select("key", "part", "hash")


def failures(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source", **limits) -> DataFrame:
    """(key, part, hash, fails, n): the mask of all five filters for each key, part and text, and its rows."""
    rows = need(docs, key, text, part).toDF("key", "text", "part").select(
        "key",
        F.coalesce("part", F.lit("")).alias("part"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    rows = rows.withColumn("hash", F.xxhash64("text"))
    alone = rows.select("key", "part", "hash", failing_alone(F.col("text"), **limits).alias("fails"), F.lit(1).alias("n"))
    copies = repeating(rows).select("key", "part", "hash", F.lit(_bit("E")).alias("fails"), F.lit(0).alias("n"))
    united = alone.union(copies).groupBy("key", "part", "hash")
    return united.agg(F.bit_or("fails").alias("fails"), F.sum("n").alias("n"))


def combinations(failed: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """(part, fails, n, good, toxic): documents per part and mask, and how many are labelled so."""
    yes = need(labels, key, "quality", "toxic").toDF("key", "quality", "toxic").where("key is not null")
    yes = yes.groupBy(F.col("key").alias("label_key")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    yes = yes.where("good + toxic > 0").withColumn("label_spread", F.lit(0))
    # Rows without a key have no label; they are dealt by their text, so that null is no hot key.
    failed = failed.withColumn("spread", F.when(F.col("key").isNull(), F.pmod("hash", F.lit(1000))).otherwise(0).cast("int"))
    told = failed.join(yes, (F.col("key") == F.col("label_key")) & (F.col("spread") == F.col("label_spread")), "left")
    return told.groupBy("part", "fails").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
    )


def every_order(cells: DataFrame) -> DataFrame:
    """The rows of the audit from the cells of each part, at most 32."""
    zero, masks = F.lit(0).cast("bigint"), F.sequence(F.lit(0), F.lit((1 << len(FILTERS)) - 1))

    def total(of: str, counts) -> Column:
        return F.aggregate("cells", zero, lambda s, c: s + F.when(counts(c), c[of]).otherwise(zero))

    def passing(of: str) -> Column:
        """Documents that no filter of a mask fails, at the mask's place."""
        return F.transform(masks, lambda m: total(of, lambda c: c["fails"].bitwiseAND(m) == 0))

    def alone() -> Column:
        return F.transform(masks, lambda m: total("n", lambda c: c["fails"] == m))

    orders = 120
    shares = F.transform(
        F.sequence(F.lit(0), F.lit(len(FILTERS) - 1)),
        # A document that k filters fail is removed by each of them in one k-th of the orders.
        lambda i: F.aggregate(
            "cells", zero,
            lambda s, c: s + F.when(
                F.call_function("shiftright", c["fails"], i).bitwiseAND(1) == 1,
                c["n"] * F.get(F.array(*[F.lit(orders // max(k, 1)) for k in range(6)]), F.bit_count(c["fails"])),
            ).otherwise(zero),
        ),
    )
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("cells"))
    parts = parts.select(
        "part", passing("n").alias("left"), passing("good").alias("good"), passing("toxic").alias("toxic"),
        alone().alias("only"), shares.alias("shares"),
        F.explode(F.split(F.lit(",".join(map("".join, permutations(FILTERS)))), ",")).alias("filter_order"),
    )
    steps = parts.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))

    def mask(letters: Column) -> Column:
        return sum((F.when(F.contains(letters, F.lit(f)), _bit(f)).otherwise(0) for f in FILTERS), F.lit(0))

    filters = F.col("filter_order")
    steps = steps.select(
        "*",
        mask(filters.substr(F.lit(1), F.col("step") - 1)).alias("before"),
        mask(filters.substr(F.lit(1), F.col("step"))).alias("after"),
        mask(filters.substr(F.col("step"), F.lit(1))).alias("own"),
    )
    fails = F.get("left", F.lit(0)) - F.get("left", F.col("own"))
    removed = F.get("left", F.col("before")) - F.get("left", F.col("after"))
    return steps.select(
        "part", "filter_order", "step",
        F.get("left", F.col("after")).alias("kept"),
        removed.alias("removed"),
        (fails - removed).alias("redundant"),
        F.get("only", F.col("own")).alias("unique_fails"),
        (F.get("good", F.col("before")) - F.get("good", F.col("after"))).alias("good_lost"),
        (F.get("toxic", F.col("before")) - F.get("toxic", F.col("after"))).alias("toxic_lost"),
        F.get("shares", F.log2("own").cast("int")).alias("shapley"),
    )


def audit_filters(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source", **limits) -> DataFrame:
    """One row per part, order of the filters and step; ``limits`` are those of ``failing_alone``."""
    return every_order(combinations(failures(docs, key, text, part, **limits), labels, key))
