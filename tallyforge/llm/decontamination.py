"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact check.

Only built-in functions are used.  A benchmark item of k shingles is looked for in windows of k
shingles of a document; the similarity of item and window is that of their shingles weighted by how
often each occurs (sum of the smaller weights over sum of the larger ones).

1.  A window can only reach the similarity if that share of the item's k shingles are in it, and then
    they are shingles of items of that size.  So positions that hold such a shingle are looked up
    first, and windows that begin at one and hold enough of them go on: all others are ruled out
    without loss (a window that begins elsewhere can be moved up to the next such position).
2.  These windows and the items get a 64-bit SimHash of their words.  It is cut in ``RADIUS + 1``
    blocks: two fingerprints within the radius agree in at least one block whole, so an equi-join on
    size, block number and block value finds every pair within the radius.
3.  Pairs within the radius are compared exactly, on the text of their shingles.

Word fingerprints of a window and an item at similarity 0.75 differ in some 4 bits for a changed word
and 10 (standard deviation 3) for the longest run that may be replaced; a radius of 23 loses such a
pair once in ten thousand, and lets one in eighty unrelated pairs through to the exact check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import need
from tallyforge.operators.materialize import materialize

SHINGLE, SIMILARITY, RADIUS = 5, 0.75, 23
#: Rows up to this many are sent to all executors (about 50 MB), more are joined by a shuffle.
SENT_ROWS = 1_000_000


def words_of(text: str) -> Column:
    """Runs of anything but ASCII white space, A-Z lower-cased."""
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(lowered, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row, however often the body names it.

    A named column is no such promise: the optimizer may put its expression in place of the name.
    """
    return F.get(F.transform(F.array(value), body), 0)


def shingles_of(words: Column) -> Column:
    """A hash of the shingle at each position; what lies beyond the end of a short text is null in it."""

    def run(hashes: Column) -> Column:
        last = F.greatest(F.size(hashes) - SHINGLE, F.lit(0))
        every = F.transform(
            F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(hashes, i + step) for step in range(SHINGLE)])
        )
        return F.when(F.size(hashes) > 0, every).otherwise(F.array().cast("array<bigint>"))

    return let(F.transform(words, lambda w: F.xxhash64(w)), run)


def fingerprint(words: Column) -> Column:
    """64-bit SimHash of an array of words; a bit is set if more words have it than not."""
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")

    def of(hashes: Column) -> Column:
        def bit(place: Column) -> Column:
            ones = F.aggregate(
                hashes, zero, lambda n, h: n + F.call_function("shiftrightunsigned", h, place).bitwiseAND(one)
            )
            return F.when(2 * ones > F.size(hashes), F.call_function("shiftleft", one, place)).otherwise(zero)

        places = F.transform(F.sequence(F.lit(0), F.lit(63)), bit)
        return F.aggregate(places, zero, lambda a, b: a.bitwiseOR(b))

    return let(F.transform(words, lambda w: F.xxhash64(w)), of)


def blocks(print_: str, radius: int) -> Column:
    """(number, value) of ``radius + 1`` blocks that part the 64 bits as evenly as they go."""
    edges = [round(64 * i / (radius + 1)) for i in range(radius + 2)]
    parts = [
        F.struct(
            F.lit(number).alias("block"),
            F.call_function("shiftrightunsigned", F.col(print_), F.lit(a)).bitwiseAND((1 << (b - a)) - 1).alias("value"),
        )
        for number, (a, b) in enumerate(zip(edges[:-1], edges[1:]))
    ]
    return F.explode(F.array(*parts))


def sent(df: DataFrame, rows: int) -> DataFrame:
    """Marked to be sent to all executors if it has few enough rows."""
    return F.broadcast(df) if rows <= SENT_ROWS else df


def shingle_weights(df: DataFrame, *keys: str) -> DataFrame:
    """How often each shingle, as text, occurs among the words of each key."""
    size = F.size("words")
    starts = F.sequence(F.lit(1), F.greatest(size - SHINGLE + 1, F.lit(1)))
    texts = F.transform(starts, lambda i: F.array_join(F.slice(F.col("words"), i, F.lit(SHINGLE)), " "))
    # Words hold no blank, so that the text of a shingle names its words.
    return df.select(*keys, F.explode(texts).alias("shingle")).groupBy(*keys, "shingle").agg(F.count("*").alias("weight"))


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    similarity: float = SIMILARITY,
    radius: int = RADIUS,
    key: str = "doc_id",
    item: str = "item_id",
) -> DataFrame:
    """One row per document and item found in it: the most similar of the windows that begin with a
    shingle of an item (the first of equal ones).

    Columns: the keys, ``start`` (word number from 0), ``n_words`` and ``similarity``.  An item or
    document of fewer than five words has its whole sequence as one shingle, so such an item is found
    only where it is the whole document.  At the end of a document a window may be shorter than the
    item.  Null or empty texts match nothing; rows with a null key are left out; rows that repeat a
    key must repeat its text and count once.  Empty tables give an empty result.
    """
    items = need(benchmark, item, "text").where(F.col(item).isNotNull()).dropDuplicates([item])
    items = materialize(items.select(F.col(item).alias("item"), words_of("text").alias("words")), "items")
    items = items.where("size(words) > 0").withColumn("size", F.greatest(F.size("words") - SHINGLE + 1, F.lit(1)))
    vocabulary = materialize(items.select(F.explode(shingles_of(F.col("words"))).alias("shingle"), "size").distinct(), "vocabulary")
    vocabulary = sent(vocabulary, vocabulary.count())

    given = need(docs, key, "text").where(F.col(key).isNotNull()).select(F.col(key).alias("doc"), "text")
    places = given.select("doc", F.posexplode(shingles_of(words_of("text"))).alias("place", "shingle"))
    hits = places.join(vocabulary, "shingle").groupBy("doc", "size").agg(
        F.array_sort(F.collect_set("place")).alias("places")
    )
    enough = F.ceil(F.lit(similarity) * F.col("size")).cast("int")
    begins = F.filter(
        F.col("places"),
        lambda place, at: F.coalesce(F.get(F.col("places"), at + enough - 1) < place + F.col("size"), F.lit(False)),
    )
    likely = hits.select("doc", "size", begins.alias("begins")).where("size(begins) > 0")
    likely = materialize(likely, "likely")

    texts = given.join(sent(likely, likely.count()), "doc").withColumn("words", words_of("text"))
    windows = texts.select("doc", "size", "words", F.explode("begins").alias("start")).select(
        "doc", "size", "start", F.slice("words", F.col("start") + 1, F.col("size") + SHINGLE - 1).alias("words")
    )
    windows = windows.dropDuplicates(["doc", "size", "start"]).withColumn("print", fingerprint(F.col("words")))
    windows = materialize(windows, "windows")

    left = windows.select("doc", "size", "start", "print", blocks("print", radius))
    left = left.select("doc", "size", "start", "print", "col.*")
    right = items.withColumn("item_print", fingerprint(F.col("words")))
    right = right.select("item", "size", "item_print", blocks("item_print", radius))
    right = right.select("item", "size", "item_print", "col.*")
    close = left.join(right, ["size", "block", "value"]).where(
        F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= radius
    )
    pairs = close.select("doc", "size", "start", "item").distinct()

    ours = shingle_weights(windows, "doc", "size", "start")
    theirs = shingle_weights(items, "item").withColumnRenamed("weight", "item_weight")
    shared = pairs.join(ours, ["doc", "size", "start"]).join(theirs, ["item", "shingle"])
    shared = shared.groupBy("doc", "size", "start", "item").agg(F.sum(F.least("weight", "item_weight")).alias("both"))
    n_words = F.size("words")
    measured = shared.join(windows.select("doc", "size", "start", n_words.alias("n_words")), ["doc", "size", "start"])
    held = F.greatest(F.col("n_words") - SHINGLE + 1, F.lit(1))
    measured = measured.withColumn("similarity", F.col("both") / (held + F.col("size") - F.col("both")))
    best = measured.where(F.col("similarity") >= similarity).groupBy("doc", "item").agg(
        F.max(F.struct("similarity", -F.col("start"), "n_words")).alias("best")
    )
    return best.select(
        F.col("doc").alias(key),
        F.col("item").alias(item),
        (-F.col("best")["col2"]).alias("start"),
        F.col("best")["n_words"].alias("n_words"),
        F.col("best")["similarity"].alias("similarity"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The documents in which no benchmark item is found, with their columns; null keys stay."""
    found = find_contamination(docs, benchmark, key=key, **options).select(key).distinct()
    found = materialize(found, "contaminated")
    return docs.join(sent(found, found.count()), key, "left_anti")
