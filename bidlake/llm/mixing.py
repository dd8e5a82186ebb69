"""Mixing sources to target weights, exactly to the word.

Every document gets a hash-random key. Within each source the documents lie in the order of that
key; the key's first digits cut the order into ranges, whose sums come from a pre-aggregation, so
that running totals of sizes need one small window over the ranges of a source and one within a
range. A source of any share of the rows is spread over all ranges.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidlake.llm.common import WORD, text_or_empty
from bidlake.sources.writers import written

# Fixed values of the contract.
WEIGHTS = (5, 2, 1)
SHARE_NUMERATOR, SHARE_DENOMINATOR, MOST = 3, 2, 2
#: Hexadecimal digits of the key that number a range: 4,096 ranges per source.
RANGE_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, key) with the words of each text counted."""
    return docs.select("doc_id", "source", text_or_empty().alias("text")).select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("key")
    )


def targets(totals: DataFrame) -> DataFrame:
    """(source, source_size, target, budget) of totals(source, source_size), one row per source.

    Sources in code-point order, null last, weigh 5, 2, 1, repeating. The sources that reach twice
    their size first are those of least size for their weight, so one pass in that order, with whole
    numbers, finds them all. One row per source, so the two global windows are over few rows.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onwards = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everyone = Window.partitionBy()
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1).cast("int"))
    exact: Column = F.col("source_size").cast("decimal(38,0)")
    t = totals.withColumn("w", weight.cast("long")).withColumn("ratio", F.col("source_size") / F.col("w"))
    t = t.withColumns({
        "all_size": F.sum("source_size").over(everyone),
        "size_before": F.coalesce(F.sum("source_size").over(before), F.lit(0)),
        "w_left": F.sum("w").over(onwards),
        "turn": F.row_number().over(by_ratio),
    })
    # Twice the words left to share out when this source's turn comes.
    left = SHARE_NUMERATOR * F.col("all_size") - SHARE_DENOMINATOR * MOST * F.col("size_before")
    t = t.withColumn("left", left).withColumn(
        "full", SHARE_DENOMINATOR * MOST * exact * F.col("w_left") <= F.col("w") * F.col("left").cast("decimal(38,0)")
    )
    # What is left after the last full source is shared by the weights of the others.
    rest = F.struct("turn", "left", "w_left")
    t = t.withColumn("at", F.min(F.when(~F.col("full"), rest)).over(everyone))
    share = F.col("w") * F.col("at.left") / (SHARE_DENOMINATOR * F.col("at.w_left")).cast("double")
    whole = F.expr(f"(w * at.left) div ({SHARE_DENOMINATOR} * at.w_left)")
    return t.select(
        "source", "source_size", F.when(F.col("full"), (MOST * F.col("source_size")).cast("double")).otherwise(share).alias("target"),
        F.when(F.col("full"), MOST * F.col("source_size")).otherwise(whole).alias("budget"),
    )


def mix(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken, before, budget) of every row of docs(doc_id, source, text).

    `taken` is the words the mix takes of the document, repeats counted: whole passes over the source,
    then one more up to the source's exact budget, which may end inside a document. Documents of one
    source with equal keys (repeated ids) go by size; rows equal in both are alike in all that is
    returned but `taken`, of which it does not matter which of them gets it. A null text has size 0,
    a null source is a source of its own, other columns are not read. An empty table gives an empty one. Of a text only its
    number of words goes on, so long texts need no memory beyond their row.
    """
    sized = written(sizes(docs), "sizes").withColumn("range", F.substring("key", 1, RANGE_DIGITS))
    ranges = sized.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    by_range = Window.partitionBy("source").orderBy("range")
    ranges = ranges.withColumn("range_before", F.sum("range_size").over(by_range) - F.col("range_size"))
    aims = targets(ranges.groupBy("source").agg(F.sum("range_size").alias("source_size")))
    within = Window.partitionBy("source", "range").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = sized.withColumn("in_range", F.sum("size").over(within) - F.col("size"))
    ranges = ranges.withColumnRenamed("source", "s").withColumnRenamed("range", "r")
    aims = aims.withColumnRenamed("source", "t")
    rows = rows.join(
        ranges.join(aims, F.col("s").eqNullSafe(F.col("t"))), F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r"))
    )
    rows = rows.withColumn("before", F.col("range_before") + F.col("in_range"))
    passes = F.expr("IF(source_size > 0, budget div source_size, 0)")
    rest = F.col("budget") - passes * F.col("source_size")
    taken = passes * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    return rows.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), "before", "budget", "source")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of docs in the mix, with all their columns: each as often as the mix takes it.

    A document that the budget ends in is in once more, whole, if at least half of it is taken; texts without
    words take none of the budget and stay once. Rows of equal id and size are taken as often as one of them says. So a source's words miss
    its budget by half of one document at most where ids differ, and by the size of the rows that share an id and a size otherwise. An empty table gives
    an empty one.
    """
    mine = docs.columns
    taken = mix(docs).select(
        F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__size"),
        F.when(F.col("size") == 0, 1).otherwise(F.expr("(2 * taken + size) div (2 * size)")).cast("int").alias("__times"),
    ).groupBy("__id", "__source", "__size").agg(F.max("__times").alias("__times")).filter("__times > 0")
    rows = docs.withColumn("__words", word_count(text_or_empty())).join(
        taken, F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("source").eqNullSafe(F.col("__source")) & (F.col("__words") == F.col("__size"))
    )
    return rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(*mine)
