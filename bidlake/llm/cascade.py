"""URL filters by Bloom filter cascades.

A cascade holds which keys of a corpus are on a list. Level 0 is a Bloom filter of the listed keys that
occur; level 1 of all other keys of the corpus that level 0 lets through; level 2 of the listed keys
that level 1 lets through; and so on, until nothing is let through wrongly. As it is built over
every key that occurs, it answers exactly for every key that occurs, and the pages are judged
without a join. Its bits grow with the listed keys alone; a list beyond `MOST_BITS` is joined.
"""

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlake.llm.common import LOWER, UPPER
from bidlake.sources.writers import written

HASHES, BITS_PER_KEY, MOST_BITS = 5, 8, 1 << 29

# Fixed values of the contract: (verdict, host, path).
RULES = (
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
)


def _hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(F.lit(1), key)


def _places(a: np.ndarray, b: np.ndarray, level: int, bits: int):
    """The places of each key, one array per hash; other ones at each level, or a level would repeat the last."""
    with np.errstate(over="ignore"):
        x = (a.view(np.uint64) ^ np.uint64(level)) * np.uint64(0x9E3779B97F4A7C15) + b.view(np.uint64)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
        step = (x >> np.uint64(32)) | np.uint64(1)
        for i in range(HASHES):
            yield ((x + np.uint64(i) * step) & np.uint64(bits - 1)).astype(np.int64)


def bloom(keys: DataFrame, n: int, level: int) -> np.ndarray:
    """The bits, as 64-bit words, of a Bloom filter of the n rows of keys(a, b)."""
    bits = max(64, 1 << (BITS_PER_KEY * n - 1).bit_length())

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(bits // 64, dtype=np.uint64)
        for batch in batches:
            for at in _places(*(batch.column(c).to_numpy().astype(np.int64) for c in "ab"), level, bits):
                np.bitwise_or.at(words, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
        used = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(words[used].view(np.int64))], names=["word", "bits"])

    found = keys.select("a", "b").mapInArrow(partial, "word long, bits long").groupBy("word").agg(F.expr("bit_or(bits)").alias("bits"))
    words = np.zeros(bits // 64, dtype=np.int64)
    for row in found.toLocalIterator():  # at most `bits` / 64 rows, and `bits` is checked
        words[row.word] = row.bits
    return words.view(np.uint64)


def holds(words: np.ndarray, a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
    """Whether the filter of this level lets each key (a, b) through."""
    through = np.ones(len(a), dtype=bool)
    for at in _places(a, b, level, 64 * len(words)):
        through &= (words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
    return through


def listed(levels: Sequence[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether each key of the corpus is on the list: the first level that stops it decides."""
    answer, open_ = np.zeros(len(a), dtype=bool), np.ones(len(a), dtype=bool)
    for i, words in enumerate(levels):
        inside = holds(words, a, b, i)
        answer[open_ & ~inside] = i % 2 == 1
        open_ &= inside
    answer[open_] = len(levels) % 2 == 1
    return answer


def build(keys: DataFrame) -> list[np.ndarray] | None:
    """The levels for keys(a, b, is_listed), one row per key; None if they are beyond the bound."""
    spark, levels = keys.sparkSession, []
    sides = [keys.filter("is_listed").select("a", "b"), keys.filter("NOT is_listed").select("a", "b")]
    while True:
        mine, other = sides[len(levels) % 2], sides[1 - len(levels) % 2]
        n = mine.count()
        if n == 0:
            return levels
        if BITS_PER_KEY * n > MOST_BITS // 2:
            return None
        words, level = bloom(mine, n, len(levels)), len(levels)
        levels.append(words)
        sent = spark.sparkContext.broadcast(words)

        @F.pandas_udf("boolean")
        def let_through(a: pd.Series, b: pd.Series) -> pd.Series:
            return pd.Series(holds(sent.value, a.to_numpy(), b.to_numpy(), level))

        sides[len(levels) % 2] = written(other.filter(let_through("a", "b")), "through")


def on_list(pages: DataFrame, keys: str, names: DataFrame, found: str) -> DataFrame:
    """pages with `found`: those keys of the array column `keys` (key, a, b) that are among names(name).

    `pages` is a stored table with a row number `row`.
    """
    spark, names_df = pages.sparkSession, names.select("name").distinct()
    universe = pages.select(F.explode(keys).alias("k")).select("k.*").distinct()
    universe = universe.join(names_df.withColumn("on_list", F.lit(True)), F.col("key") == F.col("name"), "left")
    levels = build(written(universe.select("a", "b", F.coalesce("on_list", F.lit(False)).alias("is_listed")), "keys"))
    if levels is None:
        hits = pages.select("row", F.explode(f"{keys}.key").alias("name")).join(names_df, "name")
        hits = hits.groupBy("row").agg(F.collect_set("name").alias(found))
        return pages.join(hits, "row", "left").withColumn(found, F.coalesce(found, F.array().cast("array<string>")))
    sent = spark.sparkContext.broadcast(levels)

    @F.pandas_udf("array<boolean>")
    def member(a: pd.Series, b: pd.Series) -> pd.Series:
        cuts = np.cumsum([len(x) for x in a])
        if not len(cuts) or not cuts[-1]:
            return pd.Series([[] for _ in a])
        flat = listed(sent.value, np.concatenate(a.to_list()).astype(np.int64), np.concatenate(b.to_list()).astype(np.int64))
        return pd.Series(np.split(flat, cuts[:-1]))

    hit = member(F.col(f"{keys}.a"), F.col(f"{keys}.b"))
    return pages.withColumn("hit", hit).withColumn(
        found, F.expr(f"transform(filter(arrays_zip({keys}.key, hit), p -> p.hit), p -> p.key)")
    ).drop("hit")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty where there is no url or no `://`."""
    host = F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def blocked_hosts(ruled: DataFrame) -> DataFrame:
    """(name): hosts of ruled(host, ruled_as) of which the rules block more pages than they allow."""
    votes = F.sum(F.when(F.col("ruled_as") == "block", 1).when(F.col("ruled_as") == "allow", -1).otherwise(0))
    return ruled.filter("host <> ''").groupBy("host").agg(votes.alias("n")).filter("n > 0").select(F.col("host").alias("name"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, hosts: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of pages(page_id, url).

    The keys of a page are its host and each parent domain, each with as much of the path as some rule
    has; the longest key that is a rule decides. Where none is, a page is blocked if its host is on the list hosts(name); without
    one the list comes from the pages themselves, see `blocked_hosts`. Rules and list are cascades over all keys that occur.
    A null url, or one without `://`, has an empty host and path and is allowed. Repeated rows are judged
    alike (and count alike for the list), null page ids stay null, other columns are not read; an empty table gives an empty one.
    """
    host, path = host_and_path(F.col("url"))
    pages = pages.select("page_id", host.alias("host"), path.alias("path"))
    parts = F.split("host", "\\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    lengths = F.filter(F.array(*(F.lit(n) for n in sorted({len(p) for _, _, p in rules}))), lambda n: n <= F.char_length("path"))
    keys = F.flatten(F.transform(domains, lambda d: F.transform(lengths, lambda n: F.concat(d, F.substring(F.col("path"), F.lit(1), n)))))
    named = lambda c: F.transform(F.array_distinct(c), lambda k: F.struct(k.alias("key"), _hashes(k)[0].alias("a"), _hashes(k)[1].alias("b")))
    pages = written(pages.select(
        F.monotonically_increasing_id().alias("row"), "page_id", "host", "path",
        named(keys).alias("keys"), named(F.array("host")).alias("hosts"),
    ), "pages")
    for verdict in ("allow", "block"):
        names = pages.sparkSession.createDataFrame([(h + p,) for v, h, p in rules if v == verdict], "name string")
        pages = on_list(pages, "keys", names, verdict)
    longest = lambda c: F.array_max(F.transform(c, lambda k: F.struct(F.char_length(k).alias("n"), k.alias("key"))))
    rule = F.greatest(
        F.when(F.size("allow") > 0, F.struct(longest("allow").alias("r"), F.lit("allow").alias("v"))),
        F.when(F.size("block") > 0, F.struct(longest("block").alias("r"), F.lit("block").alias("v"))),
    )
    ruled = written(pages.withColumn("best", rule).select("row", "page_id", "host", "path", "hosts", F.col("best.r.key").alias("rule"), F.col("best.v").alias("ruled_as")), "ruled")
    judged = on_list(ruled, "hosts", blocked_hosts(ruled) if hosts is None else hosts, "bad")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("ruled_as", F.when(F.size("bad") > 0, "block").otherwise("allow")).alias("verdict"))
