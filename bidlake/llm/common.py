"""What several operators share: reading tables, Arrow passes over texts, the word pattern."""

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space of the contracts, as in [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"
WORD = "[^\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_LOWER_WORDS = bytes.maketrans((SPACES + UPPER).encode(), (" " * len(SPACES) + LOWER).encode())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def text_key(name: str = "text") -> Column:
    """128 bits of the whole text; rows with equal texts share it, whatever task reads them."""
    text = text_or_empty(name)
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))


def lower_words(text: bytes) -> list[bytes]:
    """The words of a UTF-8 text in order, runs of anything but ASCII white space; A-Z lower-cased and nothing else."""
    return [w for w in text.translate(_LOWER_WORDS).split(b" ") if w]


#: What tasks of one kind leave to the next in the same worker process, one thing at a time.
KEPT: dict[tuple, object] = {}


def kept(key: tuple, make: Callable[[], object]) -> object:
    """What `make` gives, once per worker process, until a task keeps something else or nothing."""
    if key not in KEPT:
        forget()
        KEPT[key] = make()
    return KEPT[key]


def forget() -> None:
    # A function of the module: in one that Spark pickles, KEPT would be a copy.
    KEPT.clear()


def _lean(fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], keeps: bool):
    """The function, in a worker process that keeps nothing of tasks of another kind, nor the memory of batches done with.

    Worker processes outlive a query, and several share an executor's memory with its heap.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            forget()
        yield from fn(batches)
        pa.default_memory_pool().release_unused()

    return run


def map_batches(
    df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, rows: int = 256, keeps: bool = False
) -> DataFrame:
    """mapInArrow with batches of few rows, so that a task holds `rows` texts and no more.

    The row limit is a session setting; it is lowered here and never raised. `keeps`: the function asks for what is `kept`.
    """
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(conf.get(key)) <= 0 or int(conf.get(key)) > rows:
        conf.set(key, str(rows))
    return df.mapInArrow(_lean(fn, keeps), schema)


def map_slices(
    df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, rows: int = 256
) -> DataFrame:
    """mapInArrow whose function gets slices of at most `rows` rows.

    Spark bounds what it sends at once by bytes (spark.sql.execution.arrow.maxBytesPerBatch); slices bound what the function
    makes Python objects of. No setting of the session is touched.
    """

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield batch.slice(at, rows)

    return df.mapInArrow(_lean(lambda batches: fn(sliced(batches)), False), schema)
