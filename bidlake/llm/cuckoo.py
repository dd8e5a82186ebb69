"""Exact duplicates by a cuckoo-filter index of live digests.

A text without its ASCII white space is named by its SHA-256. Each task holds an index of the
digests that are live in its share: a cuckoo filter (16-bit fingerprints, four to a bucket, two
buckets per digest) in front of content buckets with the full digests. A miss of the filter is a new
digest; a hit is verified against the content bucket. When a better row of a group turns up, the
live entry is deleted and the better one inserted. When no slot can be freed, the filter doubles and
is filled again from the stored keys. Tasks first index their own rows, which leaves one entry of a
group per task however large it is, and then the entries that meet in one digest range.
"""

from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlake.llm.common import map_batches, text_or_empty
from bidlake.sources.writers import written

SLOTS = 4


class CuckooIndex:
    """Live digests (bytes, 10 or more) with a value each."""

    def __init__(self, buckets: int = 256, most_kicks: int = 100):
        if buckets & (buckets - 1):
            raise ValueError("the number of buckets is a power of two")
        self.most_kicks, self.resizes, self.live = most_kicks, 0, 0
        self._empty(buckets)

    def _empty(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.marks = array("H", bytes(2 * SLOTS * buckets))
        self.content: list[list[tuple[bytes, tuple]]] = [[] for _ in range(buckets)]

    def _where(self, digest: bytes) -> tuple[int, int]:
        return int.from_bytes(digest[:8], "little") & self.mask, int.from_bytes(digest[8:10], "little") or 1

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ ((mark * 0x5BD1E995 >> 4) & self.mask)

    def _slot(self, bucket: int, mark: int) -> int:
        """The slot of the bucket that holds the mark, or -1."""
        for i in range(SLOTS * bucket, SLOTS * bucket + SLOTS):
            if self.marks[i] == mark:
                return i
        return -1

    def get(self, digest: bytes) -> tuple | None:
        bucket, mark = self._where(digest)
        if self._slot(bucket, mark) < 0 and self._slot(self._other(bucket, mark), mark) < 0:
            return None
        return next((value for key, value in self.content[bucket] if key == digest), None)

    def _mark(self, bucket: int, mark: int) -> bool:
        """Put a mark into one of its two buckets, moving others; False if none could be freed."""
        for step in range(self.most_kicks):
            for b in (bucket, self._other(bucket, mark)):
                if (i := self._slot(b, 0)) >= 0:
                    self.marks[i] = mark
                    return True
            i = SLOTS * bucket + (mark + step) % SLOTS
            mark, self.marks[i] = self.marks[i], mark
            bucket = self._other(bucket, mark)
        return False

    def insert(self, digest: bytes, value: tuple) -> None:
        """Add a digest that is not live."""
        bucket, mark = self._where(digest)
        self.content[bucket].append((digest, value))
        self.live += 1
        if not self._mark(bucket, mark):
            self._grow()

    def _grow(self) -> None:
        stored, buckets = list(self.items()), len(self.content)
        while True:
            buckets, self.resizes = 2 * buckets, self.resizes + 1
            self._empty(buckets)
            for digest, value in stored:
                bucket, mark = self._where(digest)
                self.content[bucket].append((digest, value))
                if not self._mark(bucket, mark):
                    break
            else:
                return

    def delete(self, digest: bytes) -> bool:
        """Take a live digest out; False if it is not live."""
        if self.get(digest) is None:
            return False
        bucket, mark = self._where(digest)
        self.content[bucket] = [x for x in self.content[bucket] if x[0] != digest]
        i = self._slot(bucket, mark)
        self.marks[i if i >= 0 else self._slot(self._other(bucket, mark), mark)] = 0
        self.live -= 1
        return True

    def items(self) -> Iterator[tuple[bytes, tuple]]:
        return (x for bucket in self.content for x in bucket)


def _better(a: tuple, b: tuple) -> bool:
    """Whether row a = (chars, doc_id) stays rather than b: more characters, then the smaller id, null last."""
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    return order(a) < order(b)


ENTRY = "digest binary, chars long, doc_id long, rows long"


def _index(most: int):
    """One entry per digest of the task; an index that holds `most` entries is emptied and begun anew."""

    def entries(index: CuckooIndex) -> Iterator[pa.RecordBatch]:
        held = list(index.items())
        for i in range(0, len(held), 10_000):
            part = held[i : i + 10_000]
            columns = [[d for d, _ in part], *zip(*(v for _, v in part))]
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["digest", "chars", "doc_id", "rows"]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = CuckooIndex()
        for batch in batches:
            for digest, chars, doc, rows in zip(*(c.to_pylist() for c in batch.columns)):
                live = index.get(digest)
                if live is None:
                    index.insert(digest, (chars, doc, rows))
                else:
                    best = (chars, doc) if _better((chars, doc), live[:2]) else live[:2]
                    index.delete(digest)
                    index.insert(digest, (*best, live[2] + rows))
            if index.live >= most:
                yield from entries(index)
                index = CuckooIndex()
        yield from entries(index)

    return run


def text_digest(text: Column) -> Column:
    """SHA-256, in hexadecimal, of a text without its ASCII white space."""
    return F.sha2(F.regexp_replace(text, "[\\x20\\x09-\\x0D]+", "").cast("binary"), 256)


def keepers(digests: DataFrame, entries_per_task: int = 400_000) -> DataFrame:
    """(digest, chars, keep_id, group_size) of digests(digest, chars, doc_id): the row of each group that stays."""
    own = map_batches(
        digests.select("digest", "chars", F.col("doc_id").cast("long").alias("doc_id"), F.lit(1).cast("long").alias("rows")),
        _index(entries_per_task // 4), ENTRY,
    )
    spark = digests.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-digests.count() // entries_per_task))
    met = map_batches(own.repartition(tasks, "digest"), _index(2**62), ENTRY)
    return met.select("digest", F.col("chars").alias("keep_chars"), F.col("doc_id").alias("keep_id"), F.col("rows").alias("group_size"))


def exact_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row of docs(doc_id, text).

    A null text counts as empty, and all empty texts are equal. Of equal texts the row with the most code
    points, then the smallest id (null last) stays; rows alike in both all count as kept. Other columns
    are not read. An empty table gives an empty one. Of a text only its digest and length go on.
    """
    text = text_or_empty()
    digests = written(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.char_length(text).cast("long").alias("chars"),
        F.unhex(text_digest(text)).alias("digest"),
    ), "digests")
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("keep_chars"))
    return digests.join(keepers(digests), "digest").select(
        "doc_id", "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns, one per group of equal texts; of rows equal in id and text one. An empty table stays empty."""
    text = text_or_empty()
    mine = docs.columns
    rows = docs.withColumns({"__digest": F.unhex(text_digest(text)), "__chars": F.char_length(text).cast("long")})
    digests = written(rows.select("doc_id", F.col("__chars").alias("chars"), F.col("__digest").alias("digest")), "digests")
    stay = keepers(digests).select(
        F.col("digest").alias("__digest"), F.col("keep_chars").alias("__most"), F.col("keep_id").alias("__keep")
    )
    is_kept = (F.col("__chars") == F.col("__most")) & F.col("doc_id").cast("long").eqNullSafe(F.col("__keep"))
    rows = rows.join(stay, "__digest").filter(is_kept)
    # Repeated rows, equal in id and text, are still all there; they lie together already.
    return rows.dropDuplicates(["__digest"]).select(*mine)
