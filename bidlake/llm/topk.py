"""Exact top-k by distributed histogram selection.

Queries and candidates are packed into blocks of vectors; each query block meets each candidate block and a
matrix product scores all pairs. No score leaves a task while the k-th value is being found: a pass
counts, per query, scores by their next eight bits, block counts are added up, and the
bin in which the k-th best lies fixes those bits. After the last pass the k-th value is known, and one
more pass keeps the pairs above it and, of those equal to it, the smallest ids still wanted.

A block only reports bins down to the one in which its own k-th best lies: the k-th best of all is no
lower. Query blocks and candidate blocks are dealt to a grid of parts and ranges: a task has one query block and at most
`RANGE` candidate blocks, so more vectors make more tasks, not longer ones.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidlake.llm.common import map_slices
from bidlake.sources.writers import written

QUERY_BLOCK, CANDIDATE_BLOCK, RANGE, BITS = 512, 4096, 16, 8
EXACT_FLOAT = 2**53


def whole_vectors(rows: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, v array<long>) of rows(vec_id, embedding): floor(scale * x); broken vectors are left out."""
    x: Column = F.col("embedding")
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) < float("inf")))
    return rows.filter(F.col("vec_id").isNotNull() & x.isNotNull() & F.coalesce(fine, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(x, lambda e: F.floor(F.lit(float(scale)) * e.cast("double")).cast("long")).alias("v"),
    )


def _block_up(most: int):
    """Rows (part, vec_id, v, dim) to blocks (part, dim, ids, data), ids ascending within a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}

        def block(key: tuple) -> pa.RecordBatch:
            rows = sorted(held.pop(key), key=lambda r: r[0])
            ids = np.array([r[0] for r in rows], dtype="<i8").tobytes()
            data = np.concatenate([r[1] for r in rows]).astype("<i8").tobytes() if key[1] else b""
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()), pa.array([ids], pa.binary()), pa.array([data], pa.binary())],
                names=["part", "dim", "ids", "data"],
            )

        for batch in batches:
            v = batch.column("v")
            offsets, flat = v.offsets.to_numpy(), v.values.to_numpy(zero_copy_only=False)
            for part, doc, lo, hi in zip(batch.column("part").to_pylist(), batch.column("vec_id").to_pylist(), offsets[:-1], offsets[1:]):
                key = (part, int(hi - lo))
                held.setdefault(key, []).append((doc, flat[lo:hi]))
                if len(held[key]) == most:
                    yield block(key)
        for key in list(held):
            yield block(key)

    return run


def blocks(vectors: DataFrame, most: int) -> DataFrame:
    """vectors(part, vec_id, v) as (part, dim, ids, data)."""
    return map_slices(vectors.select("part", "vec_id", "v"), _block_up(most), "part long, dim long, ids binary, data binary", 4096)


def _scores(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query ids, candidate ids, whole scores) of one pair of blocks; a query's own row scores lowest."""
    dim = batch.column("dim")[i].as_py()
    q_ids, c_ids = (np.frombuffer(batch.column(c)[i].as_py(), dtype="<i8") for c in ("q_ids", "c_ids"))
    q, c = (
        np.frombuffer(batch.column(x)[i].as_py(), dtype="<i8").reshape(len(n), dim) for x, n in (("q_data", q_ids), ("c_data", c_ids))
    )
    top = max(1, dim) * max(1.0, float(np.abs(q).max(initial=0))) * max(1.0, float(np.abs(c).max(initial=0)))
    s = (q.astype(float) @ c.T.astype(float)).astype(np.int64) if top < EXACT_FLOAT else q @ c.T
    return q_ids, c_ids, s


def _states(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Per query of the block: the bits fixed so far, and how many are wanted among scores with those bits."""
    return tuple(np.frombuffer(batch.column(c)[i].as_py(), dtype="<i8") for c in ("prefix", "wanted"))


def _count(shift: int, base: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                q_ids, c_ids, s = _scores(batch, i)
                prefix, wanted = _states(batch, i)
                u = s + base
                bins = np.where((u >> (shift + BITS)) == prefix[:, None], (u >> shift) & (2**BITS - 1), -1)
                bins[q_ids[:, None] == c_ids[None, :]] = -1
                k = min(int(wanted.max()), bins.shape[1])
                least = np.partition(bins, bins.shape[1] - k, axis=1)[:, bins.shape[1] - k]
                row, col = np.nonzero((bins >= least[:, None]) & (bins >= 0))
                cell, n = np.unique(row * 2**BITS + bins[row, col], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_ids[cell >> BITS]), pa.array(cell & (2**BITS - 1)), pa.array(n)], names=["query_id", "bin", "n"]
                )

    return run


def _pick(base: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                q_ids, c_ids, s = _scores(batch, i)
                value, wanted = _states(batch, i)
                u = s + base
                u[q_ids[:, None] == c_ids[None, :]] = -2
                row, col = np.nonzero(u > value[:, None])
                tie_row, tie_col = np.nonzero((u == value[:, None]) & (value[:, None] >= 0))
                # Ids ascend within a block, so the first ties of a row have the smallest ids.
                place = np.arange(len(tie_row)) - np.searchsorted(tie_row, tie_row)
                first = place < wanted[tie_row]
                row, col = np.concatenate([row, tie_row[first]]), np.concatenate([col, tie_col[first]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_ids[row]), pa.array(c_ids[col]), pa.array(s[row, col])], names=["query_id", "vec_id", "score"]
                )

    return run


def _with_state(queries: DataFrame, state: DataFrame, parts: int) -> DataFrame:
    """Query blocks with the state of each query beside its vector: (part, dim, q_ids, q_data, prefix, wanted)."""
    rows = queries.join(state, "vec_id").select(
        "part", "vec_id", F.concat(F.array(F.col("prefix"), F.col("wanted")), F.col("v")).alias("v")
    )
    packed = blocks(rows.repartition(parts, "part"), QUERY_BLOCK)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, dim, ids, data in zip(*(c.to_pylist() for c in batch.columns)):
                m = np.frombuffer(data, dtype="<i8").reshape(-1, dim)
                columns = ids, m[:, 2:].tobytes(), m[:, 0].tobytes(), m[:, 1].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int64()), pa.array([dim - 2], pa.int64()), *(pa.array([c], pa.binary()) for c in columns)],
                    names=["part", "dim", "q_ids", "q_data", "prefix", "wanted"],
                )

    return packed.mapInArrow(unpack, "part long, dim long, q_ids binary, q_data binary, prefix binary, wanted binary")


def top_k(rows: DataFrame, is_query: Column, k: int = 5, most: int = CANDIDATE_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k candidates of highest inner product for each query.

    rows(vec_id, embedding); a candidate is every row whose id is not the query's. Equal scores go by the
    smaller id. Rows with a null id or vector, or null or non-finite components, take no part; vectors of
    different lengths do not meet; of repeated rows with one id the query takes one and the candidates
    all; an empty table gives no rows. Scores are 64-bit whole numbers. A candidate block has at most `most` vectors.
    """
    vectors = written(whole_vectors(rows), "vectors")
    norm = vectors.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, e: s + e.cast("double") * e)).alias("m"), F.count("*").alias("n")).first()
    base = int(norm.m or 0) + 1  # no product is larger than the largest squared norm
    passes = max(1, -(-(2 * base).bit_length() // BITS))
    queries = vectors.filter(is_query).dropDuplicates(["vec_id"])
    parts = max(1, -(-queries.count() // QUERY_BLOCK))
    queries = written(queries.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(parts))), "queries")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<bigint>"))
    candidates = written(blocks(vectors.withColumn("part", F.lit(0).cast("long")), most), "candidates")
    ranges = max(1, -(-candidates.count() // RANGE))
    numbered = candidates.withColumn("range", F.pmod(F.xxhash64("ids"), F.lit(ranges).cast("long")))
    candidates = numbered.select(every(parts).alias("part"), "dim", "range", F.col("ids").alias("c_ids"), F.col("data").alias("c_data"))
    state = queries.select("vec_id", F.lit(0).cast("long").alias("prefix"), F.lit(k).cast("long").alias("wanted"))

    def pairs() -> DataFrame:
        return candidates.join(_with_state(queries, state, parts).withColumn("range", every(ranges)), ["part", "dim", "range"])

    for p in reversed(range(passes)):
        counted = pairs().mapInArrow(_count(p * BITS, base), "query_id long, bin long, n long")
        bins = counted.groupBy("query_id", "bin").agg(F.sum("n").alias("n"))
        above = F.coalesce(F.sum("n").over(Window.partitionBy("query_id").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        bins = bins.withColumn("above", above).join(state.withColumnRenamed("vec_id", "query_id"), "query_id")
        found = bins.filter((F.col("above") < F.col("wanted")) & (F.col("above") + F.col("n") >= F.col("wanted"))).select(
            F.col("query_id").alias("vec_id"), (F.col("prefix") * 2**BITS + F.col("bin")).alias("prefix"), (F.col("wanted") - F.col("above")).alias("wanted")
        )
        # With fewer than k candidates no bin is found, and every score is above the value -1.
        missing = F.lit(-1).cast("long")
        old = state.select("vec_id", F.col("wanted").alias("old"))
        state = written(old.join(found, "vec_id", "left").select(
            "vec_id", F.coalesce("prefix", missing).alias("prefix"), F.coalesce("wanted", "old").alias("wanted")
        ), "state")
    picked = pairs().mapInArrow(_pick(base), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return picked.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
