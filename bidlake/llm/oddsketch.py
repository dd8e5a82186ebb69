"""Near duplicates by banded MinHash, odd sketches and an exact check of full shingle sets.

Documents with equal shingle sets form a class, and classes take part once. MinHash samples of a class are
cut into bands; classes that share a band meet in a bucket. A pair is verified in two steps: the samples, folded
into parity bitmaps (odd sketches), whose XOR population count estimates the Jaccard similarity, drop pairs that
are far off; full shingle sets decide the rest.

A bucket is not expanded into all its pairs. First each class meets the smallest class of its buckets, the one it shares most of them with. What links is
joined into components, and a bucket whose members lie in one component is done. In the others, members of
different components are compared by sketches inside tasks, in blocks that several tasks share: first each class meets the nearest two.
What is still apart then is decided in the blocks: the full sets of the members that are near one of another component are brought to the
task, each near pair of components that are still apart is checked there, and only links that joined something leave it. So no list of
pairs is ever written or shuffled, and no link between different components is lost, but for the
chance that a pair above the threshold shares no band (below 1e-7 at 0.8 with 32 bands of 4) or that its
estimate is off by more than `MARGIN`, over four standard deviations.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlake.llm.cascade import BITS_PER_KEY, MOST_BITS, bloom, holds
from bidlake.llm.common import lower_words, map_slices, text_or_empty
from bidlake.sources.writers import written

BANDS, ROWS, SKETCH_BITS, SEED = 32, 4, 1024, 7
#: How far below the threshold an estimate may be for the pair to be checked in full.
MARGIN = 0.17
#: Most members, and most shingles, of a block.
BLOCK, SHINGLES = 1024, 2_000_000


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Distinct shingle hashes of texts; words are hashed once and remembered."""

    def __init__(self, size: int, memory: int = 300_000):
        self.size, self.memory, self.words = size, memory, {}

    def __call__(self, text: bytes) -> np.ndarray:
        """Sorted distinct 64-bit hashes of the shingles of a UTF-8 text."""
        from xxhash import xxh64_intdigest

        if len(self.words) > self.memory:
            self.words = {}
        words = lower_words(text)
        if not words:
            return np.empty(0, dtype=np.uint64)
        for w in set(words).difference(self.words):
            self.words[w] = xxh64_intdigest(w, SEED)
        ids = np.fromiter(map(self.words.__getitem__, words), dtype=np.uint64, count=len(words))
        n = min(self.size, len(ids))
        count = len(ids) - n + 1
        h = np.full(count, n, dtype=np.uint64)
        for i in range(n):
            h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + ids[i : i + count])
        return np.unique(h)


_RNG = np.random.default_rng(SEED)
_A, _B = _RNG.integers(0, 2**64, (2, BANDS * ROWS), dtype=np.uint64)


def min_hashes(shingles: np.ndarray) -> np.ndarray:
    """One sample per hash function; the functions multiply and add 32 mixed bits and keep the high half."""
    low = shingles & np.uint64(0xFFFFFFFF)
    out = np.full(len(_A), np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(low), 512):
        part = (low[None, i : i + 512] * _A[:, None] + _B[:, None]) >> np.uint64(32)
        np.minimum(out, part.min(axis=1), out=out)
    return out


def bands_of(samples: np.ndarray) -> np.ndarray:
    keys = np.arange(BANDS, dtype=np.uint64)
    for r in range(ROWS):
        keys = _mix(keys * np.uint64(0x9E3779B97F4A7C15) + samples.reshape(BANDS, ROWS)[:, r])
    return keys.view(np.int64)


def sketch_of(samples: np.ndarray) -> np.ndarray:
    """Parity bitmap of the set of (function, sample), as 64-bit words."""
    at = _mix(samples * np.uint64(0x9E3779B97F4A7C15) + np.arange(len(samples), dtype=np.uint64)) & np.uint64(SKETCH_BITS - 1)
    return np.packbits(np.bincount(at.astype(np.int64), minlength=SKETCH_BITS) & 1).view(np.int64)


def similar(differing: np.ndarray) -> np.ndarray:
    """Jaccard similarity estimated from the XOR population count of two odd sketches."""
    share = np.minimum(differing / SKETCH_BITS, 0.4999)
    difference = -SKETCH_BITS / 2 * np.log1p(-2 * share)
    return 1 - difference / (2 * BANDS * ROWS)


def most_differing(threshold: float) -> int:
    """The largest population count whose estimate is within the margin below the threshold."""
    return int(np.searchsorted(-similar(np.arange(SKETCH_BITS // 2)), MARGIN - threshold, "right")) - 1


SIGNED = "doc_id long, text_key long, n_shingles long, class binary, bands array<bigint>, sketch array<bigint>"


def _sign(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        shingler = Shingler(size)
        for batch in batches:
            sizes, classes, bands, sketches = [], [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                s = shingler(text)
                sizes.append(len(s))
                if not len(s):
                    classes.append(None), bands.append(None), sketches.append(None)
                    continue
                samples = min_hashes(s)
                classes.append(xxh3_128_digest(s.tobytes()))
                bands.append(bands_of(samples))
                sketches.append(sketch_of(samples))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64()))],
                names=["doc_id", "text_key", "n_shingles", "class", "bands", "sketch"],
            )

    return run


def _sets(size: int):
    """(cid, text) to (cid, shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        for batch in batches:
            sets = [shingler(t).view(np.int64) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("cid"), pa.array(sets, pa.list_(pa.int64()))], names=["cid", "shingles"])

    return run


def components(edges: DataFrame) -> DataFrame:
    """(cid, root) of edges(u, v): the smallest class reachable, by large and small stars in turn.

    Each star replaces the edges of a class by edges to the smallest class it sees; hubs are aggregated before they
    are shuffled. Ends when a round changes nothing.
    """
    both = lambda e: e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))

    def star(e: DataFrame, large: bool) -> DataFrame:
        near = both(e) if large else e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        near = near.join(least, "u")
        out = near.filter(F.col("v") > F.col("u")).select("v", "m") if large else near.select("v", "m").union(least.select("u", "m"))
        return out.toDF("u", "v").filter("u <> v").distinct()

    def state(e: DataFrame):
        return e.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()

    edges = written(edges.select("u", "v").filter("u <> v").distinct(), "edges")
    before = None
    while (now := state(edges)) != before:
        before = now
        edges = written(star(star(edges, True), False), "edges")
    roots = edges.groupBy("u").agg(F.min("v").alias("root"))
    return roots.select(F.col("u").alias("cid"), "root").union(roots.select("root", "root")).distinct()


def further(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(cid, root) when links(u, v) join what roots has already."""
    at = lambda c: links.join(roots.toDF(c, f"r{c}"), c, "left").withColumn(f"r{c}", F.coalesce(f"r{c}", c))
    seen = written(at("u").join(roots.toDF("v", "rv"), "v", "left").select("u", "v", "ru", F.coalesce("rv", "v").alias("rv")), "links")
    merged = components(seen.select(F.greatest("ru", "rv").alias("u"), F.least("ru", "rv").alias("v"))).toDF("root", "to")
    new = seen.select("u", "ru").union(seen.select("v", "rv")).toDF("cid", "root")
    return roots.union(new).distinct().join(merged, "root", "left").select("cid", F.coalesce("to", "root").alias("root"))


def _confirm(percent: int):
    """Rows sorted by (v, part, u), the hub v's own set first, to the pairs whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, hub_set = None, None
        for batch in batches:
            column = batch.column("shingles")
            offsets, flat = column.offsets.to_numpy(), column.values.to_numpy().view(np.uint64)
            us, vs = [], []
            for v, u, lo, hi in zip(batch.column("v").to_pylist(), batch.column("u").to_pylist(), offsets[:-1], offsets[1:]):
                own = flat[lo:hi]
                if u is None:
                    hub, hub_set = v, own.copy()
                    continue
                assert hub == v
                at = np.minimum(np.searchsorted(hub_set, own), len(hub_set) - 1)
                common = int((hub_set[at] == own).sum())
                if 100 * common >= percent * (len(own) + len(hub_set) - common):
                    us.append(u), vs.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    return run


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of pairs(u, v) whose full sets are similar enough. A hub of many pairs is dealt out to several tasks."""
    parts = pairs.groupBy("v").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    pairs = pairs.join(parts, "v").withColumn("part", F.pmod(F.xxhash64("u"), "parts"))
    hubs = pairs.select("v", "part").distinct().join(sets.withColumnRenamed("cid", "v"), "v")
    members = pairs.select("v", "part", "u").join(sets.withColumnRenamed("cid", "u"), "u")
    rows = members.select("v", "part", "u", "shingles").unionByName(hubs.withColumn("u", F.lit(None).cast("long")))
    rows = rows.repartition("v", "part").sortWithinPartitions("v", "part", F.col("u").asc_nulls_first())
    return map_slices(rows.select("v", "u", "shingles"), _confirm(percent), "u long, v long", 256)


def _across(most: int, best: int):
    """For each member of a group the nearest few members of other components whose sketches are near enough."""

    def compare(left: list, right: list) -> tuple[list, list]:
        a, b = (np.array([x[1] for x in rows]).view(np.uint64) for rows in (left, right))
        roots, ids = np.array([x[2] for x in right]), np.array([x[0] for x in right])
        u, v = [], []
        for i, (cid, _, root) in enumerate(left):
            at = np.flatnonzero(roots != root)
            n = np.bitwise_count(b[at] ^ a[i]).sum(axis=1, dtype=np.int64)
            at, n = at[n <= most], n[n <= most]
            at = at[np.argpartition(n, best)[:best]] if len(at) > best else at
            u += [cid] * len(at)
            v += ids[at].tolist()
        return u, v

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _groups(batches, ("cid", "sketch", "root")):
            left, right = block.sides()
            u, v = compare(left, right) if left and right else ([], [])
            if block.key[1] != block.key[2] and left and right:
                more = compare(right, left)
                u, v = u + more[0], v + more[1]
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["x", "y"])

    return run


def _blocks(met: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of the buckets of met(bucket, band, cid, n, weight) that lie in several components, dealt out in blocks.

    A bucket of more than `BLOCK` members, or of more than `SHINGLES` shingles, is several blocks; each pair of blocks is one group
    (bucket, first, second), and `side` is the block of the row.
    """
    rows = met.join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    open_ = rows.groupBy("bucket").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a <> b").select("bucket")
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("weight") / SHINGLES))
    rows = rows.join(open_, "bucket").withColumn("blocks", blocks).withColumn("side", F.pmod(F.xxhash64("cid"), "blocks"))
    rows = rows.withColumn("t", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.withColumns({"first": F.least("side", "t"), "second": F.greatest("side", "t")})
    return rows.select("bucket", "first", "second", "side", "cid", "root", "band")


def _by_group(rows: DataFrame) -> DataFrame:
    return rows.repartition("bucket", "first", "second").sortWithinPartitions("bucket", "first", "second")


def across(met: DataFrame, roots: DataFrame, classes: DataFrame, most: int, best: int) -> DataFrame:
    """Pairs (u, v) of each class and the `best` nearest ones of other components in its buckets, if their sketches are near."""
    rows = _blocks(met, roots).join(classes.select("cid", "sketch"), "cid")
    rows = _by_group(rows.select("bucket", "first", "second", "side", "cid", "sketch", "root"))
    pairs = map_slices(rows, _across(most, best), "x long, y long", 4096)
    return pairs.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct()


class Block:
    """The members of one group (bucket, first, second), by side."""

    def __init__(self, key: tuple):
        self.key, self.held = key, {}

    def sides(self) -> tuple[list, list]:
        return self.held.get(self.key[1], []), self.held.get(self.key[2], [])


def _groups(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[Block]:
    """The groups of rows that come sorted by (bucket, first, second)."""
    block = None
    for batch in batches:
        for bucket, first, second, side, *row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "first", "second", "side", *columns))):
            if block is None or block.key != (bucket, first, second):
                if block is not None:
                    yield block
                block = Block((bucket, first, second))
            block.held.setdefault(side, []).append(tuple(row))
    if block is not None:
        yield block


def _near(left: list, right: list, same: bool, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(i, [j], distances) for each row of left: the rows of right with near sketches that share no earlier band with it.

    Rows are (cid, root, sketch, bands, band, ...). With `same`, the two lists are one and each pair comes once.
    """
    a, b = (np.array([x[2] for x in rows]).view(np.uint64) for rows in (left, right))
    bands_a, bands_b = (np.array([x[3] for x in rows]) for rows in (left, right))
    for i, row in enumerate(left):
        at = np.arange(i + 1 if same else 0, len(right))
        n = np.bitwise_count(b[at] ^ a[i]).sum(axis=1, dtype=np.int64)
        at, n = at[n <= most], n[n <= most]
        fresh = ~(bands_b[at, : row[4]] == bands_a[i, : row[4]]).any(axis=1)
        yield i, at[fresh], n[fresh]


def _candidates(most: int):
    """The members of each group that some member of another component comes near, by their sketches: a row each, no pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _groups(batches, ("cid", "root", "sketch", "bands", "band")):
            left, right = block.sides()
            same, wanted = block.key[1] == block.key[2], [set(), set()]
            roots = np.array([x[1] for x in right])
            for i, at, _ in _near(left, right, same, most) if left and right else ():
                at = at[roots[at] != left[i][1]]
                if len(at):
                    wanted[0].add(i)
                    wanted[1].update(at.tolist())
            if same:
                wanted = [wanted[0] | wanted[1], set()]
            cids = [rows[i][0] for rows, own in zip((left, right), wanted) for i in sorted(own)]
            sides = [side for side, own in zip(block.key[1:], wanted) for _ in own]
            fixed = [pa.array([x] * len(cids), pa.int64()) for x in block.key]
            yield pa.RecordBatch.from_arrays([*fixed, pa.array(sides, pa.int64()), pa.array(cids, pa.int64())], names=["bucket", "first", "second", "side", "cid"])

    return run


def _join_up(most: int, percent: int):
    """Links of full sets in each group, only those that join two components that the group has not joined yet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _groups(batches, ("cid", "root", "sketch", "bands", "band", "shingles")):
            left, right = block.sides()
            if not left or not right:
                continue
            same = block.key[1] == block.key[2]
            sets = [np.array(x[5]).view(np.uint64) for x in right]
            roots = [np.array([x[1] for x in rows]) for rows in (left, right)]
            u, v = [], []
            for i, at, n in _near(left, right, same, most):
                own = np.array(left[i][5]).view(np.uint64)
                at = at[np.argsort(n, kind="stable")]
                # The nearest few first; what they join need not be compared any more.
                while len(at := at[roots[1][at] != roots[0][i]]):
                    some, at = at[:64], at[64:]
                    size = np.array([len(sets[j]) for j in some])
                    flat = np.concatenate([sets[j] for j in some])
                    found = own[np.minimum(np.searchsorted(own, flat), len(own) - 1)] == flat
                    common = np.add.reduceat(found, np.cumsum(size) - size, dtype=np.int64)
                    for j in some[100 * common >= percent * (len(own) + size - common)].tolist():
                        old, new = roots[1][j], roots[0][i]
                        if old != new:
                            u.append(left[i][0]), v.append(right[j][0])
                            for labels in roots:
                                labels[labels == old] = new
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return run


def joined(met: DataFrame, roots: DataFrame, classes: DataFrame, sets: DataFrame, most: int, percent: int) -> DataFrame:
    """Links (u, v) that join components which share a bucket of met; between any two components with a link, some path of them.

    Pairs never leave a task: a first pass names the members with somebody near, a second one has their full sets in the task
    of their block, where a label per component says which pairs still matter. So fewer rows come out than members went in.
    """
    near = classes.select("cid", "sketch", "bands")
    groups = written(_blocks(met, roots), "blocks")
    members = _by_group(groups.join(near, "cid"))
    wanted = map_slices(members, _candidates(most), "bucket long, first long, second long, side long, cid long", 4096)
    rows = written(wanted, "candidates").join(groups, ["bucket", "first", "second", "side", "cid"]).join(near, "cid").join(sets, "cid")
    return map_slices(_by_group(rows), _join_up(most, percent), "u long, v long", 256).distinct()


def _only(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """texts, less most of those that are not in wanted(text_key, doc_id), by a Bloom filter of bounded size."""
    keys = wanted.select(F.col("text_key").alias("a"), F.coalesce("doc_id", F.lit(0)).alias("b"))
    n = keys.count()
    if n == 0 or BITS_PER_KEY * n > MOST_BITS // 2:
        return texts
    sent = texts.sparkSession.sparkContext.broadcast(bloom(keys, n, 0))

    @F.pandas_udf("boolean")
    def let_through(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(holds(sent.value, a.to_numpy(), b.to_numpy(), 0))

    return texts.filter(let_through("text_key", F.coalesce("doc_id", F.lit(0))))


def near_groups(docs: DataFrame, shingle: int = 4, percent: int = 80) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id, component, kept) of every row of docs(doc_id, text).

    The shingle set of a text is its distinct runs of `shingle` words, A-Z lower-cased; with fewer words, the whole
    sequence. Sets with 100 * intersection >= percent * union are linked; a text without words, or null, has an
    empty set, no link, and itself as component. component_id is the smallest doc_id reachable (null only if all
    ids there are null); kept is doc_id = component_id. Repeated rows are linked to each other. An empty table gives an empty one. A task holds
    one text's shingles at a time, some 30 bytes a word, and the sets of a block, `SHINGLES` numbers or a single longer set a side. Other columns are not
    read; text_key is a 64-bit hash of the text, component numbers components, also those without ids.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    texts = texts.withColumn("text_key", F.xxhash64("text"))
    signed = written(map_slices(texts, _sign(shingle), SIGNED), "signed")
    one = F.min(F.struct("doc_id", "text_key")).alias("one")
    classes = signed.filter("class IS NOT NULL").groupBy("class").agg(
        one, F.first("bands").alias("bands"), F.first("sketch").alias("sketch"), F.min("doc_id").alias("least"),
        F.first("n_shingles").alias("n_shingles"),
    )
    classes = written(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    members = classes.select(F.posexplode("bands").alias("band", "bucket"), "cid", F.col("n_shingles").alias("size"))
    buckets = members.groupBy("bucket").agg(F.min("cid").alias("hub"), F.count("*").alias("n"), F.sum("size").alias("weight")).filter("n > 1")
    met = written(members.drop("size").join(buckets, "bucket"), "buckets")

    near = most_differing(percent / 100)
    sketch = lambda c, s: classes.select(F.col("cid").alias(c), F.col("sketch").alias(s))
    differing = F.expr("aggregate(zip_with(a, b, (x, y) -> bit_count(x ^ y)), 0, (s, n) -> s + n)")
    # Each class first meets the hub with which it shares most buckets.
    shared = met.filter("cid <> hub").groupBy("cid", "hub").agg((-F.count("*")).alias("n"))
    pairs = shared.groupBy(F.col("cid").alias("u")).agg(F.min(F.struct("n", "hub")).alias("m")).select("u", F.col("m.hub").alias("v"))
    pairs = pairs.join(sketch("u", "a"), "u").join(sketch("v", "b"), "v").filter(differing <= near).select("u", "v")

    wanted = met.select("cid").distinct().join(classes, "cid").select("cid", "one.doc_id", "one.text_key")
    wanted = written(wanted, "wanted")
    w = wanted.select("cid", F.col("doc_id").alias("i"), F.col("text_key").alias("t"))
    found = _only(texts, wanted).join(w, (F.col("text_key") == F.col("t")) & F.col("doc_id").eqNullSafe(F.col("i")))
    sets = map_slices(found.select("cid", "text"), _sets(shingle), "cid long, shingles array<bigint>")
    sets = written(sets.dropDuplicates(["cid"]), "sets")

    # What a step joins need not be compared by the next: the hub, the nearest few, then all that is left.
    edges = written(confirmed(pairs, sets, percent), "edges")
    roots = written(components(edges), "roots")
    edges = written(edges.union(confirmed(across(met, roots, classes, near, 2), sets, percent)), "edges")
    roots = written(components(edges), "roots")
    last = joined(met, roots, classes, sets, near, percent)
    roots = written(further(roots, last), "roots")

    labelled = classes.join(roots, "cid", "left").select("class", F.coalesce("root", "cid").alias("root"), "least")
    least = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = labelled.join(least, "root").select("class", "component_id", F.col("root").alias("component"))
    rows = signed.join(labels, "class", "left").withColumn(
        "component_id", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    )
    # Texts without shingles are components of their own, by id and text.
    alone = F.when(F.col("class").isNull(), F.xxhash64("doc_id", "text_key")).otherwise(F.col("component"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return rows.select("doc_id", "text_key", "n_shingles", "component_id", alone.alias("component"), kept.alias("kept"))


def deduplicate(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs that stay, with all their columns: of each component the one of smallest doc_id.

    Where several rows share that id, or no row of a component has an id, the one of smallest text key stays.
    """
    mine = docs.columns
    verdicts = written(near_groups(docs, shingle, percent), "verdicts")
    # Rows without shingles are alone; the others of a component compete.
    stay = verdicts.groupBy("component_id", "component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("null"), F.col("doc_id").alias("id"), F.col("text_key").alias("key"))).alias("one")
    ).select(F.col("one.id").alias("__id"), F.col("one.key").alias("__key")).distinct()
    rows = docs.withColumn("__key", F.xxhash64(text_or_empty())).join(stay, "__key")
    rows = rows.filter(F.col("doc_id").cast("long").eqNullSafe(F.col("__id")))
    return rows.dropDuplicates(["__id", "__key"]).select(*mine)
