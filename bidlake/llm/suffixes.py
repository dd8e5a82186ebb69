"""Repeated passages by suffix sorting, without a suffix array of the whole corpus in one place.

A string of `span` bytes that occurs twice has the same anchor both times: the position, among its first bytes, whose
`GRAM` bytes have the smallest hash. So each text is cut into anchors with the starts that each of them governs, and a
repeated string only ever meets its like under the same anchor hash. Most anchors occur once and are done with. An
anchor whose surroundings are the same wherever it occurs repeats as a whole. Where surroundings differ, one of each kind
goes to the task of its hash, and the surroundings that meet there are sorted: a two-stage suffix sort puts only
those suffixes in order directly that are smaller than their successors, and induces the order of all others by scanning
the buckets of first bytes; neighbours in that order with a common prefix of `span` bytes are repeats.

Anchors with more than `MOST` different surroundings are not sorted in one task: their starts are counted one
by one, by a hash of the whole string.
"""

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest, xxh64_intdigest

from bidlake.llm.common import map_slices, text_or_empty
from bidlake.sources.writers import written

SPAN, GRAM, MOST = 400, 160, 4000
_RNG = np.random.default_rng(3)
_BYTES = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Bits of a key that hold a place in a text, of up to a gigabyte.
_PLACE = np.uint64((1 << 30) - 1)


def _powers(n: int, base: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, by doubling."""
    out = np.ones(n, dtype=np.uint64)
    have, step = 1, np.uint64(base)
    while have < n:
        take = min(have, n - have)
        out[have : have + take] = out[:take] * step
        have, step = have + take, step * step
    return out


_INVERSE = pow(int(_BASE), -1, 2**64)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of each run of `gram` bytes: sums of powers, mixed so that its order says nothing."""
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTES[data] * _powers(len(data), int(_BASE)), out=sums[1:])
        h = (sums[gram:] - sums[:-gram]) * _powers(len(data) - gram + 1, _INVERSE)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))


def anchors(data: np.ndarray, span: int = SPAN, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, hash, first start, last start) of each anchor: the gram of smallest hash of those starts' strings.

    Grams are compared by the high bits of their hashes, then by place, so that the leftmost of equal ones is taken; either
    depends on the string alone.
    """
    n = len(data) - span + 1
    if n <= 0:
        return (np.empty(0, dtype=np.int64),) * 4
    h, window = gram_hashes(data, gram), span - gram + 1
    # Smallest key of each window: of the tail of one block and the head of the next.
    blocks = -(-len(h) // window)
    padded = np.full(blocks * window, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(h)] = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
    grid = padded.reshape(blocks, window)
    head = np.minimum.accumulate(grid, axis=1).ravel()
    tail = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(tail[:n], head[window - 1 : window - 1 + n])
    firsts = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
    places = (least[firsts] & _PLACE).astype(np.int64)
    return places, h[places], firsts, np.append(firsts[1:], n) - 1


# ---- suffix sorting ------------------------------------------------------------------------------


def _eights(text: np.ndarray, depth: int) -> np.ndarray:
    """Bytes i to i + 7 as one number whose order is theirs, for each i; zeros stand behind the text."""
    padded = np.append(text, np.zeros(depth + 15, dtype=np.uint8)).astype(np.uint64)
    out = padded[:-7].copy()
    for k in range(1, 8):
        out = (out << np.uint64(8)) | padded[k : len(padded) - 7 + k]
    return out


def _direct(eights: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes `at` in the order of their first `depth` bytes, eight bytes a round, only ties going on.

    Of the ties, only groups in which some member has other eight bytes than the first one are sorted in a round.
    """
    if not len(at):
        return at
    order = at[np.argsort(eights[at], kind="stable")]
    k = eights[order]
    first = np.append(True, k[1:] != k[:-1])  # where a group of ties begins
    tied = np.flatnonzero(~(first & np.append(first[1:], True)))
    for step in range(8, depth, 8):
        if not len(tied):
            break
        k = eights[np.minimum(order[tied] + step, len(eights) - 1)]
        begins = first[tied]
        group = np.cumsum(begins) - 1
        other = k != k[begins][group]
        if not other.any():
            continue
        split = np.zeros(group[-1] + 1, dtype=bool)
        split[group[other]] = True
        some = split[group]
        slots, group, k = tied[some], group[some], k[some]
        sub = np.lexsort((k, group))
        order[slots], k = order[slots][sub], k[sub]
        first[slots[1:]] |= (k[1:] != k[:-1]) & (group[1:] == group[:-1])
        ends = np.append(first[1:], True)
        tied = tied[~(first[tied] & ends[tied])]
    return order


def suffix_order(text: np.ndarray, depth: int = SPAN, eights: np.ndarray | None = None) -> np.ndarray:
    """The suffixes of a byte text, in the order of their first `depth` bytes at least; two stages.

    Suffixes smaller than their successor are sorted directly. All others are induced: a scan of the buckets of first
    bytes, in rising order, puts before each suffix it meets the one that starts a byte earlier, if that is larger
    than its successor, at the next free place at the front of its own bucket.
    """
    n = len(text)
    if n == 0:
        return np.empty(0, dtype=np.int64)
    # Smaller than the successor: at the first byte that differs from the one before, it is the larger. The end counts as smallest.
    change = np.append(text[1:].astype(np.int16) - text[:-1], np.int16(-1))
    run_end = np.flatnonzero(change != 0)
    small = change[run_end[np.searchsorted(run_end, np.arange(n))]] > 0
    direct = _direct(_eights(text, depth) if eights is None else eights, np.flatnonzero(small), depth)
    first = text[direct]
    own = np.split(direct, np.searchsorted(first, np.arange(1, 256)))
    larger: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []

    def induce(found: np.ndarray, byte: int) -> np.ndarray:
        """Hand on the predecessors of suffixes just placed; give back those of the same bucket."""
        before = found[found > 0] - 1
        before = before[~small[before]]
        c = text[before]
        order = np.argsort(c, kind="stable")
        before, c = before[order], c[order]
        cuts = np.flatnonzero(np.diff(c)) + 1
        same = np.empty(0, dtype=np.int64)
        for part in np.split(before, cuts) if len(before) else []:
            if text[part[0]] == byte:
                same = part
            else:
                larger[text[part[0]]].append(part)
        return same

    larger[text[n - 1]].append(np.array([n - 1]))  # the last suffix comes before all others of its bucket
    for byte in range(256):
        wave = np.concatenate(larger[byte]) if larger[byte] else np.empty(0, dtype=np.int64)
        while len(wave):
            out.append(wave)
            wave = induce(wave, byte)
        if len(own[byte]):
            out.append(own[byte])
            induce(own[byte], byte)
    return np.concatenate(out)


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int, eights: np.ndarray | None = None) -> np.ndarray:
    """Whether each suffix of the order shares its first `depth` bytes, eight or more, with the one before it."""
    eights = _eights(text, depth) if eights is None else eights
    alike = np.flatnonzero(np.maximum(order[1:], order[:-1]) + depth <= len(text))
    for step in [*range(0, depth - 8, 8), depth - 8]:
        alike = alike[eights[order[alike + 1] + step] == eights[order[alike] + step]]
    out = np.zeros(len(order), dtype=bool)
    out[alike + 1] = True
    return out


def repeated_starts(parts: list[tuple[bytes, int]], span: int = SPAN) -> list[np.ndarray]:
    """Of each (surroundings, number of starts): which starts begin a string that another start begins too."""
    if not parts:
        return []
    sizes = np.array([len(p) for p, _ in parts])
    offsets = np.cumsum(sizes) - sizes
    text = np.frombuffer(b"".join(p for p, _ in parts), dtype=np.uint8)
    is_start = np.zeros(len(text), dtype=bool)
    for o, (_, n) in zip(offsets, parts):
        is_start[o : o + n] = True
    eights = _eights(text, span)
    order = suffix_order(text, span, eights)
    # Only starts matter; between two of them with a common prefix all suffixes share it.
    alike = common_prefixes(text, order, span, eights)
    run = np.cumsum(~alike)
    starts = is_start[order]
    many = np.bincount(run, weights=starts)[run] > 1
    found = np.zeros(len(text), dtype=bool)
    found[order[starts & many]] = True
    return [found[o : o + n] for o, (_, n) in zip(offsets, parts)]


def spans_of(found: np.ndarray, first: int, span: int) -> list[tuple[int, int]]:
    """Byte ranges that the strings at the found starts cover; touching ones are joined."""
    at = np.flatnonzero(found)
    if not len(at):
        return []
    cuts = np.flatnonzero(np.diff(at) > span) + 1
    return [(first + int(x[0]), first + int(x[-1]) + span) for x in np.split(at, cuts)]


# ---- the job ------------------------------------------------------------------------------------

ANCHOR = "k1 long, k2 long, hash long, kind binary, place int, first int, last int"


def _anchors(span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in range(7)]
            for k1, k2, text in zip(*(c.to_pylist() for c in batch.select(["k1", "k2"]).columns), batch.column("text").cast(pa.binary()).to_pylist()):
                places, hashes, firsts, lasts = anchors(np.frombuffer(text, dtype=np.uint8), span)
                kinds = [xxh3_128_digest(text[a : b + span]) for a, b in zip(firsts.tolist(), lasts.tolist())]
                for c, x in zip(columns, ([k1] * len(kinds), [k2] * len(kinds), hashes.view(np.int64).tolist() if len(kinds) else [], kinds, places.tolist(), firsts.tolist(), lasts.tolist())):
                    c.extend(x)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["k1", "k2", "hash", "kind", "place", "first", "last"])

    return run


def _cut_out(span: int):
    """(text, anchors of it) to the surroundings of each anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, wanted in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("wanted").to_pylist()):
                for w in wanted:
                    out.append((w["hash"], w["kind"], w["hot"], w["place"] - w["first"], text[w["first"] : w["last"] + span]))
            h, k, hot, place, data = zip(*out) if out else ((), (), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(h, pa.int64()), pa.array(k, pa.binary()), pa.array(hot, pa.bool_()), pa.array(place, pa.int32()), pa.array(data, pa.binary())],
                names=["hash", "kind", "hot", "place", "data"],
            )

    return run


RANGES = "array<struct<a:int,b:int>>"
_RANGES = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def _with_company(group: list[tuple], span: int, gram: int) -> list[tuple]:
    """Those of an anchor's surroundings (hash, kind, place, data) that can hold a repeat.

    A string around the anchor's gram also holds half of what is left of `span`, on one side of it. So a repeat shares the
    bytes on that side with other surroundings.
    """
    half = (span - gram) // 2
    sides = [
        (d[p - half : p] if p >= half else None, d[p + gram : p + gram + half] if len(d) >= p + gram + half else None) for _, _, p, d in group
    ]
    left, right = (Counter(x for x in side if x is not None) for side in zip(*sides))
    return [g for g, (a, b) in zip(group, sides) if left[a] > 1 or right[b] > 1]


def _sort_block(span: int, gram: int = GRAM, most_bytes: int = 2_000_000):
    """Surroundings sorted by hash to the ranges repeated in each; whole hashes are sorted together up to `most_bytes`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes, int, bytes]] = []
        size = 0
        group: list[tuple[int, bytes, int, bytes]] = []

        def done() -> pa.RecordBatch:
            found = repeated_starts([(d, len(d) - span + 1) for *_, d in held], span)
            ranges = [[dict(zip("ab", r)) for r in spans_of(f, 0, span)] for f in found]
            keep = [i for i, r in enumerate(ranges) if r]
            out = pa.RecordBatch.from_arrays(
                [pa.array([held[i][0] for i in keep], pa.int64()), pa.array([held[i][1] for i in keep], pa.binary()), pa.array([ranges[i] for i in keep], _RANGES)],
                names=["hash", "kind", "ranges"],
            )
            held.clear()
            return out

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("hash", "kind", "place", "data"))):
                if group and row[0] != group[0][0]:
                    kept = _with_company(group, span, gram)
                    held.extend(kept)
                    size += sum(len(d) for *_, d in kept)
                    group.clear()
                    if size >= most_bytes:
                        yield done()
                        size = 0
                group.append(row)
        if group:
            held.extend(_with_company(group, span, gram))
        if held:
            yield done()

    return run


def _starts(span: int):
    """Surroundings to one row per start: a hash of its whole string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h, kind, data in zip(*(batch.column(c).to_pylist() for c in ("hash", "kind", "data"))):
                n = len(data) - span + 1
                strings = [xxh3_128_digest(data[i : i + span]) for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([h] * n, pa.int64()), pa.array([kind] * n, pa.binary()), pa.array(range(n), pa.int32()), pa.array(strings, pa.binary())],
                    names=["hash", "kind", "at", "string"],
                )

    return run


def _strike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, ranges) to what is left of each text."""
    import hashlib

    for batch in batches:
        rows = []
        for text, ranges in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("ranges").to_pylist()):
            kept, at, spans, removed = [], 0, 0, 0
            end = -1
            for r in sorted((x["a"], x["b"]) for x in ranges or []):
                if r[0] > end:
                    kept.append(text[max(at, 0) : r[0]])
                    spans += 1
                removed += max(0, r[1] - max(r[0], end))
                end = max(end, r[1])
                at = end
            kept.append(text[at:])
            rows.append((len(text), removed, spans, hashlib.sha256(b"".join(kept)).hexdigest()))
        size, removed, spans, digest = zip(*rows) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (size, removed, spans)), pa.array(digest, pa.string())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def strike_repeats(docs: DataFrame, span: int = SPAN, most: int = MOST) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row of docs(doc_id, text).

    Every byte covered by a string of `span` bytes that starts anywhere else too, in the same text or another row's, is
    removed; a null text is empty. Repeated rows are repeats of each other. A null doc_id stays null; other columns
    are not read; an empty table gives an empty one. A task cuts one text at a time, with some 70 bytes of memory a byte of it, so a text of
    100 MB needs 7 GB; texts are below a gigabyte.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    texts = texts.withColumns({"k1": F.xxhash64("text"), "k2": F.xxhash64(F.lit(1), "text")})
    long_ = texts.filter(F.octet_length("text") >= span)
    # Rows with one text have the same anchors; counted apart, each of a repeated text occurs more than once.
    all_ = written(map_slices(long_.select("k1", "k2", "text"), _anchors(span), ANCHOR, 64), "anchors")
    kinds = all_.groupBy("hash", "kind").agg(F.count("*").alias("n"), F.min(F.struct("k1", "k2", "place", "first", "last")).alias("one"))
    by_hash = kinds.groupBy("hash").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).filter("total > 1")
    kinds = written(kinds.join(by_hash, "hash"), "kinds")
    whole = kinds.filter("n > 1").select("hash", "kind", F.lit(None).cast(RANGES).alias("ranges"))

    mixed = kinds.filter("kinds > 1").select("one.*", "hash", "kind", (F.col("kinds") > most).alias("hot"))
    wanted = mixed.groupBy(F.col("k1").alias("w1"), F.col("k2").alias("w2")).agg(F.collect_list(F.struct("hash", "kind", "hot", "place", "first", "last")).alias("wanted"))
    found = long_.join(wanted, (F.col("k1") == F.col("w1")) & (F.col("k2") == F.col("w2"))).dropDuplicates(["k1", "k2"])
    around = written(map_slices(found.select("text", "wanted"), _cut_out(span), "hash long, kind binary, hot boolean, place int, data binary", 64), "around")
    cool = around.filter("NOT hot").select("hash", "kind", "place", "data").repartition("hash").sortWithinPartitions("hash")
    ranges = map_slices(cool, _sort_block(span), f"hash long, kind binary, ranges {RANGES}", 512)
    starts = map_slices(around.filter("hot").select("hash", "kind", "data"), _starts(span), "hash long, kind binary, at int, string binary", 64)
    twice = starts.groupBy("string").agg(F.count("*").alias("n")).filter("n > 1").select("string")
    hot = starts.join(twice, "string").groupBy("hash", "kind").agg(
        F.collect_list(F.struct(F.col("at").alias("a"), (F.col("at") + span).alias("b"))).alias("ranges")
    )
    partly = ranges.unionByName(hot).join(whole.select("hash", "kind"), ["hash", "kind"], "left_anti")
    repeated = whole.unionByName(partly)

    hits = all_.join(repeated, ["hash", "kind"])
    inside = F.expr("transform(ranges, r -> struct(first + r.a AS a, first + r.b AS b))")
    everything = F.array(F.struct(F.col("first").alias("a"), (F.col("last") + span).alias("b")))
    hits = hits.select("k1", "k2", F.coalesce(inside, everything).alias("ranges"))
    # One text's ranges, of however many rows; at most a few per anchor.
    per_text = hits.distinct().groupBy("k1", "k2").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))
    rows = texts.join(per_text, ["k1", "k2"], "left").select("doc_id", "text", "ranges")
    return map_slices(rows, _strike, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", 64)
