"""Periodic runs of words by an enhanced suffix array, for many documents of a batch at once.

The words of each document get numbers that no other document of the batch uses, each document ends in a number of its own,
and all are laid end to end, so that no two suffixes of different documents, nor of one beyond its end, have anything in
common. The suffix array comes from prefix doubling, which sorts only what is still tied; the ranks of each round are
kept and answer how far two places agree, forwards and backwards, in as many steps as there were rounds.

A border of the suffix array with common prefix d joins the suffixes on its two sides, as far as prefixes do not fall below d.
Of the smaller side each suffix i is tested: if i + d or i - d lies on the other side by the inverse suffix array, the d words from the
first of the two are followed by the same d words and then by another word than before: a square that cannot move to the right. Moved
to the left as far as it stays a square it covers one run, whole. Runs that are found with multiples of their period cover the same
words, and the smallest period stays. Tests per document of n words are n log n at most, and there are no tree nodes,
only the two ends of each border's sides.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlake.llm.common import SPACES, map_slices, text_or_empty

LEAST, PERIODS = 12, 2
#: Words of one batch that are sorted together; a longer document makes a batch of its own.
WORDS = 200_000
_TO_BLANK = bytes.maketrans(SPACES.encode(), b" " * len(SPACES))


def split_words(text: bytes) -> list[bytes]:
    """The words of a UTF-8 text, runs of anything but ASCII white space."""
    return [w for w in text.translate(_TO_BLANK).split(b" ") if w]


def repeated(n: int, h: int) -> np.ndarray | None:
    """Which original word stands at each place of a text that is made periodic; None for the texts that are not."""
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def suffix_array(ids: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(suffixes in order, ranks by the first 1, 2, 4 ... numbers): equal ranks, equal beginnings. All suffixes must differ."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    first = np.append(True, ids[order[1:]] != ids[order[:-1]])
    rank = np.empty(n + 1, dtype=np.int64)
    rank[n] = -1
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    levels, step = [rank[:n].astype(np.int32)], 1
    while True:
        slots = np.flatnonzero(~(first & np.append(first[1:], True)))  # where ties are left
        if not len(slots):
            return order, levels
        tied = order[slots]
        key = rank[tied] * (n + 1) + rank[np.minimum(tied + step, n)] + 1
        sub = np.argsort(key, kind="stable")
        order[slots], key = tied[sub], key[sub]
        new = np.append(True, key[1:] != key[:-1])
        first[slots] = new
        rank[order[slots]] = np.maximum.accumulate(np.where(new, slots, 0))
        levels.append(rank[:n].astype(np.int32))
        step *= 2


def agree(levels: list[np.ndarray], x: np.ndarray, y: np.ndarray, back: bool = False) -> np.ndarray:
    """How many numbers from places x and y on are the same; with `back`, how many before them. x and y differ."""
    n, got = len(levels[0]), np.zeros(len(x), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        a, b = (x - got - (1 << k), y - got - (1 << k)) if back else (x + got, y + got)
        inside = (np.minimum(a, b) >= 0) & (np.maximum(a, b) < n)
        same = np.zeros(len(x), dtype=bool)
        same[inside] = levels[k][a[inside]] == levels[k][b[inside]]
        got += same.astype(np.int64) << k
    return got


def sides(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(border, first, last) for each border with a common prefix: it joins first..border-1 and border..last.

    lcp[i] belongs to the border before slot i. The left side ends at a border of at most the same prefix, the right one at a smaller.
    Ends are found by jumps over borders whose own end is known to be no nearer.
    """
    n = len(lcp)
    at = np.flatnonzero(lcp > 0)
    padded = np.append(lcp, -1).astype(np.int64)
    padded[0] = -1
    left, right = np.arange(n + 1) - 1, np.arange(n + 1) + 1
    for end, stays in ((left, lambda a, b: padded[a] > padded[b]), (right, lambda a, b: padded[a] >= padded[b])):
        open_ = at
        while len(open_):
            open_ = open_[stays(end[open_], open_)]
            end[open_] = end[end[open_]]
    return at, left[at], right[at] - 1


def _members(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which range, slot) of every slot of the ranges lo..hi."""
    size = hi - lo + 1
    which = np.repeat(np.arange(len(lo)), size)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + lo[which]


def find_runs(ids: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of the runs of at least two periods and `least` numbers, by start, then period.

    ids are documents laid end to end, none sharing a number with another, each ended by a number that occurs once.
    """
    empty = (np.empty(0, dtype=np.int64),) * 3
    if not len(ids):
        return empty
    order, levels = suffix_array(ids)
    if len(levels) == 1:
        return empty
    inverse = np.empty(len(order), dtype=np.int64)
    inverse[order] = np.arange(len(order))
    lcp = np.zeros(len(order), dtype=np.int64)
    near = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]]) + 1
    lcp[near] = agree(levels, order[near - 1], order[near])

    border, lo, hi = sides(lcp)
    left_is_smaller = border - lo <= hi - border + 1
    which, slot = _members(np.where(left_is_smaller, lo, border), np.where(left_is_smaller, border - 1, hi))
    d, i = lcp[border][which], order[slot]
    other_lo, other_hi = np.where(left_is_smaller, border, lo)[which], np.where(left_is_smaller, hi, border - 1)[which]
    squares = []
    for first, second in ((i, i + d), (i - d, i)):
        partner = second if first is i else first
        inside = (partner >= 0) & (partner < len(order))
        j = inverse[np.where(inside, partner, 0)]
        hit = inside & (j >= other_lo) & (j <= other_hi)
        squares.append((first[hit], d[hit]))
    start, period = (np.concatenate(x) for x in zip(*squares))
    end = start + 2 * period
    start = start - agree(levels, start, start + period, back=True)
    long_ = end - start >= least
    start, end, period = start[long_], end[long_], period[long_]
    by = np.lexsort((period, end, start))
    start, end, period = start[by], end[by], period[by]
    new = np.append(True, (start[1:] != start[:-1]) | (end[1:] != end[:-1]))[: len(start)]
    start, length, period = start[new], (end - start)[new], period[new]
    by = np.lexsort((period, start))
    return start[by], length[by], period[by]


SCHEMA = (
    "doc_id long, words long, runs array<struct<start:long,length:long,period:long>>, "
    "longest struct<start:long,length:long,period:long,exponent_milli:long>, runs_sha256 string, collapsed string"
)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_LONGEST = pa.struct([*_RUN, ("exponent_milli", pa.int64())])


def _describe(words: list[bytes], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> tuple:
    """(runs, longest, digest, collapsed text) of one document."""
    lines = [f"{s},{n},{p}\n" for s, n, p in zip(start.tolist(), length.tolist(), period.tolist())]
    digest = hashlib.sha256("".join(lines).encode()).hexdigest()
    if not len(start):
        return [], None, digest, b" ".join(words).decode()
    at = np.lexsort((period, start, -length))[0]
    s, n, p = (int(x[at]) for x in (start, length, period))
    longest = {"start": s, "length": n, "period": p, "exponent_milli": 1000 * n // p}
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(cover, start + period, 1)
    np.add.at(cover, start + length, -1)
    kept = np.flatnonzero(np.cumsum(cover)[:-1] == 0)
    runs = [{"start": a, "length": b, "period": c} for a, b, c in zip(start.tolist(), length.tolist(), period.tolist())]
    return runs, longest, digest, b" ".join([words[k] for k in kept.tolist()]).decode()


def _detect(repeat: bool, least: int, most_words: int):
    def batch_of(held: list[tuple]) -> pa.RecordBatch:
        sizes = np.array([len(w) for _, w, _ in held])
        offsets = np.cumsum(sizes + 1) - sizes - 1
        total = int((sizes + 1).sum())
        ids, used = np.empty(total, dtype=np.int64), 0
        for (_, _, numbers), o in zip(held, offsets.tolist()):
            ids[o : o + len(numbers)] = numbers + used
            used += int(numbers.max(initial=-1)) + 2
            ids[o + len(numbers)] = used - 1
        start, length, period = find_runs(ids, least)
        cuts = np.searchsorted(start, np.append(offsets, total))
        rows = []
        for (doc, words, _), o, a, b in zip(held, offsets.tolist(), cuts[:-1].tolist(), cuts[1:].tolist()):
            rows.append((doc, len(words), *_describe(words, start[a:b] - o, length[a:b], period[a:b])))
        held.clear()
        doc, n, runs, longest, digest, collapsed = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(doc, pa.int64()), pa.array(n, pa.int64()), pa.array(runs, pa.list_(_RUN)), pa.array(longest, _LONGEST),
             pa.array(digest, pa.string()), pa.array(collapsed, pa.string())],
            names=["doc_id", "words", "runs", "longest", "runs_sha256", "collapsed"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for doc, text, h in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), batch.column("h").to_pylist()):
                words = split_words(text)
                seen: dict[bytes, int] = {}
                numbers = np.array([seen.setdefault(w, len(seen)) for w in words], dtype=np.int64)
                at = repeated(len(words), h) if repeat else None
                if at is not None:
                    words, numbers = [words[k] for k in at.tolist()], numbers[at]
                if held and size + len(words) > most_words:
                    yield batch_of(held)
                    size = 0
                held.append((doc, words, numbers))
                size += len(words) + 1
        if held:
            yield batch_of(held)

    return run


def periodic_runs(docs: DataFrame, repeat: bool = False, least: int = LEAST, most_words: int = WORDS) -> DataFrame:
    """(doc_id, words, runs, longest, runs_sha256, collapsed) of every row of docs(doc_id, text).

    A run is a stretch of words, `least` of them and twice its smallest period or more, that no neighbouring word
    extends with that period. `runs` has them by start, then period; `longest` is the one of greatest length, then smallest
    start, then smallest period, or null; `collapsed` is the text without the words that some run holds behind its first period,
    joined by single spaces. With `repeat`, every tenth document by the crc32 of its id (a null id counts as empty text) is first made periodic from a drawn
    word on, to plant runs. A null text, like one without words, has no words and no runs. Rows are independent of each other, so ties and repeated rows need no rule,
    and an empty table gives an empty one; other columns are not read. A task sorts `most_words` words at a time, or one longer
    document, with some 150 bytes of memory a word.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"),
        F.crc32(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))).alias("h"),
    )
    return map_slices(rows, _detect(repeat, least, most_words), SCHEMA, 256)
