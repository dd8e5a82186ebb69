"""Document fingerprints by one-permutation MinHash, in column functions only.

Every shingle of a text is hashed once. The high bits of a hash choose one of `BINS` bins, and the smallest hash of
a bin stands for it. A bin that no shingle chose borrows from another one: each empty bin has an order of all
bins of its own, given by a hash of both, and takes the value of the first in it that is not empty (optimal densification).
Of each bin the lowest `BITS` bits are kept, packed into numbers of 64 bits. Two fingerprints agree in a bin by chance once in
2^BITS, so the likeness, (share of equal bins - 2^-BITS) / (1 - 2^-BITS), is corrected for that.

All of it happens inside a row, so nothing is shuffled for it. Arrays are sorted, filtered and folded by
higher-order functions; `_let` names a value inside them so that it is worked out once.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bidlake.llm.common import LOWER, SPACES, UPPER, text_or_empty

#: 256 bins of four bits: 1,024 bits, 256 hex digits; a standard error of 0.033 at a similarity of 0.6.
BINS, BITS, SHINGLE, GROUP = 256, 4, 5, 16
_SHIFT = 64 - BINS.bit_length() + 1
_PACKED = 64 // BITS
_LOW = (1 << BITS) - 1


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with the value worked out once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text, runs of anything but ASCII white space, A-Z lower-cased; an empty array without any."""
    blank = F.translate(text, UPPER + SPACES, LOWER + " " * len(SPACES))
    return F.filter(F.split(blank, " "), lambda w: w != "")


def shingle_hashes(text: Column, size: int = SHINGLE) -> Column:
    """64-bit hashes of the runs of `size` words, in order and with repeats; of all words together where there are fewer."""

    def runs(hashed: Column) -> Column:
        # Behind the last word there is no more: the hash takes nulls for nothing.
        run = lambda first, i: F.xxhash64(F.lit(size), first, *(F.get(hashed, i + k) for k in range(1, size)))
        return F.transform(F.slice(hashed, 1, F.greatest(F.least(F.size(hashed), F.lit(1)), F.size(hashed) - size + 1)), run)

    return _let(F.transform(words(text), lambda w: F.xxhash64(w)), runs)


def _bin(value: Column) -> Column:
    """0 to BINS - 1, rising with the value."""
    return F.shiftright(value, _SHIFT) + BINS // 2


def bin_values(hashes: Column) -> Column:
    """The low bits of every bin, borrowed where a bin is empty; an empty array for no hashes.

    A bin travels as one number: its place, a flag if it is empty, its low bits. The order in which an empty bin looks at
    the others goes by groups of `GROUP` neighbours, groups in an order of its own and bins of a group in one too.
    """
    flag, place = 1 << BITS, BITS + 1
    low = lambda x: x.bitwiseAND(F.lit(_LOW))
    # Signed order, so the smallest of a bin come first in it.
    least = lambda a: F.filter(a, lambda x, i: (i == 0) | (F.shiftright(x.bitwiseXOR(F.get(a, i - 1)), _SHIFT) != 0))
    code = lambda x: (_bin(x) * (1 << place) + x.bitwiseAND(F.lit(_LOW).cast("long"))).cast("int")
    is_full = lambda c: c.bitwiseAND(F.lit(flag)) == 0

    def first(items: Column, rank: Callable[[Column], Column]) -> Column:
        """The item of least rank, ties to the least item; items are below 2^16."""
        high = F.lit(-(1 << 16)).cast("long")
        return F.array_min(F.transform(items, lambda x: rank(x).bitwiseAND(high).bitwiseOR(x.cast("long")))).bitwiseAND(F.lit(0xFFFF).cast("long")).cast("int")

    def filled(every: Column) -> Column:
        def borrowed(groups: Column, live: Column, bin_: Column) -> Column:
            group = first(live, lambda g: F.xxhash64(bin_, g))
            return first(F.get(groups, group), lambda c: F.xxhash64(F.shiftright(c, place), bin_))

        def fill(groups: Column) -> Column:
            numbers = F.sequence(F.lit(0), F.lit(BINS // GROUP - 1))
            return _let(
                F.filter(numbers, lambda g: F.size(F.get(groups, g)) > 0),
                lambda live: F.transform(every, lambda c: F.when(is_full(c), low(c)).otherwise(low(borrowed(groups, live, F.shiftright(c, place))))),
            )

        groups = F.transform(F.sequence(F.lit(0), F.lit(BINS // GROUP - 1)), lambda g: F.filter(F.slice(every, g * GROUP + 1, F.lit(GROUP)), is_full))
        return F.when(F.exists(every, lambda c: ~is_full(c)), _let(groups, fill)).otherwise(F.transform(every, low))

    def complete(present: Column) -> Column:
        empty = F.array_except(F.sequence(F.lit(0), F.lit(BINS - 1)), F.transform(present, lambda c: F.shiftright(c, place)))
        return F.sort_array(F.concat(present, F.transform(empty, lambda b: b * (1 << place) + flag)))

    present = _let(F.sort_array(hashes), lambda a: F.transform(least(a), code))
    return F.when(F.size(hashes) > 0, _let(_let(present, complete), filled)).otherwise(F.array().cast("array<int>"))


def pack(bits: Column) -> Column:
    """The low bits of all bins as 64-bit numbers, the first bin highest; an empty array stays empty."""

    def number(j: Column) -> Column:
        return F.aggregate(F.slice(bits, j * _PACKED + 1, F.lit(_PACKED)), F.lit(0).cast("long"), lambda a, x: F.shiftleft(a, BITS).bitwiseOR(x.cast("long")))

    return F.when(F.size(bits) > 0, F.transform(F.sequence(F.lit(0), F.lit(BINS // _PACKED - 1)), number)).otherwise(F.array().cast("array<long>"))


def fingerprint(text: Column, size: int = SHINGLE) -> Column:
    """The packed fingerprint of a text as an array of 64-bit numbers; empty for a text without words or a null text."""
    return _let(_let(_let(F.coalesce(text, F.lit("")), lambda t: shingle_hashes(t, size)), bin_values), pack)


def as_text(packed: Column) -> Column:
    """Hex digits of a packed fingerprint; empty for an empty one."""
    return F.lower(F.array_join(F.transform(packed, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of shingles two packed fingerprints have in common, 0 to 1: 1 for two empty ones, 0 if only one is empty."""
    ones = sum(1 << (BITS * k) for k in range(_PACKED))
    ones = F.lit(ones - (1 << 64) if ones >= 1 << 63 else ones).cast("long")

    def differing(x: Column, y: Column) -> Column:
        # A set bit at the low end of each bin that differs in any of its bits.
        either = x.bitwiseXOR(y)
        step = 1
        while step < BITS:
            folded = F.shiftrightunsigned(either, step)
            either, step = either.bitwiseOR(folded), step * 2
        return F.bit_count(either.bitwiseAND(ones))

    equal = 1 - F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda s, n: s + n) / F.lit(float(BINS))
    chance = 2.0**-BITS
    corrected = F.greatest(F.lit(0.0), (equal - chance) / (1 - chance))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(corrected)


# ---- the next document ---------------------------------------------------------------------------


def _cuts(docs: DataFrame, rows: int, most: int) -> list[int]:
    """Ids, the smallest first, that cut the rows into ranges of about `rows`; at most `most`. All are ids of the table."""
    seen = docs.filter("doc_id IS NOT NULL").agg(F.count("*").alias("n"), F.min("doc_id").alias("least")).first()
    if not seen.n:
        return []
    parts = min(most, -(-seen.n // rows))
    if parts == 1:
        return [seen.least]
    shares = [i / parts for i in range(1, parts)]
    found = docs.agg(F.percentile_approx("doc_id", shares, 10 * parts).alias("cuts")).first().cuts
    return sorted({seen.least, *found})


def with_next(docs: DataFrame, columns: list[str], rows: int = 64, most: int = 1 << 16) -> DataFrame:
    """docs with `next_<column>` of the document of the next higher doc_id; behind the last comes the first.

    Rows of one id stand in the order of their texts' length and hash. A row without id has no place in the order: it is
    its own next. Rows are dealt out once, to ranges of ids of about `rows` rows, and the row that begins a range goes as a
    guest to the range before it too. So no task orders the whole table, and no second copy of the texts is shuffled. Needs `text` among the columns
    of docs, and doc_id of type long.
    """
    cuts = _cuts(docs, rows, most)
    width = max(1, round(len(cuts) ** 0.5))
    coarse, fine = F.lit(cuts[::width]).cast("array<long>"), F.lit(cuts).cast("array<long>")
    id_ = F.col("doc_id")
    below = lambda a: F.size(F.filter(a, lambda c: c <= id_))
    # How many cuts are not above the id, by way of every width-th of them.
    block = F.greatest(below(coarse) - 1, F.lit(0)) * width
    own = (block + below(F.slice(fine, block + 1, F.lit(width))) - 1).cast("long")
    alone = -1 - F.pmod(F.monotonically_increasing_id(), F.lit(1 << 20))
    placed = docs.withColumn("__range", F.when(id_.isNull(), alone).otherwise(own))
    starts = F.coalesce(F.get(fine, F.col("__range").cast("int")) == id_, F.lit(False))
    place = lambda r, guest: F.struct(r.alias("range"), F.lit(guest).alias("guest"))
    before = F.pmod(F.col("__range") - 1, F.lit(max(1, len(cuts))).cast("long"))
    at = F.explode(F.when(starts, F.array(place(F.col("__range"), False), place(before, True))).otherwise(F.array(place(F.col("__range"), False))))
    dealt = placed.withColumn("__at", at).withColumns({"__range": F.col("__at.range"), "__guest": F.col("__at.guest")}).drop("__at")
    w = Window.partitionBy("__range").orderBy("__guest", "doc_id", F.length("text"), F.xxhash64("text"), F.xxhash64(F.lit(1), F.col("text")))
    ahead = {f"next_{c}": F.when(id_.isNull(), F.col(c)).otherwise(F.lead(c).over(w)) for c in columns}
    return dealt.withColumns(ahead).filter("NOT __guest").drop("__range", "__guest")


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next) of every row of docs(doc_id, text).

    `edited` is the text with its last quarter of code points (rounded down) replaced by as many from the head of the next document, or by
    all of that if it is shorter. The next document is that of the next higher doc_id, see `with_next`, which says what ties,
    repeated rows and null ids do. A null text is empty. A text without words has an empty fingerprint; likeness is 1 between two of
    these and 0 between one and any other. Texts of one to four words are one shingle. A single row is its own next.
    An empty table gives an empty table; other columns are not read. A text is handled whole in its row, at some 100 bytes of memory a word.
    """
    mine = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    signed = mine.withColumn("print", fingerprint(F.col("text"), size))
    rows = with_next(signed, ["text", "print"])
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - quarter), F.substring("next_text", F.lit(1), quarter))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "print", "next_print")
    rows = rows.withColumn("edited_print", fingerprint(F.col("edited"), size))
    return rows.select(
        "doc_id", "n_chars", "edited", as_text(F.col("print")).alias("fingerprint"), as_text(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"), likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )
