"""Fill-in-the-middle texts by a pipeline of pyarrow.compute, batch by batch.

A text is a row of units: a word with the white space before it, or white space that ends the text. A batch of texts is
split into a list array of units, the units are flattened with the row each belongs to, numbered within their row, filtered
by role (before the first cut, between the cuts, behind the second), rebuilt into lists per role and joined to
one piece per row and role. The pieces are joined with the marks in the order of the row's form. Texts are handled as
bytes: the white space that ends a unit is ASCII, so no cut falls inside a character.

The draws of a row depend on its id alone, so reruns agree and no task needs another's rows.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlake.llm.common import map_slices, text_or_empty

# The marks of the three parts, and what a unit is.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
_UNIT = rb"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+)"
#: A byte that no UTF-8 text holds.
_END = b"\xff"


def draw(seed: int, part: int) -> Column:
    """The row's draw number `part`: eight hex digits of the SHA-256 of seed and id. A null id counts as empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * part + 1, 8), 16, 10).cast("long")


def _binary(values: pa.Array) -> pa.Array:
    return values.cast(pa.binary())


def units(texts: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """The units of binary texts: all in one array, the row of each, its number within the row."""
    marked = pc.replace_substring_regex(texts, pattern=_UNIT, replacement=rb"\1" + _END)
    lists = pc.split_pattern(marked, pattern=_END)
    flat, parents = pc.list_flatten(lists), pc.list_parent_indices(lists)
    first = pc.take(lists.offsets, parents)
    ordinal = pc.subtract(pa.array(np.arange(len(flat))), pc.subtract(pc.cast(first, pa.int64()), lists.offsets[0].as_py()))
    full = pc.greater(pc.binary_length(flat), 0)  # behind the last end of a row stands an empty piece
    return flat.filter(full), parents.filter(full), ordinal.filter(full)


def _per_row(parents: pa.Array, rows: int) -> pa.Array:
    """How often each of `rows` rows occurs."""
    counted = pc.value_counts(pc.cast(parents, pa.int64()))
    at = pc.index_in(pa.array(np.arange(rows)), counted.field(0))
    return pc.fill_null(pc.take(counted.field(1), at), 0)


def _piece(flat: pa.Array, parents: pa.Array, role: pa.Array, rows: int) -> pa.Array:
    """Of each row the units with the role, joined."""
    own = flat.filter(role)
    ends = pc.cumulative_sum(_per_row(parents.filter(role), rows))
    offsets = pa.concat_arrays([pa.array([0], pa.int64()), ends]).cast(pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, own), b"")


def _constant(value: bytes, rows: int) -> pa.Array:
    return pa.array([value] * rows, pa.binary())


def _join(*pieces: pa.Array) -> pa.Array:
    return pc.binary_join_element_wise(*pieces, pa.scalar(b"", pa.binary()))


def _within(draws: pa.Array, n: pa.Array) -> pa.Array:
    """draws % (n + 1)"""
    size = pc.add(n, 1)
    return pc.subtract(draws, pc.multiply(pc.divide(draws, size), size))


def _transform(plain_percent: int, spm_percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            text = _binary(batch.column("text"))
            flat, parents, ordinal = units(text)
            n = _per_row(parents, rows)
            one, two = (_within(batch.column(c), n) for c in ("h1", "h2"))
            first, second = pc.min_element_wise(one, two), pc.max_element_wise(one, two)
            lo, hi = pc.take(first, parents), pc.take(second, parents)
            before, behind = pc.less(ordinal, lo), pc.greater_equal(ordinal, hi)
            inside = pc.invert(pc.or_(before, behind))
            prefix, middle, suffix = (_piece(flat, parents, role, rows) for role in (before, inside, behind))

            marked = pc.match_substring_regex(text, pattern=b"|".join((PREFIX, SUFFIX, MIDDLE)))
            plain = pc.or_(pc.or_(pc.equal(n, 0), marked), pc.greater_equal(batch.column("h3"), plain_percent))
            spm = pc.less(batch.column("h4"), spm_percent)
            p, s, m = (_constant(x, rows) for x in (PREFIX, SUFFIX, MIDDLE))
            output = pc.if_else(plain, text, pc.if_else(spm, _join(s, suffix, p, prefix, m, middle), _join(p, prefix, s, suffix, m, middle)))
            form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))
            sizes = [pc.if_else(plain, pa.scalar(None, pa.int64()), pc.cast(pc.utf8_length(x.cast(pa.string())), pa.int64())) for x in (prefix, middle)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pc.cast(n, pa.int64()), form.cast(pa.string()), *sizes, output.cast(pa.string())],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    return run


def _halves(texts: pa.Array, mark: bytes) -> tuple[pa.Array, pa.Array]:
    """What stands before and behind the first mark of each text; behind is empty without one."""
    parts = pc.split_pattern(texts, pattern=mark, max_splits=1)
    many = pc.greater(pc.list_value_length(parts), 1)
    padded = pc.if_else(many, texts, _join(texts, _constant(mark, len(texts))))
    parts = pc.split_pattern(padded, pattern=mark, max_splits=1)
    return pc.list_element(parts, 0), pc.list_element(parts, 1)


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        form, output = batch.column("form"), _binary(batch.column("output"))
        spm, plain = pc.equal(form, "spm"), pc.equal(form, "plain")
        rest, middle = _halves(output, MIDDLE)
        # Both forms begin with a mark too, the only one of its kind.
        psm_prefix, psm_suffix = _halves(pc.replace_substring(rest, pattern=PREFIX, replacement=b""), SUFFIX)
        spm_suffix, spm_prefix = _halves(pc.replace_substring(rest, pattern=SUFFIX, replacement=b""), PREFIX)
        text = pc.if_else(spm, _join(spm_prefix, middle, spm_suffix), _join(psm_prefix, middle, psm_suffix))
        restored = pc.if_else(plain, output, text).cast(pa.string())
        yield pa.RecordBatch.from_arrays([*batch.columns, restored], names=[*batch.schema.names, "restored"])


def fill_in_middle(docs: DataFrame, seed: int = 42, plain_percent: int = 50, spm_percent: int = 80, rows: int = 256) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row of docs(doc_id, text).

    A text of n units is cut at two of its n + 1 borders, drawn by the row's id. Of the rows, `plain_percent` in 100 are transformed:
    `spm_percent` in 100 of these to suffix, prefix, middle, the others to prefix, suffix, middle, each part behind
    its mark. All others stay plain, and so does a text that is empty, null (it counts as empty) or holds a mark; their two
    lengths are null. Rows with one id are cut by the same draws; a null id draws as an empty id. An empty table gives an
    empty table, and other columns are not read, whatever their names. A task holds `rows` texts at a time, of
    64 MB at most together or a single longer one, and some four times their bytes.
    """
    draws = {f"h{i + 1}": draw(seed, i) for i in range(4)}
    rows_in = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).withColumns(draws)
    rows_in = rows_in.withColumns({"h3": F.col("h3") % 100, "h4": F.col("h4") % 100})
    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    return map_slices(rows_in, _transform(plain_percent, spm_percent), schema, rows)


def restore(transformed: DataFrame, rows: int = 256) -> DataFrame:
    """transformed(..., form, output) with `restored`, the text rebuilt from output and form alone.

    `form` and `output` must not be null; an empty table gives an empty one; a column `restored` there would clash and is refused.
    """
    if "restored" in transformed.columns:
        raise ValueError("a column restored is there already")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in transformed.schema.fields)
    return map_slices(transformed, _rebuild, f"{fields}, restored string", rows)
