"""Item rows out of page text (two layouts) and out of page tables."""

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from bidlake.functions import fixed
from bidlake.functions.ordered import last_seen
from bidlake.functions.text import holds_any, is_engineer, money, norm_blanks, norm_ws, qty
from bidlake.operators.pages import contractor_names, item_blocks, money_pair, page_context, qty_unit, with_layout, wrapped_layout
from bidlake.operators.repair import null_safe_join
from bidlake.sources.writers import written

ITEM_COLUMNS = [
    "doc_id", "pdf_page", "schedule", "option", "line_item_no", "pay_item_no", "description",
    "quantity", "unit", "contractor", "unit_price", "amount", "is_engineers_estimate",
]
ORDER_COLUMNS = ["block_no", "line_no"]


def stored_names(pages: DataFrame) -> DataFrame:
    """Company names per document as a table in the shared folder.

    Names are looked at several times, and finding them reads all page text.
    """
    return written(contractor_names(pages), "names")


# ---- prefix layout -----------------------------------------------------------------------


def name_lengths(names: DataFrame) -> DataFrame:
    """Distinct name lengths of each document: at most one number per possible length."""
    return names.groupBy("doc_id").agg(F.collect_set(F.length("contractor")).alias("lengths"))


def shortest_names(names: DataFrame) -> DataFrame:
    """Names that do not start with another name of the same document.

    The shortest name a line starts with is its contractor, so longer names that start with a
    shorter one can never be it. What is left is prefix-free: a line starts with at most one.
    """
    probes = (
        names.join(name_lengths(names), "doc_id")
        .select("doc_id", "contractor", F.explode("lengths").alias("n"))
        .filter(F.col("n") < F.length("contractor"))
        .select("doc_id", "contractor", F.substr(F.col("contractor"), F.lit(1), F.col("n")).alias("_start"))
    )
    longer = probes.join(
        names.select("doc_id", F.col("contractor").alias("_start")), ["doc_id", "_start"], "left_semi"
    ).select("doc_id", "contractor")
    return names.join(longer, ["doc_id", "contractor"], "left_anti")


def match_names(lines: DataFrame, names: DataFrame, column: str = "line") -> DataFrame:
    """Lines with the name of their document they start with as `contractor`; others go.

    Engineer lines stay, with the engineer as their contractor. A hash join, not a prefix
    comparison of all pairs: each line is looked up once per distinct name length of its document.
    """
    names = shortest_names(names)
    line = F.col(column)
    fitting = F.filter("lengths", lambda n: n <= F.length(line))
    starts = F.transform(fitting, lambda n: F.substr(line, F.lit(1), n))
    tried = F.when(F.col("engineer"), F.array(F.lit(fixed.ENGINEER_NAME))).otherwise(starts)
    probes = (
        lines.withColumn("engineer", is_engineer(line))
        .join(name_lengths(names), "doc_id", "left")
        .withColumn("contractor", F.explode_outer(tried))
        .drop("lengths")
        .filter(F.col("contractor").isNotNull())
    )
    matched = probes.join(names.withColumn("_known", F.lit(True)), ["doc_id", "contractor"], "left")
    return matched.filter(F.col("engineer") | F.col("_known")).drop("_known")


def _block_lines(blocks: DataFrame) -> DataFrame:
    kept = [c for c in blocks.columns if c != "body"]
    return blocks.select(*kept, F.posexplode_outer("body").alias("line_no", "line")).filter(F.col("line_no").isNotNull())


def _finish(rows: DataFrame, contractor: Column, engineer: Column, line: Column, quantity: Column, unit: Column) -> DataFrame:
    price, amount = money_pair(line)
    return rows.select(
        "doc_id", F.col("page_no").alias("pdf_page"), "schedule", "option", "line_item_no", "pay_item_no",
        "description", quantity.alias("quantity"), unit.alias("unit"), contractor.alias("contractor"),
        price.alias("unit_price"), amount.alias("amount"), engineer.cast("int").alias("is_engineers_estimate"),
        *ORDER_COLUMNS,
    )


def line_items_text(pages: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Item rows of the prefix layout: engineer lines, and lines that start with a known name."""
    return items_of_blocks(item_blocks(pages), stored_names(pages) if names is None else names)


def items_of_blocks(blocks: DataFrame, names: DataFrame) -> DataFrame:
    """`line_items_text` of blocks."""
    rows = match_names(_block_lines(blocks), names)
    own_qty, own_unit = (F.when(~F.col("engineer"), c) for c in qty_unit(F.col("line")))
    return _finish(
        rows, F.col("contractor"), F.col("engineer"), F.col("line"),
        F.coalesce(own_qty, F.col("quantity")), F.coalesce(own_unit, F.col("unit")),
    )


# ---- wrapped-name layout -----------------------------------------------------------------

#: A token with the blank before it: all of them in a row are the line.
PIECE = r"\s?(?:\w+|[^\w\s])"
SKIPPED_STARTS = r"(?i)^(schedule:|line item|pay item)"
BLOCK_KEY = ["doc_id", "page_no", "block_no"]


def holds_tail(line: Column) -> Column:
    return holds_any(line, fixed.NAME_TAIL_WORDS)


def pieces_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PIECE), F.lit(0))


def name_fragments(names: DataFrame) -> DataFrame:
    """Whole names and their phrases of 2 and 3 words: (doc_id, fragment, n), n being its number of tokens.

    The words of a name are a column, so that they are not split anew for every phrase.
    """
    words = F.col("_words")
    split = F.filter(F.transform(F.split("contractor", r"[\s,]+"), lambda w: F.btrim(w, F.lit(" ,"))), lambda w: w != "")

    def phrases(size: int) -> Column:
        at = F.sequence(F.lit(1), F.greatest(F.size(words) - size + 1, F.lit(1)))
        texts = F.transform(at, lambda i: F.array_join(F.slice(words, i, size), " "))
        return F.when(F.size(words) >= size, F.filter(texts, lambda t: F.length(t) >= 6)).otherwise(F.array().cast("array<string>"))

    fragments = F.concat(F.array("contractor"), phrases(2), phrases(3))
    return (
        names.withColumn("_words", split).select("doc_id", F.explode_outer(fragments).alias("fragment"))
        .distinct()
        .withColumn("n", F.size(pieces_of(F.col("fragment"))))
    )


def line_grams(lines: DataFrame, sizes: DataFrame) -> DataFrame:
    """Every run of whole tokens of each line that is as long as some fragment of its document: `at`, `n` and the text `fragment`.

    So a line has at most as many as its tokens times the distinct lengths. Runs that begin or end inside a word are not whole.
    """
    pieces, last = F.col("_pieces"), F.size("_pieces") - 1
    piece = lambda i: F.get(pieces, i)
    begins = lambda i: (i == 0) | F.startswith(piece(i), F.lit(" ")) | ~piece(i - 1).rlike(r"\w$")
    ends = lambda i: (i == last) | F.startswith(piece(i + 1), F.lit(" ")) | ~piece(i + 1).rlike(r"^\w")

    def runs(n: Column) -> Column:
        at = F.sequence(F.lit(0), F.greatest(last + 1 - n, F.lit(0)))
        whole = F.filter(at, lambda i: (i + n - 1 <= last) & begins(i) & ends(i + n - 1))
        return F.transform(whole, lambda i: F.struct(i.alias("at"), n.alias("n"), F.ltrim(F.array_join(F.slice(pieces, i + 1, n), "")).alias("fragment")))

    kept = [c for c in lines.columns if c != "line"]
    grams = lines.withColumn("_pieces", pieces_of(F.col("line"))).join(sizes, "doc_id").select(*kept, F.explode(F.flatten(F.transform("sizes", runs))).alias("g"))
    return grams.select(*kept, "g.*")


def known_fragments(lines: DataFrame, names: DataFrame) -> DataFrame:
    """The places of name fragments in lines(..., doc_id, line): `at` (first token), `n` (tokens) and `fragment`.

    The token n-grams of a line meet the dictionary of its document by equality; no pair of a line and a name is formed that does not fit.
    """
    fragments = name_fragments(names)
    sizes = fragments.groupBy("doc_id").agg(F.collect_set("n").alias("sizes"))
    return line_grams(lines, sizes).join(fragments.select("doc_id", "fragment"), ["doc_id", "fragment"])


def _without_places(line: Column, places: Column) -> Column:
    """The line without the tokens of the places, the longest fragments taken first; a place that meets a taken one stays."""
    covered = lambda p: F.sequence(p["at"], p["at"] + p["n"] - 1)
    taken = F.aggregate(
        F.array_sort(places), F.array().cast("array<int>"),
        lambda done, p: F.when(F.arrays_overlap(done, covered(p)), done).otherwise(F.concat(done, covered(p))),
    )
    blank = F.transform(
        F.transform(F.array(taken), lambda t: F.transform(pieces_of(line), lambda x, i: F.when(F.array_contains(t, i), F.when(F.startswith(x, F.lit(" ")), " ").otherwise("")).otherwise(x))),
        lambda xs: F.array_join(xs, ""),
    )
    return blank[0]


def _without_tails(line: Column) -> Column:
    """The line without the company words, where no word character touches them."""
    words = "|".join(re.escape(w) for w in sorted(fixed.NAME_TAIL_WORDS, key=len, reverse=True))
    return norm_ws(F.regexp_replace(line, rf"(?<!\w)(?:{words})(?!\w)", ""))


def loose_lines(blocks: DataFrame) -> DataFrame:
    """The lines of blocks that may hold a broken name: those without money that are not the engineer's."""
    return _block_lines(blocks.select(*BLOCK_KEY, "body")).filter(_is_loose(F.col("line")))


def _is_loose(line: Column) -> Column:
    return ~F.contains(line, F.lit("$")) & ~is_engineer(line)


def _body_with_fragments(blocks: DataFrame, names: DataFrame) -> DataFrame:
    """Blocks whose `body` is lines as structs: line, is_name (may be part of a name), rest (null for a line that is not loose).

    Only the places of fragments are brought together, by block; blocks meet them by their own key.
    """
    found = known_fragments(loose_lines(blocks), names)
    place = F.struct((-F.length("fragment")).alias("size"), "fragment", "at", "n")
    per_line = found.groupBy(*BLOCK_KEY, "line_no").agg(F.collect_list(place).alias("places"))
    notes = per_line.groupBy(*BLOCK_KEY).agg(F.map_from_entries(F.collect_list(F.struct("line_no", "places"))).alias("_notes"))

    def annotate(line: Column, i: Column) -> Column:
        places = F.try_element_at(F.col("_notes"), i)
        kept = F.when(places.isNull(), line).otherwise(_without_places(line, places))
        loose = _is_loose(line)
        return F.struct(line.alias("line"), (loose & (places.isNotNull() | holds_tail(line))).alias("is_name"), F.when(loose, _without_tails(kept)).alias("rest"))

    return blocks.join(notes, BLOCK_KEY, "left").withColumn("body", F.transform("body", annotate)).drop("_notes")


def _marked(body: Column) -> Column:
    """Body lines with their part: money line, name fragment; and the name tail that follows.

    A line right after a money line that has no money but a company word belongs to that money
    line's name and to nothing else.
    """
    def is_money(x: Column) -> Column:
        return x["line"].rlike(fixed.MONEY) & ~is_engineer(x["line"])

    def is_tail(x: Column) -> Column:
        return ~x["line"].rlike(fixed.MONEY) & holds_tail(x["line"])

    def mark(x: Column, i: Column) -> Column:
        before, after = F.try_element_at(body, F.when(i > 0, i)), F.try_element_at(body, i + 2)
        taken = F.coalesce(is_money(before) & is_tail(x), F.lit(False))
        engineer = is_engineer(x["line"]) & ~taken
        money_line = is_money(x)
        plain = ~taken & ~engineer & ~money_line & ~x["line"].rlike(SKIPPED_STARTS)
        return F.struct(
            i.alias("line_no"),
            x["line"].alias("line"),
            engineer.alias("engineer"),
            money_line.alias("money"),
            (plain & x["is_name"]).alias("fragment"),
            F.when(money_line & is_tail(after), after["line"]).alias("tail"),
        )

    return F.transform(body, mark)


def _wrapped_name(marked: Column, x: Column) -> Column:
    """Name of a money line: its text before `$`, else the fragments since the last money line."""
    start = F.btrim(F.substring_index(x["line"], "$", 1), F.lit(" ,"))
    last = F.coalesce(
        F.array_max(F.transform(F.filter(marked, lambda y: y["money"] & (y["line_no"] < x["line_no"])), lambda y: y["line_no"])),
        F.lit(-1),
    )
    parts = F.filter(marked, lambda y: y["fragment"] & (y["line_no"] > last) & (y["line_no"] < x["line_no"]))
    buffered = F.btrim(F.array_join(F.transform(parts, lambda y: y["line"]), " "), F.lit(" ,"))
    name = F.when(start != "", start).otherwise(buffered)
    return F.nullif(F.btrim(F.concat_ws(" ", name, x["tail"]), F.lit(" ,")), F.lit(""))


def line_items_wrapped(pages: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Item rows of the wrapped layout: names may be broken over lines around the money."""
    return wrapped_items_of_blocks(item_blocks(pages), stored_names(pages) if names is None else names)


def wrapped_items_of_blocks(blocks: DataFrame, names: DataFrame) -> DataFrame:
    """`line_items_wrapped` of blocks."""
    blocks = _body_with_fragments(blocks, names)
    body = F.col("body")
    rests = F.transform(F.filter(body, lambda x: x["rest"] != ""), lambda x: x["rest"])
    description = norm_ws(F.array_join(F.concat(F.array("description"), rests), " "))
    marked = blocks.withColumns({"description": description, "_marked": _marked(body)})
    kept = [c for c in blocks.columns if c not in ("body", "description")]

    def row(x: Column) -> Column:
        name = F.when(x["engineer"], fixed.ENGINEER_NAME).otherwise(_wrapped_name(F.col("_marked"), x))
        return F.struct(x["line_no"].alias("line_no"), x["line"].alias("line"), x["engineer"].alias("engineer"), name.alias("contractor"))

    found = F.transform(F.filter("_marked", lambda x: x["engineer"] | x["money"]), row)
    rows = marked.select(*kept, "description", F.inline_outer(found)).filter(F.col("contractor").isNotNull())
    own_qty, own_unit = qty_unit(F.col("line"))
    return _finish(
        rows, F.col("contractor"), F.col("engineer"), F.col("line"),
        F.coalesce(own_qty, F.col("quantity")), F.coalesce(own_unit, F.col("unit")),
    )


# ---- page tables -------------------------------------------------------------------------


def norm_cell(c: Column) -> Column:
    """Cell text, null as empty, normalised as its document's layout has it: the prefix layout keeps line breaks inside a cell."""
    text = F.coalesce(c, F.lit(""))
    return F.when(text == "", "").when(wrapped_layout(), norm_ws(text)).otherwise(norm_blanks(text))


def clean_cell(text: Column) -> Column:
    """Normalised cell text without printed footers."""
    without = norm_cell(reduce(lambda t, p: F.regexp_replace(t, p, ""), fixed.CELL_FOOTERS, text))
    return F.when(holds_any(text, fixed.CELL_FOOTER_MARKS), without).otherwise(text)


def whole_table() -> WindowSpec:
    """All rows of a page's table. It has an order so that every window here shares one sort."""
    return (
        Window.partitionBy("doc_id", "page_no", "table_no").orderBy("row_no")
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )


def item_table_rows(cells: DataFrame) -> DataFrame:
    """Rows of item tables with their 8 cells cleaned as c0..c7; header rows and other tables go.

    A table is an item table if its first row is a header, or if any row starts with a
    line-item and a pay-item number. Cells are normalised by the column `layout`; without one the layout is `prefix`. They are
    normalised once, below the windows, and then only looked at.
    """
    table = whole_table()
    cells = with_layout(cells).withColumn("cells", F.transform("cells", norm_cell))

    def raw(i: int) -> Column:
        return F.coalesce(F.try_element_at("cells", F.lit(i + 1)), F.lit(""))

    joined = F.array_join("cells", " ")
    titles = F.contains(joined, F.lit("Line Item")) & F.contains(joined, F.lit("Pay Item"))
    header = F.when(F.col("row_no") == F.col("_first"), titles).otherwise(False)
    signature = raw(0).rlike(rf"^{fixed.LINE_ITEM}$") & raw(1).rlike(rf"^{fixed.PAY_ITEM}$")
    marked = (
        cells.withColumn("_first", F.min("row_no").over(table))
        .withColumns({"_header": header, "_signature": signature})
        .withColumns({
            "_headed": F.max("_header").over(table),
            "_signed": F.max("_signature").over(table),
            "_blank_top": F.max((F.col("row_no") == F.col("_first")) & (F.size("cells") == 0)).over(table),
        })
        .filter((F.col("_headed") | F.col("_signed")) & ~F.col("_header") & ~F.col("_blank_top"))
    )
    cleaned = [clean_cell(raw(i)).alias(f"c{i}") for i in range(8)]
    return marked.select("doc_id", "page_no", "table_no", "row_no", *cleaned)


def carry_cells(rows: DataFrame) -> DataFrame:
    """Line item, pay item and description filled down within each table.

    A row with a contractor but no money, and with both item numbers known, leaves what is
    carried as it was. Whether they are known depends on earlier such rows, so the row from
    which each number is known is worked out first.
    """
    table = whole_table()
    earlier = table.rowsBetween(Window.unboundedPreceding, -1)
    has = {i: F.col(f"c{i}") != "" for i in (0, 1, 2)}
    moneyless = (F.col("c3") != "") & F.col("unit_price").isNull() & F.col("amount").isNull()

    def first_row(condition: Column) -> Column:
        return F.coalesce(F.min(F.when(condition, F.col("row_no"))).over(table), F.lit(2147483647))

    with_onsets = rows.withColumn("_moneyless", moneyless).withColumns({
        "_sure0": first_row(~F.col("_moneyless") & has[0]),
        "_sure1": first_row(~F.col("_moneyless") & has[1]),
        "_only0": first_row(F.col("_moneyless") & has[0] & ~has[1]),
        "_only1": first_row(F.col("_moneyless") & has[1] & ~has[0]),
    })
    # Of the moneyless rows with one number, only those before the other number is known count.
    maybe0 = F.least("_sure0", "_only0")
    maybe1 = F.least("_sure1", "_only1")
    known0 = F.when(maybe1 < maybe0, F.col("_sure0")).otherwise(maybe0)
    known1 = F.when(maybe0 < maybe1, F.col("_sure1")).otherwise(maybe1)
    before0 = has[0] | (F.col("_known0") < F.col("row_no"))
    before1 = has[1] | (F.col("_known1") < F.col("row_no"))
    flagged = with_onsets.withColumns({"_known0": known0, "_known1": known1}).withColumn(
        "_updates", ~(F.col("_moneyless") & before0 & before1)
    )

    def filled(i: int) -> Column:
        carried = F.last(F.when(F.col("_updates") & has[i], F.col(f"c{i}")), ignorenulls=True).over(earlier)
        return F.coalesce(F.nullif(F.col(f"c{i}"), F.lit("")), carried)

    return flagged.select(
        *rows.columns, filled(0).alias("line_item_no"), filled(1).alias("pay_item_no"), filled(2).alias("description")
    )


def schedule_seen(contexts: DataFrame) -> DataFrame:
    """Per page its option, and the last schedule named on it or an earlier page of its document."""
    return last_seen(contexts, ["doc_id"], "page_no", "schedule")


def line_items_cells(cells: DataFrame, pages: DataFrame) -> DataFrame:
    """Item rows of page tables: rows with both item numbers, a contractor and money."""
    return items_of_cells(cells_with_layout(cells, pages), page_context(pages))


def cells_with_layout(cells: DataFrame, pages: DataFrame) -> DataFrame:
    """The cells with the layout of their document's pages, where they have none of their own."""
    if "layout" in cells.columns or "layout" not in pages.columns:
        return cells
    layouts = pages.groupBy("doc_id").agg(F.max("layout").alias("layout"))
    return cells.join(layouts, "doc_id", "left").withColumn("layout", F.coalesce("layout", F.lit("prefix")))


def items_of_cells(cells: DataFrame, contexts: DataFrame) -> DataFrame:
    """`line_items_cells` with the context of each page.

    Cells are dealt out by page once: the windows over a page's tables and the join with its context find them there.
    """
    priced = item_table_rows(cells.repartition("doc_id", "page_no")).withColumns({"unit_price": money(F.col("c6")), "amount": money(F.col("c7"))})
    rows = carry_cells(priced).filter(
        F.col("line_item_no").isNotNull() & F.col("pay_item_no").isNotNull() & (F.col("c3") != "")
        & (F.col("unit_price").isNotNull() | F.col("amount").isNotNull())
    )
    joined = rows.join(schedule_seen(contexts), ["doc_id", "page_no"], "left")
    letter = F.when(F.col("line_item_no").rlike(r"^[A-Z]\d"), F.left(F.col("line_item_no"), F.lit(1)))
    return joined.select(
        "doc_id", F.col("page_no").alias("pdf_page"),
        F.coalesce("schedule", letter).alias("schedule"), "option",
        "line_item_no", "pay_item_no", "description",
        qty(F.col("c4")).alias("quantity"), F.nullif(F.col("c5"), F.lit("")).alias("unit"),
        F.col("c3").alias("contractor"), "unit_price", "amount",
        is_engineer(F.col("c3")).cast("int").alias("is_engineers_estimate"),
        F.col("table_no").alias("block_no"), F.col("row_no").alias("line_no"),
    )


def fill_from_text(items_cells: DataFrame, items_text: DataFrame) -> DataFrame:
    """Quantity and unit that table rows lack, from the last text row of the same key.

    A name that a cell breaks over lines is the name that the text has on one.
    """
    keys = ["doc_id", "schedule", "line_item_no", "pay_item_no", "_name"]
    place, name = F.struct("pdf_page", *ORDER_COLUMNS), norm_ws(F.col("contractor")).alias("_name")
    last = items_text.groupBy(*keys[:-1], name).agg(F.max_by(F.struct("quantity", "unit"), place).alias("_text"))
    joined = null_safe_join(items_cells.select("*", name), last, keys)
    return joined.withColumns({
        "quantity": F.coalesce("quantity", "_text.quantity"), "unit": F.coalesce("unit", "_text.unit"),
    }).drop("_text", "_name")


def text_only(items_cells: DataFrame, items_text: DataFrame) -> DataFrame:
    """Text rows of the documents without table rows."""
    return items_text.join(items_cells.select("doc_id").distinct(), "doc_id", "left_anti")


def merge_qty_unit(items_cells: DataFrame, items_text: DataFrame) -> DataFrame:
    """Table rows filled from text rows, and the text rows of documents without table rows."""
    return fill_from_text(items_cells, items_text).unionByName(text_only(items_cells, items_text))
