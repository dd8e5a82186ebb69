"""Operators on page text: metadata, lines, context, bidder totals, item blocks.

A page is one row, so everything inside a page is done on arrays within the row. Page text is
not shuffled; only small extracts (names, amounts, captured fields, the lines at a page's ends) are.

Arrays are unnested with the `_outer` generators and a null filter after them: for the plain
ones the optimizer adds a not-empty filter below, which works the whole array out again.
"""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlake.functions import fixed
from bidlake.functions.ordered import following
from bidlake.functions.text import (
    any_of, capture, holds_any, is_engineer, norm_blanks, norm_ws, printed_number, strip_ws,
)
from bidlake.sources.writers import written

# Regular expressions run with Unicode classes; in metadata `.` stops only at a line feed.
UNICODE = "(?U)"
METADATA_FLAGS = "(?idU)"
ANY_BLANKS = r"(?U)[\s&&[^\n\r\x0B\f\x85\u2028\u2029]]+"
LINE_BREAK = r"(?U)\s*\R\s*"
QUANTITY_UNIT = rf"(?<!\S)({fixed.QUANTITY})\b\s+({'|'.join(fixed.LINE_UNITS)})(?!\S)"


def with_layout(pages: DataFrame, layout: str = "prefix") -> DataFrame:
    """Add the layout column where a page table has none."""
    return pages if "layout" in pages.columns else pages.withColumn("layout", F.lit(layout))


def wrapped_layout() -> Column:
    return F.col("layout") == "wrapped"


def lines_of(text: Column, wrapped: Column | None = None) -> Column:
    """The lines of a page that are not blank, in order, with whitespace normalised.

    Blank runs are collapsed over the whole page and the split takes the blanks around a line
    break with it, so there is no work per line. In the wrapped layout every kind of blank is
    collapsed, else only blanks and tabs.
    """
    every, plain = F.regexp_replace(text, ANY_BLANKS, " "), F.regexp_replace(text, r"[ \t]+", " ")
    even = F.when(wrapped_layout() if wrapped is None else wrapped, every).otherwise(plain)
    return F.array_remove(F.split(strip_ws(even), LINE_BREAK), "")


def explode_lines(pages: DataFrame) -> DataFrame:
    """One row per line that is not blank: line_no counts from 0 within the page."""
    lines = lines_of(F.col("text"), None if "layout" in pages.columns else F.lit(True))
    kept = [c for c in pages.columns if c != "text"]
    return pages.select(*kept, F.posexplode_outer(lines).alias("line_no", "line")).filter(F.col("line_no").isNotNull())


def last_capture(lines: Column, pattern: str) -> Column:
    """What the pattern captures in the last line that holds it."""
    hit = F.try_element_at(F.filter(lines, lambda s: s.rlike(pattern)), F.lit(-1))
    return capture(hit, pattern)


def option_of(lines: Column) -> Column:
    return last_capture(lines, UNICODE + fixed.OPTION)


def schedule_of(lines: Column) -> Column:
    return last_capture(lines, UNICODE + fixed.SCHEDULE)


def bid_schedule_of(lines: Column) -> Column:
    """Like `schedule_of`; a line with `Base Schedule` and a lone A sets A."""
    def base_a(s: Column) -> Column:
        return F.contains(s, F.lit("Base Schedule")) & s.rlike(r"\bA\b")

    pattern = UNICODE + fixed.SCHEDULE
    hit = F.try_element_at(F.filter(lines, lambda s: base_a(s) | s.rlike(pattern)), F.lit(-1))
    return F.when(base_a(hit), "A").otherwise(capture(hit, pattern))


def page_context(pages: DataFrame) -> DataFrame:
    """Schedule and option of each page: the last ones named on it."""
    pages = with_layout(pages).withColumn("_lines", lines_of(F.col("text")))
    return pages.select(
        "doc_id", "page_no", schedule_of(F.col("_lines")).alias("schedule"), option_of(F.col("_lines")).alias("option")
    )


def is_summary_page(text: Column) -> Column:
    """Bidder totals are on it and item rows are not."""
    total = holds_any(text, fixed.SUMMARY_PAGE_MARKS) | text.rlike(UNICODE + fixed.SUMMARY_PAGE_OPTION)
    return ~holds_any(text, fixed.ITEM_PAGE_MARKS) & total


def summary_pages(pages: DataFrame) -> DataFrame:
    return pages.filter(is_summary_page(F.col("text")))


# ---- document metadata -------------------------------------------------------------------


def _label(pattern: str) -> str:
    """The literal text a metadata pattern starts with, in lower case."""
    return re.match(r"[A-Za-z ]+", pattern).group().rstrip().lower()


#: The first three lines that are not blank. But for the wrapped name, a match covers three such lines of a document at most.
THREE_LINES = r"(?dU)^(?:\s*\S[^\n]*\n?){0,3}"


def _utf16(text: Column) -> Column:
    """Length in the units that regexp_instr counts in."""
    return F.octet_length(F.encode(text, "UTF-16BE")) / 2


def _is_blank(text: Column) -> Column:
    return ~text.rlike(r"(?U)\S")


def _hits(text: Column, upto: Column, holding: Column) -> dict[str, Column]:
    """Per pattern what its first match in the text captures, if that starts in the first `upto` units.

    `holding` is the lower-case text that a label must be in; looking for that first is much cheaper than the pattern.
    """
    hits = {}
    for pattern in (p for ps in fixed.METADATA.values() for p in ps):
        flagged = METADATA_FLAGS + pattern
        found = F.when(F.contains(holding, F.lit(_label(pattern))), capture(text, flagged))
        hits[pattern] = F.when(found.isNotNull() & (F.regexp_instr(text, F.lit(flagged)) <= upto), found)
    return hits


def metadata_pieces(pages: DataFrame, others: list[str] = ()) -> DataFrame:
    """What each page gives to its document's metadata: finished captures, and the little text that other pages may finish.

    `head` is the page's first three lines that are not blank, or its white space if none is; `tail` is its last three, where a label is among them. A match whose label stands
    before the tail lies within the page (`inner`); one that begins in the tail is looked for in the tail and the heads after it. Columns
    of `others` stay. A null text is empty, and a page without number stands before page 1.
    """
    lower = F.lower("text")
    labels = sorted({_label(p) for ps in fixed.METADATA.values() for p in ps})
    tail = F.reverse(F.regexp_extract(F.reverse("text"), THREE_LINES, 0))
    pages = with_layout(pages).withColumns({"text": F.coalesce("text", F.lit("")), "page_no": F.coalesce("page_no", F.lit(0))})
    pieces = pages.withColumns({
        "_labelled": holds_any(lower, labels), "head": F.when(_is_blank(F.col("text")), F.col("text")).otherwise(F.regexp_extract("text", THREE_LINES, 0)),
    })
    pieces = pieces.withColumn("tail", F.when(F.col("_labelled"), tail))
    inner = _hits(F.col("text"), _utf16(F.col("text")) - _utf16(F.col("tail")), lower)
    return pieces.select(
        "doc_id", "source_stem", "layout", "page_no", "head",
        F.when(holds_any(F.lower("tail"), labels), F.col("tail")).alias("tail"),
        F.when(F.col("_labelled"), F.struct(*[c.alias(f"p{i}") for i, c in enumerate(inner.values())])).alias("inner"),
        F.when(wrapped_layout() & (F.col("page_no") == 1), header_project_name(F.col("text"))).alias("header"), *others,
    )


def _seams(pieces: DataFrame, chunk: int | None) -> DataFrame:
    """`_stitched` of some documents; windows run over `chunk` page numbers, or a document where there is none."""
    noted = following(pieces.select("doc_id", "page_no", "tail", "head"), ["doc_id"], "page_no", "head", 1, chunk)
    blank = F.when(_is_blank(F.col("head_1")), F.concat(F.lit("\n"), "head_1")).otherwise("")
    full = noted.filter(~_is_blank(F.col("head"))).select("doc_id", "page_no", "tail", F.concat("head", blank).alias("head"), blank.alias("_blank"))
    rows = following(full, ["doc_id"], "page_no", "head", 2, chunk).filter(F.col("tail").isNotNull())
    text = F.concat_ws("\n", F.concat("tail", "_blank"), "head_1", "head_2")
    rows = rows.withColumns({"_upto": _utf16(F.col("tail")), "_tail": F.lower("tail"), "_text": text})
    hits = _hits(F.col("_text"), F.col("_upto"), F.col("_tail"))
    return rows.select("doc_id", "page_no", F.struct(*[c.alias(f"p{i}") for i, c in enumerate(hits.values())]).alias("seam"))


def _stitched(pieces: DataFrame, most: int = 4096) -> DataFrame:
    """Pages that have an open tail, with what each pattern captures from it and the heads after it (`seam`).

    A page break is a line break. Blank pages give nothing but white space: of some in a row the first one's is kept by the page before them, and
    they are passed over, so that two full pages after the tail are always enough.

    Only documents that have an open tail are looked at, so the heads of others stay where they are. Those of up to `most` pages are ordered
    whole, longer ones and the pages without a document in chunks.
    """
    sizes = pieces.groupBy("doc_id").agg(F.count("tail").alias("_open"), F.count(F.lit(1)).alias("_n")).filter("_open > 0")
    opened = written(sizes.select("doc_id", "_n"), "open-documents")
    few, many = (pieces.join(opened.filter(c).select("doc_id"), "doc_id", "left_semi") for c in (F.col("_n") <= most, F.col("_n") > most))
    return _seams(few, None).unionByName(_seams(many.unionByName(pieces.filter(F.col("doc_id").isNull())), most))


def _wrapped_names(pages: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, name) of the wrapped layout for the wanted documents: from the first label to the first terminator behind it.

    First the page of the label and that of the terminator are found. Only pages from the one to the other are put
    together, which is no more text than the match and the rest of its two outer pages.
    """
    label, end = _label(fixed.WRAPPED_PROJECT_NAME), r"(?idU)(?:^|\s)Contractor Responsive\?"
    mine = with_layout(pages).filter(wrapped_layout()).join(wanted, "doc_id", "left_semi")
    mine = mine.select("doc_id", F.coalesce("page_no", F.lit(0)).alias("page_no"), F.coalesce("text", F.lit("")).alias("text"))
    from_label = F.substr("text", F.locate("project name:", F.lower("text")))
    marks = mine.select(
        "doc_id", "page_no", F.contains(F.lower("text"), F.lit(label + ":")).alias("labelled"), F.col("text").rlike(end).alias("ended"), from_label.alias("rest")
    )
    first = marks.filter("labelled").groupBy("doc_id").agg(F.min("page_no").alias("first"), F.min_by("rest", "page_no").alias("rest"))
    # Where nothing stands between the label and the next terminator, that one does not end the name.
    bare = F.col("rest").rlike(r"(?idU)^Project Name:\s*(?:Contractor Responsive\?|$)")
    own = F.col("rest").rlike(METADATA_FLAGS + fixed.WRAPPED_PROJECT_NAME)
    first = first.select("doc_id", "first", F.when(own, F.col("first")).alias("own"), F.when(bare, 2).otherwise(1).alias("ends"))
    later = marks.filter("ended").join(first, "doc_id").filter(F.col("page_no") > F.col("first"))
    next_ = later.groupBy("doc_id").agg(F.min("page_no").alias("next"))
    second = later.filter("ends = 2").join(next_, "doc_id").filter("page_no > next").groupBy("doc_id").agg(F.min("page_no").alias("after"))
    bounds = first.join(next_, "doc_id", "left").join(second, "doc_id", "left")
    last = F.coalesce("own", F.when(F.col("ends") == 2, F.coalesce("after", "next")).otherwise(F.col("next")))
    bounds = bounds.select("doc_id", "first", last.alias("last")).filter(F.col("last").isNotNull())
    between = mine.join(bounds, "doc_id").filter(F.col("page_no").between(F.col("first"), F.col("last")))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_no", "text"))), lambda p: p["text"]), "\n")
    return between.groupBy("doc_id").agg(capture(text, METADATA_FLAGS + fixed.WRAPPED_PROJECT_NAME).alias("name"))


def doc_metadata(pages: DataFrame, pieces: DataFrame | None = None) -> DataFrame:
    """One row per document: seven fields, each from the first pattern that hits anywhere in the pages, in page order.

    A match may run over any number of pages, with any gaps between their numbers. No page text is brought together for that: each
    page gives its finished captures and the few lines at its ends that a match may cross (`metadata_pieces`), and those are stitched.
    The wrapped layout's name alone may take whole pages, those it covers. It falls back to the head of page 1. `pieces` are those of the pages where
    they are stored already.
    """
    pieces = written(metadata_pieces(pages), "pieces") if pieces is None else pieces
    patterns = [p for ps in fixed.METADATA.values() for p in ps]
    names = [f"p{i}" for i in range(len(patterns))]
    parts = pieces.filter(F.col("inner").isNotNull()).select("doc_id", "page_no", F.lit(0).alias("part"), "inner.*")
    parts = parts.unionByName(_stitched(pieces).select("doc_id", "page_no", F.lit(1).alias("part"), "seam.*"))
    place = F.struct("page_no", "part")
    hits = parts.groupBy("doc_id").agg(*[F.min_by(n, F.when(F.col(n).isNotNull(), place)).alias(n) for n in names])
    documents = pieces.groupBy("doc_id", "source_stem", "layout").agg(F.max("header").alias("_header"))
    found = documents.withColumnRenamed("doc_id", "_id").join(hits, F.col("_id").eqNullSafe(F.col("doc_id")), "left").drop("doc_id").withColumnRenamed("_id", "doc_id")
    hit = dict(zip(patterns, map(F.col, names)))
    found = found.select("doc_id", "source_stem", "layout", "_header", *[F.coalesce(*[hit[p] for p in ps]).alias(f) for f, ps in fixed.METADATA.items()])
    found = written(found, "captures")
    nameless = found.filter(wrapped_layout() & F.col("project_name").isNull()).select("doc_id")
    found = found.join(_wrapped_names(pages, nameless), "doc_id", "left")

    def cleaned(c: Column) -> Column:
        return F.nullif(F.when(wrapped_layout(), norm_ws(c)).otherwise(norm_blanks(c)), F.lit(""))

    fields = {f: cleaned(F.coalesce("project_name", "name") if f == "project_name" else F.col(f)) for f in fixed.METADATA}
    fields["project_name"] = F.coalesce(fields["project_name"], F.col("_header"))
    return found.select("doc_id", "source_stem", "layout", *[c.alias(name) for name, c in fields.items()])


def header_project_name(text: Column) -> Column:
    """Project name from the first lines of a page."""
    head = F.array_join(F.slice(F.split(F.regexp_replace(text, r"(?U)^\s+|\s+$", ""), r"\R"), 1, fixed.HEADER_LINES), "\n")
    return F.nullif(norm_ws(capture(head, METADATA_FLAGS + fixed.HEADER_PROJECT_NAME)), F.lit(""))


def report_dates(pages: DataFrame) -> DataFrame:
    """Report date per document from its first two pages: `Report Date`, else `Report Generated on`."""
    first, second = ("(?U)" + p for p in fixed.METADATA["report_date"])
    found = pages.filter(F.col("page_no") <= 2).select(
        "doc_id", "source_stem", "page_no", capture(F.col("text"), first).alias("a"), capture(F.col("text"), second).alias("b")
    )

    def earliest(c: str) -> Column:
        return F.min_by(c, F.when(F.col(c).isNotNull(), F.col("page_no")))

    return found.groupBy("doc_id").agg(
        F.max("source_stem").alias("source_stem"), F.coalesce(earliest("a"), earliest("b")).alias("report_date")
    )


# ---- contractor names --------------------------------------------------------------------


def _name_on(line: Column) -> Column:
    """What may be the company name of a line, or null."""
    lower = F.lower(line)
    before_money = F.btrim(F.substring_index(line, "$", 1), F.lit(" ,"))
    of_money_line = F.when((F.length(before_money) >= 3) & ~F.lower(before_money).startswith("engineer"), before_money)
    other = lower.startswith("engineer") | lower.startswith("contract") | lower.startswith("report")
    plain = (F.length(line) >= 3) & ~other & ~line.rlike(fixed.ADDRESS)
    return F.when(line.rlike(r"\$\s*[0-9]"), of_money_line).when(plain, F.btrim(line, F.lit(" ,")))


def names_on(lines: Column) -> Column:
    """Distinct company names that lines give; a name is worked out once and then looked at."""
    found = F.transform(F.filter(lines, lambda s: holds_any(s, fixed.COMPANY_WORDS)), _name_on)
    return F.array_distinct(F.filter(found, lambda name: ~holds_any(name, ["Engineer", "Estimate"]) & (name != "")))


def distinct_names(found: DataFrame) -> DataFrame:
    """(doc_id, contractor) of rows with an array `names`."""
    names = found.select("doc_id", F.explode_outer("names").alias("contractor"))
    return names.filter(F.col("contractor").isNotNull()).distinct()


def contractor_names(pages: DataFrame) -> DataFrame:
    """Distinct company names of each document: (doc_id, contractor)."""
    holding = with_layout(pages).filter(holds_any(F.col("text"), fixed.COMPANY_WORDS))
    return distinct_names(holding.select("doc_id", names_on(lines_of(F.col("text"))).alias("names")))


# ---- bidder totals -----------------------------------------------------------------------


def _amounts_on(lines: Column) -> Column:
    """Lines with their first amount: empty if there is none after a `$`, null without a `$`."""
    def look(line: Column) -> Column:
        amount = F.when(F.contains(line, F.lit("$")), F.regexp_extract(line, fixed.BID_AMOUNT, 0))
        return F.struct(line.alias("line"), amount.alias("amount"))

    return F.transform(lines, look)


def _bid(name: Column, amount: Column) -> Column:
    return F.struct(F.btrim(name, F.lit(" ,")).alias("name"), printed_number(amount).alias("amount"))


def _line_bids(seen: Column) -> Column:
    """Name and amount on one line, or a name line followed by a line of only an amount."""
    def bid(x: Column, i: Column) -> Column:
        line, amount = x["line"], x["amount"]
        after = F.try_element_at(seen, i + 2)
        before = F.call_function("substring_index", line, amount, F.lit(1))
        same = F.when((amount != "") & (F.trim(before) != ""), _bid(before, amount))
        split = F.when(amount.isNull() & (after["amount"] == after["line"]), _bid(line, after["amount"]))
        return F.coalesce(same, split)

    def keep(b: Column) -> Column:
        return (b["amount"] != 0) & (is_engineer(b["name"]) | ((F.length(b["name"]) >= 3) & ~b["name"].rlike(r"^\d")))

    return F.filter(F.array_compact(F.transform(seen, bid)), keep)


def _flat_bids(text: Column) -> Column:
    """Every `name $amount [suffix]` of the page taken as one line.

    A match can only start where a run of name characters does, or where the last match ended;
    saying so keeps the search linear.
    """
    flat = F.regexp_replace(F.replace(text, F.lit("\n"), F.lit(" ")), r"(\$[0-9,]+\.[0-9]{2})([A-Za-z])", "$1 $2")
    pattern = rf"(?:\G|(?<![A-Za-z'.,& ])){fixed.FLAT_BID}({any_of(fixed.BID_NAME_SUFFIXES)})?"
    matches = F.regexp_extract_all(flat, F.lit(pattern), F.lit(0))
    amount = r"(\$[0-9,]+\.[0-9]{2})\s*(.*)"

    def bid(m: Column) -> Column:
        suffix = F.nullif(F.regexp_extract(m, amount, 2), F.lit(""))
        return _bid(F.concat_ws(" ", F.regexp_extract(m, "^[^$\t\r]*", 0), suffix), F.regexp_extract(m, amount, 1))

    def keep(b: Column) -> Column:
        name = b["name"]
        return (b["amount"] != 0) & (F.length(name) >= 3) & (is_engineer(name) | ~F.contains(name, F.lit("Estimate")))

    return F.filter(F.transform(matches, bid), keep)


def bids_on(text: Column, lines: Column, seen: Column) -> Column:
    """Bidder totals of a summary page, both passes, with the page's schedule; null for other pages. `seen` is `_amounts_on(lines)`."""
    rows = F.concat(_line_bids(seen), _flat_bids(text))
    return F.when(is_summary_page(text), F.struct(bid_schedule_of(lines).alias("schedule"), rows.alias("rows")))


def bids_of(found: DataFrame) -> DataFrame:
    """Bidder totals of rows (doc_id, page_no, option, bids), repeats included."""
    rows = found.filter(F.col("bids").isNotNull()).select(
        "doc_id", F.col("page_no").alias("pdf_page"), "bids.schedule", "option", F.explode_outer("bids.rows").alias("b")
    ).filter(F.col("b").isNotNull())
    engineer = is_engineer(F.col("b.name"))
    return rows.select(
        "doc_id", "pdf_page", "schedule", "option",
        F.when(engineer, fixed.ENGINEER_NAME).otherwise(F.col("b.name")).alias("contractor"),
        F.col("b.amount").alias("bid_amount"),
        engineer.cast("int").alias("is_engineers_estimate"),
    )


def bid_rows(pages: DataFrame) -> DataFrame:
    """Bidder totals of the summary pages as found, both passes, repeats included."""
    lines = F.col("_lines")
    found = summary_pages(with_layout(pages)).withColumn("_lines", lines_of(F.col("text"))).withColumn("_seen", _amounts_on(lines))
    return bids_of(found.select("doc_id", "page_no", option_of(lines).alias("option"), bids_on(F.col("text"), lines, F.col("_seen")).alias("bids")))


def first_bids(rows: DataFrame) -> DataFrame:
    """One row per document, schedule, option, contractor and amount: the one on the first page."""
    keys = ["doc_id", "schedule", "option", "contractor", "bid_amount", "is_engineers_estimate"]
    return rows.groupBy(*keys).agg(F.min("pdf_page").alias("pdf_page")).select(*rows.columns)


def bid_amounts(pages: DataFrame) -> DataFrame:
    """Bidder totals per document, without repeats."""
    return first_bids(bid_rows(pages))


# ---- item blocks -------------------------------------------------------------------------


def qty_unit(line: Column) -> tuple[Column, Column]:
    """Quantity and unit: the first number followed by a known unit."""
    number = F.regexp_extract(line, QUANTITY_UNIT, 1)
    return printed_number(number), capture(line, QUANTITY_UNIT, 2)


def money_pair(line: Column) -> tuple[Column, Column]:
    """Price and amount: the last two money values; a lone one is the amount."""
    values = F.regexp_extract_all(line, F.lit(fixed.MONEY), F.lit(1))
    return printed_number(F.try_element_at(values, F.lit(-2))), printed_number(F.try_element_at(values, F.lit(-1)))


def _opens_block(line: Column) -> Column:
    return line.rlike(fixed.LINE_ITEM) & line.rlike(fixed.PAY_ITEM)


def block_starts(lines: Column) -> Column:
    """Places of the lines that open a block."""
    last = F.size(lines) - 1
    return F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: _opens_block(F.try_element_at(lines, i + 1)))


def blocks_on(lines: Column, starts: Column) -> Column:
    """The blocks of a page: number, header line and the lines below it."""
    def block(start: Column, k: Column) -> Column:
        end = F.coalesce(F.try_element_at(starts, k + 2), F.size(lines))
        return F.struct(
            k.alias("block_no"),
            F.try_element_at(lines, start + 1).alias("header"),
            F.slice(lines, start + 2, F.greatest(end - start - 1, F.lit(0))).alias("body"),
        )

    return F.transform(starts, block)


def blocks_of(found: DataFrame) -> DataFrame:
    """One row per block of rows with an array `blocks`, its header taken apart; other columns stay."""
    kept = [c for c in found.columns if c != "blocks"]
    rows = found.select(*kept, F.inline_outer("blocks")).filter(F.col("block_no").isNotNull())
    pay_item = capture(F.col("header"), fixed.PAY_ITEM)
    rest = F.substr(F.col("header"), F.instr(F.col("header"), pay_item) + F.length(pay_item))
    engineer_line = F.try_element_at(F.filter("body", is_engineer), F.lit(1))
    quantity, unit = qty_unit(engineer_line)
    return rows.select(
        *kept, "block_no",
        capture(F.col("header"), fixed.LINE_ITEM).alias("line_item_no"),
        pay_item.alias("pay_item_no"),
        norm_ws(rest).alias("description"),
        quantity.alias("quantity"),
        unit.alias("unit"),
        "body",
    )


def item_blocks(pages: DataFrame) -> DataFrame:
    """One row per item block: its header fields and its lines.

    A line with a line-item number and a pay-item number opens a block, which runs to the next
    such line or the end of the page.
    """
    lines = F.col("_lines")
    kept = [c for c in pages.columns if c not in ("text", "layout")]
    found = with_layout(pages).withColumn("_lines", lines_of(F.col("text"))).withColumn("_starts", block_starts(lines))
    return blocks_of(found.select(
        *kept, "layout", schedule_of(lines).alias("schedule"), option_of(lines).alias("option"), blocks_on(lines, F.col("_starts")).alias("blocks")
    ))


# ---- everything of a page at once ----------------------------------------------------------


def page_products(pages: DataFrame) -> DataFrame:
    """All that a document job needs of a page, from one look at its text: context, names, bidder totals, item blocks and metadata pieces.

    Columns: doc_id, source_stem, layout, page_no, schedule, option, names, bids, blocks, and those of `metadata_pieces`.
    """
    lines, text = F.col("_lines"), F.col("text")
    seen = with_layout(pages).withColumn("_lines", lines_of(text))
    seen = seen.withColumns({"_starts": block_starts(lines), "_seen": F.when(is_summary_page(text), _amounts_on(lines))})
    products = {
        "schedule": schedule_of(lines), "option": option_of(lines), "names": F.when(holds_any(text, fixed.COMPANY_WORDS), names_on(lines)),
        "bids": bids_on(text, lines, F.col("_seen")), "blocks": blocks_on(lines, F.col("_starts")),
    }
    return metadata_pieces(seen.withColumns(products), list(products))
