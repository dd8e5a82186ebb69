"""Golden pages and tables, written by hand."""

from pyspark.sql import functions as F

from bidlake.functions import fixed
from bidlake.operators import items as I
from bidlake.operators import pages as P
from bidlake.plans.documents import parse_documents

SUMMARY = """Schedule: A
Contractor Responsive? Bid Amount
Birch Hollow Construction Inc. $92,410.50
Engineer's Estimate $88,020.00"""
ITEMS = """A1130 62201-0250 CULVERT PIPE
Birch Hollow Construction Inc. Lump Sum $41,205.75
Engineer's Estimate 310 LNFT $65.00 $20,150.00"""
CELLS = "doc_id string, page_no int, table_no int, row_no int, cells array<string>"


def pages_of(spark, *texts, layout="prefix", doc="d", stem="stem"):
    rows = [(doc, stem, i + 1, t, layout) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id string, source_stem string, page_no int, text string, layout string")


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_bid_summary(spark):
    rows = got(P.bid_amounts(pages_of(spark, SUMMARY)), "schedule", "contractor", "bid_amount", "is_engineers_estimate")
    assert rows == sorted([
        ("A", "Birch Hollow Construction Inc.", 92410.5, 0),
        ("A", "Engineer's Estimate", 88020.0, 1),
        ("A", "Bid Amount Birch Hollow Construction Inc.", 92410.5, 0),
    ], key=str)


def test_amount_on_next_line_loses_suffix_in_line_pass(spark):
    page = "Total Base Schedule\nBase Schedule A\nWest Fork, LLC\n$ 10.00\nAcme Industries\n$5,000.00\nInc.\nZero Co.\n$0.00"
    rows = got(P.bid_amounts(pages_of(spark, page)), "schedule", "contractor", "bid_amount")
    assert ("A", "West Fork, LLC", 10.0) in rows
    assert ("A", "Acme Industries", 5000.0) in rows
    # The suffix is put after a name that keeps its trailing blank.
    assert ("A", "Acme Industries  Inc.", 5000.0) in rows
    assert not any(r[2] == 0 for r in rows)


def test_item_pages_are_not_summaries(spark):
    pages = pages_of(spark, "Line Item\n" + SUMMARY, "Option: X\nA Co. $1.00")
    assert got(P.summary_pages(pages), "page_no") == [(2,)]


def test_last_context_of_page_wins(spark):
    pages = pages_of(spark, "Schedule: A\nOption: X\nSchedule: B\nOption: YZ", "nothing")
    assert got(P.page_context(pages), "page_no", "schedule", "option") == [(1, "B", "YZ"), (2, None, None)]


def test_prefix_items(spark):
    pages = pages_of(spark, SUMMARY, ITEMS)
    assert {r[0] for r in got(P.contractor_names(pages), "contractor")} == {
        "Birch Hollow Construction Inc.", "Birch Hollow Construction Inc. Lump Sum",
    }
    rows = got(I.line_items_text(pages), *I.ITEM_COLUMNS[1:])
    head = (2, None, None, "A1130", "62201-0250", "CULVERT PIPE", 310.0, "LNFT")
    assert rows == sorted([
        head + ("Birch Hollow Construction Inc.", None, 41205.75, 0),
        head + ("Engineer's Estimate", 65.0, 20150.0, 1),
    ], key=str)


def test_shortest_name_is_taken(spark):
    names = spark.createDataFrame([("d", "ABC"), ("d", "ABC Inc."), ("d", "AB"), ("e", "ABC Inc.")], "doc_id string, contractor string")
    assert got(I.shortest_names(names), "doc_id", "contractor") == [("d", "AB"), ("e", "ABC Inc.")]


def test_wrapped_names(spark):
    page = "\n".join([
        "A0100 15102-0000 CLEARING AND",
        "Birch Hollow Construction",
        "GRUBBING",
        "$10.00 $1,000.00",
        "Inc.",
        "West Fork, LLC $9.00 $900.00",
        "Engineer's Estimate 100 SQYD $8.00 $800.00",
        "West Fork,",
        "Engineer's Estimate $1.00",
        "$7.00",
        "A1130 15103-0000 SEEDING",
        "$5.00",
    ])
    summary = "Contractor Responsive?\nBirch Hollow Construction Inc. $1.00\nWest Fork, LLC $2.00"
    rows = got(I.line_items_wrapped(pages_of(spark, summary, page, layout="wrapped")), "description", "quantity", "unit", "contractor", "unit_price", "amount")
    head = ("CLEARING AND GRUBBING ,", 100.0, "SQYD")
    assert rows == sorted([
        head + ("Birch Hollow Construction Inc.", 10.0, 1000.0),
        head + ("West Fork, LLC", 9.0, 900.0),
        head + ("Engineer's Estimate", 8.0, 800.0),
        head + ("Engineer's Estimate", None, 1.0),
        head + ("West Fork", None, 7.0),
    ], key=str)


def cells_of(spark, rows, page=1, table=0):
    return spark.createDataFrame([("d", page, table, i, r) for i, r in enumerate(rows)], CELLS)


def test_cells_with_header_and_carry(spark):
    cells = cells_of(spark, [
        ["Line Item No.", "Pay Item No.", "Description", "Contractor", "Qty", "Unit", "Price", "Amount"],
        ["A0010", "62201-0250", "CULVERT PIPE", "", "", "", "", ""],
        ["", "", "", "West Fork, LLC", "1,000", "LNFT", "$2.00", "$2,000.00"],
        ["A0099", "15199-0000", "NOT CARRIED", "No Money Co.", "", "", "", ""],
        ["", "", None, "Engineer's  Estimate", "1,000", "LNFT", "$3.00", "$3,000.00 Generated by : someone"],
        ["A0020", "15102-0000", "CLEARING", "Short Row", "5", "", "$1.00"],
        ["", "", "", "Bad Money", "5", "", "x", "y"],
    ])
    rows = got(I.line_items_cells(cells, pages_of(spark, "Schedule: C\nOption: X")), *I.ITEM_COLUMNS[1:])
    assert rows == sorted([
        (1, "C", "X", "A0010", "62201-0250", "CULVERT PIPE", 1000.0, "LNFT", "West Fork, LLC", 2.0, 2000.0, 0),
        (1, "C", "X", "A0010", "62201-0250", "CULVERT PIPE", 1000.0, "LNFT", "Engineer's Estimate", 3.0, 3000.0, 1),
        (1, "C", "X", "A0020", "15102-0000", "CLEARING", 5.0, None, "Short Row", 1.0, None, 0),
    ], key=str)


def test_cells_without_header_need_signature(spark):
    signed = cells_of(spark, [["x"], ["A0010", "62201-0250", "D", "Acme", "1", "EA", "$1.00", "$1.00"]])
    plain = cells_of(spark, [["Name", "Amount"], ["Acme", "$1.00", "D", "Acme", "1", "EA", "$1.00", "$1.00"]], table=1)
    rows = got(I.line_items_cells(signed.union(plain), pages_of(spark, "no context")), "line_item_no", "schedule", "contractor")
    assert rows == [("A0010", "A", "Acme")]


def walk_table(rows):
    """What a reader going down the table would note."""
    known = ["", "", ""]
    for own0, own1, own2, contractor, price in rows:
        now = [own or old for own, old in zip((own0, own1, own2), known)]
        whole = bool(now[0] and now[1] and contractor)
        if whole and price:
            yield now[0], now[1], now[2] or None, contractor
        if price or not whole:
            known = now


def test_carry_against_brute_force(spark):
    import random

    rng = random.Random(7)
    tables, expected = [], []
    for t in range(150):
        rows = [(rng.choice(["", "", f"A{i:04d}"]), rng.choice(["", "", f"{15000 + i}-0000"]), rng.choice(["", f"D{i}"]),
                 rng.choice(["", "Acme", "West"]), rng.choice(["", "$1.00"])) for i in range(rng.randint(1, 9))]
        top = ["Line Item Pay Item"]
        tables += [("d", 1, t, 0, top)]
        tables += [("d", 1, t, i + 1, [a, b, c, d, "", "", e, ""]) for i, (a, b, c, d, e) in enumerate(rows)]
        expected += [(t,) + r for r in walk_table(rows)]
    cells = spark.createDataFrame(tables, CELLS)
    rows = got(I.line_items_cells(cells, pages_of(spark, "")), "block_no", "line_item_no", "pay_item_no", "description", "contractor")
    assert rows == sorted(expected, key=str)


def test_schedule_is_carried_over_pages(spark):
    pages = pages_of(spark, "Schedule: B", "none", "Schedule: C", "none")
    assert got(I.schedule_seen(P.page_context(pages)), "page_no", "schedule") == [(1, "B"), (2, "B"), (3, "C"), (4, "C")]


def test_table_rows_take_quantity_from_text(spark):
    pages = pages_of(spark, "Schedule: A\n" + SUMMARY, "Schedule: A\n" + ITEMS)
    cells = cells_of(spark, [["A1130", "62201-0250", "CULVERT PIPE", "Birch Hollow Construction Inc.", "", "", "", "$41,205.75"]], page=2)
    tables = parse_documents(pages, cells)
    assert got(tables["items"], "contractor", "quantity", "unit", "amount") == [
        ("Birch Hollow Construction Inc.", 310.0, "LNFT", 41205.75)
    ]
    other = pages_of(spark, SUMMARY, ITEMS, doc="e")
    assert parse_documents(pages.union(other), cells)["items"].count() == 3


METADATA_PAGE = """Report Generated on 3/4/2024
Project Name: BRIDGE  REPAIR 12
Division: East
Solicitation No. AB-12-9
State: NC
County: Lake, Hill
Opened at: Raleigh office
Bid Open Date and Time: 3/4/2024 10:00 AM
"""


def test_metadata(spark):
    row = P.doc_metadata(pages_of(spark, METADATA_PAGE, "Report Date: 1/2/2024")).first()
    assert row["report_date"] == "1/2/2024"
    assert row["project_name"] == "BRIDGE REPAIR 12"
    assert row["solicitation_no"] == "AB-12-9"
    assert (row["state"], row["county"], row["opened_at"]) == ("NC", "Lake, Hill", "Raleigh office")
    assert row["bid_open_date_time"].startswith("3/4/2024 10:00 AM")


def test_metadata_across_a_page_break(spark):
    row = P.doc_metadata(pages_of(spark, "x\nProject Name: CULVERT", "Division: West\nReport Date:", "5/6/2024")).first()
    assert (row["project_name"], row["report_date"]) == ("CULVERT", "5/6/2024")


def test_project_name_from_head_of_page_one(spark):
    row = P.doc_metadata(pages_of(spark, "Tabulation\nProject Name: DAM 3 Solicitation No. 77", layout="wrapped")).first()
    assert row["project_name"] == "DAM 3"


def test_report_dates_from_first_two_pages(spark):
    pages = pages_of(spark, "Report Generated on 3/4/2024", "Report Date: 1/2/2024", "x")
    assert P.report_dates(pages).first()["report_date"] == "1/2/2024"
    late = pages_of(spark, "x", "Report Generated on 3/4/2024", "Report Date: 1/2/2024")
    assert P.report_dates(late).first()["report_date"] == "3/4/2024"


def test_lines_and_quantity(spark):
    lines = P.explode_lines(pages_of(spark, " a  b \r\n\t\n c "))
    assert got(lines, "line_no", "line") == [(0, "a b"), (1, "c")]
    df = spark.createDataFrame([("x 1,200.500 SY 3 EA",), ("5 XX 7, LF 8 LF",), ("none",)], "line string")
    q, u = P.qty_unit(F.col("line"))
    assert [tuple(r) for r in df.select(q, u).collect()] == [(1200.5, "SY"), (8.0, "LF"), (None, None)]


def test_metadata_runs_over_any_number_of_lines_and_pages(spark):
    long_name = pages_of(spark, "x\nProject Name: LEVEE\nB\nC\nD\nE", "F\nG", "H\nContractor Responsive?", layout="wrapped")
    assert P.doc_metadata(long_name).first().project_name == "LEVEE B C D E F G H"
    gap = pages_of(spark, "Project Name: SLUICE", "gone", "Division: W").filter("page_no <> 2")
    assert P.doc_metadata(gap).first().project_name == "SLUICE"
    # A county is closed by the end of its line; the document's last line has none.
    assert P.doc_metadata(pages_of(spark, "a\nCounty: Lake")).first().county is None
    assert P.doc_metadata(pages_of(spark, "a\nCounty: Lake", "b")).first().county == "Lake"


def joined_metadata(pages):
    """The same seven fields by searching each document's joined text, which is what the pieces stand for."""
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_no", F.coalesce("text", F.lit("")).alias("t")))), lambda p: p["t"]), "\n")
    first = F.max(F.when(F.col("page_no") == 1, F.col("text")))
    docs = pages.groupBy("doc_id", "source_stem", "layout").agg(whole.alias("text"), first.alias("first"))
    wrapped = F.col("layout") == "wrapped"

    def field(name):
        hits = [P.capture(F.col("text"), "(?idU)" + p) for p in fixed.METADATA[name]]
        if name == "project_name":
            hits.append(F.when(wrapped, P.capture(F.col("text"), "(?idU)" + fixed.WRAPPED_PROJECT_NAME)))
        clean = F.nullif(F.when(wrapped, P.norm_ws(F.coalesce(*hits))).otherwise(P.norm_blanks(F.coalesce(*hits))), F.lit(""))
        return F.coalesce(clean, F.when(wrapped, P.header_project_name(F.col("first")))) if name == "project_name" else clean

    return docs.select("doc_id", "source_stem", "layout", *[field(f).alias(f) for f in fixed.METADATA])


def test_metadata_pieces_against_joined_text(spark):
    import random

    rng = random.Random(11)
    parts = [
        "Report Date:", "Report Generated on", "1/2/2024", "12/3/24", "Project Name:", "project name: A B", "NAME \U0001f600 X", "Contractor", "Contractor Responsive?", "Division: W",
        "Schedule: A", "Project No", "Solicitation No.", "Solicitation No", ":", "AB-1", "State:", "State: NC", "VA", "County:", "County: Lake, \U0001f600", "County: Hill",
        "Opened at:", "Opened at: ", "Room 7", "Bid Open Date and Time:", "1/2/2024 9:00 AM", "x", "", " ", "\t", "other words",
    ]
    rows = []
    for d in range(1500):
        page = 0
        for _ in range(rng.randint(1, 6)):
            page += rng.choice([1, 1, 1, 2, 5000])
            text = rng.choice(["\n", "\n", " ", "\r\n"]).join(rng.choice(parts) for _ in range(rng.choice([0, 1, 1, 2, 3, 4, 5, 9])))
            rows.append((f"d{d}", "s", page, None if rng.random() < 0.02 else text, "wrapped" if d % 2 else "prefix"))
    pages = spark.createDataFrame(rows, "doc_id string, source_stem string, page_no int, text string, layout string").repartition(5)
    fields = ["doc_id", "layout", *fixed.METADATA]
    mine, theirs = got(P.doc_metadata(pages), *fields), got(joined_metadata(pages), *fields)
    assert [(a, b) for a, b in zip(mine, theirs) if a != b] == [] and len(mine) == len(theirs) == 1500
    assert all(sum(r[2 + i] is not None for r in theirs) > 20 for i in range(7))


def test_metadata_of_a_document_of_many_pages(spark):
    """One document holds nearly all pages; its fields lie at its ends and across a gap."""
    n = 100_000
    text = F.when(F.col("id") == 0, "Project Name:").when(F.col("id") == 1, "WEIR").when(F.col("id") == 2, "Division: W").when(
        F.col("id") == n - 2, "Report Date:").when(F.col("id") == n - 1, "5/6/2024").otherwise(F.concat(F.lit("line one\nand page "), F.col("id").cast("string")))
    big = spark.range(n).select(F.lit("big").alias("doc_id"), F.lit("s").alias("source_stem"), (F.col("id") * 3 + 1).cast("int").alias("page_no"), text.alias("text"), F.lit("prefix").alias("layout"))
    pages = big.unionByName(pages_of(spark, METADATA_PAGE))
    found = {r.doc_id: r for r in P.doc_metadata(pages).collect()}
    assert (found["big"].project_name, found["big"].report_date, found["big"].county) == ("WEIR", "5/6/2024", None)
    assert found["d"].project_name == "BRIDGE REPAIR 12"


def test_metadata_of_no_pages(spark):
    assert P.doc_metadata(pages_of(spark, "x").limit(0)).count() == 0


def test_following_rows_over_chunks(spark):
    """The next rows are the same whatever the chunks, with gaps, ties and chunks of few rows."""
    import random

    from bidlake.functions.ordered import following

    rng = random.Random(2)
    rows = [(g, rng.randint(0, 60), f"{i:03d}") for g in "ab" for i in range(50)] + [("c", 7, "only")]
    df = spark.createDataFrame(rows, "g string, n int, v string")
    for chunk in (1, 2, 7, 1000):
        found = {(r.g, r.n, r.v): (r.v_1, r.v_2) for r in following(df, ["g"], "n", "v", 2, chunk).collect()}
        for g in "abc":
            own = sorted(r for r in rows if r[0] == g)
            for k, r in enumerate(own):
                assert found[r] == tuple(own[k + j][2] if k + j < len(own) else None for j in (1, 2))


def test_fragments_against_patterns(spark):
    """Places found by token n-grams are those that a pattern per line and fragment finds, and cutting them out leaves the same text."""
    import random
    import re

    rng = random.Random(4)
    words = ["West", "Fork", "Birch", "Hollow", "Co", "&", "A-1", "O'Neil", "(East)", "Sons", "Inc.", "LLC", "é", "x.y"]
    names = [("d", " ".join(rng.choice(words) for _ in range(rng.randint(1, 5))) + rng.choice(["", ", Inc.", " LLC"])) for _ in range(60)]
    lines = [("d", 1, 0, i, " ".join(rng.choice(words + ["noise", "AWest", "Forks", "Inc.x"]) + rng.choice(["", ",", "."]) for _ in range(rng.randint(1, 9)))) for i in range(300)]
    dictionary = spark.createDataFrame(names, "doc_id string, contractor string").distinct()
    df = spark.createDataFrame(lines, "doc_id string, page_no int, block_no int, line_no int, line string")
    fragments = sorted({r.fragment for r in I.name_fragments(dictionary).collect()})
    found = {(r.line_no, r.fragment) for r in I.known_fragments(df, dictionary).collect()}
    pattern = {f: re.compile(rf"(?<!\w){re.escape(f)}(?!\w)", re.ASCII) for f in fragments}
    assert found == {(r[3], f) for r in lines for f in fragments if pattern[f].search(r[4])} and len(found) > 100
    place = F.struct((-F.length("fragment")).alias("size"), "fragment", "at", "n")
    places = I.known_fragments(df, dictionary).groupBy("line_no").agg(F.collect_list(place).alias("places"))
    cut = df.join(places, "line_no").select("line_no", "line", P.norm_ws(I._without_places(F.col("line"), F.col("places"))).alias("rest"))
    for r in cut.collect():
        text = r.line
        for f in sorted((f for n, f in found if n == r.line_no), key=lambda f: (-len(f), f)):
            text = pattern[f].sub("\x00", text)  # what has gone joins nothing
        assert r.rest == " ".join(text.replace("\x00", "").split())


def test_many_names_of_one_first_word(spark):
    """A document with 1,000 lines and 400 names that all begin with one word: no pairs of lines and names."""
    names = spark.range(400).select(F.lit("d").alias("doc_id"), F.concat(F.lit("Delta Works Number"), F.col("id").cast("string"), F.lit(" Company")).alias("contractor"))
    lines = spark.range(1000).select(
        F.lit("d").alias("doc_id"), F.lit(1).alias("page_no"), F.lit(0).alias("block_no"), F.col("id").cast("int").alias("line_no"),
        F.concat(F.lit("Delta Works Number"), (F.col("id") % 500).cast("string"), F.lit(" Company")).alias("line"),
    )
    sizes = I.name_fragments(names).groupBy("doc_id").agg(F.collect_set("n").alias("sizes"))
    assert I.line_grams(lines, sizes).count() <= 1000 * 4 * 3
    whole = I.known_fragments(lines, names).filter("n = 4")
    assert whole.count() == 800 and whole.filter("fragment <> concat('Delta Works Number', line_no % 500, ' Company')").count() == 0


def test_the_document_job_reads_page_text_three_times_at_most(spark, tmp_path):
    """All page text is read by one scan of the products and one for names that run over pages."""
    import re

    pages_of(spark, METADATA_PAGE, SUMMARY, ITEMS).write.parquet(f"{tmp_path}/pages")
    pages = spark.read.parquet(f"{tmp_path}/pages")
    cells = cells_of(spark, [["A1130", "62201-0250", "CULVERT PIPE", "Birch Hollow Construction Inc.", "", "", "", "$41,205.75"]], page=3)
    plans = [str(t._jdf.queryExecution().executedPlan()) for t in parse_documents(pages, cells).values()]
    assert not any(re.search(r"ReadSchema: struct<[^>]*\btext:", p) for p in plans)


def test_products_give_what_each_operator_gives(spark):
    pages = pages_of(spark, METADATA_PAGE, SUMMARY, ITEMS).union(pages_of(spark, SUMMARY, ITEMS, doc="w", layout="wrapped"))
    products = P.page_products(pages)
    assert got(P.distinct_names(products), "doc_id", "contractor") == got(P.contractor_names(pages), "doc_id", "contractor")
    assert got(products, "doc_id", "page_no", "schedule", "option") == got(P.page_context(pages), "doc_id", "page_no", "schedule", "option")
    bids = P.bids_of(products)
    assert got(bids, *bids.columns) == got(P.bid_rows(pages), *bids.columns) and bids.count() > 0
    blocks = P.blocks_of(products.select("doc_id", "layout", "page_no", "schedule", "option", "blocks"))
    assert got(blocks, *blocks.columns) == got(P.item_blocks(pages), *blocks.columns) and blocks.count() == 2


def test_line_breaks_in_cells_by_layout(spark):
    """The prefix layout keeps a line break in a cell, the wrapped one makes it a blank; names meet the text either way."""
    row = ["A1130", "62201-0250", "CULVERT\nPIPE", "Birch Hollow\nConstruction Inc.", "", "", "", "$41,205.75\nGenerated by : someone"]
    pages = pages_of(spark, "Schedule: A\n" + SUMMARY, "Schedule: A\n" + ITEMS)
    found = got(parse_documents(pages, cells_of(spark, [row], page=2))["items"], "description", "contractor", "quantity", "unit", "amount")
    assert found == [("CULVERT\nPIPE", "Birch Hollow\nConstruction Inc.", 310.0, "LNFT", 41205.75)]
    wrapped = pages_of(spark, "Schedule: A\n" + SUMMARY, "Schedule: A\n" + ITEMS, layout="wrapped")
    found = got(I.line_items_cells(cells_of(spark, [row], page=2), wrapped), "description", "contractor", "amount")
    assert found == [("CULVERT PIPE", "Birch Hollow Construction Inc.", 41205.75)]
    header = ["Line\nItem No.", "Pay\nItem No.", "", "", "", "", "", ""]
    plain = cells_of(spark, [header, ["x", "y", "D", "Acme", "1", "EA", "$1.00", "$1.00"]], page=1)
    assert I.line_items_cells(plain, pages_of(spark, "")).count() == 0
    assert I.line_items_cells(plain, pages_of(spark, "", layout="wrapped")).count() == 1


def test_printed_pages_are_not_shuffled_again(spark, sf_dir):
    """Where line items and orders are shuffled to meet, that is the last shuffle of a document's rows."""
    from bidlake.plans import rendered

    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        blocks = rendered.blocks(spark, sf_dir)
        for made in (rendered.page_text(blocks), rendered.page_cells(blocks), rendered.scattered_pages(blocks)):
            plan = made._jdf.queryExecution().executedPlan().toString()
            assert "hashpartitioning(doc_id" not in plan and "hashpartitioning(orderkey" not in plan
    finally:
        spark.conf.set(key, before)


def test_documents_without_an_open_tail_are_not_ordered(spark):
    """Seams of short, long and nameless documents; heads of documents without an open tail go through no window."""
    from bidlake.operators import pages

    rows = [("a", "s", n, f"line {n}\nReport Date:" if n == 1 else "\n1/2/2024\nmore" if n == 2 else "x", "prefix") for n in range(1, 8)]
    rows += [(d, "s", n, "plain\ntext", "prefix") for d in ("b", "c") for n in range(1, 4)]
    rows += [(None, "s", 1, "State:", "prefix"), (None, "s", 9000, "NC", "prefix")]
    found = spark.createDataFrame(rows, "doc_id string, source_stem string, page_no int, text string, layout string")
    pieces = pages.metadata_pieces(found).cache()
    by_size = [{(r.doc_id, r.page_no): r.seam for r in pages._stitched(pieces, most).collect()} for most in (1, 3, 4096)]
    assert by_size[0] == by_size[1] == by_size[2] and set(by_size[0]) == {("a", 1), (None, 1)}
    assert "1/2/2024" in tuple(by_size[0]["a", 1]) and "NC" in tuple(by_size[0][None, 1])


def test_cells_are_shuffled_once(spark):
    """The windows over tables and the join with page contexts share the shuffle by page."""
    from bidlake.operators import items

    cells = spark.createDataFrame([("a", 2, 0, 0, ["A0001", "15101-0000", "ITEM", "B, Inc.", "1", "EACH", "$2.00", "$2.00"])], "doc_id string, page_no int, table_no int, row_no int, cells array<string>")
    contexts = spark.createDataFrame([("a", 2, "A", None)], "doc_id string, page_no int, schedule string, option string")
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        found = items.items_of_cells(cells, contexts)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(doc_id" in plan and "table_no" not in "".join(line for line in plan.splitlines() if "Exchange" in line)
        assert [(r.schedule, r.amount) for r in found.collect()] == [("A", 2.0)]
    finally:
        spark.conf.set(key, before)


def test_a_name_is_worked_out_once_a_line(spark):
    """Its address pattern stands in the plan once, whatever is asked of the name afterwards."""
    lines = spark.createDataFrame([(["Acme Road, Inc.", "Bolt, Inc. ,", "Engineer's Co., Inc.", "Crane, Inc. $5", "Bolt, Inc."],)], "lines array<string>")
    found = lines.select(P.names_on(F.col("lines")).alias("names"))
    assert found.first()["names"] == ["Bolt, Inc.", "Crane, Inc."]
    assert found._jdf.queryExecution().analyzed().toString().count("North Carolina") == 1


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_cells_are_normalised_once(spark):
    """Whatever looks at a cell finds it normalised: one array, below the windows."""
    rows = [("d", 1, 0, 0, "wrapped", ["A001", " 15101-0000 ", "x\n y", None, "", "", "", "$1.00 Generated by : me"]), ("d", 1, 0, 1, "wrapped", None)]
    cells = spark.createDataFrame(rows, "doc_id string, page_no int, table_no int, row_no int, layout string, cells array<string>")
    found = I.item_table_rows(cells)
    assert [tuple(r)[4:] for r in found.orderBy("row_no").collect()] == [("A001", "15101-0000", "x y", "", "", "", "", "$1.00"), ("",) * 8]
    assert _optimized(found).count("transform(") == 1


def test_shortest_names_reads_page_text_once(spark, sf_dir):
    from bidlake.plans import queries_text

    assert "text#" not in _optimized(queries_text.shortest_names(spark, sf_dir))
