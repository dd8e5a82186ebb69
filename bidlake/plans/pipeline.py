"""Documents or CSV sets to canonical table to feature tables."""

from pyspark.sql import DataFrame, SparkSession

from bidlake.operators.features import line_item_features, project_contractor_features, with_project_id
from bidlake.operators.repair import (
    clean, fill_from_engineer, fill_from_engineer_grouped, fill_report_date, mark_lump_sum, merge_metadata,
)
from bidlake.operators.shape import coerce, ensure_columns, normalize, to_canonical
from bidlake.plans.documents import parse_documents
from bidlake.sources.readers import read_csv_set
from bidlake.sources.writers import write_csv, written


def canonical_items(
    items: DataFrame, bids: DataFrame | None = None, dedupe: bool = False, order: list[str] | None = None, document: list[str] = (),
    doc_meta: DataFrame | None = None, stem: str = "_source_file",
) -> DataFrame:
    """Merge bid metadata in, clean, normalise, fill from the engineer, mark lump sums; stored, as many things read it.

    With `document`, the columns that tell documents apart, each document is first filled from its own engineer rows, null
    options included. With `doc_meta` the report date of an item's document, found by the stem of the column `stem`, is taken where it has none.
    Row order is `_pos` or the columns of `order`.
    """
    merged = ensure_columns(items)
    if document:
        merged = fill_from_engineer_grouped(coerce(merged), order, document)
    if doc_meta is not None:
        merged = fill_report_date(merged, doc_meta, stem)
    if bids is not None:
        merged = merge_metadata(merged, bids, dedupe)
    kept = [c for c in order or [] if c not in to_canonical(merged).columns]
    if kept:
        raise ValueError(f"no canonical columns: {', '.join(kept)}")
    # Each fill reads its input twice.
    cleaned = written(normalize(clean(to_canonical(merged))), "cleaned")
    return written(mark_lump_sum(fill_from_engineer(cleaned, order=order)), "canonical")


def read_canonical(
    spark: SparkSession, items_glob: str, bids_glob: str | None = None, doc_meta: DataFrame | None = None, document: list[str] = (),
    stem: str = "_source_file", dedupe: bool = False,
) -> DataFrame:
    """`canonical_items` of CSV sets, in the order of files and rows."""
    bids = read_csv_set(spark, bids_glob) if bids_glob else None
    return canonical_items(read_csv_set(spark, items_glob), bids, dedupe, document=document, doc_meta=doc_meta, stem=stem)


def feature_tables(items: DataFrame, order: list[str] | None = None) -> dict[str, DataFrame]:
    """The two feature tables of a canonical table."""
    keyed = with_project_id(items)
    return {"line_items": line_item_features(keyed, order), "projects": project_contractor_features(keyed)}


def write_documents(tables: dict[str, DataFrame], folder: str) -> None:
    """The tables of `parse_documents` as CSV sets: items and bids, with the stem of their document.

    Items come in the order of their documents' stems and of their places there, over as many files as that takes.
    """
    write_csv(written(tables["items"], "items").orderBy("_pos"), f"{folder}/items")
    write_csv(tables["bids"], f"{folder}/bids")


def documents_to_features(spark: SparkSession, pages: DataFrame, cells: DataFrame | None, folder: str) -> dict[str, DataFrame]:
    """Pages and their tables to CSV sets in `folder`, those to the canonical table, that to the two feature tables.

    Tables `canonical`, `line_items` and `projects`. Each document is filled from its own engineer rows, and its report date
    goes to its items.
    """
    parsed = parse_documents(pages, cells)
    write_documents(parsed, folder)
    canonical = read_canonical(
        spark, f"{folder}/items/*.csv", f"{folder}/bids/*.csv", parsed["doc_meta"].select("source_stem", "report_date"), ["source_stem"], "source_stem", True
    )
    return {"canonical": canonical} | feature_tables(canonical)
