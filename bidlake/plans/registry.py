"""Registered queries: a DataFrame function and, where SQL can say it, the SQL for the same rows."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from bidlake.plans.bid_lines import BID_LINES_SQL, BIDS_SQL, TABLES
from bidlake.plans.rendered import BLOCKS_SQL


@dataclass
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}

_names = {t: t for t in TABLES}
CTES = {
    "bid_lines": BID_LINES_SQL.format(**_names),
    "bids": BIDS_SQL.format(bid_lines="bid_lines"),
    "with_id": "SELECT *, concat(coalesce(project_name, ''), '|', coalesce(schedule, ''), '|', coalesce(option, '')) AS project_id FROM bid_lines",
    "blocks": BLOCKS_SQL.format(**_names),
}
# Which other parts each part is built on.
NEEDS = {"bids": ["bid_lines"], "with_id": ["bid_lines"]}


def with_parts(sql: str, parts: tuple[str, ...], extra: dict[str, str]) -> str:
    """Put the named parts, and those they need, in front of a SELECT."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for part in parts:
        add(part)
    ctes = [(n, CTES[n]) for n in order] + list(extra.items())
    if not ctes:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({body})" for n, body in ctes) + "\n" + sql


def query(sql: str | None = None, parts: tuple[str, ...] = (), name: str | None = None, **extra: str):
    """Register a query under its function's name."""
    def add(run):
        REGISTRY[name or run.__name__] = Query(run, None if sql is None else with_parts(sql, parts, extra))
        return run

    return add
