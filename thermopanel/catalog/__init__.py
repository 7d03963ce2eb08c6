"""Named queries over the given tables, each with a SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from thermopanel import rules
from thermopanel.functions.numeric import rounded, tie_nudge
from thermopanel.session import prepare
from thermopanel.sources.panels import HOURLY_STEP, NUMERIC, SEASON_STEP, panel_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, doubles: Sequence[str] | str = (), places: int = 6):
    """Register a query. Doubles are rounded alike on both sides: sums differ in order."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = lambda spark, sf_dir: rounded(build(prepare(spark), sf_dir), places)
        if sql is not None:
            cols = doubles.split() if isinstance(doubles, str) else list(doubles)
            swaps = ", ".join(f'round(CAST("{c}" AS DOUBLE) + {tie_nudge(places)}, {places}) + 0e0 AS "{c}"' for c in cols)
            ORACLES[name] = f"SELECT * REPLACE ({swaps}) FROM (\n{sql}\n)" if cols else sql
        return build

    return register


def _null_if(column: str) -> str:
    codes = "-99e0, -9.9e0" if column == "wd" else "-99e0"
    return f"CASE WHEN {column} IN ({codes}) THEN NULL ELSE {column} END AS {column}"


def panel(step_hours: int) -> str:
    """WITH list: obs (raw), clean (codes to null), ready (rows with a target)."""
    cleaned = ", ".join(_null_if(c) for c in NUMERIC)
    return (
        f"WITH obs AS ({panel_sql(step_hours)}),\n"
        f"clean AS (SELECT id, branch_id, tm, {cleaned} FROM obs),\n"
        "ready AS (SELECT * FROM clean WHERE heat_demand IS NOT NULL)\n"
    )


HOURLY, SEASON = panel(HOURLY_STEP), panel(SEASON_STEP)


def values(rows: Sequence[tuple]) -> str:
    """Rows as a SQL VALUES list."""

    def text(v) -> str:
        return f"'{v}'" if isinstance(v, str) else f"{v}e0" if isinstance(v, float) else str(v)

    return "(VALUES " + ", ".join("(" + ", ".join(text(v) for v in r) + ")" for r in rows) + ")"


CLUSTERS_SQL = f"{values(rules.SITE_CLUSTERS)} AS c(site, cluster_id)"
BREAKPOINTS_SQL = f"{values([(s, *x) for s, x in rules.TA_BREAKPOINTS.items()])} AS b(site, x0, x1)"
NIGHTS_SQL = f"{values(rules.NIGHT_RULES)} AS n(site, start_md, end_md, night_start, night_end)"


def load() -> None:
    """Import every module of the catalog."""
    from thermopanel.catalog import (  # noqa: F401
        aggregates, cleaning, clustering, features, files, jobs, joins, modelling, series, sorting, statistics,
    )
