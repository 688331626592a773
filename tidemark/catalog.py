"""The registered queries over the driver's tables and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import report_queries as R
from tidemark.plans import table_queries as Q
from tidemark.plans.report_sql import SQL as REPORT_SQL
from tidemark.plans.table_queries import link_graph as link_graph
from tidemark.plans.table_sql import SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: getattr(Q, name) for name in SQL} | {name: getattr(R, name) for name in [*REPORT_SQL, "report_layout"]}
ORACLES: dict[str, str] = SQL | REPORT_SQL
