"""Temp views over a loaded model, so reports can be written in Spark SQL.

A report is one ``spark.sql`` call: the plan is parsed and analysed once in
the JVM instead of step by step through the Python bridge, and the SQL text
reads like the reference's queries.  Each table dict gets its own view names
(one registration per dict and table), so several loads can live in one session; only the tables
that a text names are asked for.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame

_LOCK = threading.RLock()
_VIEWS: dict[int, tuple[Mapping[str, DataFrame], dict[str, str]]] = {}


def view(tables: Mapping[str, DataFrame], name: str) -> str:
    """The temp view of a table, registered on first use."""
    with _LOCK:
        hit = _VIEWS.get(id(tables))
        if hit is None or hit[0] is not tables:
            hit = _VIEWS[id(tables)] = (tables, {})
        names = hit[1]
        if name not in names:
            made = f"sm_{name}_{uuid.uuid4().hex[:8]}"
            tables[name].createOrReplaceTempView(made)
            names[name] = made
        return names[name]


def render(tables: Mapping[str, DataFrame], text: str) -> str:
    """``text`` with each ``{table}`` placeholder replaced by its view name
    (other braces, e.g. in regular expressions, are left alone)."""
    for name in tables:
        if "{" + name + "}" in text:
            text = text.replace("{" + name + "}", view(tables, name))
    return text


def sql(tables: Mapping[str, DataFrame], text: str) -> DataFrame:
    named = next(name for name in tables if "{" + name + "}" in text)
    return tables[named].sparkSession.sql(render(tables, text))
