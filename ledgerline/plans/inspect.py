"""Plan inspection helpers used by the plan tests and the bench."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                "MapInPandas", "PythonUDF")


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def physical_section(df: DataFrame) -> str:
    """The physical operator tree with each node's arguments (simple mode)."""
    return plan_text(df, "simple")


def count_nodes(df: DataFrame, name: str) -> int:
    return len(re.findall(rf"\b{re.escape(name)}\b", physical_section(df)))


def has_python(df: DataFrame) -> bool:
    tree = physical_section(df)
    return any(n in tree for n in PYTHON_NODES)


def scans(df: DataFrame) -> list[str]:
    """ReadSchema of every parquet scan in the plan."""
    return re.findall(r"ReadSchema: (struct<[^\n]*>)", plan_text(df, "formatted"))
