"""Reading fields out of stored JSON responses."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from litsieve.functions.text import as_column


def json_path(payload: Column | str, path: str) -> Column:
    """Value at a dotted path such as ``data.0.text``; null when a step is missing.

    A numeric step indexes a list, or names a key where the value is an object.
    """
    payload = as_column(payload)
    if not path:
        return F.lit(None).cast("string")
    paths = ["$"]
    for step in path.split("."):
        options = [f"['{step}']"] + ([f"[{int(step)}]"] if step.isdigit() else [])
        paths = [head + option for head in paths for option in options]
    return F.coalesce(*(F.get_json_object(payload, p) for p in paths))
