"""Viewer links and their pseudo-JSON state."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridloom.functions.arithmetic import col


def pseudo_json(text: str | Column) -> Column:
    """Pseudo-JSON as JSON: `_` stands for a comma and a single quote for a double one."""
    return F.translate(col(text), "_'", ',"')


def link_state(link: str | Column) -> Column:
    """The JSON state after `#!` of a viewer link; null if there is none. A `+` in the state is literal."""
    state = F.regexp_extract(col(link), r"#!(.*)$", 1)
    return F.when(state != "", pseudo_json(F.url_decode(F.replace(state, F.lit("+"), F.lit("%2B")))))
