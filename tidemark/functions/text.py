"""Fixed message templates filled with column values."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def fill_message(template: str, **cols: str) -> Column:
    """``{name}`` placeholders of ``template`` replaced by columns."""
    parts = []
    for token in re.split(r"(\{[a-z_]+\})", template):
        if token.startswith("{") and token.endswith("}"):
            parts.append(F.col(cols[token[1:-1]]))
        elif token:
            parts.append(F.lit(token))
    return F.concat(*parts)
