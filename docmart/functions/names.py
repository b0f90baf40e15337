"""Document names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def doc_id(file_name: Column) -> Column:
    """File name without its last extension; leading dots do not start one."""
    return F.regexp_replace(file_name, r"(?s)^(\.*[^.].*)\.[^.]*$", "$1")
