"""Enough tasks for work that is bound by the CPU, and the folders of partitioned output."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters that a partition folder's name holds as % and two hex digits.
_ESCAPED = re.compile("[\x01-\x1f\x7f\"#%'*/:=?\\\\{\\[\\]^]")


def partition_folder(name: str, value: str) -> str:
    """The folder below a partitioned table that holds rows of ``value``."""
    return f"{name}=" + _ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", value)


def partition_value(path: Column, name: str) -> Column:
    """The value of a partition column from a file's path."""
    text = F.regexp_extract(path, rf"/{name}=([^/]+)/", 1)
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def spread(df: DataFrame, tasks: int) -> DataFrame:
    """``df`` dealt out to so many tasks.

    Detection costs far more than reading, and a table of a few small files is
    read by as many tasks.  It is a shuffle and rows lose their order, so the
    caller decides; the library itself never does it.
    """
    return df.repartition(tasks)
