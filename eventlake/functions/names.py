"""F8: table names from topic names, for driver-side setup and as a column."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATORS = "[-.]"


def table_name(topic: str) -> str:
    return re.sub(SEPARATORS, "_", topic).lower()


def table_name_column(topic: Column) -> Column:
    return F.lower(F.regexp_replace(topic, SEPARATORS, "_"))
