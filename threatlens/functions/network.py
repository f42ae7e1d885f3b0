"""Network address expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DOTTED_QUAD = r"^\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}$"


def ip_to_long(address: Column) -> Column:
    """IPv4 text as a big-endian 32-bit number; anything else becomes null."""
    parts = F.transform(F.split(address, r"\."), lambda part: part.try_cast("bigint"))
    number = F.aggregate(parts, F.lit(0).cast("bigint"), lambda total, part: total * 256 + part)
    valid = address.rlike(DOTTED_QUAD) & F.forall(parts, lambda part: part <= 255)
    return F.when(valid, number)
