"""Column expressions: everything here stays inside the JVM."""

from threatlens.functions.hashing import mix, pick_by_hash, split_bucket
from threatlens.functions.network import ip_to_long
from threatlens.functions.text import fill_blank, with_default
from threatlens.functions.times import (
    date_parts,
    epoch_seconds,
    to_ts,
    try_ts,
    weekend_flag,
    year_month,
)

__all__ = [
    "date_parts", "epoch_seconds", "fill_blank", "ip_to_long", "mix", "pick_by_hash",
    "split_bucket", "to_ts", "try_ts", "weekend_flag", "with_default", "year_month",
]
