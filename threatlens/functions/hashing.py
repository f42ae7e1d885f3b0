"""Seeded choices that depend on a row's id only, never on its partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MULTIPLIER = 2654435761  # odd, close to 2^32 / golden ratio
MODULUS = 1 << 32


def mix(key: Column, seed: int = 0) -> Column:
    """Spread an integer id over 0 .. 2^32 - 1.

    The id is reduced to 31 bits first, so the product stays below 2^63 and
    cannot overflow under ANSI arithmetic. Any SQL engine can compute it.
    """
    small = F.pmod(key.cast("bigint"), F.lit(1 << 31))
    return F.pmod(small * F.lit(MULTIPLIER) + F.lit(seed), F.lit(MODULUS))


def draw(key: Column, n: int, seed: int = 0) -> Column:
    """An even draw from 0 .. n - 1, n up to 2^31, fixed by an integer id and the seed.

    Two rounds of multiplying and folding the high bits down reach all 32 bits; the
    draw is their share of n, so it reads the high ones.
    """
    x = mix(key, seed)
    for _ in range(2):
        x = F.pmod(x.bitwiseXOR(F.shiftright(x, 15)).bitwiseAND(F.lit((1 << 31) - 1)) * F.lit(MULTIPLIER), F.lit(MODULUS))
    return F.shiftright(x * F.lit(n), 32)


def scatter(key: Column, seed: int = 0) -> Column:
    """The high half of ``mix``, 0 .. 65535.

    The low bits of a multiplicative hash follow the low bits of the id;
    choices made by a remainder read the high half instead.
    """
    return F.shiftright(mix(key, seed), 16)


def pick_by_hash(key: Column, values: Sequence[str], seed: int = 0) -> Column:
    """One of ``values``, fixed by the key and the seed."""
    options = F.array(*[F.lit(value) for value in values])
    return F.element_at(options, (F.pmod(scatter(key, seed), F.lit(len(values))) + 1).cast("int"))


def split_bucket(key: Column, seed: int = 0, buckets: int = 100) -> Column:
    """A bucket number 0 .. buckets - 1 for random splits."""
    return F.pmod(scatter(key, seed), F.lit(buckets))
