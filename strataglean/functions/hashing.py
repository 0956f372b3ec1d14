"""Integer hashes that any engine can reproduce."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three Bloom hashes (a, b, first modulus or None, bits).
BLOOM_HASHES = [
    (131, 103, None, 69997),
    (137, 107, 701, 69997),
    (149, 109, None, 69997),
]
FM_MODULUS = 69997


def string_mod(text: Column, modulus: int) -> Column:
    """UTF-8 bytes of ``text`` read as one big-endian integer, modulo ``modulus`` (< 2^31).

    Folds three bytes at a time, so no value leaves 64 bits.
    """
    digits = F.hex(F.encode(text, "UTF-8"))

    def step(acc: Column, at: Column) -> Column:
        chunk = F.substring(digits, at, 6)
        value = F.conv(chunk, 16, 10).cast("bigint")
        shift = F.when(F.length(chunk) == 6, F.lit(1 << 24)).when(
            F.length(chunk) == 4, F.lit(1 << 16)
        ).otherwise(F.lit(1 << 8))
        return F.pmod(acc * shift.cast("bigint") + value, F.lit(modulus).cast("bigint"))

    starts = F.when(F.length(digits) > 0, F.sequence(F.lit(1), F.length(digits), F.lit(6)))
    folded = F.aggregate(starts, F.lit(0).cast("bigint"), step)
    return F.when(text.isNotNull(), F.coalesce(folded, F.lit(0).cast("bigint")))


def linear_hash(x: Column, a: int | Column, b: int | Column, modulus: int) -> Column:
    return F.pmod(F.lit(a).cast("bigint") * x + F.lit(b).cast("bigint"), F.lit(modulus).cast("bigint"))


def mod_hash(text: Column, a: int, b: int, m: int, p: int | None = None) -> Column:
    """``((a * int(text) + b) mod p) mod m``; the first modulus is optional."""
    first = p or m
    hashed = linear_hash(string_mod(text, first), a, b, first)
    return hashed if p is None else F.pmod(hashed, F.lit(m).cast("bigint"))


def trailing_zeros(value: Column) -> Column:
    """Zero bits below the lowest set bit; 0 has none."""
    below = value.bitwiseAND(-value) - F.lit(1)
    return F.when(value == 0, F.lit(0)).otherwise(F.bit_count(below))


def md5_int(*parts: Column) -> Column:
    """The first 32 bits of md5 over the joined parts, as a BIGINT."""
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def linear_params(count: int, seed: int, high: int) -> list[tuple[int, int]]:
    """``count`` seeded (a, b) pairs in 1..high."""
    state, out = seed, []
    for _ in range(2 * count):
        state = (state * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out.append(1 + (state >> 33) % high)
    return list(zip(out[0::2], out[1::2]))
