"""Hash columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def sha256_mod(text: Column, modulus: int) -> Column:
    """The whole 256-bit digest of a text, read as one number, modulo ``modulus``."""
    return digest_mod(F.sha2(text, 256), modulus)


def digest_mod(digest: Column, modulus: int) -> Column:
    """A hex digest of 64 digits, read as one number, modulo ``modulus``.

    The digest is folded chunk by chunk so that every step fits a BIGINT.
    """
    bits = 32 if modulus < 2**31 else 16
    if modulus >= 2**47:
        raise ValueError("modulus must stay below 2**47")
    digits = bits // 4
    folded = F.lit(0).cast("bigint")
    for start in range(1, 65, digits):
        chunk = F.conv(F.substring(digest, start, digits), 16, 10).cast("bigint")
        folded = F.pmod(folded * F.lit(2**bits) + chunk, F.lit(modulus))
    return folded


def short_hash(text: str | Column) -> Column:
    """Six hex digits, the low 24 bits of the text's SHA-256."""
    return F.right(F.sha2(text, 256), F.lit(6))


def shard_of(text: str | Column, shards: int) -> Column:
    """Shard number from the high 32 bits of the text's SHA-256."""
    return F.pmod(F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("bigint"), F.lit(shards)).cast("int")
