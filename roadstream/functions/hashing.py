"""Hash-derived bit positions for the bloom-style distinct count."""

from pyspark.sql import Column, functions as F

HASHES = ("xxhash64", "md5")


def bit_offsets(value, bits: int, hash: str = "xxhash64") -> Column:
    """Two positions in ``[0, bits)`` as an array."""
    value = F.col(value) if isinstance(value, str) else value
    if hash == "xxhash64":
        return F.array(F.pmod(F.xxhash64(value), F.lit(bits)),
                       F.pmod(F.xxhash64(value, F.lit(1)), F.lit(bits)))
    if hash == "md5":
        digest = F.md5(value)
        return F.array(*[
            F.conv(F.substring(digest, at, 8), 16, 10).cast("bigint") % F.lit(bits)
            for at in (1, 9)])
    raise ValueError(f"hash must be one of {HASHES}")
