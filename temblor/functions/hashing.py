"""Random choice as a hash of (seed, key).

``rand(seed)`` depends on how rows are partitioned, so a retried task or another cluster size
picks other rows. A hash of the row's own key does not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

def sample_hash(seed: int, key: Sequence[str]) -> Column:
    """32 hex digits, uniform over the key; their text order is the random order."""
    parts = [F.col(name).cast("string") for name in key]
    return F.md5(F.concat(F.lit(f"{seed}:"), F.concat_ws("|", *parts)))


def hash_size(hashed: Column) -> Column:
    """The hash up to its first digit that is not zero.

    Its text order is the hash order. Among n keys about n / 16**z have z leading zeros, so the
    first few hash sizes hold few keys and each holds at most about as many as all before it.
    """
    leading_zeros = F.length(hashed) - F.length(F.ltrim(hashed, F.lit("0")))
    return F.substring(hashed, F.lit(1), leading_zeros + 1)


def below_fraction(hashed: Column, fraction: float) -> Column:
    """True for ``fraction`` of all keys."""
    if fraction >= 1.0:
        return F.lit(True)
    return F.substring(hashed, 1, 8) < F.lit(f"{int(fraction * 2**32):08x}")
