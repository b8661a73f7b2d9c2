"""Reading only what earlier results ask for: a filter of keys that reaches the scan.

The keys found in one result decide which rows of the next table matter. A semi join on them
would exchange both sides where the keys are many. Instead the keys are hashed into a bitmap
of fixed size, which combines on the map side, is broadcast, and is tested right above the
scan, before any exchange. A row whose key was found is never lost; of the others a few pass
(with one hash, a share of about keys / bits) and are dropped by the exact join that follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# At most this many bits, in words of 64: half a million rows of 16 bytes are broadcast, however
# many keys there are.
KEY_BITS = 1 << 25

_WORD, _BITS = "__word", "__bits"


def _slot(key: Column) -> tuple[Column, Column, Column]:
    """The word of a key, a one, and the place of its bit in the word."""
    h = F.pmod(F.xxhash64(key.cast("bigint")), F.lit(KEY_BITS))
    return F.shiftright(h, 6), F.lit(1).cast("bigint"), F.pmod(h, F.lit(64)).cast("int")


def key_bits(keys: DataFrame, key: str) -> DataFrame:
    """The bitmap of a numeric key column: one row per word that has a bit set."""
    word, one, bit = _slot(F.col(key))
    set_bit = F.call_function("shiftleft", one, bit)
    return keys.where(F.col(key).isNotNull()).select(word.alias(_WORD), set_bit.alias(_BITS)).groupBy(_WORD).agg(
        F.bit_or(_BITS).alias(_BITS)
    )


def may_be_among(df: DataFrame, key: str, bits: DataFrame) -> DataFrame:
    """Rows whose key may be one of the keys in the bitmap; rows without a key go."""
    word, _, bit = _slot(F.col(key))
    hit = F.call_function("shiftright", F.col(_BITS), bit).bitwiseAND(F.lit(1)) == 1
    # the bitmap's size is bounded, so it is broadcast whatever the estimates say
    return df.withColumn(_WORD, word).join(F.broadcast(bits), _WORD).where(hit).select(*df.columns)
