"""Row keys and reproducible hash buckets."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from centigram.functions.columns import col
from centigram.schemas import KEY

# Fixed value: modulus of the integer key.
INT_KEY_MODULUS = 2147483647


def hash_percent(key: Column) -> Column:
    """0..99 from the key's md5, the same on every engine and every run."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") % 100


def product_id(df: DataFrame, style: str = "code", key: str = KEY) -> Column:
    """Identifier of a result row.

    ``code``: the natural key as text.  ``int``: ``id`` if there is one, else the key's
    32-bit hash folded to a non-negative int (two keys may collide).  ``long``: 64-bit
    hash.  Rows with no key fall back to a generated number in the numeric styles.
    """
    if style == "code":
        if key in df.columns:
            return col(key).cast("string")
        if "id" in df.columns:
            return col("id").cast("string")
        return F.monotonically_increasing_id().cast("string")
    if style not in ("int", "long"):
        raise ValueError(f"unknown key style: {style}")
    generated = F.monotonically_increasing_id()
    if style == "int" and "id" in df.columns:
        return col("id").cast("int")
    if key not in df.columns:
        return generated
    text = col(key).cast("string")
    hashed = F.abs(F.hash(text) % INT_KEY_MODULUS) if style == "int" else F.xxhash64(text)
    return F.when(text.isNotNull(), hashed.cast("bigint")).otherwise(generated)
