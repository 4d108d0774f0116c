"""C3–C6 content hashes and deterministic keys (``sha2`` in the JVM)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sha256_hex(col: Column) -> Column:
    return F.sha2(col, 256)


def url_hash(url: Column) -> Column:
    return F.sha2(url, 256)


def state_key(dataset: Column, url: Column) -> Column:
    """URL-state key ``{dataset}#{sha256(url)}``."""
    return F.concat(dataset, F.lit("#"), F.sha2(url, 256))


def raw_key(dataset: Column, url: Column) -> Column:
    """Raw page key ``{dataset}/raw/{sha256(url)[:16]}.html``."""
    return F.concat(dataset, F.lit("/raw/"), F.substring(F.sha2(url, 256), 1, 16), F.lit(".html"))


def vector_id(dataset: Column, text: Column) -> Column:
    """Vector id ``sha256("{dataset}:{text}")[:32]``."""
    return F.substring(F.sha2(F.concat_ws(":", dataset, text), 256), 1, 32)


def query_hash(query: Column) -> Column:
    """Answer key ``sha256(query)[:16]``."""
    return F.substring(F.sha2(query, 256), 1, 16)


def hex_bucket(col: Column, n: int) -> Column:
    """``int(sha256(x)[:8], 16) % n`` — a stable bucket of a string."""
    return F.pmod(F.conv(F.substring(F.sha2(col, 256), 1, 8), 16, 10).cast("bigint"), F.lit(n))
