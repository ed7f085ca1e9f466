"""Deterministic stand-ins for randomness: the same seed picks the same rows
whatever the partitioning, and a retried task repeats its choice."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def order_key(seed: int, *cols: str | Column) -> Column:
    """Text that sorts rows in a seeded pseudo-random order."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.md5(F.concat_ws(":", *[p.cast("string") for p in parts], F.lit(str(seed))))


def bucket60(seed: int, *cols: str | Column) -> Column:
    """Seeded integer in [0, 2**60): more values than there are rows to pick from."""
    return F.conv(F.substring(order_key(seed, *cols), 1, 15), 16, 10).cast("bigint")


def unit(seed: int, *cols: str | Column) -> Column:
    """Seeded number strictly between 0 and 1."""
    return (bucket60(seed, *cols) + F.lit(0.5)) / F.lit(float(1 << 60))


def entity_text(type_name: str | Column, *keys: str | Column) -> Column:
    """The type and source key as one text: what a vertex id is the hash of, in a fraction of its bytes."""
    kind = F.lit(type_name) if isinstance(type_name, str) else type_name
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.concat_ws(":", kind, *[p.cast("string") for p in parts])


def hashed(text: Column) -> Column:
    """The vertex id of an entity's text."""
    return F.sha2(text, 256)


def stable_id(type_name: str | Column, *keys: str | Column) -> Column:
    """Vertex id from the type and source key; unlike a random uuid it survives a re-run."""
    return hashed(entity_text(type_name, *keys))
