"""Left join against a table with unique keys, safe for large tables and for hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeloom.session import staged_bytes

BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 16


def fits_broadcast(table: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Measured size of a staged table against the broadcast bound."""
    return staged_bytes(table) <= limit


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    spread: str,
    how: str = "left",
    broadcast: bool | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Join rows to a lookup table that has at most one entry per key.

    ``table`` should be staged: its size is measured, and it is broadcast only within the bound.
    Beyond it the join shuffles on (key, salt), the salt coming from the row id in ``spread``, so a key
    carried by a large share of all rows is spread over ``salts`` tasks. Entries are repeated per salt,
    which is cheap because a lookup entry stands for many rows.
    """
    small = fits_broadcast(table) if broadcast is None else broadcast
    if small:
        return rows.join(F.broadcast(table), list(on), how)
    salted_rows = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    salted_table = table.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    return salted_rows.join(salted_table, [*on, "_salt"], how).drop("_salt")
