"""Left lookups that hold up under hot keys.

``lookup`` joins rows to a table that is unique on its keys. A table whose
observed size is within the broadcast limits is broadcast, so the (wide)
rows never shuffle. A larger one is joined by shuffle, after the hottest keys
have been taken out of the shuffle: they are matched by broadcast, and the
rows they matched (like those with no key at all) get a key of their own,
which spreads them evenly. With K hot keys taken out, no remaining key can
hold more than 1/K of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchgate.session import Table

BROADCAST_ROWS = 400_000
BROADCAST_BYTES = 48 * 1024 * 1024
HOT_KEYS = 20_000


def fits_broadcast(
    table: Table, max_rows: int | None = None, max_bytes: int | None = None, **_
) -> bool:
    return table.rows <= (BROADCAST_ROWS if max_rows is None else max_rows) and table.bytes <= (
        BROADCAST_BYTES if max_bytes is None else max_bytes
    )


def lookup(
    rows: DataFrame,
    table: Table,
    keys: dict[str, Column],
    values: list[str],
    weight: str,
    spread: Column,
    max_rows: int | None = None,
    max_bytes: int | None = None,
    hot_keys: int | None = None,
) -> DataFrame:
    """Add ``values`` of ``table`` to ``rows``, null where no key matches.

    ``keys`` maps the table's key columns to expressions over ``rows``; the
    last one must be text. ``weight`` is the table column saying how many rows
    want a key, ``spread`` an expression telling rows apart.
    """
    types = {f.name: f.dataType for f in table.df.schema.fields}
    if table.rows == 0:
        return rows.withColumns({v: F.lit(None).cast(types[v]) for v in values})

    probe = {f"__key_{k}": e for k, e in keys.items()}
    probed = rows.withColumns(probe)

    def joined(left: DataFrame, right: DataFrame, probes: dict[str, str], prefix: str) -> DataFrame:
        side = right.select(
            *[F.col(k).alias(f"{prefix}{k}") for k in keys],
            *[F.col(v).alias(f"{prefix}{v}") for v in values],
        )
        on = [F.col(probes[k]) == F.col(f"{prefix}{k}") for k in keys]
        return left.join(side, on, "left")

    names = {k: f"__key_{k}" for k in keys}
    if fits_broadcast(table, max_rows, max_bytes):
        out = joined(probed, F.broadcast(table.df), names, "__t_")
        picked = {v: F.col(f"__t_{v}") for v in values}
        return out.withColumns(picked).select(*rows.columns, *values)

    # No more keys than what may be broadcast holds of the observed average.
    most = (BROADCAST_BYTES if max_bytes is None else max_bytes) * table.rows // max(table.bytes, 1)
    wanted = HOT_KEYS if hot_keys is None else hot_keys
    hot = table.df.orderBy(F.col(weight).desc()).limit(max(min(wanted, most), 1))
    last = list(keys)[-1]
    out = joined(probed, F.broadcast(hot), names, "__h_")
    matched = F.col(f"__h_{last}").isNotNull()
    settled = matched | F.col(names[last]).isNull()
    out = out.withColumn(
        "__cold",
        F.when(settled, F.concat(F.lit("\x00"), spread.cast("string"))).otherwise(
            F.col(names[last])
        ),
    )
    out = joined(out, table.df.hint("merge"), {**names, last: "__cold"}, "__c_")
    picked = {
        v: F.when(matched, F.col(f"__h_{v}")).otherwise(F.col(f"__c_{v}")) for v in values
    }
    return out.withColumns(picked).select(*rows.columns, *values)
