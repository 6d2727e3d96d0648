"""Keep-last merge of a batch into stored rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.catalog import TableSpec, spec_of


def newest_order(df: DataFrame, key: Sequence[str], newest_first: Sequence[str]) -> list[str]:
    """Total order of the rows of one key: the named columns first, then every other column,
    so that the surviving row never depends on how the input was partitioned."""
    columns = df.columns
    named = [c for c in newest_first if c in columns]
    rest = [c for c in columns if c not in named and c not in key]
    return [f"`{c}` DESC NULLS LAST" for c in [*named, *rest]]


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str], n: int = 1) -> DataFrame:
    """First ``n`` rows of each key by an ``ORDER BY`` list. Spark trims each key to ``n`` rows
    before the shuffle (WindowGroupLimit), so a hot key sends at most ``n`` rows per map task."""
    keys, by = ", ".join(f"`{c}`" for c in key), ", ".join(order) or "1"
    rank = f"row_number() OVER (PARTITION BY {keys} ORDER BY {by}) AS _rank"
    return df.selectExpr("*", rank).where(f"_rank <= {n:d}").drop("_rank")


def keep_last(df: DataFrame, key: Sequence[str], newest_first: Sequence[str] = ()) -> DataFrame:
    """One row per key: the newest. Null key parts compare equal."""
    return first_per_key(df, key, newest_order(df, key, newest_first))


def without_keys(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``keys``; null key parts compare equal."""
    other = keys.select(*[F.col(c).alias(f"_other_{c}") for c in on]).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"_other_{c}")) for c in on]
    return df.join(other, same, "left_anti")


def merge_keep_last(
    stored: DataFrame,
    incoming: DataFrame,
    key: Sequence[str],
    newest_first: Sequence[str] = (),
    stored_is_unique: bool = False,
) -> DataFrame:
    """Whole-row replace on the key: incoming beats stored, the newest row wins in a batch.

    Stored rows are kept by an anti join instead of re-ranking both sides, so a small batch is
    broadcast (by size, at run time) and the stored side is not shuffled at all.
    """
    fresh = keep_last(incoming, key, newest_first)
    if not stored_is_unique:
        stored = keep_last(stored, key, newest_first)
    return without_keys(stored, incoming, key).unionByName(fresh, allowMissingColumns=True)


def conform(df: DataFrame, table: str | TableSpec, allow_extra: bool = False) -> DataFrame:
    """Catalogue columns in catalogue order and type; missing ones are null."""
    spec = spec_of(table)
    have = df.columns
    cols = [
        f"CAST({f'`{f.name}`' if f.name in have else 'NULL'} AS {f.dataType.simpleString()}) "
        f"AS `{f.name}`"
        for f in spec.schema.fields
    ]
    extra = [f"`{c}`" for c in have if c not in spec.columns] if allow_extra else []
    return df.selectExpr(*cols, *extra)


def merge_table(
    stored: DataFrame, incoming: DataFrame, table: str, stored_is_unique: bool = False
) -> DataFrame:
    """Keep-last merge with the key and tie-break of a catalogue table."""
    spec = spec_of(table)
    return merge_keep_last(
        stored, conform(incoming, spec), spec.key, spec.newest_first, stored_is_unique
    )
