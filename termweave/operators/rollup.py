"""Several rows of a record rolled up into one."""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _joined(entries: Column, field: str, by_value: bool) -> Column:
    """The field of all entries as ``a|b|b``, repeated by its copies; NULL if all are NULL."""
    known = F.filter(entries, lambda e: e[field].isNotNull())
    if by_value:
        known = F.array_sort(F.transform(known, lambda e: F.struct(e[field], e["copies"])))
    parts = F.transform(
        known, lambda e: F.concat_ws("|", F.array_repeat(e[field], e["copies"].cast("int")))
    )
    return F.when(F.size(known) > 0, F.array_join(parts, "|"))


def concat_per_record(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    lists: dict[str, str],
    by_value: tuple[str, ...] = (),
    best: dict[str, str] | None = None,
    copies: Column | None = None,
) -> DataFrame:
    """One row per record with ``|``-separated lists of its values.

    Lists are ordered by ``order`` and then by the value, NULLs first, or by the value alone
    for names in ``by_value``; NULL values are skipped one by one. ``best`` adds the first
    value of a column, what rank 1 of a dense rank would keep. ``copies`` weighs each row, in
    place of rows that a fan-out would repeat.

    Equal entries are counted before they are brought together by record, under a key that
    spreads a record with very many rows. What then meets in one group is the distinct
    entries, the text of the result itself.
    """
    fields = list(dict.fromkeys(order + list(lists.values())))
    best = best or {}
    copies = F.lit(1) if copies is None else copies
    entries = df.groupBy(keys + fields).agg(
        F.sum(copies).alias("copies"),
        *[F.min(F.struct(F.col(c).alias("first"))).alias(f"_{name}") for name, c in best.items()],
    )
    records = entries.groupBy(keys).agg(
        F.sort_array(F.collect_list(F.struct(*fields, "copies"))).alias("_entries"),
        *[F.min(f"_{name}").alias(f"_{name}") for name in best],
    )
    return records.select(
        *keys,
        *[
            _joined(F.col("_entries"), field, name in by_value).alias(name)
            for name, field in lists.items()
        ],
        *[F.col(f"_{name}.first").alias(name) for name in best],
    )


def rows_with_lists(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    lists: dict[str, str],
    by_value: tuple[str, ...] = (),
    best: dict[str, str] | None = None,
    copies: str | None = None,
) -> DataFrame:
    """Distinct rows, each with the lists of its record and only where its ``best`` columns are the first.

    Lists are those of ``concat_per_record``. Rows travel inside the group that makes the lists, so
    the table is read once and not joined with its own roll-up. ``copies`` names the column that
    weighs a row; NULL weighs nothing, and the row isn't returned. A group holds a record's distinct
    rows: make them distinct before, which spreads a record with very many rows.
    """
    best = best or {}
    fields = list(dict.fromkeys(order + list(lists.values())))
    rest = [c for c in df.columns if c not in [*keys, *fields, copies]]
    weight = F.lit(1) if copies is None else F.col(copies)
    entry = F.struct(*fields, weight.alias("copies"), *rest)
    known = df if copies is None else df.where(F.col(copies).isNotNull())
    records = known.groupBy(keys).agg(
        F.sort_array(F.collect_list(entry)).alias("_entries"),
        *[F.min(F.struct(F.col(c).alias("first"))).alias(f"_{name}") for name, c in best.items()],
    )
    entries = F.col("_entries")
    kept = F.filter(
        entries,
        lambda e: reduce(and_, (e[c].eqNullSafe(F.col(f"_{name}.first")) for name, c in best.items()), F.lit(True)),
    )
    return records.select(
        *keys,
        *[_joined(entries, field, name in by_value).alias(name) for name, field in lists.items()],
        F.explode(kept).alias("_row"),
    ).select(*keys, *lists, *[F.col(f"_row.{c}").alias(c) for c in [*fields, *rest]])


def dense_rank_values(df: DataFrame, keys: list[str], column: str, name: str) -> DataFrame:
    """Rows with the dense rank of a column's value within its record, NULL ranked first.

    The rank is taken over the distinct values of a record and joined back, so a record with
    very many rows is never sorted as one group.
    """
    values = df.select(*keys, F.col(column).alias("_value")).distinct()
    ranked = values.withColumn(
        name, F.dense_rank().over(Window.partitionBy(*keys).orderBy("_value"))
    ).select(*[F.col(k).alias(f"_{k}") for k in keys], "_value", name)
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    same.append(F.col(column).eqNullSafe(F.col("_value")))
    return df.join(ranked, same).drop("_value", *[f"_{k}" for k in keys])
