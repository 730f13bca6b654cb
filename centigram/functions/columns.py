"""Small column helpers."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of a table by group that the driver may hold and broadcast.
MAX_GROUPS = 10_000


def col(name: str) -> Column:
    """Column by literal name: dots and hyphens are part of the name."""
    return F.col("`" + name.replace("`", "``") + "`")


def present(df: DataFrame, names) -> list[str]:
    have = set(df.columns)
    return [n for n in names if n in have]


def all_of(conditions) -> Column:
    result = F.lit(True)
    for condition in conditions:
        result = result & condition
    return result


def any_of(conditions) -> Column:
    result = F.lit(False)
    for condition in conditions:
        result = result | condition
    return result


def unpivot_row(row: DataFrame, label: str, entries: dict[str, dict[str, Column]]) -> DataFrame:
    """One wide aggregate row -> one row per entry (``label`` holds the entry's name)."""
    return row.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(name).alias(label), *[c.alias(a) for a, c in values.items()])
                    for name, values in entries.items()
                ]
            )
        )
    )


def kept_rows(df: DataFrame, rule: Column) -> DataFrame:
    """Rows that meet ``rule``, which reads the columns as they are.

    A plain filter would move below the projection that computes the columns and repeat it,
    nested lookups included; a generator's output stays above.  For the same reason nothing is
    pushed into the scan of a table with flat columns.
    """
    kept = df.select("*", F.explode(F.array(rule)).alias("_kept")).filter("_kept")
    return kept.select(*[col(c) for c in df.columns])


def with_row(df: DataFrame, row: DataFrame) -> DataFrame:
    """``df`` with the columns of a one-row table (global statistics) on every row.

    The row is a scalar subquery: computed once, checked by Spark to be a single row, and
    neither joined nor broadcast.  It is unpacked by a generator because Spark would
    repeat the subquery for each field read from it, and would move a filter on these
    columns below the projection that computes the other side of the comparison.
    """
    packed = row.select(F.struct(*[col(c) for c in row.columns]).alias("row")).scalar()
    return df.select(*[col(c) for c in df.columns], F.inline(F.array(packed)))


def settled(table: DataFrame, limit: int = MAX_GROUPS) -> tuple[DataFrame, bool]:
    """The same rows, held by the plan itself if there are at most ``limit``, and whether they are.

    A table held so has a proven size and may be broadcast; any other is computed again.
    """
    head = table.limit(limit + 1).collect()
    if len(head) > limit:
        return table, False
    return table.sparkSession.createDataFrame(head, table.schema), True
