"""Where the first rows of a table, or of each of its groups, end.

The rows are not sorted or copied for that.  A sketch of the order key's codes proposes a
cut in one pass over the key; a second pass counts what lies up to it.  A cut that leaves
too few rows moves on to the sketch's next value, one that leaves far too many is narrowed by
a sketch of only those rows.  Counts are exact, so a cut never loses a row.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from centigram.functions.columns import all_of, col

# The sketch's ranks are off by one row in so many at most.
ACCURACY = 10_000
# Shares of the rows at which the sketch is read.
FRACTIONS = [min(1.0, 1e-8 * 2**i) for i in range(28)]
# Groups with a smaller share of the rows get no cut, so there are at most so many cuts.
MOST_CUTS = 10_000
# A cut that keeps more rows than this, and than so many times those asked for, is narrowed.
ROOMY, TIMES = 200_000, 8
# Characters (bytes) of a text that its code takes.
CODE_BYTES = 7


def order_code(df: DataFrame, key: str) -> Column:
    """A number that never falls as the key rises, nulls first.

    Texts give their first bytes.  Of keys that have no number all are equal.
    """
    kind, value = df.schema[key].dataType, col(key)
    if isinstance(kind, T.StringType):
        digits = F.rpad(F.hex(F.substring(value.cast("binary"), 1, CODE_BYTES)), 2 * CODE_BYTES, "0")
        code = F.conv(digits, 16, 10).cast("double")
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        code = F.when(F.isnan(value), F.lit(float("inf"))).otherwise(value.cast("double"))
    elif isinstance(kind, (T.NumericType, T.BooleanType)):
        code = value.cast("double")
    elif isinstance(kind, T.TimestampType):
        code = F.unix_micros(value).cast("double")
    elif isinstance(kind, T.DateType):
        code = F.unix_date(value).cast("double")
    else:
        code = F.lit(0.0)
    return F.coalesce(code, F.lit(float("-inf")))


class Cuts:
    """Codes up to which the first ``n`` rows of the large groups lie, and how many rows that is."""

    def __init__(self, df: DataFrame, groups: list[str], key: str, n: int) -> None:
        self.groups, self.key, self.n = groups, key, n
        self.names = [f"_group{i}" for i in range(len(groups))]
        # -0.0 and 0.0, and the nulls of a group column, are one group in Spark's grouping as here.
        parts = [col(g).alias(name) for g, name in zip(groups, self.names)]
        self.keys = df.select(*parts, order_code(df, key).alias("_code"))
        kinds = [f"{name} {self.keys.schema[name].dataType.simpleString()}" for name in self.names]
        self.schema = ", ".join([*kinds, "_cut double"])
        self.cuts: dict[tuple, float] = {}
        self.kept: dict[tuple, int] = {}
        self.find()

    def table(self, cuts: dict[tuple, float]) -> DataFrame:
        return self.keys.sparkSession.createDataFrame([(*g, c) for g, c in cuts.items()], self.schema)

    def attached(self, rows: DataFrame, columns: list[Column], cuts: dict[tuple, float], how: str) -> DataFrame:
        """Rows with their group's ``_cut``; without groups it is one number."""
        if not self.groups:
            return rows.withColumn("_cut", F.lit(cuts.get((), None)).cast("double"))
        table = self.table(cuts).withColumnsRenamed({n: f"{n}_cut" for n in self.names})
        same = [c.eqNullSafe(F.col(f"{n}_cut")) for c, n in zip(columns, self.names)]
        # MOST_CUTS rows at most
        return rows.join(F.broadcast(table), all_of(same), how).drop(*[f"{n}_cut" for n in self.names])

    def counted(self, cuts: dict[tuple, float]) -> DataFrame:
        rows = self.attached(self.keys, [F.col(n) for n in self.names], cuts, "inner")
        return rows.filter(F.col("_code") <= F.col("_cut"))

    def sketched(self, rows: DataFrame) -> list:
        """For each large group its rows, and codes at the shares where the first ``n`` may end."""
        count = F.count(F.lit(1))
        read = F.percentile_approx("_code", FRACTIONS, ACCURACY)
        sizes = rows.groupBy(*self.names).agg(count.alias("_rows"), read.alias("_codes"))
        least = F.lit(float(self.n)) + 2 * F.col("_rows") / ACCURACY
        fraction = F.filter(
            F.arrays_zip(F.array(*map(F.lit, FRACTIONS)).alias("f"), F.col("_codes").alias("c")),
            lambda x: x["f"] * F.col("_rows") >= least,
        )
        steps = F.transform(fraction, lambda x: x["c"])
        large = sizes.select(*self.names, "_rows", steps.alias("_steps")).filter(F.size("_steps") > 1)
        return large.orderBy(F.desc("_rows")).limit(MOST_CUTS).collect()

    def find(self) -> None:
        steps = {tuple(r[: len(self.names)]): list(r["_steps"]) for r in self.sketched(self.keys)}
        while steps:
            proposed = {g: s[0] for g, s in steps.items()}
            found = self.counted(proposed).groupBy(*self.names).count().collect()
            counts = {tuple(r[: len(self.names)]): r["count"] for r in found}
            again, wide = {}, {}
            for g, s in steps.items():
                kept = counts.get(g, 0)
                if kept < self.n:
                    if len(s) > 1:  # the last value is the group's highest code: nothing to cut
                        again[g] = s[1:]
                    continue
                narrower = g not in self.cuts or s[0] < self.cuts[g]
                if narrower:
                    self.cuts[g], self.kept[g] = s[0], kept
                if narrower and kept > max(ROOMY, TIMES * self.n):
                    wide[g] = s[0]
            if wide:
                for r in self.sketched(self.counted(wide)):
                    g = tuple(r[: len(self.names)])
                    lower = [c for c in r["_steps"] if c < wide[g]]
                    if lower:
                        again[g] = lower
            steps = again

    def apply(self, df: DataFrame) -> DataFrame:
        """Rows that may be among the first ``n`` of their group."""
        if not self.cuts:
            return df
        code = order_code(df, self.key)
        if not self.groups:
            return df.filter(code <= F.lit(self.cuts[()]))
        cut = self.attached(df, [col(g) for g in self.groups], self.cuts, "left")
        return cut.filter(F.col("_cut").isNull() | (code <= F.col("_cut"))).drop("_cut")
