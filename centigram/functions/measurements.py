"""Expressions that read values out of arrays of structs."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from centigram.functions.columns import col
from centigram.schemas import NAME, NESTED

# Fixed values: (separator, replacement) pairs that give the accepted spellings of a name.
SEPARATOR_SWAPS = (("_", "-"), ("-", " "), ("-", "_"), ("_", " "))

# No array is this long.
ABSENT_INDEX = 2147483646


def name_variants(feature: str) -> list[str]:
    """Every accepted spelling of ``feature``; the array's order decides which one wins."""
    return sorted({feature, *(feature.replace(a, b) for a, b in SEPARATOR_SWAPS)})


def measured(feature: str, array: str = NESTED, name: str = "name", value: str = "100g") -> Column:
    """Value of the first element called ``feature`` (any spelling), as double.

    Written over the two leaf arrays rather than with a lambda over whole elements: the
    scan then reads only ``name`` and ``value``, and the lookup stays in generated code.
    NULL for a NULL or empty array, no match, or a NULL value in the first match.
    """
    names = col(array).getField(name)
    values = col(array).getField(value)
    # array_position counts from 1 and gives 0 for "absent"; wrapped around, absent lies
    # beyond every real index, so the smallest index is the first match of any spelling.
    indexes = [
        F.pmod(F.array_position(names, v) - 1, F.lit(ABSENT_INDEX + 1))
        for v in name_variants(feature)
    ]
    first = indexes[0] if len(indexes) == 1 else F.least(*indexes)
    return F.get(values, first.cast("int")).cast("double")


def first_text(array: str = NAME, field: str = "text") -> Column:
    """``field`` of the first element; NULL for a NULL or empty array."""
    return F.get(col(array).getField(field), F.lit(0))


def list_text(values: Column) -> Column:
    """Array as ``[a,b,c]``."""
    return F.concat(F.lit("["), F.array_join(values.cast("array<string>"), ","), F.lit("]"))
