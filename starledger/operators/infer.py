"""The types that a CSV reader would infer, as one aggregate.

Each cell of a text column allows a set of types: an integer text is also a
float, a date or a boolean is only that, every text is a text, and a missing
cell allows all. The types of a column are those that all of its cells allow:
a bitwise AND, so partial results of any split of the rows merge, and one bad
cell widens the type. The narrowest one left is reported.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starledger.functions.dates import parse_day
from starledger.functions.text import na_tokens_to_null

# The lattice, narrowest first, and the texts of each type.
TYPES = ["integer", "float", "boolean", "date", "text"]
EMPTY = "all-null"
_INTEGER = r"^[+-]?[0-9]+$"
_FLOAT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_BOOLEAN = r"^([Tt]rue|TRUE|[Ff]alse|FALSE)$"


def _allowed(cell: Column) -> Column:
    """The types that a cell allows, as bits in the order of ``TYPES``."""
    day = cell.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & parse_day(cell).isNotNull()
    tests = [cell.rlike(_INTEGER), cell.rlike(_FLOAT), cell.rlike(_BOOLEAN), day, F.lit(True)]
    bits = reduce(lambda a, b: a + b, [F.when(test, F.lit(1 << i)).otherwise(F.lit(0)) for i, test in enumerate(tests)])
    return F.when(cell.isNotNull(), bits)


def infer_types(df: DataFrame, table: str) -> DataFrame:
    """tabla, columna, tipo, filas_con_valor for the text columns of ``df``;
    missing-value tokens count as missing. A column without values is
    ``all-null``."""
    cells = df.select(*[na_tokens_to_null(F.col(c)).alias(c) for c in df.columns])
    wide = cells.agg(*[F.bit_and(_allowed(F.col(c))).alias(f"bits_{i}") for i, c in enumerate(df.columns)],
                     *[F.count(c).alias(f"n_{i}") for i, c in enumerate(df.columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("columna"), F.col(f"bits_{i}").alias("bits"), F.col(f"n_{i}").alias("filas_con_valor"))
                     for i, c in enumerate(df.columns)])
    narrowest = reduce(lambda rest, i: F.when(F.col("bits").bitwiseAND(F.lit(1 << i)) != 0, TYPES[i]).otherwise(rest),
                       reversed(range(len(TYPES))), F.lit(EMPTY))
    return wide.select(F.inline(rows)).select(F.lit(table).alias("tabla"), "columna", narrowest.alias("tipo"), "filas_con_valor")
