"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The strings a pandas CSV read turns into a missing value by
# default (its documented ``na_values`` list). Spark's CSV reader only treats
# the empty field as null, so these are mapped after the scan.
PANDAS_NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Python's str.strip() removes Unicode white space plus the four ASCII
# separators 0x1C-0x1F (tab, NBSP, ...). Trimmed by this list and not by a
# regular expression, which tries every position of every text.
_EDGE_SPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
               "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def normalize_channel(c: Column) -> Column:
    """Lower-case, then strip white space at both ends."""
    return strip_space(F.lower(c))


def strip_space(c: Column) -> Column:
    """Strip Unicode white space at both ends (Python ``str.strip``)."""
    return F.btrim(c, F.lit(_EDGE_SPACE))


def na_tokens_to_null(c: Column) -> Column:
    """Map the pandas missing-value tokens to NULL."""
    return F.when(c.isin(PANDAS_NA_TOKENS), F.lit(None).cast("string")).otherwise(c)


def blank_to_null(c: Column) -> Column:
    """Empty or all-space text to NULL."""
    return F.nullif(strip_space(c), F.lit(""))
