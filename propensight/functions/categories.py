"""Clean-up of category text."""

from pyspark.sql import Column, functions as F

from propensight import constants as C


def normalize_category(col: Column) -> Column:
    """Trimmed lower-case value, renamed where two spellings mean the same; unknown values become ``''``."""
    clean = F.lower(F.trim(col))
    out = F.when(clean.isin(C.MISSING_CATEGORIES), "")
    for old, new in C.CATEGORY_RENAMES.items():
        out = out.when(clean == old, new)
    return out.otherwise(clean)
