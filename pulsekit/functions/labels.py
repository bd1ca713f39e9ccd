"""Label helpers: one-hot columns and the chart marker."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's: the label meaning "no
# activity", the name its one-hot column gets, and the activity names of its
# bundled feature matrix (in that matrix's column order).
NO_LABEL = "0"
NO_LABEL_COLUMN = "Nothing"
SPORTS = ["Circuit Training", "Martial Arts", "Run", "Sport", "Walk"]


def one_hot_columns(label_col: str, domain: list[str], no_label: str = NO_LABEL,
                    no_label_name: str = NO_LABEL_COLUMN) -> list[Column]:
    """One 0/1 int column per label of ``domain``; ``no_label`` comes first and is
    renamed.  Labels outside the domain give all zeros."""
    labels = [no_label] + [d for d in sorted(domain) if d != no_label]
    out = []
    for value in labels:
        name = no_label_name if value == no_label else value
        out.append(F.when(F.col(label_col) == F.lit(value), 1).otherwise(0).alias(name))
    return out


def sport_marker(label_col: str = "sport", high: int = 200) -> Column:
    """200 when a label is present, 0 otherwise (the chart bar)."""
    return F.when(F.col(label_col) != F.lit(NO_LABEL), F.lit(high)).otherwise(F.lit(0))
