"""Bounded samples of labelled rows for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PLACES = 1 << 31


def sample_per_label(docs: DataFrame, label: str, rows: int) -> DataFrame:
    """About `rows` rows of each label, all if there are fewer, picked by hash of `doc_id`.

    Rows without a label are left out; repeated ids are taken or left together. Only
    one count for each label reaches the driver, so labels must be classes.
    """
    known = docs.filter(F.col(label).isNotNull())
    place = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(PLACES))
    taken = F.lit(False)
    for value, n in known.groupBy(label).agg(F.count(F.lit(1))).collect():
        most = PLACES if n <= rows else int(PLACES * rows / n)
        taken |= (F.col(label) == F.lit(value)) & (place < F.lit(most))
    return docs.filter(taken)
