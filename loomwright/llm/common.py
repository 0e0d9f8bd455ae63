"""Helpers shared by the corpus operators: stable row ids, materialised steps, distributed ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwright.functions.tables import fresh, quoted, settled, shared_dir, with_rank, with_row_ids
from loomwright.functions.tables import written as materialise

__all__ = ["fresh", "materialise", "quoted", "ranked", "settled", "shared_dir", "text_rows", "with_row_ids"]


def text_rows(docs: DataFrame) -> DataFrame:
    """Rows ``rid, doc_id, text``, null text read as empty; ``rid`` is the same in each read of the result."""
    return with_row_ids(docs.select("doc_id", F.col("text").cast("string").alias("text")), "rid").select("rid", "doc_id", F.coalesce("text", F.lit("")).alias("text"))


def ranked(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """``df`` with its global 0-based rank in ``order``, which must be total for ranks to be the same in each run."""
    return with_rank(df, order, name, 0)
