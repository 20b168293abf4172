"""What the operators of this subpackage share: choosing columns, Arrow maps and saved tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

__all__ = ["arrow_map", "bounded_sample", "id_and_text", "materialize"]


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """Only the columns an operator reads, so that others can have any name. A null text is empty."""
    return df.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
        *(F.col(f"`{c}`") for c in more),
    )


def arrow_map(df: DataFrame, schema: str, rows: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]]) -> DataFrame:
    """``mapInArrow`` with a function that yields dictionaries of columns; empty ones are left out."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in rows(batches):
            arrays = [
                v.cast(f.type) if isinstance(v := columns[f.name], pa.Array) else pa.array(v, type=f.type)
                for f in arrow
            ]
            if len(arrays[0]):
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, schema)


def bounded_sample(
    docs: DataFrame, labels: DataFrame, label_col: str, sample: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """About ``sample`` labelled texts at most: (doc_id, text, y), once per id.

    Labels are taken by the hash of their id, in proportion to how many there are, so the choice does not
    depend on order or partitions and follows the corpus. Of several labels of an id the smallest counts, of
    several texts the first in order.
    """
    known = labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{label_col}`").alias("y"))
    known = known.dropna().groupBy("doc_id").agg(F.min("y").cast("double").alias("y"))
    total = max(known.count(), sample, 1)
    chosen = known.filter(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(total)) < sample)
    texts = id_and_text(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id")  # about ``sample`` rows
    return texts.groupBy("doc_id", "y").agg(F.min("text").alias("text")).select("doc_id", "text", "y")
