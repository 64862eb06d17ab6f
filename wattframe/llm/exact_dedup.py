"""Exact duplicates by sorting the content.

The normalised bytes are range-partitioned by sampled splitters and sorted inside each partition,
so equal texts stand next to each other and a comparison of neighbours in full finds them. The
splitters are short, whatever the texts: the leading bytes, then a hash of all bytes. The identifier
and the row's own number belong to them too, so a text that a third of all rows share is spread over
many ranges. Such a run goes on in the next partition, so the runs whose leading bytes and hash are
those of the partition's first or last row are put together afterwards by their whole text. But for
clashes of the hash that is at most two rows per partition, whatever the data.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattframe.llm.tables import in_slices, texts
from wattframe.session import keep

#: One ASCII white-space run counts as one space.
SPACES = r"[\x20\x09-\x0D]+"

_RUNS = (
    "doc_id long, keep_id long, group_size long, leads boolean, text_sha256 string,"
    " edge long, edge_text binary, edge_rows long"
)
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("keep_id", pa.int64()),
        ("group_size", pa.int64()),
        ("leads", pa.bool_()),
        ("text_sha256", pa.string()),
        ("edge", pa.int64()),
        ("edge_text", pa.binary()),
        ("edge_rows", pa.int64()),
    ]
)


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def _run_rows(text: bytes, ids: list, edge: int | None) -> pa.RecordBatch:
    """The rows of one run. A run at the edge of its partition carries its text on its first row."""
    count = len(ids)
    sha = hashlib.sha256(text).hexdigest()
    inner = edge is None
    columns = [
        pa.array(ids, pa.int64()),
        pa.array([ids[0] if inner else None] * count, pa.int64()),
        pa.array([count if inner else None] * count, pa.int64()),
        pa.array([True] + [False] * (count - 1), pa.bool_()),
        pa.array([sha] * count, pa.string()),
        pa.array([edge] * count, pa.int64()),
        pa.array([None if inner else text] + [None] * (count - 1), pa.binary()),
        pa.array([None if inner else count] + [None] * (count - 1), pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare each sorted row with the one before it; of a run, only the identifiers are held."""
    partition = TaskContext.get().partitionId()
    edge = (partition << 32) - 1
    first_key = key = None
    runs: list[tuple[bytes, list]] = []  # of the current key: mostly one

    def closed(last: bool) -> list[pa.RecordBatch]:
        nonlocal edge
        done = []
        for text, ids in runs:
            at_edge = last or key == first_key
            edge += at_edge
            done.append(_run_rows(text, ids, edge if at_edge else None))
        return done

    for batch in in_slices(batches):
        ready: list[pa.RecordBatch] = []
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            doc_id, text, row_key = row[0], row[1], row[2:]
            if row_key == key and runs[-1][0] == text:
                runs[-1][1].append(doc_id)
                continue
            if row_key != key:
                ready += closed(last=False)
                runs.clear()
                key = row_key
                first_key = first_key or row_key
            runs.append((text, [doc_id]))
        if ready:
            yield from pa.Table.from_batches(ready).combine_chunks().to_batches()
    yield from closed(last=True)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when their normalised bytes are. NULL text counts as empty; all empty texts
    form one group, and a text of white space only equals a single space. The smallest identifier
    of a group stays; a NULL identifier comes after all others and stays only in a group without
    any. If rows repeat an identifier with the same text, exactly one of them is kept. No rows in,
    no rows out; other columns are ignored. Very long texts are compared whole.
    """
    rows = texts(docs, id_col, text_col).select(
        "doc_id",
        normalised(F.col("text")).alias("norm"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = rows.withColumns({"head": F.substring("norm", 1, 24), "hash": F.xxhash64("norm")})
    splitters = [F.col("head"), F.col("hash"), F.col("doc_id").asc_nulls_last(), F.col("row")]
    runs = keep(
        rows.repartitionByRange(*splitters)
        .sortWithinPartitions("head", "hash", "norm", *splitters[2:])
        .select("doc_id", F.col("norm").cast("binary"), "head", "hash")
        .mapInArrow(_neighbours, _RUNS)
    )
    edges = runs.where(F.col("edge_text").isNotNull()).select(
        "edge", "edge_text", "edge_rows", F.col("doc_id").alias("first_id")
    )
    groups = edges.groupBy("edge_text").agg(
        F.min("first_id").alias("edge_keep"),
        F.sum("edge_rows").alias("edge_size"),
        F.min("edge").alias("first_edge"),
    )
    # Two rows per sorted partition but for clashes of the hash, without the texts.
    joined = edges.join(groups, "edge_text").select("edge", "edge_keep", "edge_size", "first_edge")
    inner = F.col("edge").isNull()
    return runs.join(F.broadcast(joined), "edge", "left").select(
        "doc_id",
        F.when(inner, F.col("keep_id")).otherwise(F.col("edge_keep")).alias("keep_id"),
        F.when(inner, F.col("group_size")).otherwise(F.col("edge_size")).alias("group_size"),
        (F.col("leads") & (inner | (F.col("edge") == F.col("first_edge")))).alias("kept"),
        "text_sha256",
    )
