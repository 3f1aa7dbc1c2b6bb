"""Token ids of documents as ORC files.

Every row is a document: its ids are an integer list, which ORC stores run-length encoded.  Files are
cut by ranges of ``doc_id`` and sorted inside, so the stripe and row-group statistics of ``doc_id``
and its Bloom filters let a reader skip all but the matching row groups; stripes are read in parallel.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tablelift.llm import encoding
from tablelift.llm.common import utf8

END_ID = 1
#: Ids of one batch that goes to the files.
BATCH_BYTES = 8 << 20


def _token_rows(tokenizer: str, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def flush(part, doc_ids, id_type, starts, own):
        """One batch; the ids of its rows are one buffer, not a value each."""
        ends = np.cumsum([0, *(len(ids) // 4 for ids in own)])
        values = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(own))])
        columns = [
            pa.array([part] * len(own), pa.int32()), pa.array(starts, pa.int64()), pa.array(doc_ids, id_type),
            pa.array(np.diff(ends), pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["part", "at", "doc_id", "n_tokens", "ids"])

    def task(batches):
        part, at, size = TaskContext.get().partitionId(), 0, 0
        doc_ids, starts, own, id_type = [], [], [], None
        for doc_id, id_type, ids in encoding.encoded(batches, tokenizer):
            doc_ids.append(doc_id)
            starts.append(at)
            own.append(ids + end)
            at += len(own[-1]) // 4
            size += len(own[-1])
            if size >= BATCH_BYTES:
                yield flush(part, doc_ids, id_type, starts, own)
                doc_ids, starts, own, size = [], [], [], 0
        if own:
            yield flush(part, doc_ids, id_type, starts, own)

    return task


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID, files: int | None = None) -> None:
    """Encode ``text`` of every row of ``docs`` and write the ids below ``path`` in ascending ``doc_id`` order.

    ``files``: ranges of ``doc_id``, one file each (default: the shuffle partitions of the session).

    A null text counts as empty and gives the end id only; a null ``doc_id`` comes first; rows with the
    same ``doc_id`` all stay, in the order of their texts' hashes and then texts; an empty table writes
    files without rows; other columns are not read.
    """
    spark = docs.sparkSession
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", utf8("text").alias("text"), F.xxhash64("text").alias("tie"))
    schema = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("at", T.LongType()),
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
        ]
    )
    (
        rows.repartitionByRange(files, "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie", "text")
        .select("doc_id", "text")
        .mapInArrow(_token_rows(tokenizer or encoding.default_tokenizer(), end_id), schema)
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.row.index.stride", "1000")
        .option("compression", "none")  # run-length encoded ids hardly shrink further
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids.

    A filter on ``doc_id`` reaches the files.  Where a file starts comes from the token counts alone;
    there is one such row per file, so they are broadcast.
    """
    tokens = spark.read.orc(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        tokens.groupBy("part")
        .agg(F.sum("n_tokens").alias("n"))
        .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    )
    return tokens.join(F.broadcast(starts), "part").select(
        "doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids"
    )


def _crc_rows(batches):
    for batch in batches:
        ids = batch.column("ids")
        values = ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
        ends = ids.offsets.to_numpy()
        crc = [zlib.crc32(values[i:j]) for i, j in zip(ends[:-1], ends[1:])]
        columns = [batch.column(c) for c in ("doc_id", "start", "n_tokens")] + [pa.array(crc, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])


def with_crc(tokens: DataFrame) -> DataFrame:
    """The columns of ``read_tokens`` with the CRC-32 of the ids, as unsigned little-endian 32-bit numbers, in their place."""
    kept = tokens.select("doc_id", "start", "n_tokens", "ids")
    schema = T.StructType([*kept.schema.fields[:3], T.StructField("ids_crc32", T.LongType())])
    return kept.mapInArrow(_crc_rows, schema)
