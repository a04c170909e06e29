"""Token ids of a corpus in files: ascending document order, coded by ``idcoder``, read back from the files.

Documents are dealt out by ranges of their ids, equal ids by ranges of how their texts begin, and sorted
within them, so the files, by their number, hold the corpus in order and no task sees more than a range. A task encodes its texts, appends the end id to
each and writes one file in batches of about ``BATCH_IDS`` ids: the table of documents (id, number of
ids), then their coded ids. The first position of a file is the sum of the files before it, from a
list with one row a file.

Files are written through the file system of the shared folder, under names that no other attempt of a
task uses; only files named in the list, a Spark table, are read. Reading checks every block's
checksum.

Layout of a file, little-endian: batches of a header (magic, documents, bytes of coded ids), the
documents (has an id, id, number of ids; 17 bytes each) and the coded ids.

Defined cases: a null text is empty and has its end id only; rows without an id come first; rows of equal
id are ordered by text; an empty table writes no file; other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from starlot.llm import idcoder
from starlot.llm.common import text_or_empty
from starlot.llm.tokens import encoder, portions, vocabulary_path
from starlot.llm.warc import store
from starlot.session import materialise, shared_folder

# Fixed values of the format.
MAGIC = b"STIDS001"
HEAD = "<8sQQ"
ENTRY = np.dtype([("has_id", "u1"), ("doc_id", "<i8"), ("n", "<u8")])
BATCH_IDS = 8_000_000
DEALT_BY = 64

FILES = "number bigint, name string, documents bigint, ids bigint"
DOCUMENTS = "number bigint, has_id boolean, doc_id bigint, at bigint, n_tokens bigint, ids binary"


class IdFile:
    """Writes one file; documents wait until a batch is large enough."""

    def __init__(self, folder: str, block: int):
        files, base = store(folder)
        self.name = f"ids-{uuid.uuid4().hex}.bin"
        self.out = files.open_output_stream(f"{base}/{self.name}", compression=None)
        self.block, self.documents, self.total = block, 0, 0
        self.entries, self.ids, self.held = [], [], 0

    def add(self, entries: np.ndarray, ids: np.ndarray) -> None:
        self.entries.append(entries)
        self.ids.append(ids)
        self.held += len(ids)
        if self.held >= BATCH_IDS:
            self.flush()

    def flush(self) -> None:
        if not self.entries:
            return
        entries, coded = np.concatenate(self.entries), idcoder.encode(np.concatenate(self.ids), self.block)
        self.out.write(struct.pack(HEAD, MAGIC, len(entries), len(coded)) + entries.tobytes())
        self.out.write(coded)
        self.documents += len(entries)
        self.total += self.held
        self.entries, self.ids, self.held = [], [], 0

    def close(self) -> pd.DataFrame:
        self.flush()
        self.out.close()
        return pd.DataFrame({"number": [TaskContext.get().partitionId()], "name": [self.name], "documents": [self.documents], "ids": [self.total]})


def _writer(folder: str, path: str, end_id: int, block: int):
    def run(batches):
        coder, file = encoder(path), None
        for batch in batches:
            texts = batch["text"].tolist()
            for rows in portions(texts):
                ids, lengths = coder.encode(texts[rows])
                ends = np.cumsum(lengths + 1)
                whole = np.full(int(ends[-1]), end_id, dtype=np.uint32)
                keep = np.ones(len(whole), dtype=bool)
                keep[ends - 1] = False
                whole[keep] = ids
                entries = np.zeros(len(lengths), dtype=ENTRY)
                entries["has_id"], entries["doc_id"], entries["n"] = batch["has_id"].iloc[rows], batch["doc_id"].iloc[rows], lengths + 1
                file = file or IdFile(folder, block)
                file.add(entries, whole)
        if file:
            yield file.close()
    return run


def write_ids(
    docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None,
    end_id: int = 0, block: int = idcoder.BLOCK,
) -> DataFrame:
    """Writes the files below ``folder`` and returns their list, itself written to ``folder``/files."""
    files, base = store(folder)
    files.create_dir(f"{base}/ids")
    read = docs.select(F.col(doc_id).cast("long").alias("id"), text_or_empty(text).alias("text"))
    # Equal ids are dealt by how their texts begin, which is in the order of the texts: many rows without an id are no single task's.
    ordered = read.repartitionByRange("id", F.substring("text", 1, DEALT_BY)).sortWithinPartitions("id", "text")
    rows = ordered.select(F.col("id").isNotNull().alias("has_id"), F.coalesce("id", F.lit(0)).alias("doc_id"), "text")
    written = rows.mapInPandas(_writer(f"{folder}/ids", vocabulary or vocabulary_path(), end_id, block), FILES)
    return materialise(written, f"{folder}/files")


def _reader(folder: str):
    def run(batches):
        files, base = store(folder)
        for batch in batches:
            for number, name in zip(batch["number"], batch["name"]):
                at = 0
                with files.open_input_file(f"{base}/{name}") as stream:
                    while head := stream.read(struct.calcsize(HEAD)):
                        magic, documents, size = struct.unpack(HEAD, head)
                        if magic != MAGIC:
                            raise ValueError(f"{name} holds no ids")
                        entries = np.frombuffer(stream.read(documents * ENTRY.itemsize), dtype=ENTRY)
                        ids = idcoder.decode(stream.read(size)).astype("<u4")
                        ends = np.cumsum(entries["n"].astype(np.int64))
                        starts = ends - entries["n"].astype(np.int64)
                        for i in range(0, documents, 2_000):
                            some = slice(i, i + 2_000)
                            yield pd.DataFrame({
                                "number": number, "has_id": entries["has_id"][some].astype(bool), "doc_id": entries["doc_id"][some],
                                "at": at + starts[some], "n_tokens": entries["n"][some].astype(np.int64),
                                "ids": [ids[s:e].tobytes() for s, e in zip(starts[some], ends[some])],
                            })
                        at += int(ends[-1])
    return run


def read_ids(spark, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` from the files; ids are little-endian unsigned 32 bits, the end id included."""
    listed = spark.read.parquet(f"{folder}/files")
    # One row a file: few and small, so one task may put them in order.
    before = W.orderBy("number").rowsBetween(W.unboundedPreceding, -1)
    placed = listed.select("number", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("first"))
    files = max(1, listed.count())
    read = listed.select("number", "name").repartitionByRange(files, "number").mapInPandas(_reader(f"{folder}/ids"), DOCUMENTS)
    joined = read.join(F.broadcast(placed.withColumnRenamed("number", "p")), F.col("number") == F.col("p"))
    return joined.select(
        F.when(F.col("has_id"), F.col("doc_id")).alias("doc_id"), (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids"
    )


def op4_context_mixing_ids(spark, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "ids")
    write_ids(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder)
    return read_ids(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
