"""Token ids in flat binary files with 64-bit document offsets, read back through memory maps.

Documents are dealt out by ranges of doc_id. Each task writes the ids of its range and their
lengths; the ranges' token counts, one number a range, give every range its base by a prefix sum,
and a second job writes the offsets. A task writes under a name of its own and renames at the end,
so a task that is repeated after the loss of an executor leaves one whole file.

Ids are written with as many bytes as the vocabulary needs: 16 bits if every id fits, else 32.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from pulcra.llm.common import in_small_batches, table
from pulcra.llm.encoding import DROPPED, encoder
from pulcra.operators.lookup import work_folder

NO_ID = -(1 << 63)  # stands for a null doc_id in the files
END = 1


def _place(folder: str, name: str) -> tuple[pyarrow.fs.FileSystem, str]:
    store, path = pyarrow.fs.FileSystem.from_uri(folder)
    return store, f"{path}/{name}"


class _Writer:
    """A file that appears under its name when it is complete."""

    def __init__(self, folder: str, name: str):
        self.store, self.path = _place(folder, name)
        self.own = f"{self.path}.{uuid.uuid4().hex}"
        self.store.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.stream = self.store.open_output_stream(self.own)

    def close(self) -> None:
        self.stream.close()
        self.store.move(self.own, self.path)


def mapped(folder: str, name: str, kind: str) -> np.ndarray:
    """The file as an array: memory-mapped on a mounted folder, else read from the store."""
    store, path = _place(folder, name)
    if store.get_file_info(path).size == 0:
        return np.empty(0, kind)
    if isinstance(store, pyarrow.fs.LocalFileSystem):
        return np.memmap(path, kind, "r")
    with store.open_input_file(path) as file:
        return np.frombuffer(file.read(), kind)


def part(number: int, what: str) -> str:
    return f"part-{number:06d}.{what}"


@cache
def id_kind(tokenizer: str, end: int = END) -> str:
    """The unsigned integers that hold every id of a vocabulary and the end id."""
    from tokenizers import Tokenizer

    largest = max(end, *Tokenizer.from_file(tokenizer).get_vocab().values())
    return "<u2" if largest < 1 << 16 else "<u4"


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, chunks: str = DROPPED, end: int = END) -> DataFrame:
    """Write ids (``.ids``, as ``id_kind`` says), doc ids and offsets (``.docs``, ``.offsets``, 64 bit)
    in ascending doc_id order; returns the parts as (part, base).

    Null texts are empty and have the end id only. Null doc_ids come first; documents of one doc_id
    are ordered by text. Every other column is left out. An empty table gives no part.
    """
    spark, mark, kind = docs.sparkSession, np.array([end], "<u4").tobytes(), id_kind(tokenizer, end)
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = in_small_batches(docs).select(docs.doc_id.cast("long").alias("doc_id"), "text").repartitionByRange(count, "doc_id").sortWithinPartitions("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, files, total = TaskContext.get().partitionId(), None, 0
        encode = encoder(tokenizer, chunks).encode_all
        for batch in batches:
            if files is None:
                files = [_Writer(folder, part(number, what)) for what in ("ids", "docs", "lengths")]
            lengths = []
            for ids in encode(batch.column(1).to_pylist()):
                ids += mark
                lengths.append(len(ids) // 4)
                files[0].stream.write(np.frombuffer(ids, "<u4").astype(kind).tobytes())
            files[1].stream.write(batch.column(0).fill_null(NO_ID).to_numpy().astype("<i8").tobytes())
            files[2].stream.write(np.array(lengths, "<u8").tobytes())
            total += sum(lengths)
        if files is not None:
            for file in files:
                file.close()
            yield pa.record_batch([pa.array([number], pa.int64()), pa.array([total], pa.int64())], ["part", "n"])

    sizes = sorted(tuple(row) for row in ranges.mapInArrow(write, "part long, n long").collect())
    bases = list(accumulate((n for _, n in sizes), initial=0))
    rows = [(number, base) for (number, _), base in zip(sizes, bases)]
    parts = spark.createDataFrame(rows, "part long, base long").repartition(max(1, len(rows)))

    def offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                file = _Writer(folder, part(number, "offsets"))
                ends = np.cumsum(mapped(folder, part(number, "lengths"), "<u8"))
                file.stream.write((np.concatenate([[0], ends]) + base).astype("<u8").tobytes())
                file.close()
            yield batch

    parts.mapInArrow(offsets, "part long, base long").write.format("noop").mode("overwrite").save()
    return parts


def read_token_files(parts: DataFrame, folder: str, batch: int = 4096) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone.

    A file's size tells how wide its ids are; sums are taken of 32-bit ids whatever it is."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in batches:
            for number in given.column(0).to_pylist():
                offsets = mapped(folder, part(number, "offsets"), "<u8")
                names = mapped(folder, part(number, "docs"), "<i8")
                local = (offsets - offsets[0]).astype(np.int64)
                flat = mapped(folder, part(number, "ids"), "u1")
                ids = flat.view(f"<u{len(flat) // local[-1]}")
                for at in range(0, len(names), batch):
                    to = min(at + batch, len(names))
                    sums = [zlib.crc32(ids[local[i] : local[i + 1]].astype("<u4").tobytes()) for i in range(at, to)]
                    own = pa.array(names[at:to], mask=np.asarray(names[at:to] == NO_ID))
                    yield pa.record_batch(
                        [own, pa.array(offsets[at:to].astype(np.int64)), pa.array(np.diff(local[at : to + 1])), pa.array(sums, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    return parts.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = f"{work_folder(spark)}/tokens-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return read_token_files(write_token_files(docs, folder, tokenizer), folder)
