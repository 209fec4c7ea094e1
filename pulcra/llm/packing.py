"""Best-fit packing with a bounded number of open sequences.

A packer takes its pieces as they come. Open sequences are kept in a bitset whose set bits are the
free spaces of at least one of them: the best fit is the lowest set bit at or above a piece's
length. When all places are taken and nothing fits, the fullest sequence is closed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulcra.llm.common import in_small_batches, table, texts_of
from pulcra.llm.encoding import LEADING, encoder
from pulcra.operators.lookup import materialize


@dataclass(frozen=True)
class Settings:
    capacity: int = 2048
    end: int = 0
    open_bins: int = 256
    packer_tokens: int = 1 << 20  # tokens that one packer is given, about


def best_fit(lengths: Iterable[int], capacity: int, open_bins: int) -> list[tuple[int, int]]:
    """(sequence, offset) of each piece in turn; sequences are numbered as they are opened."""
    places: list[tuple[int, int]] = []
    by_free: dict[int, list[int]] = {}
    free_bits = opened = count = 0
    for length in lengths:
        fitting = free_bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            stack = by_free[free]
            number = stack.pop()
            if not stack:
                free_bits &= ~(1 << free)
            opened -= 1
        else:
            if opened == open_bins:
                fullest = (free_bits & -free_bits).bit_length() - 1
                by_free[fullest].pop()
                if not by_free[fullest]:
                    free_bits &= ~(1 << fullest)
                opened -= 1
            number, free, count = count, capacity, count + 1
        places.append((number, capacity - free))
        left = free - length
        if left:
            by_free.setdefault(left, []).append(number)
            free_bits |= 1 << left
            opened += 1
    return places


PIECE = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())]


def token_pieces(docs: DataFrame, tokenizer: str, settings: Settings = Settings(), with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` tokens of every row, each document ended by the end id.

    Null and empty texts are the end id alone. The first piece of a longer document takes what the
    full ones leave over. ``with_ids`` adds the ids as little-endian unsigned 32-bit integers.
    """
    size, mark = settings.capacity, settings.end.to_bytes(4, "little")
    fields = PIECE if with_ids else PIECE[:-1]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, LEADING).encode
        for batch, texts in texts_of(batches):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), texts):
                ids = encode(text) + mark
                total = len(ids) // 4
                bounds = [0, *range((total - 1) % size + 1, total + 1, size)]
                for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    own = ids[4 * a : 4 * b]
                    rows.append((doc_id, k, a, b - a, zlib.crc32(own), own)[: len(fields)])
            columns = list(zip(*rows)) or [[] for _ in fields]
            yield pa.record_batch([pa.array(c, kind) for c, (_, kind) in zip(columns, fields)], [n for n, _ in fields])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return in_small_batches(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, schema)


def pack(pieces: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to every piece.

    Pieces are dealt to packers by a hash, each about ``packer_tokens`` tokens, and reach a packer in
    an order that only depends on the rows: reruns agree, equal rows are interchangeable. Packers
    know nothing of each other; each leaves at most ``open_bins`` sequences unfilled.
    """
    total = pieces.agg(F.sum("length")).first()[0] or 0
    count = max(1, round(total / settings.packer_tokens))
    mixed = F.xxhash64("doc_id", "piece", "ids_crc32", "length")
    dealt = pieces.withColumn("_mixed", mixed).withColumn("_packer", F.pmod(F.col("_mixed"), F.lit(count)))

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([(c, "ascending") for c in ("_mixed", "doc_id", "piece", "start", "length", "ids_crc32")])
        places = best_fit(group["length"].to_pylist(), settings.capacity, settings.open_bins)
        base = group["_packer"][0].as_py() << 40
        group = group.append_column("sequence_id", pa.array([base + n for n, _ in places], pa.int64()))
        return group.append_column("offset", pa.array([o for _, o in places], pa.int64())).drop(["_mixed", "_packer"])

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema]
    return dealt.groupBy("_packer").applyInArrow(run, ", ".join([*fields, "sequence_id long", "offset long"]))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token ids of each sequence; needs pieces made ``with_ids``."""
    placed = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    ids = F.aggregate(F.transform(placed, lambda x: x["ids"]), F.lit(b""), lambda a, b: F.concat(a, b))
    return packed.groupBy("sequence_id").agg(ids.alias("ids"))


def pack_documents(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    import public_tokenizers

    pieces = token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), settings)
    return pack(materialize(pieces), settings)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
