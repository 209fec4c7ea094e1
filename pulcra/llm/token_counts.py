"""Token counts of whole texts, huge ones encoded in overlapping chunks.

Between two characters that stand side by side in no piece of the vocabulary no merge can happen:
every piece that spanned the place would hold the pair. Such a place is a token boundary in each
encoding that covers it. Neighbouring chunks overlap; both know the same first stable boundary of
their overlap, and the counts are spliced there. If an overlap has none, it is widened until it has
one or the text ends.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulcra.llm.common import in_small_batches, table, texts_of

BLANK = "▁"  # how the vocabulary writes a blank


@dataclass(frozen=True)
class Settings:
    chunk: int = 16_384  # characters
    overlap: int = 64
    limit: int = 4096
    remembered: int = 500_000


class Counter:
    def __init__(self, path: str, settings: Settings):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        take = self.library
        pieces = [take.id_to_piece(i) for i in range(take.get_piece_size()) if not (take.is_control(i) or take.is_unknown(i) or take.is_byte(i))]
        self.pairs = {p[i : i + 2] for p in pieces for i in range(len(p) - 1)}
        # If no piece has a blank behind another character, texts fall apart before their blanks.
        apart = not any(p[1] == BLANK and p[0] != BLANK for p in self.pairs)
        self.segments = re.compile(f"{BLANK}+[^{BLANK}]*" if apart else "(?s).+").findall
        self.settings, self.known = settings, {}

    def count(self, text: str | None) -> int:
        """Tokens of a text, by its segments between stable boundaries before blanks."""
        if not text:
            return 0
        parts, known = self.segments(BLANK + text.replace(" ", BLANK)), self.known
        try:
            return sum([known[p] for p in parts])
        except KeyError:
            pass
        if len(known) > self.settings.remembered:
            known.clear()
        missing = list({p for p in parts if p not in known})
        # The library puts a blank before a text, so a segment is given without its first one.
        known.update(zip(missing, map(len, self.library.encode([p[1:] for p in missing], num_threads=1))))
        known[BLANK] = 1  # a lone blank would be an empty text
        return sum([known[p] for p in parts])

    def stable(self, text: str, start: int, stop: int) -> int | None:
        """First place in (start, stop) where no merge can cross."""
        for i in range(start + 1, min(stop, len(text))):
            if text[i - 1 : i + 1].replace(" ", BLANK) not in self.pairs:
                return i
        return None

    def chunks(self, text: str) -> list[tuple[int, int, int, int]]:
        """(start, stop, from, to): characters to encode, and the part to count tokens of."""
        size, out, start, counted = self.settings.chunk, [], 0, 0
        while True:
            cut, overlap, at = None, self.settings.overlap, start + size
            while cut is None and at < len(text):
                cut = self.stable(text, at, at + overlap)
                if cut is None and at + overlap >= len(text):
                    break
                overlap *= 2
            if cut is None:
                return [*out, (start, len(text), counted, len(text))]
            out.append((start, min(len(text), cut + self.settings.overlap), counted, cut))
            start, counted = at, cut

    def count_between(self, text: str, begin: int, end: int) -> int:
        """Tokens of a chunk between two places that must be boundaries of its encoding."""
        ends = [p.end for p in self.library.encode(text, return_type="proto").pieces]  # in bytes
        begin, end = (len(text[:place].encode()) for place in (begin, end))
        first, last = bisect_right(ends, begin) if begin else 0, bisect_right(ends, end)
        for place, k in ((begin, first), (end, last)):
            if place and (k == 0 or ends[k - 1] != place):
                raise ValueError(f"no token ends at {place}: the chunks do not align")
        return last - first


@cache
def counter(path: str, settings: Settings) -> Counter:
    return Counter(path, settings)


def count_tokens(docs: DataFrame, path: str, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row.

    Null texts are empty: no bytes, no tokens. Texts up to a chunk's length are counted where they
    are read. Longer ones become overlapping chunks that are dealt out anew, so one huge text is
    encoded by many tasks; their counts are added up by row, also if a doc_id or row repeats.
    """
    rows = in_small_batches(docs).select("doc_id", "text")
    long = F.char_length("text") > settings.chunk

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path, settings).count
        for batch, texts in texts_of(batches):
            counts = [count(t) for t in texts]
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take = counter(path, settings)
        for batch, texts in texts_of(batches):
            for i, text in enumerate(texts):
                row = batch.column(batch.schema.get_field_index("_row"))[i].as_py()
                found = [{"row": row, "text": text[a:b], "begin": f - a, "end": t - a} for a, b, f, t in take.chunks(text)]
                for at in range(0, len(found), 256):
                    yield pa.RecordBatch.from_pylist(found[at : at + 256], pa.schema([("row", pa.int64()), ("text", pa.string()), ("begin", pa.int64()), ("end", pa.int64())]))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take = counter(path, settings)
        for batch in batches:
            texts, begin, end = (batch.column(k).to_pylist() for k in (1, 2, 3))
            counts = [take.count_between(*x) for x in zip(texts, begin, end)]
            yield pa.record_batch([batch.column(0), pa.array(counts, pa.int64())], ["row", "n"])

    sized = rows.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    kind = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long"
    small = sized.where(~F.coalesce(long, F.lit(False))).mapInArrow(short, kind)
    # Rows that are equal in id and text have the same key: their chunks are counted once for each.
    huge = sized.where(long).withColumn("_row", F.xxhash64("doc_id", "text"))
    pieces = huge.mapInArrow(cut, "row long, text string, begin long, end long")
    # A round-robin repartition sorts whole rows to be repeatable; a key from the row is as good.
    dealt = pieces.repartition(F.xxhash64("row", "begin", F.length("text"), F.crc32("text")))
    sums = dealt.mapInArrow(encode, "row long, n long").groupBy("row").agg(F.sum("n").alias("n_tokens"))
    keys = huge.groupBy("_row", "doc_id", "n_bytes").agg(F.count(F.lit(1)).alias("copies"))
    whole = keys.join(sums, F.col("_row") == F.col("row")).select("doc_id", "n_bytes", (F.col("n_tokens") / F.col("copies")).cast("long").alias("n_tokens"), F.explode(F.expr("sequence(1, copies)")).alias("_copy")).drop("_copy")
    return small.unionByName(whole).withColumn("over_limit", F.col("n_tokens") > settings.limit)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
