"""Quality rules on words and lines, and lines that too many documents of a host share.

Normalised lines are hashed; for each host (``source``) the distinct texts that hold a line are
counted. A line above the limit is removed from all but the first of them (smallest doc_id), and
documents that lose most of their words are rejected. ``marked`` gives the verdicts; the pipeline's
stage gives the documents that are left, without those lines.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, replace

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from pulcra.config import JoinLimits
from pulcra.llm.common import WORD, in_small_batches, table, without
from pulcra.operators.lookup import lookup_join, materialize

_words = re.compile(WORD).findall
_symbols = re.compile(r"[#*$%&|<>]").findall


@dataclass(frozen=True)
class Settings:
    least_words: int = 50
    repeat_percent: int = 50
    line_documents: int = 20  # a line in more distinct texts of a host is removed
    kept_percent: int = 50  # of the words; documents with less left are rejected


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_KINDS = [*((c, pa.int64()) for c in COUNTS), ("lines", pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int64())])))]


def line_hash(words: list[bytes], host: int) -> int:
    """Of a host's normalised line; ``host`` is an unsigned number that stands for it."""
    return xxhash.xxh64_intdigest(b" ".join(words), host) - (1 << 63)


def text_counts(text: str | None, host: int = 0) -> tuple:
    """The values of COUNTS and, for each distinct normalised line, its hash and its words.

    Lines are normalised by lower case for A-Z and one blank between words; words of a line that
    stands in the text more than once are added up.
    """
    words = _words(text or "")
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(often := Counter(windows)) < len(windows):
        until = 0  # words before this place are counted
        for i, window in enumerate(windows):
            if often[window] > 1:
                repeated += i + 3 - max(i, until)
                until = i + 3
    seen, twice, lines = set(), 0, {}
    for line in (text or "").split("\n"):
        if line in seen:
            twice += 1
        elif own := line.encode().lower().split():
            seen.add(line)
            key = line_hash(own, host)
            lines[key] = lines.get(key, 0) + len(own)
    if twice:
        lines = {}
        for line in text.split("\n"):
            if own := line.encode().lower().split():
                key = line_hash(own, host)
                lines[key] = lines.get(key, 0) + len(own)
    return len(words), sum(map(len, words)), len(_symbols(text or "")), twice, repeated, lines


_UNSIGNED = (1 << 64) - 1
_STRUCT = ", ".join(f"{c} long" for c in COUNTS) + ", lines array<struct<line:long,words:long>>"


def counted(text: Column, host: Column) -> Column:
    @arrow_udf(_STRUCT)
    def count(texts: pa.Array, hosts: pa.Array) -> pa.Array:
        rows = []
        for text, host in zip(texts.to_pylist(), hosts.to_pylist()):
            *counts, lines = text_counts(text, host & _UNSIGNED)
            rows.append(dict(zip(COUNTS, counts)) | {"lines": [{"line": k, "words": n} for k, n in lines.items()]})
        return pa.array(rows, pa.struct(_KINDS))

    return count(text, host)


def shortened(text: Column, host: Column, gone: Column) -> Column:
    """The text without the lines whose hashes are in ``gone``; null where that is null."""

    @arrow_udf("string")
    def shorten(texts: pa.Array, hosts: pa.Array, gones: pa.Array) -> pa.Array:
        out = []
        for text, host, gone in zip(texts.to_pylist(), hosts.to_pylist(), gones.to_pylist()):
            if gone is None or text is None:
                out.append(None)
                continue
            gone, host = set(gone), host & _UNSIGNED
            own = ((line, line.encode().lower().split()) for line in text.split("\n"))
            out.append("\n".join(line for line, words in own if not words or line_hash(words, host) not in gone))
        return pa.array(out, pa.string())

    # Other texts do not travel to Python.
    return shorten(F.when(gone.isNotNull(), text), host, gone)


def host_key(source: Column) -> Column:
    return F.xxhash64(source.isNull(), source)


def row_key(source: Column, text: Column) -> Column:
    """Same for rows of one host and text; they share a verdict."""
    return F.xxhash64(source.isNull(), source, text.isNull(), text)


def _counted_rows(docs: DataFrame, s: Settings, lines: bool) -> tuple[DataFrame, DataFrame]:
    """(doc_id, _key, COUNTS) of every row, and (_key, _lost) of each text that common lines are taken
    from: how many of its words, and with ``lines`` the hashes of those lines as ``_gone``."""
    host = host_key(F.col("source"))
    found = in_small_batches(docs).select("doc_id", row_key(F.col("source"), F.col("text")).alias("_key"), counted(F.col("text"), host).alias("c"))
    rows = materialize(found.select("doc_id", "_key", "c.*"))
    texts = rows.groupBy("_key").agg(F.min("doc_id").alias("_doc"), F.any_value("lines").alias("lines"))
    # The host is part of the hash, so a line needs one long as its key.
    held = texts.select("_key", "_doc", F.explode("lines").alias("l"))
    held = materialize(held.select("_key", "_doc", F.col("l.line").alias("_line"), F.col("l.words").alias("_words")))
    first = held.groupBy("_line").agg(F.count(F.lit(1)).alias("n"), F.min("_doc").alias("_first"))
    common = materialize(first.where(F.col("n") > s.line_documents).drop("n"))
    lost = held.join(common, "_line").where(~F.col("_doc").eqNullSafe(F.col("_first")))
    sums = [F.sum("_words").alias("_lost"), *([F.collect_list("_line").alias("_gone")] if lines else [])]
    return rows.drop("lines"), materialize(lost.groupBy("_key").agg(*sums))


def _judged(rows: DataFrame, lost: DataFrame, s: Settings) -> DataFrame:
    failed = (F.col("n_words") < s.least_words) | (100 * F.col("n_repeat_words") > s.repeat_percent * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed)
    # Of each text whose lines were all rare nothing is lost; the others are few or copies.
    joined = rows.join(lost, "_key", "left")
    left = F.col("n_words") - F.coalesce("_lost", F.lit(0))
    joined = joined.withColumn("n_words_left", left).withColumn("depleted", 100 * left < s.kept_percent * F.col("n_words"))
    return joined.withColumn("kept", ~F.col("base_failed") & ~F.col("depleted")).drop("_lost")


def marked(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(doc_id, COUNTS, base_failed, depleted, kept, _key) of every row.

    Null and empty texts have no words and fail the base rules. A null source is a host of its own.
    Texts are counted once for a host however often they are repeated, so exact copies do not use
    up a line's limit.
    """
    return _judged(*_counted_rows(docs, s, lines=False), s)


def remove_common_lines_rejects(docs: DataFrame, s: Settings = Settings(), limits: JoinLimits = JoinLimits()) -> DataFrame:
    """Pipeline stage: documents that the rules reject go, the others lose their common lines.

    A removed line goes with its line break; ``n_chars``, if there is one, follows. Documents
    without such a line stay as they are.
    """
    judged = _judged(*_counted_rows(docs, s, lines=True), s).where("NOT kept OR _gone IS NOT NULL")
    # Rows of one host and text share a verdict.
    verdicts = judged.groupBy("_key").agg(F.any_value("kept").alias("kept"), F.count(F.lit(1)).alias("rows"), F.any_value(F.when(F.col("kept"), F.col("_gone"))).alias("_gone"))
    verdicts = materialize(verdicts)
    key, source, text, gone = row_key(F.col("source"), F.col("text")), F.col("_row.source"), F.col("_row.text"), F.col("_gone")
    kept = without(docs, key, verdicts.where("NOT kept").select("_key"), limits)
    changed = verdicts.where("kept").select(F.col("_key").alias("_changed"), "rows", "_gone")
    hashes = changed.agg(F.sum(F.size("_gone"))).first()[0]
    if not hashes:
        return kept
    room = replace(limits, broadcast_bytes=max(0, limits.broadcast_bytes - 16 * hashes))
    # No name of the rows' own can clash inside a struct.
    own = in_small_batches(kept).select(F.struct([F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    own = lookup_join(own, changed, key=row_key(source, text), lookup_key="_changed", weight="rows", row_id=F.coalesce("_row.doc_id", F.lit(0)), limits=room)
    own = own.withColumn("_text", shortened(text, host_key(source), gone))
    new = {"text": F.when(gone.isNotNull(), F.col("_text")).otherwise(text)}
    if "n_chars" in docs.columns:
        count = F.length("_text").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(gone.isNotNull(), count).otherwise(F.col("_row.n_chars"))
    return own.select([new.get(c, F.col("_row").getField(c)).alias(c) for c in docs.columns])


def op6_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marked(table(spark, sf_dir, "documents")).drop("_key")
