"""Languages of a document as proportions of a mixture.

Every language is a distribution over letter trigrams; a document's trigrams are drawn from a
mixture of them. Expectation-maximisation estimates the proportions, and the set of languages is the
one with the largest penalised likelihood.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from pulcra.llm.common import in_fold, in_small_batches, table, texts_of

SLOTS = 1 << 16  # hashed trigrams; the model has SLOTS numbers for each language
UNKNOWN = "und"
RESULT = "lang_pred string, score double, languages array<string>, proportions array<double>"
_PIECE = 1 << 20


@dataclass(frozen=True)
class Settings:
    smoothing: float = 0.1
    rounds: int = 40
    settled: float = 1e-3
    least_share: float = 0.01  # smaller shares of the first fit go together if none of them is worth its price
    overlap: float = 3.0  # a letter takes part in three trigrams: their likelihoods count a third


@cache
def _letters() -> np.ndarray:
    """Lower-case code of every letter, 0 for other code points."""
    codes = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        if (char := chr(c)).isalpha():
            codes[c] = ord(char.lower()[0])
    return codes


def trigram_counts(text: str | None) -> np.ndarray | None:
    """Trigrams around each letter (other characters look alike), counted by slot; None without a
    letter. Long texts are taken in pieces that overlap by one character."""
    if not text:
        return None
    total, letters = None, _letters()
    for at in range(0, len(text), _PIECE):
        piece = text[max(0, at - 1) : at + _PIECE + 1]
        codes = letters[np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), "<u4")]
        codes = np.concatenate([codes[:0] if at else [np.uint32(0)], codes, [np.uint32(0)]])
        if at + _PIECE < len(text):
            codes = codes[:-1]
        middle = codes[1:-1]
        mixed = codes[:-2] * np.uint32(0x9E3779B1) ^ middle * np.uint32(0x85EBCA6B) ^ codes[2:] * np.uint32(0xC2B2AE35)
        slots = ((mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(16)
        counts = np.bincount(slots[middle != 0], minlength=SLOTS)
        total = counts if total is None else total + counts
    return total if total.any() else None


def language_counts(labelled: DataFrame) -> DataFrame:
    """(lang, slot, n) over all rows of (lang, text); rows with a null in either teach nothing."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch, texts in texts_of(batches):
            for lang, text in zip(batch.column(0).to_pylist(), texts):
                if (counts := trigram_counts(text)) is not None:
                    sums[lang] = counts if lang not in sums else sums[lang] + counts
        for lang, counts in sums.items():
            slots = np.flatnonzero(counts)
            yield pa.record_batch([pa.array([lang] * len(slots), pa.string()), pa.array(slots), pa.array(counts[slots])], ["lang", "slot", "n"])

    rows = in_small_batches(labelled).select("lang", "text").where("lang IS NOT NULL AND text IS NOT NULL")
    return rows.mapInArrow(count, "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Model:
    languages: list[str]
    chances: np.ndarray  # (slot, language)


def learn(labelled: DataFrame, settings: Settings = Settings()) -> Model:
    """Trigram distributions of all labelled rows.

    The counts, at most SLOTS for each language, are what reaches the driver.
    """
    counts = language_counts(labelled).toArrow()
    names = sorted(set(counts["lang"].to_pylist()))
    found = np.full((SLOTS, len(names)), settings.smoothing)
    where = {name: i for i, name in enumerate(names)}
    columns = np.array([where[x] for x in counts["lang"].to_pylist()], int)
    np.add.at(found, (counts["slot"].to_numpy().astype(int), columns), counts["n"].to_numpy())
    return Model(names, (found / found.sum(axis=0, keepdims=True)).astype(np.float32))


def _fit(chances: np.ndarray, counts: np.ndarray, shares: np.ndarray, s: Settings) -> tuple[np.ndarray, float]:
    total = counts.sum()
    for _ in range(s.rounds):
        new = shares * ((counts / (chances @ shares)) @ chances) / total
        moved = np.abs(new - shares).max()
        shares = new
        if moved < s.settled:
            break
    return shares, float(counts @ np.log(chances @ shares)) / s.overlap


def mixture(counts: np.ndarray, model: Model, s: Settings = Settings()) -> tuple[list[int], np.ndarray]:
    """Language indices and their shares.

    From all languages, those of a small share go at once if all of them together add no more to the
    likelihood than the price of one, so that none would be kept; then the smallest one goes as long
    as the penalised likelihood does not fall.
    """
    slots = np.flatnonzero(counts)
    counts = counts[slots].astype(float)
    chances = model.chances[slots].astype(float)
    count = len(model.languages)
    price = 0.5 * np.log(max(counts.sum(), 2))
    chosen = np.arange(count)
    shares, fit = _fit(chances, counts, np.full(count, 1 / count), s)
    large = np.flatnonzero(shares >= min(s.least_share, shares.max()))
    fewer, fit_fewer = _fit(chances[:, large], counts, shares[large] / shares[large].sum(), s)
    if fit_fewer + price >= fit:
        chosen, shares, fit = large, fewer, fit_fewer
    while len(chosen) > 1:
        rest = np.delete(np.arange(len(chosen)), int(shares.argmin()))
        fewer, fit_fewer = _fit(chances[:, chosen[rest]], counts, shares[rest] / shares[rest].sum(), s)
        if fit_fewer + price < fit:
            break
        chosen, shares, fit = chosen[rest], fewer, fit_fewer
    return chosen.tolist(), shares / shares.sum()


def identify(spark: SparkSession, text: Column, model: Model, settings: Settings = Settings()) -> Column:
    """Struct of the main language, its share, and all languages with their shares.

    Null, empty and letterless texts, or a model that learned nothing, give ``und`` and 0. Of equal
    shares the language first in code point order leads. Texts of any length are taken whole.
    """
    shared = spark.sparkContext.broadcast(model)

    @arrow_udf(RESULT)
    def predict(texts: pa.Array) -> pa.Array:
        model, out = shared.value, []
        for text in texts.to_pylist():
            counts = trigram_counts(text) if model.languages else None
            if counts is None:
                out.append({"lang_pred": UNKNOWN, "score": 0.0, "languages": [], "proportions": []})
                continue
            chosen, shares = mixture(counts, model, settings)
            names = [model.languages[i] for i in chosen]
            best = int(shares.argmax())
            out.append({"lang_pred": names[best], "score": min(1.0, float(shares[best])), "languages": names, "proportions": shares.tolist()})
        kinds = [("lang_pred", pa.string()), ("score", pa.float64()), ("languages", pa.list_(pa.string())), ("proportions", pa.list_(pa.float64()))]
        return pa.array(out, pa.struct(kinds))

    return predict(text)


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.where(~in_fold(F.col("doc_id"), 5, 0))


def op1_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(training_rows(docs))
    found = docs.select("doc_id", in_fold(F.col("doc_id"), 5, 0).alias("held_out"), identify(spark, F.col("text"), model).alias("p"))
    return found.select("doc_id", "held_out", "p.*")


def keep_identified(spark: SparkSession, docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Documents with an identified language, however many share the text; those without a letter go."""
    model = learn(training_rows(docs), settings)
    own = f"found_{uuid.uuid4().hex}"  # no name of the documents'
    marked = docs.withColumn(own, identify(spark, F.col("text"), model, settings))
    return marked.where(F.col(own)["lang_pred"] != UNKNOWN).drop(own)
