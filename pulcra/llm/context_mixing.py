"""Log probabilities of texts by logistic mixing of hashed-context bit predictors.

A text is its tokens in lower case; it is coded byte by byte and bit by bit, each word closed by a
blank, the end of a text being one byte of its own. Several contexts (the last bytes of the text
across words, the word so far, and that with the word before) are hashed into tables of bit counts.
Their predictions are stretched and added with weights that a gate selects; the weights are learned
online over the training texts, and an adaptive table refines the mixed probability. Every text is
read three times, byte by byte: counted, learned from and scored. Long ones are read in pieces, which
begin with what their contexts reach back to, so that a piece says the same as the whole text.
"""

from __future__ import annotations

import struct
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulcra.config import JoinLimits
from pulcra.llm.common import ID_BYTES, in_fold, in_small_batches, table
from pulcra.operators.lookup import materialize

END = b"\xff"  # no byte of a word
LEVELS = 6  # of how often a context was seen
BLOCK = 1 << 14  # slots whose counts travel together
REACH = 7  # bytes that a piece of a text repeats at least; it begins with a whole word before them
WORD, PAIR = 99, 100  # orders: the word so far, and with the word before


@dataclass(frozen=True)
class Settings:
    orders: tuple[int, ...] = (1, 2, 3, 4, 6, WORD, PAIR)  # bytes before a byte, across words
    slots: int = 1 << 21  # of each order's table: the model's size does not grow with the corpus
    prior: float = 0.4
    rate: float = 0.3
    step: int = 1 << 12  # bytes of one online step, about
    chunk: int = 1 << 16  # bytes whose slots are looked up together, one order after the other
    tasks: int = 24  # that count, at most: each passes all tables on
    refine: int = 33  # steps of the adaptive table
    vocabulary: int = 200_000  # distinct tokens a task counts before it passes them on


def tokens(text: str | None) -> list[bytes]:
    return [*(text or "").encode("utf-8", "surrogatepass").lower().split(), END]


def vocabulary(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(token, n): every distinct token with its count in the training rows (``train``)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.record_batch([pa.array(sums.keys(), pa.binary()), pa.array(sums.values(), pa.int64())], ["token", "n"])

        sums: Counter[bytes] = Counter()
        for batch in batches:
            for text, train in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = tokens(text)
                if train:
                    sums.update(own)
                else:
                    for token in own:
                        sums.setdefault(token, 0)
                if len(sums) > s.vocabulary:
                    yield out()
                    sums.clear()
        yield out()

    counted = docs.select("text", "train").mapInArrow(count, "token binary, n long")
    return counted.groupBy("token").agg(F.sum("n").alias("n"))


def pieces(text: str | None, size: int = 1 << 16) -> Iterator[tuple[bytes, int]]:
    """A text's tokens, closed by blanks and the end, in pieces of about ``size`` bytes, each with the
    number of bytes in front that only repeat what the contexts of its first bytes reach back to."""
    words = tokens(text)
    given = b" ".join(words[:-1]) + b" " * (len(words) > 1) + END
    at = 0
    while at < len(given):
        end = given.find(b" ", at + size - 1) + 1 or len(given)
        start = at
        while start > 0 and at - start < REACH:
            start = given.rfind(b" ", 0, start - 1) + 1
        yield given[start:end], at - start
        at = end


_times = np.uint64(0x100000001B3)
_back = np.uint64(pow(0x100000001B3, -1, 1 << 64))


@cache
def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    ones = lambda base: np.cumprod(np.concatenate([[np.uint64(1)], np.full(count, base, np.uint64)]), dtype=np.uint64)
    return ones(_times), ones(_back)


# The nodes of a half byte's tree on the way to it; and with the bits that follow, a pair of places a node.
_NODES = (np.arange(16)[:, None] | 16) >> np.arange(4, 0, -1)
_TAKEN = (np.arange(16)[:, None] | 16) >> np.arange(3, -1, -1)


class Bits:
    """All bytes of some runs of text: for each the lines of its contexts, and its bits.

    A run is closed by a blank, unless it ends with one or with the end of a text. The first ``skip``
    bytes of a run are context only. A context has a line of sixteen slots for the upper half of the
    next byte and one for the lower half: a tree of four bits each. ``run`` has the run of each byte.
    """

    def __init__(self, runs: list[bytes], s: Settings, skip: np.ndarray | None = None):
        ends = [w if w[-1:] in (END, b" ") else w + b" " for w in runs]
        lengths = np.array([len(w) for w in ends], np.int64)
        data = np.frombuffer(b"".join(ends), np.uint8)
        starts = np.cumsum(lengths) - lengths
        self.run = np.repeat(np.arange(len(runs)), lengths)
        contexts = self._hashed(data, starts, s.orders)
        if skip is not None and skip.any():
            kept = np.arange(len(data)) >= np.repeat(starts + skip, lengths)
            data, self.run, contexts = data[kept], self.run[kept], [x[kept] for x in contexts]
        self.data, self.contexts, self.s = data, contexts, s
        self.upper, self.lower = data >> 4, data & 15
        self.half = (self.upper.astype(np.uint32) + np.uint32(1)) * np.uint32(0x9E3779B1)

    def leaves(self, k: int) -> np.ndarray:
        """(byte, half): sixteen times the line in the table of an order, and the half byte."""
        out = np.empty((len(self.data), 2), np.intp)
        lines = np.uint32(32 - (int(self.s.slots).bit_length() - 5))
        for part, (mixed, own) in enumerate(((self.contexts[k].copy(), self.upper), (self.contexts[k] + self.half, self.lower))):
            mixed ^= mixed >> np.uint32(15)
            mixed *= np.uint32(0x85EBCA77)
            mixed ^= mixed >> np.uint32(13)
            mixed *= np.uint32(0xC2B2AE3D)
            mixed >>= lines
            mixed <<= np.uint32(4)
            mixed |= own
            out[:, part] = mixed
        return out

    @staticmethod
    def _hashed(data: np.ndarray, starts: np.ndarray, orders: tuple[int, ...]) -> list[np.ndarray]:
        """For each of the orders a hash of what lies before each byte."""
        out: dict[int, np.ndarray] = {}
        given = data.astype(np.uint32) + np.uint32(1)
        nearest = [k for k in orders if k < WORD]
        last, seen = np.zeros(len(data), np.uint32), np.empty(len(data), np.uint32)
        for back in range(1, max(nearest, default=0) + 1):
            seen[back:] = given[:-back]
            first = (starts[:, None] + np.arange(back)).ravel()
            seen[first[first < len(data)]] = 0
            last ^= seen
            last *= np.uint32(0x01000193)
            last ^= last >> np.uint32(15)
            if back in nearest:
                out[back] = last.copy()
        if max(orders) >= WORD:
            # Where words begin, and how often each one's values are repeated.
            opens = np.zeros(len(data), bool)
            opens[1:] = data[:-1] == 32
            opens[starts] = True
            begins = np.flatnonzero(opens)
            lengths = np.diff(begins, append=len(data))
            # A sum over the word so far, times a power that does not depend on where it stands.
            up, down = (x[: len(data)] for x in _powers(1 << max(16, len(data).bit_length())))
            sums = (data.astype(np.uint64) + np.uint64(1)) * up
            before = np.cumsum(sums)
            before -= sums
            word = before - np.repeat(before[begins], lengths)
            word *= np.repeat(down[begins] * np.uint64(0x9E3779B97F4A7C15), lengths)
            word >>= np.uint64(32)
            out[WORD] = word.astype(np.uint32)
            # The hash at the blank before is that of the whole word before.
            ended = out[WORD][np.maximum(begins - 1, 0)] + np.uint32(1)
            ended[np.searchsorted(begins, starts)] = 0
            out[PAIR] = (out[WORD] ^ np.repeat(ended * np.uint32(0x27D4EB2F), lengths)) * np.uint32(0x165667B1)
        return [out[k] for k in orders]


@dataclass
class Model:
    known: np.ndarray  # (order * slot): prediction of the training texts; its last three bits: how often it was seen
    weights: np.ndarray  # (gate, order)
    refined: np.ndarray  # (node, step): probability of a one

    @cached_property
    def paths(self) -> np.ndarray:
        """(line * 16 + half byte, bit): what is known of the nodes on the way to a half byte, side by side."""
        return self.known.reshape(-1, 16).take(_NODES.ravel(), axis=1).reshape(-1, 4)


@dataclass
class LeftOut:
    """Predictions and levels of counts from which the bit that follows has been taken out once."""

    counts: np.ndarray  # (bit, order * slot)
    s: Settings

    @cached_property
    def paths(self) -> np.ndarray:
        """(line * 16 + half byte, bit): the predictions on the way to a half byte, side by side."""
        out = np.empty((self.counts.shape[1], 4), np.float32)
        for at in range(0, len(out), BLOCK):
            zeros, ones = self.counts[:, at : at + BLOCK]
            both = np.empty((len(zeros), 2), np.float32)
            # Places that no text has taken are not looked at.
            both[:, 0] = _stretched(np.maximum(zeros - np.float32(1), 0), ones, self.s)
            both[:, 1] = _stretched(zeros, np.maximum(ones - np.float32(1), 0), self.s)
            out[at : at + BLOCK] = both.reshape(-1, 32).take(_TAKEN.ravel(), axis=1).reshape(-1, 4)
        return out

    @cached_property
    def gates(self) -> np.ndarray:
        """(order, line * 16 + half byte, bit): what the last two orders add to the gate."""
        out = np.empty((2, self.s.slots, 4), np.uint8)
        for which, (k, times) in enumerate(((-2, LEVELS + 1), (-1, 1))):
            low = (len(self.s.orders) + k) * self.s.slots
            for at in range(0, self.s.slots, BLOCK):
                zeros, ones = self.counts[:, low + at : low + min(at + BLOCK, self.s.slots)]
                levels = _level(np.maximum(zeros + ones - np.float32(1), 0)) * np.uint8(times)
                out[which, at : at + len(levels)] = levels.reshape(-1, 16).take(_NODES.ravel(), axis=1).reshape(-1, 4)
        return out


def _inputs(bits: Bits, paths: np.ndarray, gates: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(order, bit): what the tables predict; and the gate of each bit, by the inputs' last bits unless ``gates`` has them."""
    s, n = bits.s, len(bits.data)
    inputs, parts = np.empty((len(s.orders), n * 8), np.float32), []
    for k in range(len(inputs)):
        leaves = bits.leaves(k).ravel()
        paths[k * s.slots : (k + 1) * s.slots].take(leaves, axis=0, out=inputs[k].reshape(-1, 4), mode="clip")
        if gates is not None and k >= len(inputs) - 2:
            parts.append(gates[k - len(inputs)].take(leaves, axis=0, mode="clip").ravel())
    if gates is None:
        other, longest = (inputs[k].view(np.uint32) & np.uint32(7) for k in (-2, -1))
        return inputs, (other * np.uint32(LEVELS + 1) + longest).astype(np.intp)
    return inputs, (parts[0] + parts[1]).astype(np.intp)


def _squash(x: np.ndarray, whole: float = 1) -> np.ndarray:
    out = np.clip(x, -20, 20)
    np.exp(np.negative(out, out=out), out=out)
    out += 1
    return np.divide(whole, out, out=out)


def _stretched(zeros: np.ndarray, ones: np.ndarray, s: Settings) -> np.ndarray:
    return np.log((ones + np.float32(s.prior)) / (zeros + np.float32(s.prior)))


def _level(total: np.ndarray) -> np.ndarray:
    """0 for contexts never seen, then in steps of a factor of four."""
    out = (total > 0).astype(np.uint8)
    for step in range(1, LEVELS):
        out += total >= 4**step
    return out


def _mixed(weights: np.ndarray, gate: np.ndarray, inputs: np.ndarray) -> np.ndarray:
    parts = np.ascontiguousarray(weights.T, np.float32).take(gate, axis=1, mode="clip")
    parts *= inputs
    return parts.sum(axis=0)


@cache
def _cells(refine: int) -> np.ndarray:
    """(byte, bit): twice the first place of its node in the adaptive table, and the bit."""
    byte = np.arange(256)[:, None]
    return ((byte | 256) >> np.arange(8, 0, -1)) * (2 * refine) + (byte >> np.arange(7, -1, -1) & 1)


# (byte, bit): what a probability of a one lacks to be that of the bit, but for the sign.
_ZERO = 1.0 - np.unpackbits(np.arange(256, dtype=np.uint8)).reshape(256, 8)


def _refine_place(x: np.ndarray, s: Settings) -> np.ndarray:
    out = np.clip(x, -8, 8)
    out += 8
    out *= (s.refine - 1) / 16
    return np.rint(out, out=out).astype(np.intp)


def leaf_counts(bits: Bits, n: np.ndarray | None, sums: np.ndarray) -> None:
    """Adds to (order * slot) how often a line was followed by a half byte: once, or by the runs' ``n``."""
    for k in range(len(bits.s.orders)):
        own = sums[k * bits.s.slots : (k + 1) * bits.s.slots]
        np.add.at(own, bits.leaves(k).ravel(), own.dtype.type(1) if n is None else np.repeat(n[bits.run].astype(own.dtype), 2))


def node_counts(leaves: np.ndarray) -> np.ndarray:
    """(bit, slot): zeros and ones that followed the nodes of each line, by its half bytes."""
    out, lines = np.zeros((2, len(leaves) // 16, 16), leaves.dtype), leaves.reshape(-1, 16)
    for bit in range(4):
        nodes = 1 << bit
        split = lines.reshape(-1, nodes, 2, 8 // nodes).sum(axis=3, dtype=leaves.dtype)
        out[:, :, nodes : 2 * nodes] = split.transpose(2, 0, 1)
    return out.reshape(2, -1)


def bit_counts(runs: list[bytes], n: np.ndarray, sums: np.ndarray, s: Settings, skip: np.ndarray | None = None) -> None:
    leaves = np.zeros(len(s.orders) * s.slots, np.int64)
    leaf_counts(Bits(runs, s, skip), n, leaves)
    sums += node_counts(leaves)


def _packed(counts: np.ndarray) -> bytes:
    """The width of an integer and the number of bytes, then the integers, as narrow as the largest allows."""
    width = next(w for w in (1, 2, 4, 8) if w == 8 or counts.max() < 256**w)
    plain = counts.astype(f"<u{width}").tobytes()
    return struct.pack("<BQ", width, len(plain)) + pa.compress(plain, codec="zstd", asbytes=True)


def _unpacked(data: bytes, rows: int = 2) -> np.ndarray:
    width, size = struct.unpack_from("<BQ", data)
    plain = pa.decompress(data[9:], decompressed_size=size, codec="zstd", asbytes=True)
    return np.frombuffer(plain, f"<u{width}").reshape(rows, -1).astype(np.int64)


Runs = tuple[list[bytes], np.ndarray, np.ndarray]  # with how often each occurs, and how much of it is context


def given_runs(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[Runs]:
    """Rows (run, n) as they are."""
    for batch in batches:
        given, n = batch.column(0).to_pylist(), batch.column(1).to_numpy().astype(np.float64)
        for at in range(0, len(given), max(1, size // 8)):
            part = given[at : at + max(1, size // 8)]
            yield part, n[at : at + len(part)], np.zeros(len(part), int)


def text_runs(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[Runs]:
    """Pieces of the texts of rows (text), about so many bytes at a time."""
    for batch in batches:
        for held, _, skip in placed_pieces(batch.column(0).to_pylist(), size):
            yield held, np.ones(len(held)), skip


def placed_pieces(texts: list[str | None], size: int) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """Pieces, the place of each one's text, and how much of it is context."""
    held, of, skip, room = [], [], [], size
    for place, text in enumerate(texts):
        for piece, repeated in pieces(text, size):
            held.append(piece)
            of.append(place)
            skip.append(repeated)
            room -= len(piece)
            if room <= 0:
                yield held, np.array(of), np.array(skip)
                held, of, skip, room = [], [], [], size
    if held:
        yield held, np.array(of), np.array(skip)


def count_bits(rows: DataFrame, s: Settings = Settings(), runs: Callable[[Iterator, int], Iterator[Runs]] = given_runs) -> DataFrame:
    """(block, counts): zeros and ones of a block of slots over the training runs, weighted by how
    often each occurs, as packed unsigned integers.

    A task reads its runs once for all orders. It adds up which half byte followed which line, from
    which the counts of the bits on the way follow, and passes on each block once.
    """
    size, plain = len(s.orders) * s.slots, runs is text_runs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[pa.RecordBatch]:
            for at in range(0, size, BLOCK):
                if (part := own[at : at + BLOCK]).any():
                    yield pa.record_batch([pa.array([at // BLOCK]), pa.array([_packed(part)], pa.binary())], ["block", "counts"])

        # Texts count once: narrow sums stay in the caches, and are passed on before one could overflow.
        own, seen = np.zeros(size, np.uint32 if plain else np.int64), 0
        for part, n, skip in runs(batches, s.chunk):
            bits = Bits(part, s, skip)
            if plain and seen + len(bits.data) >= 1 << 31:
                yield from out()
                own[:], seen = 0, 0
            leaf_counts(bits, None if plain else n.astype(np.int64), own)
            seen += len(bits.data)
        yield from out()

    def add(group: pa.Table) -> pa.Table:
        total = sum(_unpacked(x, 1)[0] for x in group["counts"].to_pylist())
        return pa.table({"block": group["block"].slice(0, 1), "counts": pa.array([_packed(node_counts(total))], pa.binary())})

    found = rows.coalesce(s.tasks).mapInArrow(run, "block long, counts binary")
    return found.groupBy("block").applyInArrow(add, "block long, counts binary")


class Mixer:
    """Weights by gate, and the adaptive table behind them; ``learn`` updates both as it goes."""

    def __init__(self, s: Settings):
        self.s = s
        self.weights = np.full((_gates(s), len(s.orders)), 1.0 / len(s.orders))
        self.uses = np.zeros(_gates(s))
        self.tried, self.ones = np.zeros((256, s.refine)), np.zeros((256, s.refine))

    def learn(self, runs: list[bytes], n: np.ndarray, counts: np.ndarray, skip: np.ndarray | None = None) -> None:
        """One step over a few runs that occur ``n`` times. One occurrence of each is taken out of
        the counts, so that weights are not learned from what has been counted already."""
        bits, left = Bits(runs, self.s, skip), LeftOut(counts, self.s)
        often = np.repeat(n[bits.run], 8).astype(float)
        self._tried(self._step(bits.data, *_inputs(bits, left.paths, left.gates), often), often)

    def learn_steps(self, groups: list[Runs], left: LeftOut) -> None:
        """A step for each of some groups of runs that occur once. What is looked up does not depend
        on the weights: this is done for all of them, one order after the other."""
        skips = [skip for _, _, skip in groups]
        bits = Bits([w for part, _, _ in groups for w in part], self.s, np.concatenate(skips))
        inputs, gate = _inputs(bits, left.paths, left.gates)
        ends = np.searchsorted(bits.run, np.cumsum([len(x) for x in skips]))
        cells = [self._step(bits.data[low:high], inputs[:, 8 * low : 8 * high], gate[8 * low : 8 * high]) for low, high in zip([0, *ends], ends)]
        self._tried(np.concatenate(cells))

    def _tried(self, cells: np.ndarray, often: np.ndarray | None = None) -> None:
        found = np.bincount(cells, often, minlength=2 * self.tried.size).reshape(*self.tried.shape, 2)
        self.tried += found[:, :, 0] + found[:, :, 1]
        self.ones += found[:, :, 1]

    def _step(self, data: np.ndarray, inputs: np.ndarray, gate: np.ndarray, often: np.ndarray | None = None) -> np.ndarray:
        """Learns the weights; returns the places of the bits in the adaptive table, twice, and the bits."""
        mixed = _mixed(self.weights, gate, inputs)
        # A step along the mean gradient of each gate, scaled by the inputs' squares.
        error = (np.unpackbits(data) - _squash(mixed)).astype(float)
        squares = np.einsum("kb,kb->b", inputs, inputs)
        if often is not None:
            error, squares = error * often, squares * often
        count = len(self.uses)
        uses = np.bincount(gate, often, minlength=count)
        size = np.maximum(uses + np.bincount(gate, squares, minlength=count) / len(inputs), 1e-9)
        for k, row in enumerate(inputs):
            self.weights[:, k] += self.s.rate * np.bincount(gate, error * row, minlength=count) / size
        self.uses += uses
        cells = _refine_place(mixed, self.s)
        cells += cells
        cells += _cells(self.s.refine).take(data, axis=0).ravel()
        return cells


def _gates(s: Settings) -> int:
    return (LEVELS + 1) ** 2


def _learn_mix(rows: DataFrame, shared, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Weights and refinement: every task learns online over its texts, and the tasks' results are
    averaged by the bits they saw."""
    gates, orders = _gates(s), len(s.orders)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer, held, room = Mixer(s), [], s.chunk
        for part in text_runs(batches, s.step):
            held.append(part)
            room -= sum(map(len, part[0]))
            if room <= 0:
                mixer.learn_steps(held, shared.value)
                held, room = [], s.chunk
        if held:
            mixer.learn_steps(held, shared.value)
        g, k = (x.ravel() for x in np.indices((gates, orders)))
        r = np.flatnonzero(mixer.tried)
        names = ["w"] * len(g) + ["r"] * len(r)
        places = np.concatenate([g * orders + k, r])
        sums = np.concatenate([(mixer.weights * mixer.uses[:, None]).ravel(), mixer.ones.ravel()[r]])
        totals = np.concatenate([mixer.uses[g], mixer.tried.ravel()[r]])
        kept = totals > 0
        yield pa.record_batch([pa.array(names, pa.string()), pa.array(places), pa.array(sums), pa.array(totals)], ["kind", "place", "x", "n"]).filter(pa.array(kept))

    parts = rows.mapInArrow(run, "kind string, place long, x double, n double")
    # Rounded before they are summed, so that the sum does not depend on the order.
    exact = [F.sum(F.col(c).cast("decimal(38,6)")).cast("double").alias(c) for c in ("x", "n")]
    weights, refined = np.full(gates * orders, 1.0 / orders), np.zeros((2, 256 * s.refine))
    for row in parts.groupBy("kind", "place").agg(*exact).collect():
        if row["kind"] == "w":
            weights[row["place"]] = row["x"] / row["n"]
        else:
            refined[:, row["place"]] = row["x"], row["n"]
    return weights.reshape(gates, orders), refine_table(refined[0].reshape(256, -1), refined[1].reshape(256, -1), s)


def refine_table(ones: np.ndarray, tried: np.ndarray, s: Settings) -> np.ndarray:
    """A place that was seen seldom stays near the probability it stands for."""
    return (ones + 20 * _squash(np.linspace(-8, 8, s.refine))) / (tried + 20)


def learn(rows: DataFrame, s: Settings = Settings()) -> Model:
    """Model of the texts of rows (text). Its tables have a fixed number of slots; the counts of
    those and the weights are what reaches the driver."""
    rows = rows.select("text")
    counts = np.zeros((2, len(s.orders) * s.slots), np.float32)
    for block, data in count_bits(rows, s, text_runs).toLocalIterator():
        own = _unpacked(data)
        counts[:, block * BLOCK : block * BLOCK + own.shape[1]] = own
    shared = rows.sparkSession.sparkContext.broadcast(LeftOut(counts, s))
    mix = _learn_mix(rows, shared, s)
    shared.destroy()
    return model_of(counts, *mix, s)


def model_of(counts: np.ndarray, weights: np.ndarray, refined: np.ndarray, s: Settings) -> Model:
    known = np.empty(counts.shape[1], np.float32)
    for at in range(0, len(known), BLOCK):
        own = counts[:, at : at + BLOCK].astype(np.float32)
        bits = _stretched(*own, s).view(np.uint32) & ~np.uint32(7) | _level(own.sum(axis=0))
        known[at : at + BLOCK] = bits.view(np.float32)
    return Model(known, weights, refined)


def token_scores(runs: list[bytes], model: Model, s: Settings = Settings(), skip: np.ndarray | None = None) -> np.ndarray:
    """log10 probability of each run."""
    bits = Bits(runs, s, skip)
    inputs, gate = _inputs(bits, model.paths)
    logs, refined = np.empty(len(bits.data)), np.repeat(model.refined.ravel() / 2, 2)
    for at in range(0, len(logs), s.step):
        data, own = bits.data[at : at + s.step], slice(8 * at, 8 * (at + s.step))
        mixed = _mixed(model.weights, gate[own], inputs[:, own])
        cells = _refine_place(mixed, s)
        cells += cells
        cells += _cells(s.refine).take(data, axis=0).ravel()
        ones = refined.take(cells, mode="clip")
        ones += _squash(mixed, 0.5)
        np.clip(ones, 1e-6, 1 - 1e-6, out=ones)
        each = ones.reshape(-1, 8)
        each -= _ZERO.take(data, axis=0)
        np.abs(each, out=each)
        each = each[:, :4] * each[:, 4:]
        each = each[:, :2] * each[:, 2:]
        np.log(each[:, 0] * each[:, 1], out=logs[at : at + s.step])
    return np.bincount(bits.run, logs, minlength=len(runs)) / np.log(10)


def text_scores(docs: DataFrame, model: Model, s: Settings = Settings()) -> DataFrame:
    """(row, doc_id, held_out, score): log10 probability of the text of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for held, of, skip in placed_pieces(batch.column(0).to_pylist(), s.chunk):
                np.add.at(scores, of, token_scores(held, shared.value, s, skip))
            yield pa.record_batch([*batch.columns[1:], pa.array(scores)], ["row", "doc_id", "held_out", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("text", "row", "doc_id", "held_out").mapInArrow(run, f"row long, doc_id {kind}, held_out boolean, score double")


def document_terms(docs: DataFrame) -> DataFrame:
    """(row, key, k): how often each row holds each of its tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, rows = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(texts), 256):
                own, keys, times = [], [], []
                for text, row in zip(texts[at : at + 256], rows[at : at + 256]):
                    found = Counter(tokens(text))
                    own.append((row, len(found)))
                    keys += [xxhash.xxh64_intdigest(w, 42) for w in found]  # as Spark hashes them
                    times += found.values()
                names = np.repeat(np.array([r for r, _ in own], np.int64), [n for _, n in own])
                hashed = np.array(keys, np.uint64).view(np.int64)
                yield pa.record_batch([pa.array(names), pa.array(hashed), pa.array(times, pa.int32())], ["row", "key", "k"])

    return docs.select("text", "row").mapInArrow(run, "row long, key long, k int")


def score_documents(docs: DataFrame, s: Settings = Settings(), limits: JoinLimits = JoinLimits()) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Null and empty texts are the end alone; null doc_ids train. Rows of one doc_id and text have the
    same scores. The vocabulary is broadcast up to ``limits.broadcast_bytes`` and joined through a
    shuffle beyond; a token that every document holds is one row for each, and skewed partitions of
    that join can be split.
    """
    key = F.xxhash64("doc_id", F.col("doc_id").isNull(), F.coalesce("text", F.lit("")))
    held = in_fold(F.col("doc_id"), 7, 2)
    rows = in_small_batches(docs).select("doc_id", "text", key.alias("row"), held.alias("held_out"), (~held).alias("train"))
    words = materialize(vocabulary(rows, s))
    sums = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") > 0, 1)), F.count(F.lit(1))).first()
    total, distinct, size = (int(x) for x in sums)
    scored = materialize(text_scores(rows, learn(rows.where("train"), s), s))
    counted = words.select(F.xxhash64("token").alias("key"), F.col("n").alias("c"))
    known = F.broadcast(counted) if size * ID_BYTES <= limits.broadcast_bytes else counted.hint("merge")
    joined = document_terms(rows).join(known, "key")
    k = F.col("k").cast("long")
    base = F.log10((F.col("c") + 1) / F.lit(float(total + distinct + 1)))
    values = joined.groupBy("row").agg(
        F.sum(k).alias("n_tokens"),
        F.sum(F.when(F.col("c") > 0, k).otherwise(0)).alias("n_known"),
        F.sum(k * base).alias("base_score"),
    )
    # Equal rows share a key: their terms were added up together, their scores agree.
    copies = scored.groupBy("row", "doc_id", "held_out").agg(F.count(F.lit(1)).alias("copies"), F.min("score").alias("score"))
    out = copies.join(values, "row").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    share = lambda c, kind: (F.col(c) / F.col("copies")).cast(kind).alias(c)
    return out.select("doc_id", "held_out", share("n_tokens", "long"), share("n_known", "long"), F.lit(total).cast("long").alias("train_tokens"), share("base_score", "double"), "score")


def op10_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
