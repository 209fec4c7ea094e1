"""Spelling variants by finite-state composition.

The vocabulary is an acceptor. Composed with a transducer of exactly one edit and with itself it
accepts the pairs of words one inserted, deleted or replaced code point apart. Before the edit both
words read the same symbols, so the composition walks the diagonal of the acceptor; after it, it
walks the states that two different arcs lead to.

Two near words share a long beginning or a long end: if the shorter one has ``l`` code points, at
least ``l // 2`` of either. The composition is therefore cut by its states after ``l // 2`` symbols,
of the vocabulary as it is and of the vocabulary reversed. States are dealt over cells by a hash,
a cell with too many words is cut into pairs of blocks; each task builds the minimised acceptor of
its words and enumerates what the composition accepts from its states. No word is ever compared
with all words of a cell.

Null and empty texts hold no word. A null doc_id reads as an empty text where ids are hashed. Rows
of one doc_id count each. Further columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulcra.config import JoinLimits
from pulcra.llm.common import in_small_batches, table
from pulcra.llm.tiles import self_tiles
from pulcra.operators.lookup import lookup_join, materialize

# Runs of letters, of texts whose A-Z are lower case already.
RUN = re.compile("[a-zÀ-ÿ]+")
GAP = re.compile("[^a-zÀ-ÿ]")
TYPO_EVERY = 199  # one of so many (document, word) has a code point deleted


@dataclass(frozen=True)
class Settings:
    min_length: int = 6
    min_count: int = 5
    factor: int = 5  # by how much a form has to be the more frequent word
    cell_rows: int = 20_000  # words that a cell should hold, about
    block: int = 40_000
    part: int = 1 << 20  # code points of a text that are taken apart at once
    held_chars: int = 8 << 20  # of words that a task counts before it passes them on


def _parts(text: str, size: int) -> Iterator[tuple[int, int]]:
    """Parts of about that size that end at a gap between runs."""
    at = 0
    while at < len(text):
        gap = GAP.search(text, at + size) if at + size < len(text) else None
        end = gap.start() if gap else len(text)
        yield at, end
        at = end


def words_of(doc_id: object, raw: bytes, s: Settings) -> Iterator[tuple[str, int]]:
    """Words of a text with how often each occurs, in parts; misspelt as the contract has it."""
    text = raw.lower().decode("utf-8", "replace")  # of bytes, lower() changes A-Z alone
    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for at, end in _parts(text, s.part):
        counts: dict[str, int] = defaultdict(int)
        for run in RUN.findall(text, at, end):
            counts[run] += 1
        for run, n in counts.items():
            if len(run) >= s.min_length:
                h = zlib.crc32(run.encode(), seed)
                if h % TYPO_EVERY == 0:
                    k = h % len(run)
                    run = run[:k] + run[k + 1 :]
                    if len(run) < s.min_length:
                        continue
                yield run, n


def vocabulary(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(word, n) of all words that occur often enough; counts are added up inside tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = defaultdict(int)
        chars = 0

        def out() -> pa.RecordBatch:
            return pa.record_batch([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for doc_id, raw in zip(batch.column(0).to_pylist(), texts):
                for word, n in words_of(doc_id, raw.as_py() or b"", s):
                    if word not in held:
                        chars += len(word) + 16
                    held[word] += n
                    if chars > s.held_chars:
                        yield out()
                        held.clear()
                        chars = 0
        yield out()

    counts = in_small_batches(docs).select("doc_id", "text").mapInArrow(run, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= s.min_count)


class Acceptor:
    """The minimised acceptor of sorted distinct words.

    A chain of states with one arc each is one arc with a longer label, so that a very long word
    takes one state; states with equal futures are one state.
    """

    def __init__(self, words: list[str]):
        self.final: list[bool] = []
        self.arcs: list[dict[str, tuple[str, int]]] = []  # by first symbol: label, state
        self._known: dict[tuple, int] = {}
        open_states: list[list] = [[0, False, []]]  # depth, final, arcs of the states on the last path
        last = ""
        for word in words:
            shared = _shared(last, word)
            self._close(open_states, last, shared)
            if len(word) == open_states[-1][0]:  # only the empty word
                open_states[-1][1] = True
            else:
                open_states.append([len(word), True, []])
            last = word
        self._close(open_states, last, 0)
        self.root = self._state(open_states[0])

    def _close(self, open_states: list[list], word: str, depth: int) -> None:
        while open_states[-1][0] > depth:
            state = open_states.pop()
            if open_states[-1][0] < depth:
                open_states.append([depth, False, []])
            parent = open_states[-1]
            parent[2].append((word[parent[0] : state[0]], self._state(state)))

    def _state(self, state: list) -> int:
        key = (state[1], tuple(state[2]))
        if key not in self._known:
            self._known[key] = len(self.final)
            self.final.append(state[1])
            self.arcs.append({label[0]: (label, to) for label, to in state[2]})
        return self._known[key]

    def both(self, a: tuple[str, int], i: int, b: tuple[str, int], j: int, n: int) -> Iterator[str]:
        """Texts of n symbols that lead to a final state from both places, each inside an arc."""
        todo = [(a, i, b, j, n, "")]
        while todo:
            a, i, b, j, n, read = todo.pop()
            m = min(len(a[0]) - i, len(b[0]) - j)
            if m > n or a[0][i : i + m] != b[0][j : j + m]:
                continue
            read, i, j, n = read + a[0][i : i + m], i + m, j + m, n - m
            end_a, end_b = i == len(a[0]), j == len(b[0])
            if end_a and end_b:
                if n == 0:
                    if self.final[a[1]] and self.final[b[1]]:
                        yield read
                else:
                    others = self.arcs[b[1]]
                    todo += [(arc, 0, others[c], 0, n, read) for c, arc in self.arcs[a[1]].items() if c in others]
            elif n and end_a:
                if arc := self.arcs[a[1]].get(b[0][j]):
                    todo.append((arc, 0, b, j, n, read))
            elif n and (arc := self.arcs[b[1]].get(a[0][i])):
                todo.append((a, i, arc, 0, n, read))

    def one_edit(self, length: int, after: int) -> Iterator[tuple[str, str]]:
        """Accepted pairs whose shorter word has ``length`` symbols and which differ by one edit
        that comes after so many shared symbols. The edit is taken where the words first differ,
        which is a state of the diagonal, so each pair comes once."""
        todo = [(self.root, "")]
        while todo:
            state, read = todo.pop()
            arcs = list(self.arcs[state].values())
            todo += [(to, read + label) for label, to in arcs if len(read) + len(label) <= length]
            rest = length - len(read)
            if len(read) < after:
                continue
            for k, a in enumerate(arcs):
                if rest == 0:  # one symbol after the whole shorter word
                    if self.final[state] and len(a[0]) == 1 and self.final[a[1]]:
                        yield read, read + a[0]
                    continue
                for b in arcs[k + 1 :]:
                    for end in self.both(a, 1, b, 1, rest - 1):
                        yield read + a[0][0] + end, read + b[0][0] + end
                for b in arcs:
                    if b is not a:
                        for end in self.both(a, 0, b, 1, rest):
                            yield read + end, read + b[0][0] + end


def _shared(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return n if a[:n] == b[:n] else next(i for i in range(n) if a[i] != b[i])


def near_words(words: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Of ``words`` (word, n): (word, n_near, best_n, best) for words with a near one, where best is
    the near word with the largest n, the first in code-point order of several."""
    cells = max(1, -(-4 * words.count() // s.cell_rows))
    size = F.char_length("word")
    # A pair belongs to the length of its shorter word; a word may be the shorter or the longer one.
    lengths = F.filter(F.array(size, size - 1), lambda n: n >= s.min_length)
    rows = words.select(F.col("word").alias("node"), "n", F.explode(lengths).alias("length"))
    rows = rows.select("*", F.explode(F.array(F.lit(False), F.lit(True))).alias("reversed"))
    half = F.floor(F.col("length") / 2).cast("int")
    state = F.when(F.col("reversed"), F.expr("right(node, length div 2)")).otherwise(F.substring("node", F.lit(1), half))
    rows = rows.withColumn("_cell", F.pmod(F.xxhash64("reversed", "length", state), F.lit(cells)))

    def compare(key: tuple, rows: pa.Table) -> pa.Table:
        _, home, probe = (k.as_py() for k in key)
        groups: dict[tuple, list[str]] = defaultdict(list)
        known = {}
        for word, n, length, back, own in zip(*(rows[c].to_pylist() for c in ("node", "n", "length", "reversed", "_own"))):
            groups[length, back].append(word)
            known[word] = (n, own)
        near: dict[str, int] = defaultdict(int)
        best: dict[str, tuple[int, str]] = {}
        for (length, back), members in groups.items():
            machine = Acceptor(sorted(w[::-1] for w in members) if back else sorted(members))
            for a, b in machine.one_edit(length, length // 2):
                if back:
                    a, b = a[::-1], b[::-1]
                    if a[: length // 2] == b[: length // 2]:
                        continue  # found by their shared beginning
                if home != probe and known[a][1] == known[b][1]:
                    continue  # found in the tile of that block alone
                for word, other in ((a, b), (b, a)):
                    near[word] += 1
                    offer = (-known[other][0], other)
                    if word not in best or offer < best[word]:
                        best[word] = offer
        return pa.table({"word": pa.array(list(near), pa.string()), "n_near": pa.array(list(near.values()), pa.int64()), "best_n": pa.array([-best[w][0] for w in near], pa.int64()), "best": pa.array([best[w][1] for w in near], pa.string())})

    found = self_tiles(rows, rows.select("_cell"), s.block).applyInArrow(compare, "word string, n_near long, best_n long, best string")
    first = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best"))).alias("first")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first).select("word", "n_near", (-F.col("first.less")).alias("best_n"), "first.best")


def _roots(forms: DataFrame, limits: JoinLimits) -> DataFrame:
    """Of (word, form): (word, root). Each round doubles the number of forms that were followed;
    counts grow by a factor at every form, so a chain is no longer than their logarithm."""
    state = materialize(forms.select("word", F.col("form").alias("root")))
    while True:
        ends = state.groupBy(F.col("root").alias("end")).agg(F.count(F.lit(1)).alias("rows"))
        further = materialize(ends.join(state.toDF("end", "next"), "end"))
        if further.isEmpty():
            return state
        state = lookup_join(state, further, key=F.col("root"), lookup_key="end", weight="rows", row_id=F.col("word"), limits=limits)
        state = materialize(state.select("word", F.coalesce("next", "root").alias("root")))


def spelling_variants(docs: DataFrame, s: Settings = Settings(), limits: JoinLimits = JoinLimits()) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``docs`` (doc_id, text)."""
    words = materialize(vocabulary(docs, s))
    found = words.join(near_words(words, s), "word", "left")
    good = F.col("best_n") >= s.factor * F.col("n")
    found = materialize(
        found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(good, F.col("best")).alias("form"), F.when(good, F.col("best_n")).alias("form_n"))
    )
    roots = _roots(found.where(F.col("form").isNotNull()), limits)
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))
