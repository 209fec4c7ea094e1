"""Spelling variants against plain loops over all words and all edits."""

import random
import re
import zlib
from collections import Counter

import pytest

from pulcra.config import JoinLimits
from pulcra.llm import spelling_variants as spelling

SMALL = spelling.Settings(cell_rows=8, block=5, part=50, held_chars=100)


def plain(docs, min_length=6, min_count=5, factor=5):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 199 == 0:
                k = h % len(word)
                word = word[:k] + word[k + 1 :]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}
    letters = {c for w in words for c in w}
    near = {}
    for w in words:
        cuts = {w[:i] + w[i + 1 :] for i in range(len(w))}
        puts = {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        swaps = {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in letters} - {w}
        near[w] = [x for x in cuts | puts | swaps if x in words]
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= factor * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words.get(form[w]))
    return out


def result(spark, docs, s, limits=JoinLimits()):
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, node long, word string")
    found = spelling.spelling_variants(frame, s, limits)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = found.collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(out) == len(rows)
    return out


def corpus(seed):
    """Words in chains of variants, many with one beginning, texts with odd characters."""
    rng = random.Random(seed)
    stems = ["abcdef", "aaaaaa", "prefixab", "zusammenhänge", "Àéÿ÷×xyz", "a" * 300 + "b" * 300]
    stems += ["prefix" + "".join(rng.choice("abc") for _ in range(rng.randrange(1, 5))) for _ in range(30)]
    stems += ["".join(rng.choice("ab") for _ in range(rng.randrange(6, 9))) + "suffix" for _ in range(30)]
    pool = []
    for k, stem in enumerate(stems):
        word, n = stem, 160 if k < 6 else rng.choice([5, 6, 30])
        while n >= 3:
            pool += [word] * n
            i, c = rng.randrange(len(word)), rng.choice("abx")
            word = rng.choice([word[:i] + c + word[i + 1 :], word[:i] + word[i + 1 :], word[:i] + c + word[i:]])
            n //= rng.choice([2, 5])
    rng.shuffle(pool)
    pool = [w.upper() if rng.random() < 0.1 and w.isascii() else w for w in pool]
    docs = [(None if i % 9 == 0 else i // 2, rng.choice([" ", ", ", "1", "\n"]).join(pool[i : i + 40])) for i in range(0, len(pool), 40)]
    return docs + [(900, None), (901, ""), (902, "1 2 3"), (903, "ābcdef 中文字字字字")]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize(
    "s, limits", [(spelling.Settings(), JoinLimits()), (SMALL, JoinLimits(broadcast_bytes=0, hot_rows=3))], ids=["one cell", "cells cut into blocks"]
)
def test_against_all_edits(spark, seed, s, limits):
    docs = corpus(seed)
    expected = plain(docs)
    assert len(expected) > 60 and any(form and root != form for form, root, *_ in expected.values())
    assert result(spark, docs, s, limits) == expected


def test_deleted_code_point(spark):
    """Ids for which the contract deletes a code point; other copies keep it."""
    word = "Étudiante"
    hit = [i for i in range(4000) if zlib.crc32(f"{i}:{word}".encode()) % 199 == 0][:5]
    docs = [(i, f"{word} ") for i in hit] * 5 + [(7, "tudiante " * 125)]
    assert result(spark, docs, spelling.Settings()) == plain(docs)


def test_empty_and_repeated(spark):
    assert result(spark, [], spelling.Settings()) == {}
    assert result(spark, [(1, None), (2, "")], spelling.Settings()) == {}
    docs = [(1, "colour colour")] * 3 + [(2, "coloor")] * 5
    assert result(spark, docs, spelling.Settings()) == plain(docs)


def test_acceptor_is_minimal():
    """As many states with several futures as the language has."""
    words = sorted(a + b + c for a in ("pre", "post", "un") for b in ("lock", "load") for c in ("ed", "ing", "s"))
    machine = spelling.Acceptor(words)
    futures = {tuple(sorted(w[k:] for w in words if w.startswith(v[:k]))) for v in words for k in range(len(v) + 1)}
    branching = [f for f in futures if len({x[:1] for x in f}) > 1 or "" in f]
    assert len(machine.final) == len(branching)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    found = spelling.spelling_variants(docs).collect()
    assert {r["word"]: tuple(r)[1:] for r in found} == {w: (f, r, n, k, m) for w, (f, r, n, k, m) in plain(rows).items()}
