"""The filter audit against a loop over documents and orders."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from compare import connect, difference

from pulcra.config import JoinLimits
from pulcra.llm import filter_audit as audit
from pulcra.llm.oracle import ORACLE

SCHEMA = "doc_id long, text string, source string, mask int, part string, h long, n long"
FEW = audit.Settings(min_words=6)
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def plain(docs, labels, min_words):
    first = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            first[text or ""] = min(first.get(text or "", doc_id), doc_id)
    good, toxic = ({i for i, *q in labels if q[k] == 1 and i is not None} for k in (0, 1))
    out = defaultdict(Counter)
    orders = ["".join(p) for p in permutations("ABCDE")]
    for doc_id, text, source in docs:
        t, part = text or "", source or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(words) < min_words,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": doc_id is not None and doc_id > first[t],
        }
        failed = [c for c in "ABCDE" if fails[c]]
        for order in orders:
            removed = None
            for step, c in enumerate(order, 1):
                row = out[part, order, step]
                row["unique_fails"] += failed == [c]
                if removed:
                    row["redundant"] += fails[c]
                elif fails[c]:
                    removed = c
                    row["removed"] += 1
                    row["good_lost"] += doc_id in good
                    row["toxic_lost"] += doc_id in toxic
                row["kept"] += removed is None
    shapley = Counter()
    for (part, order, step), row in out.items():
        shapley[part, order[step - 1]] += row["removed"]
    return {k: tuple(row[m] for m in MEASURES[:-1]) + (shapley[k[0], k[1][k[2] - 1]],) for k, row in out.items()}


def result(spark, docs, labels, s, limits=JoinLimits()):
    rows = [(*d, 0, "p", 1, 2) for d in docs]
    found = audit.mask_counts(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), s, limits)
    rows = audit.audit(found).collect()
    out = {(r["part"], r["filter_order"], r["step"]): tuple(r[m] for m in MEASURES) for r in rows}
    assert len(out) == len(rows)
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = ["one", "two", "three", "Four", "FIVE", "a#b", "é", "字", "x", "y", "z"]
    texts = [rng.choice([" ", "\n", "\t", " "]).join(rng.choice(words) for _ in range(rng.randrange(1, 14))) for _ in range(60)]
    texts += [None, "", " ", "same text as many others have it", "long words " * 3000]
    docs = []
    for i in range(400):
        text = texts[-2] if i % 3 == 0 else rng.choice(texts)
        docs.append((None if i % 17 == 0 else rng.randrange(300), text, rng.choice([None, "", "s1", "s2"])))
    docs += docs[:20]
    labels = [(rng.randrange(310), rng.choice([None, 0, 1]), rng.choice([None, 0, 1])) for _ in range(200)] + [(None, 1, 1)] * 5
    return docs, labels


@pytest.mark.parametrize("limits", [JoinLimits(), JoinLimits(broadcast_bytes=0, hot_rows=20)], ids=["broadcast", "shuffled"])
@pytest.mark.parametrize("s", [FEW, audit.Settings(min_words=6, cells_per_text=40_000)], ids=["one segment", "many segments"])
def test_against_a_loop(spark, s, limits):
    docs, labels = corpus(5)
    expected = plain(docs, labels, s.min_words)
    assert len(expected) == 3 * 600
    assert result(spark, docs, labels, s, limits) == expected


def test_no_text_repeats_and_no_rows(spark):
    docs = [(i, f"text number {i}", "s") for i in range(50)]
    assert result(spark, docs, [], FEW) == plain(docs, [], 6)
    assert result(spark, [], [(1, 1, 1)], FEW) == {}


def test_full_sketch_loses_nothing(spark):
    """A sketch with far too few cells only shuffles more."""
    docs, labels = corpus(6)
    s = audit.Settings(min_words=6, cells_per_text=0, held=64, part=5)
    assert result(spark, docs, labels, s) == plain(docs, labels, 6)


def test_sketch_clears_unique_texts(spark):
    hashes = spark.range(20_000).selectExpr("xxhash64(id) AS h").selectExpr("h", "xxhash64(h) AS mixed")
    twice = hashes.limit(500)
    n = 20_500 * 8 // audit.CELLS + 1
    bits = audit.repeated_cells(hashes.unionByName(twice), n, audit.Settings())
    probed = hashes.selectExpr("h", "mixed", f"pmod(h, {n}) AS segment").join(bits, "segment")
    kept = probed.where(audit._may_repeat(probed["bits"], probed["mixed"]))
    assert kept.join(twice, "h", "left_semi").count() == 500
    assert kept.count() < 500 + 0.05 * 20_000


def test_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    assert difference(audit.op12_filter_audit(spark, sf_dir), connect(sf_dir), ORACLE["op12_filter_audit"]) is None
