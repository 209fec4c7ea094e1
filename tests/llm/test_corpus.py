"""Near-duplicates, vectors, line rules, mixing, scoring and the pipeline, against plain versions."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from pulcra.config import JoinLimits
from pulcra.llm import apportion, line_frequency, near_text, pq_dedup, simhash_pivot
from pulcra.llm import context_mixing as mixing
from pulcra.llm.common import components, without

SF = "/root/testdata/sf0.001"
KINDS = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = ", size long, node long, _key long, target double"


@pytest.fixture(scope="module")
def docs(spark):
    """Documents with copies, near copies, odd texts, null and repeated ids, clashing names."""
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    rng = random.Random(3)
    for i in range(40):
        words = rows[i % 4][1].split(" ")
        if i % 2:
            words[rng.randrange(len(words))] = "changed"
        rows.append((1000 + i, " ".join(words), "en", "src1", 5))
    rows += [(2000, None, None, None, None), (2001, "", "en", "src1", 0), (2002, " \n", None, "src1", 2), (2003, "one", "en", None, 3), (2003, "one", "en", None, 3), (None, "null id here", "en", "src2", 9), (2004, "b a " * 50_000, "en", "src1", 9)]
    return spark.createDataFrame([(*r, 1, 2, 3, 0.5) for r in rows], KINDS + EXTRA)


def groups(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    return [find(i) for i in range(n)]


def plain_fingerprint(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    runs = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(2001, 2400)]
    own = groups(2500, edges)
    least = {}
    for i, r in enumerate(own):
        least.setdefault(r, i)
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(found.get(i, i) == least[own[i]] for i in range(2500))
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_without(spark):
    rows = spark.createDataFrame([(1,), (None,), (2,), (2,)], "a long")
    for limit in (0, 1 << 20):
        for gone, left in (([(2,), (None,)], [1]), ([(1,)], [None, 2, 2]), ([], [1, None, 2, 2])):
            keys = spark.createDataFrame(gone, "k long")
            assert Counter(r[0] for r in without(rows, F.col("a"), keys, JoinLimits(broadcast_bytes=limit)).collect()) == Counter(left)


@pytest.mark.parametrize("settings", [simhash_pivot.Settings(), simhash_pivot.Settings(cell_rows=5, block=4)])
def test_simhash_groups(docs, settings):
    found = simhash_pivot.near_duplicates(docs, settings).collect()
    given = [(r["doc_id"], r["text"]) for r in docs.collect()]
    prints = [plain_fingerprint(t) for _, t in given]
    assert Counter((r["doc_id"], r["fp"] & (2**64 - 1)) for r in found) == Counter((d, p) for (d, _), p in zip(given, prints))
    links = [(i, j) for i in range(len(given)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    own, least = groups(len(given), links), {}
    for i, r in enumerate(own):
        if given[i][0] is not None:
            least[r] = min(least.get(r, math.inf), given[i][0])
    assert Counter((r["doc_id"], r["component_id"]) for r in found) == Counter((d, least.get(r)) for (d, _), r in zip(given, own))


def test_simhash_of_random_fingerprints_loses_no_link(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(1500)]
    for x in base[:700]:
        for _ in range(rng.randrange(3)):
            base.append(x ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 4))))
    signed = sorted({x - (1 << 63) for x in base})
    links = [(i, j) for i in range(len(signed)) for j in range(i) if (signed[i] + (1 << 63) ^ signed[j] + (1 << 63)).bit_count() <= 2]
    own, least = groups(len(signed), links), {}
    for i, r in enumerate(own):
        least.setdefault(r, signed[i])
    classes = spark.createDataFrame([(x,) for x in signed], "node long")
    edges = simhash_pivot.linked(classes, simhash_pivot.Settings(cell_rows=20, block=64))
    found = {r["node"]: r["root"] for r in components(edges).collect()}
    assert [found.get(x, x) for x in signed] == [least[r] for r in own]


def test_keep_first(docs):
    kept = near_text.keep_first(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert {0, 1, 2, 3} <= set(ids) and not set(range(1000, 1040, 2)) & set(ids)
    assert near_text.keep_first(docs.limit(0)).count() == 0


def test_similar_texts_meet_and_others_stay_apart(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    rows, groups_of = [], []
    for g in range(60):
        base = [word() for _ in range(300)]
        for c in range(1 + g % 5):
            text = list(base)
            for at in rng.sample(range(300), 0 if not c else 4):
                text[at] = word()
            rows.append((len(rows), " ".join(text)))
            groups_of.append(g)
        half = base[:150] + [word() for _ in range(150)]  # a third in common
        rows.append((len(rows), " ".join(half)))
        groups_of.append(1000 + g)
    found = {r["doc_id"]: r["component_id"] for r in near_text.near_texts(spark.createDataFrame(rows, "doc_id long, text string"), near_text.Settings(cell_rows=20, block=32)).collect()}
    first = {}
    for i, g in enumerate(groups_of):
        first.setdefault(g, i)
    assert sum(found[i] == first[g] for i, g in enumerate(groups_of)) >= 0.99 * len(rows)
    assert all(found[i] == i for i, g in enumerate(groups_of) if g >= 1000)


def test_signatures_estimate_similarity():
    rng = random.Random(3)
    for share in (0.5, 0.8, 0.95):
        estimates = []
        for _ in range(20):
            words = [str(rng.random()) for _ in range(400)]
            cut = round(400 * 2 * share / (1 + share))  # of 400 shingles on either side
            other = words[:cut] + [str(rng.random()) for _ in range(400 - cut)]
            a, b = ([set(zip(*(x[k:] for k in range(5)))) for x in (words, other)])
            exact = len(a & b) / len(a | b)
            sigs = near_text.signatures(pa.array([near_text.signature(" ".join(x)) for x in (words, other)]))
            estimates.append(near_text.similarity(sigs[:1], sigs[1:])[0] - exact)
        assert abs(np.mean(estimates)) < 0.02 and np.std(estimates) < 0.06


@pytest.mark.parametrize("allowed", [2, 1000])
def test_pairs_near_the_threshold_are_decided_by_shingles(spark, allowed):
    """Families whose members share 0.72 to 0.88 of their shingles with the first, against brute force."""
    rng, rows = random.Random(21), []
    for _ in range(60):
        base = [f"w{rng.getrandbits(40)}" for _ in range(400)]
        rows.append((len(rows), " ".join(base)))
        for _ in range(3):
            share = rng.uniform(0.72, 0.88)
            cut = round(396 * (1 - share) / (1 + share))  # of 396 shingles that change
            rows.append((len(rows), " ".join([*base[: 400 - cut], *(f"w{rng.getrandbits(40)}" for _ in range(cut))])))
    held = [set(zip(*(t.split()[k:] for k in range(5)))) for _, t in rows]
    alike = lambda i, j: len(held[i] & held[j]) / len(held[i] | held[j])
    pairs = [(i, j) for i in range(len(rows)) for j in range(i - i % 4, i)]
    assert sum(0.78 <= alike(i, j) <= 0.85 for i, j in pairs) > 50
    links = [(i, j) for i, j in pairs if alike(i, j) >= 0.8]
    own, least = groups(len(rows), links), {}
    for i, r in enumerate(own):
        least.setdefault(r, i)
    s = near_text.Settings(pairs=allowed)
    found = {r["doc_id"]: r["component_id"] for r in near_text.near_texts(spark.createDataFrame(rows, "doc_id long, text string"), s).collect()}
    # None is joined wrongly; up to one in a hundred differs in more bits or meets nowhere.
    assert all(own[found[i]] == own[i] for i, _ in rows)
    assert sum(found[i] != least[own[i]] for i, _ in rows) <= 0.02 * len(rows)


def test_shingles_travel_by_tile_and_not_by_pair(spark):
    """All pairs of one group and some chains: decided as by brute force, with few sets on the way."""
    rng, count = random.Random(5), 40
    texts = {n: " ".join(rng.choices("abcdefghijkl", k=9)) for n in range(count + 20)}
    for n in range(0, count, 2):
        texts[n + 1] = texts[n]
    links = [(i, j) for i in range(count) for j in range(i)] + [(i, i - 1) for i in range(count + 1, count + 20)]
    docs = spark.createDataFrame([(n, t) for n, t in texts.items()], "doc_id long, text string")
    keyed = docs.select(F.col("doc_id").alias("node"), F.struct(near_text._row_key().alias("key")).alias("found"))
    pairs = spark.createDataFrame(links, "u long, v long")
    s = near_text.Settings(sets=10, shingle=2)
    held = {n: set(zip(t.split(), t.split()[1:])) for n, t in texts.items()}
    alike = {(i, j) for i, j in links if len(held[i] & held[j]) >= 0.8 * len(held[i] | held[j])}
    found = [tuple(r) for r in near_text.similar_pairs(pairs, docs, keyed, s).collect()]
    assert sorted(found) == sorted(alike) and len(alike) >= 20
    tiled = near_text.tiled_pairs(pairs, s).collect()
    sent = {(r["_cell"], r["_home"], r["_probe"], r[side]) for r in tiled for side in "uv"}
    assert len(tiled) == len(links) and len(sent) <= 4 * count + 2 * 20
    assert max(Counter(t[:3] for t in sent).values()) <= 40


def shuffled_bytes(df):
    """What the executed plan of a collected frame has shuffled."""

    def below(plan):
        if plan.nodeName() == "AdaptiveSparkPlan":
            return below(plan.executedPlan())
        if "QueryStage" in plan.nodeName():
            return below(plan.plan())
        own = plan.metrics().get("shuffleBytesWritten")
        inner = plan.children()
        own = own.get().value() if plan.nodeName() == "Exchange" and own.isDefined() else 0
        return own + sum(below(inner.apply(i)) for i in range(inner.size()))

    return below(df._jdf.queryExecution().executedPlan())


def test_only_texts_in_question_are_shuffled(spark):
    """Also where their keys are too many for Spark to broadcast them by itself."""
    rng = random.Random(12)
    words = ["%05x" % rng.randrange(1 << 20) for _ in range(300)]
    rows = [(0, " ".join(words)), (1, " ".join([*words, "more"]))]
    rows += [(i, " ".join("%05x" % rng.randrange(1 << 20) for _ in range(300))) for i in range(2, 600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    keyed = docs.select(F.col("doc_id").alias("node"), F.struct(near_text._row_key().alias("key")).alias("found"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = near_text.similar_pairs(spark.createDataFrame([(1, 0)], "u long, v long"), docs, keyed, near_text.Settings())
        assert [tuple(r) for r in found.collect()] == [(1, 0)]
        assert 0 < shuffled_bytes(found) < 50_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_many_pairs_near_the_threshold_are_passed_on_in_turns():
    """Unlike texts with similar signatures: every pair is passed on in the end, none twice a turn."""
    rng = np.random.default_rng(4)
    nodes = np.unique(rng.integers(0, 1 << 12, 120))
    sig = rng.integers(0, 256, near_text.SIGNATURE, dtype=np.uint8)
    sigs = np.tile(sig, (len(nodes), 1))
    for row in sigs:
        row[rng.choice(near_text.SIGNATURE, 6, replace=False)] ^= 85
    sigs = sigs.view(np.uint64)
    places, s = np.arange(len(nodes)), near_text.Settings(margin=0.3, similarity=0.9)
    few = near_text.groups_in_tile(nodes, sigs, places, places, s, places, 2)
    assert few[2] and few[1].shape[1] == 2 * len(nodes)
    roots, pairs, more = near_text.groups_in_tile(nodes, sigs, places, places, s, places, 1000)
    assert not more and (roots == places).all()
    assert len(set(map(tuple, np.sort(pairs, axis=0).T.tolist()))) == len(nodes) * (len(nodes) - 1) // 2


def test_tables_miss_few_pairs_at_the_threshold():
    """The chance to meet in no table, by formula and for signatures of texts with 0.8 in common."""
    s = near_text.Settings()
    assert near_text.missed(0.8, s) < 0.01 and near_text.missed(0.9, s) < 1e-4 and near_text.missed(0.1, s) > 0.99
    rng = np.random.default_rng(4)
    same = rng.random((20_000, near_text.HASHES)) < 0.8 + 0.2 / 4
    bands = same[:, : s.bands * s.hashes].reshape(len(same), s.bands, s.hashes).all(axis=2)
    assert abs((~bands.any(axis=1)).mean() - near_text.missed(0.8, s)) < 0.002


def test_coordinates_are_differing_bits_of_blocks():
    s = simhash_pivot.Settings()
    fps = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 500)
    first = int(simhash_pivot.references(1)[0])
    plain = [[((int(f) ^ first) >> at & 3).bit_count() for at in range(0, 64, 2)] for f in fps]
    assert (simhash_pivot.coordinates(fps, s) == np.array(plain)).all()


@pytest.mark.parametrize("block", [2048, 16])
def test_no_partner_is_left_out(spark, block):
    """One large crowd of fingerprints within the radius whose texts form several groups: each
    node's nearest partners are often of another group."""
    rng = random.Random(11)
    centre, sig, nodes = rng.getrandbits(63), {}, set()
    while len(nodes) < 150:
        nodes.add(centre ^ sum(1 << b for b in rng.sample(range(63), rng.randrange(1, 9))))
    nodes = sorted(nodes)
    kinds = [bytes(rng.randrange(256) for _ in range(near_text.SIGNATURE)) for _ in range(6)]
    sig = {n: rng.choice(kinds) for n in nodes}
    links = [(i, j) for i in range(len(nodes)) for j in range(i) if sig[nodes[i]] == sig[nodes[j]] and (nodes[i] ^ nodes[j]).bit_count() <= 16]
    own, least = groups(len(nodes), links), {}
    for i, r in enumerate(own):
        least.setdefault(r, nodes[i])
    # One cell a table: every pair meets.
    classes = spark.createDataFrame([(n, sig[n]) for n in nodes], "node long, sig binary")
    edges = near_text.table_edges(classes, near_text.Settings(block=block))
    assert edges.where("u = v").count() == 0
    found = {r["node"]: r["root"] for r in components(edges).collect()}
    assert [found.get(n, n) for n in nodes] == [least[r] for r in own]


def plain_links(vectors, threshold):
    unit = []
    for v in vectors:
        bad = not v or any(x is None or not math.isfinite(x) for x in v) or not any(v)
        a = None if bad else np.array(v, float) / np.abs(np.array(v, float)).max()
        unit.append(None if bad else a / np.linalg.norm(a))
    return [(i, j) for i in range(len(unit)) for j in range(i) if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold]


@pytest.mark.parametrize("settings", [pq_dedup.Settings(), pq_dedup.Settings(list_rows=10, block=16, codewords=16)])
def test_vectors(spark, settings):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 16))
    vectors = [(c + 0.25 * rng.normal(size=16)).tolist() for c in centres for _ in range(12)]
    vectors += [vectors[0]] * 5 + [[2 * x for x in vectors[0]], None, [], [0.0] * 16, [None, *[1.0] * 15], [math.nan, *[1.0] * 15], [math.inf, *[1.0] * 15], [1.0, 2.0], [1.0, 2.0], [-1.0, 0.0], [1e-30] * 16, [1e30] * 16, [1.0] * 16]
    rows = [(i, v, "x", 1) for i, v in enumerate(vectors)]
    found = {r["vec_id"]: r for r in pq_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, node string, n int"), settings).collect()}
    links = plain_links(vectors, 0.9)
    n = Counter(x for pair in links for x in pair)
    own, least = groups(len(vectors), links), {}
    for i, r in enumerate(own):
        least.setdefault(r, i)
    lost = sum(abs(found[i]["n_links"] - n[i]) for i in range(len(vectors)))
    assert lost <= 0.002 * 2 * len(links)
    assert all(found[i]["component_id"] == least[own[i]] and found[i]["kept"] == (least[own[i]] == i) for i in range(len(vectors)))
    assert pq_dedup.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def plain_lines(rows, s):
    host = defaultdict(dict)
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    texts = defaultdict(list)
    for d, t, h in rows:
        texts[(h, t)].append(d)
    low = lambda ids: min((d for d in ids if d is not None), default=None)
    for (h, t), ids in texts.items():
        for line in {" ".join(words(lower(x))) for x in (t or "").split("\n")} - {""}:
            host[h].setdefault(line, []).append(low(ids))
    out = []
    for d, t, h in rows:
        w = words(t)
        windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        often = Counter(windows)
        inside = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(3)}
        lines = [x for x in (t or "").split("\n") if words(x)]
        bad = len(w) < s.least_words or 100 * len(inside) > s.repeat_percent * len(w)
        mine, lost = low(texts[(h, t)]), 0
        for x in lines:
            held = host[h][" ".join(words(lower(x)))]
            if len(held) > s.line_documents and mine != low(held):
                lost += len(words(x))
        kept = not bad and not 100 * (len(w) - lost) < s.kept_percent * len(w)
        out.append((d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(inside), bad, kept))
    return out


def test_line_rules(spark, docs):
    shared = "\n".join("boiler plate line number %d of this host" % i for i in range(8))
    more = [(3000 + i, shared + "\n" + " ".join(f"own{i}x{k}" for k in range(20 if i % 2 else 90)), "en", "src1", 1, 1, 2, 3, 0.5) for i in range(40)]
    given = docs.unionByName(spark.createDataFrame(more, docs.schema))
    s = line_frequency.Settings()
    found = line_frequency.marked(given, s).select("doc_id", *line_frequency.COUNTS, "base_failed", "kept").collect()
    expected = plain_lines([(r["doc_id"], r["text"], r["source"]) for r in given.collect()], s)
    assert Counter(map(tuple, found)) == Counter(expected)
    verdicts = {d: kept for d, *_, kept in expected}
    assert verdicts[3000] and not verdicts[3003] and verdicts[3002]
    kept = line_frequency.remove_common_lines_rejects(given)
    assert kept.columns == given.columns and Counter(r["doc_id"] for r in kept.collect()) == Counter(d for d, *_, k in expected if k)
    assert line_frequency.marked(docs.limit(0)).count() == 0


@pytest.mark.parametrize("limits", [JoinLimits(), JoinLimits(broadcast_bytes=0), JoinLimits(broadcast_bytes=0, hot_rows=1)])
def test_common_lines_leave_kept_documents(docs, limits):
    """All but the first document lose the shared line, wherever and however it stands in them."""
    own = lambda i: " ".join(f"own{i}x{k}" for k in range(60))
    texts = [f"{own(i)}\n Shared  LINE here\n\nlast {i}\nshared line here" for i in range(30)]
    rows = [(5000 + i, t, "en", "src1", 7, 1, 2, 3, 0.5) for i, t in enumerate(texts)]
    rows += [(5100, texts[4], "en", "src1", 7, 1, 2, 3, 0.5), (5101, texts[4], "en", "other", 7, 1, 2, 3, 0.5)]
    given = docs.unionByName(docs.sparkSession.createDataFrame(rows, docs.schema))
    kept = line_frequency.remove_common_lines_rejects(given, limits=limits)
    assert kept.schema == given.schema
    found = {r["doc_id"]: (r["text"], r["n_chars"]) for r in kept.where("doc_id >= 5000").collect()}
    assert found.pop(5000) == (texts[0], 7) and found.pop(5101) == (texts[4], 7)
    without_it = [f"{own(i)}\n\nlast {i}" for i in range(30)]
    expected = {5000 + i: t for i, t in enumerate(without_it) if i} | {5100: without_it[4]}
    assert found == {d: (t, len(t)) for d, t in expected.items()}
    left = {r["doc_id"]: r["n_words_left"] for r in line_frequency.marked(given).where("doc_id > 5000").collect()}
    assert all(left[d] == len(t.split()) for d, t in expected.items())


def test_sainte_lague_is_highest_quotients():
    rng = random.Random(4)
    for _ in range(200):
        weights = [rng.choice([0, 1, 1, 5, 17, rng.random() * 100]) for _ in range(rng.randrange(1, 9))]
        seats, got = rng.randrange(0, 60), [0] * len(weights)
        for _ in range(seats if sum(weights) else 0):
            got[max(range(len(weights)), key=lambda i: (weights[i] / (2 * got[i] + 1), -i))] += 1
        assert sum(apportion.sainte_lague(weights, seats)) == sum(got)
        assert sorted(w / (2 * g + 1) for w, g in zip(weights, got)) == pytest.approx(sorted(w / (2 * g + 1) for w, g in zip(weights, apportion.sainte_lague(weights, seats))))


def test_targets():
    assert apportion.targets([100, 100, 100]) == pytest.approx([200, 166.6667, 83.3333], abs=1e-3)
    assert apportion.targets([1, 1000, 1000]) == pytest.approx([2, 1999.667, 999.8333], abs=1e-3)
    assert apportion.targets([0, 0]) == [0, 0] and apportion.targets([]) == []


def test_mix(docs):
    rows = [r.asDict() for r in apportion.placed(docs.select("doc_id", "source", "text"), F.col("text"), carry=True).select("doc_id", "source", F.col("text"), "_start", "source_size", apportion.taken().alias("taken")).collect()]
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    by, given = defaultdict(int), defaultdict(int)
    for r in rows:
        assert 0 <= r["taken"] <= 2 * size(r["text"])
        by[r["source"]] += r["taken"]
        given[r["source"]] += size(r["text"])
    names = sorted((s for s in given if s is not None)) + [None]
    for name, target in zip(names, apportion.targets([given[n] for n in names])):
        assert abs(by[name] - target) <= max(64, 0.03 * target)
    mixed = apportion.mixed_documents(docs)
    assert mixed.columns == docs.columns
    out = defaultdict(int)
    for r in mixed.collect():
        out[r["source"]] += size(r["text"])
        assert r["n_chars"] == len(r["text"])
    assert dict(out) == {k: v for k, v in by.items() if v}
    assert apportion.mixed_documents(docs.limit(0)).count() == 0


@pytest.mark.parametrize("limits", [JoinLimits(), JoinLimits(broadcast_bytes=0)])
def test_scores(docs, limits):
    found = mixing.score_documents(docs, limits=limits).collect()
    given = [(r["doc_id"], mixing.tokens(r["text"])) for r in docs.collect()]
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    c = Counter(t for d, own in given if not held(d) for t in own)
    total, distinct = sum(c.values()), len(c)
    expected = Counter((d, held(d), len(own), sum(t in c for t in own), total, round(sum(math.log10((c[t] + 1) / (total + distinct + 1)) for t in own), 6)) for d, own in given)
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found) == expected
    assert all(r["score"] < 0 for r in found)


def test_token_probabilities_add_up():
    """What bytes may follow a prefix shares one; unknown tokens are possible."""
    s = mixing.Settings(orders=(1, 2, 99), slots=1 << 12)
    words = [b"ab", b"abc", b"b", mixing.END, b"hello"]
    counts = np.zeros((2, len(s.orders) * s.slots))
    mixing.bit_counts(words, np.array([5.0, 3, 2, 4, 1]), counts, s)
    mixer = mixing.Mixer(s)
    mixer.learn(words, np.array([5.0, 3, 2, 4, 1]), counts.astype(np.float32))
    model = mixing.model_of(counts, mixer.weights, mixing.refine_table(mixer.ones, mixer.tried, s), s)
    one = mixing.token_scores([bytes([x]) for x in range(256) if bytes([x]) not in (b" ", mixing.END)], model, s)
    assert 10**one.sum() < 1 and (one < 0).all()
    assert mixing.token_scores([b"ab", b"zq"], model, s).argmax() == 0
    assert mixing.token_scores([b"x" * 5000], model, s)[0] < -100


def test_slots_count_past_32_bits(spark):
    s = mixing.Settings(orders=(1, 99), slots=1 << 10)
    words = spark.createDataFrame([(b"ab", 3_000_000_000), (b"ac", 3_000_000_001), (b"b", 7)], "token binary, n long").repartition(3)
    expected = np.zeros((2, len(s.orders) * s.slots))
    mixing.bit_counts([b"ab", b"ac", b"b"], np.array([3e9, 3e9 + 1, 7]), expected, s)
    found = {block: mixing._unpacked(data) for block, data in mixing.count_bits(words, s).collect()}
    assert expected.max() > 2**32 and (found[0] == expected).all()


def test_held_out_score_per_known_token_is_near_the_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.score_documents(docs).where("held_out AND n_known = n_tokens").agg(F.sum("base_score"), F.sum("score")).first()
    assert rows[1] > 1.3 * rows[0]


def small_model(texts, s):
    counts, one = np.zeros((2, len(s.orders) * s.slots)), lambda x: np.ones(len(x))
    parts = list(mixing.placed_pieces(texts, 1 << 20))
    for runs, _, skip in parts:
        mixing.bit_counts(runs, one(runs), counts, s, skip)
    mixer = mixing.Mixer(s)
    for _ in range(20):
        for runs, _, skip in parts:
            mixer.learn(runs, one(runs), counts.astype(np.float32), skip)
    return mixing.model_of(counts, mixer.weights, mixing.refine_table(mixer.ones, mixer.tried, s), s)


def test_contexts_reach_over_words():
    """The same words in another order are another text, also in the next word but one's last bytes."""
    s = mixing.Settings(slots=1 << 14)
    model = small_model(["red fox runs to the blue house"] * 30 + ["the red house"] * 5, s)

    def score(text):
        (runs, _, skip), = mixing.placed_pieces([text], 1 << 20)
        return mixing.token_scores(runs, model, s, skip).sum()

    assert score("red fox runs to the blue house") > score("house blue the to runs fox red") + 5


def test_texts_are_read_once_to_be_counted(spark):
    """For all orders in one pass; the counts are those of every bit on its own."""
    s, texts = mixing.Settings(slots=1 << 12), ["red fox", None, "x" * 300, " a b  c " * 50, "Red fox runs"] * 4
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3).mapInArrow(seen, "text string")
    found = {block: mixing._unpacked(data) for block, data in mixing.count_bits(rows, s, mixing.text_runs).collect()}
    assert read.value == len(texts)
    given = [p for t in texts for p in mixing.pieces(t)]
    size = len(s.orders) * s.slots
    expected = np.zeros((2, size), int)
    for run, _ in given:
        bits = mixing.Bits([run], s)
        for k in range(len(s.orders)):
            for (upper, lower), byte in zip(bits.leaves(k).tolist(), run):
                for leaf, half in ((upper, byte >> 4), (lower, byte & 15)):
                    assert leaf % 16 == half
                    node = 1
                    for place in (3, 2, 1, 0):
                        bit = half >> place & 1
                        expected[bit, k * s.slots + leaf - half + node] += 1
                        node = 2 * node + bit
    assert expected.sum() == 8 * len(s.orders) * sum(len(run) for run, _ in given)
    for block, own in found.items():
        at = block * mixing.BLOCK
        assert (own == expected[:, at : at + mixing.BLOCK]).all()
        expected[:, at : at + mixing.BLOCK] = 0
    assert not expected.any()


def test_steps_looked_up_together_learn_what_single_ones_do():
    rng = random.Random(6)
    texts = [" ".join(rng.choices(["a", "bc", "red", "house", "x" * 90], k=rng.randrange(1, 400))) for _ in range(30)] + [None, ""]
    s = mixing.Settings(slots=1 << 14, step=1 << 9)
    groups = [(runs, np.ones(len(runs)), skip) for runs, _, skip in mixing.placed_pieces(texts, s.step)]
    assert len(groups) > 20 and any(skip.any() for _, _, skip in groups)
    counts = np.zeros((2, len(s.orders) * s.slots))
    for runs, n, skip in groups:
        mixing.bit_counts(runs, n, counts, s, skip)
    counts = counts.astype(np.float32)
    one, all_ = mixing.Mixer(s), mixing.Mixer(s)
    for runs, n, skip in groups:
        one.learn(runs, n, counts, skip)
    left = mixing.LeftOut(counts, s)
    for at in range(0, len(groups), 7):
        all_.learn_steps(groups[at : at + 7], left)
    assert not np.allclose(one.weights, 1 / len(s.orders))
    assert all_.weights == pytest.approx(one.weights, rel=1e-6)
    for name in ("uses", "tried", "ones"):
        assert (getattr(all_, name) == getattr(one, name)).all()


def test_pieces_say_what_the_whole_text_says():
    rng = random.Random(4)
    text = " ".join("".join(rng.choices("abcd", k=rng.choice([1, 2, 9, 300]))) for _ in range(400)) + " \n"
    s = mixing.Settings(slots=1 << 14)
    model = small_model([text[:3000], "a b"], s)
    whole, cut = (list(mixing.pieces(text, size)) for size in (1 << 20, 50))
    assert len(whole) == 1 and len(cut) > 100
    assert b"".join(x[k:] for x, k in cut) == whole[0][0]
    score = lambda found: mixing.token_scores([x for x, _ in found], model, s, np.array([k for _, k in found])).sum()
    assert score(cut) == pytest.approx(score(whole), rel=1e-6)
    assert list(mixing.pieces(None)) == list(mixing.pieces(" ")) == [(mixing.END, 0)]


def test_scores_depend_on_the_order_of_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").where("doc_id < 60")
    rows = [tuple(r) for r in docs.collect()]
    held = next(t for d, t in rows if zlib.crc32(str(d).encode()) % 7 == 2 and len((t or "").split()) > 30)
    fold = [d for d in range(10_000, 10_200) if zlib.crc32(str(d).encode()) % 7 == 2][:2]
    rows += [(fold[0], held), (fold[1], " ".join(reversed(held.split())))]
    found = {r["doc_id"]: r for r in mixing.score_documents(spark.createDataFrame(rows, "doc_id long, text string")).where(F.col("doc_id").isin(fold)).collect()}
    assert found[fold[0]]["base_score"] == pytest.approx(found[fold[1]]["base_score"])
    assert abs(found[fold[0]]["score"] - found[fold[1]]["score"]) > 1


def test_pipeline(spark, docs, tmp_path):
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    names = now.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == names, name
    assert 0 < now.count()
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(packed[0].asDict())


def test_pipeline_of_an_empty_table(spark, docs, tmp_path):
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
