"""Language, encoding, counting, packing and chat rendering, against plain versions."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pulcra.llm import chat_render as chat
from pulcra.llm import language_mixture as lang
from pulcra.llm import packing, token_counts, token_files
from pulcra.llm.common import in_fold
from pulcra.llm.encoding import DROPPED, LEADING, Encoder

SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", "\n\n", "a", "  b  \n c ", "don't  stop\u00a0now\u3000x", "\x1c\x1d a \x85 b", "<|endoftext|>", "x  <|endoftext|> y", "▁a ▁ b", "\U0001f600 e\u0301 \u1e9b\u0323", "</s> <s>", "word " * 3000, "noblanks" * 4000, "\u4e2d\u6587" * 9000, "l1\nl2\n" * 4000]


def documents(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="module")
def texts(spark):
    rows = documents(spark).select("text").limit(60).collect()
    return [*ODD, *(r["text"] for r in rows)]


@pytest.fixture(scope="module")
def odd_documents(spark):
    """Ids repeated and null, texts of every kind, and columns whose names the operators use."""
    rows = [(i, t, None if i % 3 else "en", f"s{i % 2}" if i % 5 else None, -1, 0.5) for i, t in enumerate(ODD)]
    rows += [rows[4], rows[13], (None, "no id", "en", "s1", 1, 0.1), (None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, size long, score double")


@pytest.mark.parametrize("name, chunks", [("word_bpe_49k.json", DROPPED), ("byte_bpe_50k.json", LEADING)])
def test_ids_of_remembered_chunks_are_those_of_whole_texts(texts, name, chunks):
    path = public_tokenizers.path(name)
    encoder, whole = Encoder(path, chunks, remembered=200), Tokenizer.from_file(path)
    for text in texts:
        expected = whole.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == expected, text and text[:40]


@settings(deadline=None)
@given(st.text(alphabet="a'sB1 .,!|\n\t\u00a0\u3000\u0301\x1c é<|>", max_size=40))
def test_ids_of_random_texts(text):
    for name, chunks in (("word_bpe_49k.json", DROPPED), ("byte_bpe_50k.json", LEADING)):
        path = public_tokenizers.path(name)
        whole = _whole.setdefault(name, (Encoder(path, chunks), Tokenizer.from_file(path)))
        assert np.frombuffer(whole[0].encode(text), "<u4").tolist() == whole[1].encode(text, add_special_tokens=False).ids


_whole = {}


def test_token_files_hold_every_document_in_order(spark, odd_documents, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    parts = token_files.write_token_files(odd_documents, str(tmp_path), path)
    found = [tuple(r) for r in token_files.read_token_files(parts, str(tmp_path)).collect()]
    rows = sorted(((r["doc_id"], r["text"] or "") for r in odd_documents.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    expected, start = [], 0
    for doc_id, text in rows:
        ids = np.array([*whole.encode(text, add_special_tokens=False).ids, 1], "<u4")
        expected.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(found, key=lambda r: r[1]) == expected


def test_token_files_of_an_empty_table(spark, odd_documents, tmp_path):
    parts = token_files.write_token_files(odd_documents.limit(0), str(tmp_path), public_tokenizers.path("word_bpe_49k.json"))
    assert token_files.read_token_files(parts, str(tmp_path)).count() == 0


@pytest.mark.parametrize("chosen", [token_counts.Settings(), token_counts.Settings(chunk=300, overlap=4)])
def test_counts_are_those_of_whole_texts(spark, texts, chosen):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    docs = spark.createDataFrame([(i // 2, t) for i, t in enumerate([*texts, *texts[-3:]])], "doc_id long, text string")
    found = sorted(tuple(r) for r in token_counts.count_tokens(docs, path, chosen).collect())
    expected = []
    for row in docs.collect():
        n = len(library.encode(row["text"] or ""))
        expected.append((row["doc_id"], len((row["text"] or "").encode()), n, n > chosen.limit))
    assert found == sorted(expected)


def test_overlaps_are_widened_until_a_boundary_is_stable():
    take = token_counts.Counter(public_tokenizers.path("piece_bpe_32k.model"), token_counts.Settings(chunk=100, overlap=2))
    text = "noblanks" * 30 + " b" + "c" * 400
    chunks = take.chunks(text)
    assert len(chunks) > 1 and chunks[-1][3] == len(text)
    assert all(a[3] == b[2] and b[0] < a[3] < a[1] or b[3] == len(text) for a, b in zip(chunks, chunks[1:]))
    assert sum(take.count_between(text[a:b], f - a, t - a) for a, b, f, t in chunks) == len(take.library.encode(text))


def test_language_of_held_out_documents(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    model = lang.learn(lang.training_rows(docs))
    found = docs.where(in_fold(F.col("doc_id"), 5, 0)).select("lang", lang.identify(spark, F.col("text"), model).alias("p")).collect()
    assert sum(r["lang"] == r["p"]["lang_pred"] for r in found) >= 0.98 * len(found)
    assert all(0 <= r["p"]["score"] <= 1 for r in found)


def test_mixture_of_two_languages(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    model = lang.learn(docs)
    long = {r["lang"]: r["text"][:3000] for r in docs.where("length(text) > 3000").collect()}
    both = long["en"][:2000] + " " + long["fr"][:1000]
    chosen, shares = lang.mixture(lang.trigram_counts(both), model)
    found = dict(zip([model.languages[i] for i in chosen], shares))
    assert set(found) == {"en", "fr"} and abs(found["en"] - 0.67) < 0.1


def test_small_share_of_a_long_text_is_kept():
    rng = np.random.default_rng(6)
    chances = rng.dirichlet(np.full(500, 0.3), size=4).T
    model = lang.Model(["a", "b", "c", "d"], np.concatenate([chances, np.full((lang.SLOTS - 500, 4), 1e-9)]).astype(np.float32))
    counts = np.zeros(lang.SLOTS, int)
    counts[:500] = rng.multinomial(995_000, chances[:, 0]) + rng.multinomial(5_000, chances[:, 2])
    chosen, shares = lang.mixture(counts, model)
    assert chosen == [0, 2] and abs(shares[1] - 0.005) < 0.001
    alone, _ = lang.mixture(np.r_[rng.multinomial(10_000, chances[:, 1]), np.zeros(lang.SLOTS - 500, int)], model)
    assert alone == [1]


def test_text_of_three_languages_stays(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    long = {r["lang"]: r["text"] for r in docs.where("length(text) > 2000 AND lang IS NOT NULL").collect()}
    parts = [long[x][:n] for x, n in zip(sorted(long), (1600, 1400, 1000))]
    assert len(parts) == 3
    mixed = spark.createDataFrame([(-5, " ".join(parts), None, None, None)], docs.schema)
    given = docs.unionByName(mixed)
    main = mixed.select(lang.identify(spark, F.col("text"), lang.learn(lang.training_rows(given))).alias("p")).first()["p"]
    assert len(main["languages"]) == 3 and main["score"] < 0.5
    assert lang.keep_identified(spark, given).where("doc_id = -5").count() == 1


def test_language_of_odd_texts(spark, odd_documents):
    model = lang.learn(odd_documents)
    found = odd_documents.select("text", lang.identify(spark, F.col("text"), model).alias("p")).collect()
    for r in found:
        assert (r["p"]["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or ""))
    nothing = lang.learn(odd_documents.limit(0))
    assert {r["p"]["lang_pred"] for r in odd_documents.select(lang.identify(spark, F.col("text"), nothing).alias("p")).collect()} == {"und"}
    assert lang.keep_identified(spark, odd_documents).columns == odd_documents.columns
    named = odd_documents.withColumn("_found", F.lit("own"))
    assert {r["_found"] for r in lang.keep_identified(spark, named).collect()} == {"own"}


def test_trigrams_of_a_long_text_do_not_depend_on_pieces(monkeypatch):
    text = "Añb c'd\n" * 50
    whole = lang.trigram_counts(text)
    monkeypatch.setattr(lang, "_PIECE", 7)
    assert (lang.trigram_counts(text) == whole).all()


def check_packing(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing(spark, odd_documents):
    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    docs = documents(spark).select("doc_id", "text").unionByName(odd_documents.select((F.col("doc_id") + 10_000).alias("doc_id"), "text"))
    pieces = packing.token_pieces(docs, path, with_ids=True)
    packed = packing.pack(pieces).cache()
    rows = packed.collect()
    used, total = check_packing(rows, 2048), sum(r["length"] for r in rows)
    assert used <= 1.03 * total / 2048 + 1
    assert sorted(map(str, rows)) == sorted(map(str, packing.pack(pieces.repartition(3)).collect()))
    expected = []
    for r in docs.collect():
        ids = np.array([*whole.encode(r["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        bounds = [0, *range((len(ids) - 1) % 2048 + 1, len(ids) + 1, 2048)]
        expected += [(r["doc_id"], k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(bounds, bounds[1:]))]
    order = lambda x: [(v is None, v) for v in x]
    assert sorted((tuple(r[:5]) for r in rows), key=order) == sorted(expected, key=order)
    one = packing.sequences(packed).first()
    assert len(one["ids"]) == 4 * sum(r["length"] for r in rows if r["sequence_id"] == one["sequence_id"])
    assert packing.pack(pieces.limit(0)).count() == 0


def test_best_fit_takes_the_fullest_that_fits_and_closes_the_fullest():
    assert packing.best_fit([6, 7, 3, 4], 10, 2) == [(0, 0), (1, 0), (1, 7), (0, 6)]
    assert packing.best_fit([6, 7, 8, 3, 2, 4], 10, 2) == [(0, 0), (1, 0), (2, 0), (0, 6), (2, 8), (3, 0)]
    random.seed(1)
    lengths = [random.randint(1, 2048) for _ in range(3000)]
    assert len({n for n, _ in packing.best_fit(lengths, 2048, 256)}) < 1.06 * sum(lengths) / 2048


@settings(deadline=None)
@given(st.text(alphabet="\\[]/<>sINTROLE=Y ab\n", max_size=60))
def test_escape_is_reversible_and_leaves_no_control_string(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not any(c in escaped for c in ("</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[/ROLE]"))


PARTS = st.sampled_from(["</s>", "[INST]", "[/INST]", "<<SYS>>", "\\", "<", "[", " ", "ok", "[ROLE=x]", "[/ROLE]", "\n", "", "s>"])
TURNS = st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool]", ""]), st.lists(PARTS, max_size=5).map("".join)), max_size=6)


@settings(deadline=None)
@given(TURNS)
def test_rendered_turns_are_read_back(turns):
    done = chat.render(turns, chat.instruction_template)
    assert done.rewritten_at is None
    assert [chat.read_turn(done.text[a:b]) for a, b in done.spans] == turns
    assert [chat.unescape(done.text[a:b]) for a, b in done.loss] == [t for r, t in turns if r == "assistant"]


def test_rewriting_templates_are_found():
    def last_only(turns):
        return "".join(f"<{r}>{t if i == len(turns) - 1 else '...'}" for i, (r, t) in enumerate(turns))

    done = chat.render([("user", "hello"), ("assistant", "hi"), ("user", "bye")], last_only)
    assert done.rewritten_at == 1 and done.loss == []


def test_conversations(spark):
    rows = [(1, 1, "assistant", None), (1, 0, "user", "a"), (1, 0, "user", "a"), (2, None, None, "x"), (None, 0, "assistant", "b\\[INST]"), (3, 0, "assistant", ""), (3, 1, "assistant", "y" * 200_000)]
    given_rows = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    found = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(given_rows)).collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert found[1]["turns_sha256"] == sha("user\na\nuser\na\nassistant\n\n") and found[1]["n_turns"] == 3
    assert found[2]["turns_sha256"] == sha("\nx\n") and found[2]["loss_chars"] == 0
    assert found[None]["loss_sha256"] == sha("b\\[INST]") and found[3]["loss_chars"] == 200_000
    assert chat.read_back(chat.format_conversations(given_rows.limit(0))).count() == 0
