"""Encoding, language, quality and rules against brute force, libraries and held-out rows."""

import base64
import hashlib
import math
import random
import re
import unicodedata
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest_llm import SF
from tideline.llm import bpe, common, language, quality_model, queries, rules
from tideline.llm.common import crc_fold, fold, table

LIBRARY = Tokenizer.from_file(queries.WORD_BPE)


@pytest.fixture(scope="module")
def tables():
    return bpe.WordBpe(open(queries.WORD_BPE, "rb").read())


def library(text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    return ids, LIBRARY.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abcdehinorst'sSt !<|>endoftx\n\t éßΣ日1²\x1c\xa0"), max_size=60))
def test_encoder_equals_library(text):
    tables = _cached()
    ids = np.frombuffer(tables.encode(text), "<u4")
    assert (ids.tolist(), b"".join(tables.decoded(ids.astype(int))).decode()) == library(text)


def _cached(held=[]):
    if not held:
        held.append(bpe.WordBpe(open(queries.WORD_BPE, "rb").read()))
    return held[0]


def test_encoder_on_long_words(tables):
    rng = random.Random(5)
    for text in ("a" * 5000, "the" * 3000, "".join(rng.choice("aeinorst") for _ in range(20_000))):
        assert np.frombuffer(tables.encode(text), "<u4").tolist() == library(text)[0]


@pytest.mark.parametrize("given_docs", ["docs", "no_docs"])
def test_round_trip_of_documents(request, given_docs):
    given_docs = request.getfixturevalue(given_docs)
    want = []
    for r in given_docs.collect():
        ids, text = library(r["text"])
        raw = np.array(ids, "<u4").tobytes()
        want.append((r["doc_id"], len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    got = [tuple(r) for r in bpe.round_trip(given_docs, queries.WORD_BPE).collect()]
    assert Counter(got) == Counter(want)


def test_encode_then_decode_keeps_other_columns(docs):
    ids = bpe.encode(docs, queries.WORD_BPE)
    back = bpe.decode(ids, queries.WORD_BPE)
    assert back.columns == [*docs.columns, "ids", "decoded"]
    assert all((r["ids"], r["decoded"]) == library(r["text"]) for r in back.collect())
    assert sorted(map(str, bpe.encode(docs, queries.WORD_BPE, decoded_col="decoded").collect())) == sorted(map(str, back.collect()))


def test_round_trip_of_the_given_table(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    for r in queries.op5_bpe(spark, SF).collect():
        ids, text = library(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


# ---- language ----


def slow_log_score(text, model):
    """One n-gram after the other."""
    points = [ord(c) if c.isalpha() else 0 for c in "\0" + text.lower() + "\0\0\0"]
    sums, mask = model.prior.copy().astype(float), (1 << 32) - 1
    for k in range(len(text.lower()) + 2):
        a, b, c = points[k : k + 3]
        two = ((a * 0x85EBCA77) ^ (b * 0xC2B2AE3D & mask) ^ 0x27D4EB2F) & mask
        if a:
            sums += model.logs[(a * 0x9E3779B1 & mask) >> 17]
        if a or b:
            sums += model.logs[(two * 0x165667B1 & mask) >> 17]
        if b:
            sums += model.logs[(((two ^ (c * 0x7FEB352D & mask)) & mask) * 0x846CA68B & mask) >> 17]
    return sums


def test_language_scores_equal_brute_force(monkeypatch):
    rng = np.random.default_rng(2)
    logs = np.vstack([rng.standard_normal((language.BUCKETS, 3)), np.zeros(3)]).astype(np.float32)
    model = language.LanguageModel(("a", "b", "c"), np.log([0.2, 0.3, 0.5]), logs, np.zeros((3, 2)))
    texts = ["Ein Haus", "", None, "x", "12", "çà et là, déjà vu", "long " * 300]
    whole, letters = language.log_scores(texts, model)
    monkeypatch.setattr(language, "CHARS_AT_ONCE", 64)
    cut, _ = language.log_scores(texts, model)
    for k, text in enumerate(texts):
        assert whole[k] == pytest.approx(slow_log_score(text or "", model), abs=1e-2)
        assert cut[k] == pytest.approx(whole[k], abs=1e-2)
    assert letters.tolist() == [7, 0, 0, 1, 0, 12, 1200]


def test_language_of_held_out_rows(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    told = queries.op10_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in told if r["held_out"]]
    assert len(told) == docs.count() and len(held) > 100
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.97
    assert all(r["held_out"] == (crc_fold(r["doc_id"]) == 0) for r in told)


def test_language_edge_cases(docs, no_docs):
    model = language.fit(docs, fold(F.col("doc_id")) != 0)
    rows = language.predict(docs, model, docs.columns[:5]).collect()
    assert len(rows) == docs.count()
    for r in rows:
        has_letter = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not has_letter) and 0 <= r["score"] <= 1
    none = language.fit(no_docs, F.lit(True))
    assert none.langs == () and {r["lang_pred"] for r in language.predict(docs, none, ["doc_id"]).collect()} == {"und"}
    assert language.predict(no_docs, model, ["doc_id"]).count() == 0


def test_gibberish_is_not_usual(spark):
    """Random letters and prose in other languages are not usual, however long; the given documents are."""
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    model = language.fit(docs, fold(F.col("doc_id")) != 0)
    rng = random.Random(4)
    odd = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz     ") for _ in range(n)) for n in (300, 3_000, 300_000)]
    odd += ["Вчера вечером мы долго гуляли по старому городу и смотрели на реку. " * k for k in (2, 200)] + ["昨天晚上我们在老城里走了很久" * 20]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(odd)], "doc_id long, text string")
    assert [r["usual"] for r in language.predict(frame, model, ["doc_id"]).orderBy("doc_id").collect()] == [False] * len(odd)
    held = language.predict(docs.where(fold(F.col("doc_id")) == 0), model, ["doc_id", "text"]).collect()
    assert np.mean([r["usual"] for r in held if len(r["text"].split()) >= 20]) == 1.0


def test_languages_are_bounded(spark):
    """A column of very many languages: the commonest are learned, and all rows are scored."""
    rows = spark.range(2_000).select(F.col("id").alias("doc_id"), F.lit("some words").alias("text"), F.when(F.col("id") < 500, "en").when(F.col("id") < 900, "de").otherwise(F.concat(F.lit("x"), F.col("id").cast("string"))).alias("lang"))
    model = language.fit(rows, F.lit(True), most_langs=3)
    assert model.langs == ("de", "en", "x1000") and language.predict(rows, model, ["doc_id"]).count() == 2_000


# ---- quality network ----


def slow_probability(p, text):
    """One filter place after the other."""
    raw = text.encode()
    blocks = -(-(len(raw) + quality_model.STEP) // quality_model.BLOCK)
    raw = raw + b"\0" * (blocks * quality_model.BLOCK + quality_model.STEP - len(raw))
    kernel = np.concatenate([p["filters"][:, : quality_model.FILTERS], p["filters"][:, quality_model.FILTERS :]])
    at = range(0, blocks * quality_model.BLOCK, quality_model.STEP)
    acts = [np.concatenate([p["embed"][b] for b in raw[k : k + 6]]) @ kernel for k in at]
    tops = [np.max(acts[k : k + quality_model.PLACES], axis=0) for k in range(0, len(acts), quality_model.PLACES)]
    chunks = [np.maximum(a, b) for a, b in zip(tops, [*tops[1:], tops[-1]])]
    hidden = [np.maximum(np.maximum(c + p["bias"], 0) @ p["dense"] + p["dense_bias"], 0) for c in chunks]
    both = np.concatenate([np.max(hidden, axis=0), np.mean(hidden, axis=0)])
    return float(1 / (1 + np.exp(-(both @ p["out"] + p["out_bias"])[0])))


def test_network_equals_brute_force(monkeypatch):
    model = quality_model.QualityModel(quality_model.start(4))
    texts = ["", "abc", "é" * 96, "word " * 100, "x" * 189, "x" * 190, "tail | table | " * 61]
    for at_once in (1, 3, 1024):
        monkeypatch.setattr(quality_model, "BLOCKS_AT_ONCE", at_once)
        got = quality_model.probabilities(model, pa.array([*texts, None], pa.string()))
        assert got == pytest.approx([slow_probability(model.params, t) for t in [*texts, ""]], abs=1e-4)


def test_network_gradients():
    p = quality_model.start(3)
    data, offsets = common.text_bytes(pa.array(["all good words here " * 20, "bad ### stuff $$$ " * 9, "q"]))
    padded, first = quality_model.laid_out(data, offsets)
    labels, weights = np.array([1, 0, 1], np.float32), np.ones(3, np.float32)
    g = quality_model.gradients(p, padded, first, labels, weights)

    def loss(q):
        top, _ = quality_model.block_maxima(q, padded, first)
        prob = quality_model.forward(q, top, first)["prob"].astype(float)
        return -np.mean(labels * np.log(prob) + (1 - labels) * np.log(1 - prob))

    for name, at in (("filters", (3, 5)), ("filters", (7, 30)), ("embed", (111, 2)), ("dense", (2, 3)), ("out", (15,))):
        up, down = ({n: v.copy() for n, v in p.items()} for _ in range(2))
        up[name][at] += 3e-3
        down[name][at] -= 3e-3
        assert g[name][at] == pytest.approx((loss(up) - loss(down)) / 6e-3, abs=2e-3)


def test_quality_of_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op2_quality_classifier(spark, sf).join(table(spark, sf, "labels"), "doc_id").where("held_out").collect()
    good = [r["predicted"] for r in rows if r["quality"] == 1]
    bad = [r["predicted"] for r in rows if r["quality"] == 0]
    assert np.mean(good) > 0.9 and (not bad or np.mean(bad) < 0.4)


def test_quality_edge_cases(spark, docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (3, 0, 0), (None, 1, 0), (9, None, 1), (10, 1, 1)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.where("false"), labels.where("quality = 1")):
        rows = quality_model.score(docs, quality_model.fit(docs, known)).collect()
        assert len(rows) == docs.count()
        assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
        assert len({r["score"] for r in rows if r["doc_id"] in (4, 5)}) == 1
    assert quality_model.score(no_docs, quality_model.fit(no_docs, labels)).count() == 0


# ---- rules ----


def slow_rules(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    covered = {k + j for k in range(len(words) - 7) if seen[tuple(words[k : k + 8])] > 1 for j in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def slow_fertility(text):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    ids = [i for w in words for i in model.encode(w)]
    if not ids:
        return 0.0, 0.0, 0.0, 0.0
    tokens = sum(len(SLOW_BYTES.encode_ordinary(" " + w)) for w in words)
    share = sum(model.is_byte(i) for i in ids) / len(ids)
    edges = [*range(0, max(len(ids) // 1024, 1) * 1024, 1024), len(ids)]
    flat = 0.0
    for a, b in zip(edges, edges[1:]):
        bits = -sum(n / (b - a) * math.log2(n / (b - a)) for n in Counter(ids[a:b]).values())
        flat += (b - a) * (bits / math.log2(b - a) if b - a > 1 else 1.0)
    return sum(map(len, words)) / len(ids), sum(map(len, words)) / tokens, share, flat / len(ids)


def _byte_ranks():
    lines = open(queries.BYTE_BPE, "rb").read().splitlines()
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


SLOW_BYTES = tiktoken.Encoding("slow", pat_str=r" ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+", mergeable_ranks=_byte_ranks(), special_tokens={})


def slow_verdict(text, lang, measured, failed):
    """The bands written out: per language, else per script of most letters."""
    per_piece, per_token, share, flat = measured
    n = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    scripts = Counter(unicodedata.name(c).split()[0] for c in text or "" if c.isalpha())
    script = {"LATIN": "Latn", "GREEK": "Grek", "CJK": "Hani", "HIRAGANA": "Kana"}.get(scripts.most_common(1)[0][0] if scripts else "")
    band = rules.BANDS.by_lang.get(lang) or rules.BANDS.by_script.get(script, rules.BANDS.other)
    slack = band.slack / math.sqrt(max(n, 1))
    inside = band.chars_per_piece[0] - slack <= per_piece <= band.chars_per_piece[1]
    inside &= band.chars_per_byte_token[0] - slack <= per_token <= band.chars_per_byte_token[1]
    return not failed and inside and share <= band.fallback_share and flat >= band.window_entropy


@pytest.mark.parametrize("which", ["docs", "given"])
def test_rules_equal_brute_force(spark, docs, which):
    source = docs if which == "docs" else table(spark, SF, "documents")
    texts = {}
    for r in source.collect():
        texts.setdefault(r["doc_id"], set()).add(r["text"])
    rows = rules.judged(source, queries.PIECE_BPE, queries.BYTE_BPE, keep=("doc_id", "text", "lang")).collect()
    assert len(rows) == source.count()
    for r in rows:
        assert r["text"] in texts[r["doc_id"]]
        assert tuple(r)[3:9] == slow_rules(r["text"])
        measured = slow_fertility(r["text"])
        assert (r["chars_per_piece"], r["chars_per_token"], r["fallback_share"], r["window_entropy"]) == pytest.approx(measured, abs=2e-6)
        assert r["kept"] == slow_verdict(r["text"], r["lang"], measured, r["base_failed"])


def test_rules_keep_clean_and_reject_foreign_text(spark, docs, no_docs):
    kept = rules.filtered(docs, queries.PIECE_BPE, queries.BYTE_BPE)
    assert kept.columns == docs.columns
    assert {4, 5, 6, 7, 8, 9, 10, 11, 100}.isdisjoint({r["doc_id"] for r in kept.collect()})
    assert {1, 2, 3, 13} <= {r["doc_id"] for r in kept.collect()}
    assert rules.filtered(no_docs, queries.PIECE_BPE, queries.BYTE_BPE).count() == 0
    labelled = table(spark, "/root/testdata/sf0.01", "documents").join(table(spark, "/root/testdata/sf0.01", "labels"), "doc_id")
    judged = rules.judged(labelled, queries.PIECE_BPE, queries.BYTE_BPE, keep=("quality",)).where("not base_failed").collect()
    assert np.mean([r["kept"] for r in judged if r["quality"] == 1]) > 0.97


@pytest.mark.parametrize("text,script", [("abc", "Latn"), ("", "Zzzz"), ("12", "Zzzz"), ("слово", "Cyrl"), ("日本", "Hani"), ("ÿé", "Latn"), ("한국", "Hang")])
def test_script(text, script):
    assert rules.script(text) == script
