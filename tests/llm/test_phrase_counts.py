"""Counts of phrases travel packed: a row for each bucket, not one for each phrase."""

from collections import Counter

import numpy as np
import pyarrow as pa
from conftest_llm import WORDS
from tideline.llm import phrases


def test_packed_counts_come_back():
    rng = np.random.default_rng(3)
    value, text = rng.integers(0, 1 << 64, 50_000, np.uint64), rng.integers(0, 1 << 32, 50_000, np.uint32)
    value = np.concatenate([value, value[:9_000], value[:9_000]])
    other = value ^ np.uint64(7)
    other[-500:] += np.uint64(1)  # other phrases of one first hash
    text = np.concatenate([text, text[:9_000], text[:9_000]])
    marks, n, *rest = phrases._distinct(value, np.ones(len(value), np.uint32), other, text)
    batch = phrases._packed(3, marks, n.astype(np.uint32), *rest)
    assert batch.num_rows <= 1 << phrases.BUCKET_BITS
    got = Counter()
    for _ in range(2):
        for cell, (m, n, o, _) in phrases._unpacked(pa.table(batch)):
            assert cell == 3 and n.dtype == np.uint32
            got.update(dict(zip(zip(m.tolist(), o.tolist()), n.tolist())))
    assert got == {k: 2 * v for k, v in Counter(zip(value.tolist(), other.tolist())).items()}
    many = [np.array([5, 5], np.uint64), np.full(2, 0xFFFFFFFF, np.uint32)]
    assert phrases._summed(*many)[1].tolist() == [2 * 0xFFFFFFFF]


def test_a_phrase_is_named_in_one_text(spark):
    """The pass that names phrases gives about one row a phrase, not one for each task that has it."""
    line = " ".join(WORDS)
    frame = spark.createDataFrame([(f"{line} w{k}", "en") for k in range(64)], "text string, lang string").repartition(16)
    sources = phrases._sources(frame, 4, "text", "lang")
    every = phrases.Filter(16, np.full(1 << 13, 255, np.uint8))
    found = phrases.counted(sources, [every] * 3, 10).cache()
    known, place = phrases.filter_of(found, found["place"], 24), []
    for text in (r["text"] for r in frame.collect()):
        words = phrases.Words([text])
        for size in (1, 2, 3):
            places = phrases.phrase_places(words, size)
            value = phrases.phrase_marks(words.marks(), places, size, phrases._salt("en"))
            place.append(known.has(phrases._placed(value, words.text_of(places))))
    assert found.count() <= np.concatenate(place).sum() <= 1.2 * found.count() + 5
    got = {r["phrase"]: r["n"] for r in phrases.named(sources, found, 3, 24).collect()}
    assert got == {" ".join(WORDS[a : a + n]): 64 for n in (1, 2, 3) for a in range(len(WORDS) - n + 1)}
