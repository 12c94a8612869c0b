"""Near copies of the pipeline's stage against brute force over all pairs."""

import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from conftest_llm import SF, WORDS, doc
from tideline.llm import nearcopies
from tideline.llm.common import table


def slow_sets(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    return {tuple(words[k : k + 5]) for k in range(max(len(words) - 4, min(len(words), 1)))}


def slow_components(texts):
    """Component of each text by comparing all pairs, and the number of pairs that are near."""
    sets, root = [slow_sets(t) for t in texts], list(range(len(texts)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    near = 0
    for j in range(len(sets)):
        for i in range(j):
            small, large = sorted((len(sets[i]), len(sets[j])))
            if small < 0.8 * large:
                continue
            both = len(sets[i] & sets[j])
            if both >= 0.8 * (small + large - both):
                near += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(k) for k in range(len(texts))], near


def slow_ids(rows):
    label, near = slow_components([r["text"] for r in rows])
    lowest = {}
    for r, k in zip(rows, label):
        if r["doc_id"] is not None:
            lowest[k] = min(lowest.get(k, r["doc_id"]), r["doc_id"])
    return set(lowest.values()), near


def mutated(rng, words, flips):
    words = list(words)
    for at in rng.sample(range(len(words)), flips):
        words[at] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def frame(spark, rows):
    return spark.createDataFrame([doc(i, t)[:5] for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")


def test_stage_finds_pairs_of_similarity_08(spark):
    rng, rows = random.Random(5), []
    for g in range(40):
        base = [f"{rng.choice(WORDS)}{rng.randrange(3000)}" for _ in range(200)]
        rows += [(1000 * g + k, mutated(rng, base, (0, 1, 2, 3, 4, 5, 6)[k])) for k in range(7)]
    hub = [f"{rng.choice(WORDS)}{rng.randrange(3000)}" for _ in range(150)]
    rows += [(90_000 + k, mutated(rng, hub, 1 + k % 3)) for k in range(150)]
    docs = frame(spark, rows)
    want, near = slow_ids(docs.collect())
    kept = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert near > 400 and {r["doc_id"] for r in kept.collect()} == want


def test_given_documents(spark):
    docs = table(spark, SF, "documents").select(*corpus_pipeline.COLUMNS)
    rows = docs.collect()
    want, _ = slow_ids(rows)
    got = corpus_pipeline.near_duplicates(spark, docs, SF).collect()
    assert Counter(map(tuple, got)) == Counter(tuple(r) for r in rows if r["doc_id"] in want)


def test_edge_cases(docs, no_docs):
    kept = nearcopies.keep_one(docs)
    assert kept.columns == docs.columns and nearcopies.keep_one(no_docs).count() == 0
    want, _ = slow_ids(docs.collect())
    got = [r["doc_id"] for r in kept.collect()]
    assert Counter(i for i in got if i is not None) == Counter(want) and got.count(None) == 2


def test_repeated_id_in_two_groups(spark):
    one, two = " ".join(WORDS), " ".join(reversed(WORDS))
    docs = frame(spark, [(1, one), (2, one), (2, two), (3, two), (3, two), (5, "a b c")])
    got = {(r["doc_id"], r["text"]) for r in nearcopies.keep_one(docs).collect()}
    assert got == {(1, one), (2, two), (5, "a b c")}


# ---- groups whose members stay apart ----


def star(rng, members, similarity, size=200, name="s"):
    """Variants of one original that have about this similarity to one another, and few to the original."""
    base = [f"{name}{rng.randrange(10**6)}" for _ in range(size)]
    # a flipped word takes five shingles; two variants differ in those of both
    shingles = size - 4
    flips = round(shingles * (1 - similarity) / (1 + similarity) / 5)
    return [mutated(rng, base, flips) for _ in range(members)]


def incidence_links(texts):
    """Links by exact Jaccard similarity of all pairs, in blocks of a matrix of shingles."""
    sets = [slow_sets(t) for t in texts]
    number = {}
    for s in sets:
        for x in s:
            number.setdefault(x, len(number))
    table = np.zeros((len(sets), len(number)), np.float32)
    for k, s in enumerate(sets):
        table[k, [number[x] for x in s]] = 1
    sizes = table.sum(axis=1)
    both = table @ table.T
    near = both >= 0.8 * (sizes[:, None] + sizes[None, :] - both) - 1e-6
    return [(i, j) for i, j in zip(*np.nonzero(near)) if i < j]


def groups_of(n, links):
    root = list(range(n))

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for i, j in links:
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    return [find(k) for k in range(n)]


def run_components(spark, texts, pairs):
    """Component of each text by the library, and how many pairs it verified."""
    near = nearcopies._near
    nearcopies._near = lambda t, p, least: pairs.append(p.count()) or near(t, p, least)
    try:
        frame = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
        found = {r["node"]: r["component"] for r in nearcopies.components(frame).collect()}
    finally:
        nearcopies._near = near
    return [found.get(k, k) for k in range(len(texts))]


@pytest.mark.parametrize("similarity", [0.5, 0.69, 0.85])
def test_pairs_do_not_grow_with_the_square(spark, similarity):
    """However large a group whose members stay apart, a member is compared with a bounded number of others."""
    per_member, found, all_links = [], 0, 0
    for members in (100, 700):
        rng, pairs = random.Random(members), []
        texts = star(rng, members, similarity, 120)
        links = incidence_links(texts)
        got = run_components(spark, texts, pairs)
        found += sum(got[i] == got[j] for i, j in links)
        all_links += len(links)
        want = groups_of(members, links)
        assert all(want[i] == want[j] for i in range(members) for j in [got[i]])  # nothing is joined wrongly
        per_member.append(sum(pairs) / members)
    assert found >= 0.9 * all_links
    # a pivot and few neighbours a band, some more in buckets of differences; all pairs would be 350 a member
    assert per_member[1] <= 2 * nearcopies.BANDS, per_member


def test_links_among_members_that_stay_apart(spark):
    """In a group of variants at 0.69, some have near copies of their own: those are found."""
    rng, pairs = random.Random(8), []
    texts = star(rng, 250, 0.69)
    texts += [mutated(rng, t.split(), 2) for t in texts[:120]]
    texts += [mutated(rng, t.split(), 1) for t in star(rng, 40, 0.6, name="o") for _ in range(3)]
    links = incidence_links(texts)
    got = run_components(spark, texts, pairs)
    assert len(links) > 150 and sum(got[i] == got[j] for i, j in links) >= 0.98 * len(links)
    assert sum(pairs) < 60 * len(texts)
