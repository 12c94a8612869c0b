"""Work and files of the near-copy stage in large groups of texts that are very much alike."""

import random
from pathlib import Path
from urllib.parse import urlparse

import pytest

from test_nearcopies import mutated, run_components, slow_sets
from tideline.llm import nearcopies
from tideline.llm.simhash import fingerprint_links
from tideline.session import _CLEANUP, shared_folder


def alike(members):
    """Variants of one original that differ in a word each: most have fingerprints of at most 4 differing bits."""
    rng = random.Random(members)
    base = [f"s{rng.randrange(10**6)}" for _ in range(400)]
    return [mutated(rng, base, 1) for _ in range(members)]


@pytest.mark.parametrize("members", [60, 500])
def test_near_fingerprints_do_not_grow_with_the_square(spark, members):
    pairs = []
    assert set(run_components(spark, alike(members), pairs)) == {0}
    assert sum(pairs) <= 10 * members, sum(pairs) / members


def test_links_between_groups_of_fingerprints(spark):
    rng = random.Random(4)
    base = [rng.randrange(1 << 64) for _ in range(6)]
    bits = {b ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(5))}) for b in base for _ in range(25)}
    rows = [(b - (1 << 64) if b >> 63 else b, rng.randrange(3)) for b in sorted(bits)]
    got = fingerprint_links(spark.createDataFrame(rows, "fp long, g long"), group_col="g").collect()
    want = {frozenset((a, b)) for a, g in rows for b, h in rows if g != h and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 4}
    assert {frozenset(r) for r in got} == want and len(got) == len(want) > 50


def test_ends_in_many_and_in_few_pairs(spark):
    rng = random.Random(9)
    texts = [t for k in range(150) for base in [[f"w{k}x{j}" for j in range(60)]] for t in (" ".join(base), *(mutated(rng, base, 1 + k % 3) for _ in range(2)))]
    pairs = {(3 * k + i, 3 * k + j) for k in range(150) for i in range(3) for j in range(i + 1, 3)}
    pairs |= {(0, k) for k in range(1, 300)} | {(k, 449) for k in range(100, 449)}
    sets = [slow_sets(t) for t in texts]
    want = {(a, b) for a, b in pairs if 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])}
    frame = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    got = nearcopies._near(frame, spark.createDataFrame(sorted(pairs), "a long, b long"), 0.8).collect()
    assert len(got) == len(want) > 100 and {tuple(r) for r in got} == want


def test_tables_on_the_way_are_removed(spark):
    before, folder = spark.conf.get(_CLEANUP), Path(urlparse(shared_folder(spark)).path)
    there = set(folder.iterdir())
    frame = spark.createDataFrame(list(enumerate(alike(60))), "node long, text string")
    found = nearcopies.components(frame)
    new = set(folder.iterdir()) - there
    assert len(new) == 1 and next(iter(new)).name.startswith("components-")
    assert found.count() == 60 and spark.conf.get(_CLEANUP) == before
