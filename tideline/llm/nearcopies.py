"""Near copies by exact Jaccard similarity of word shingles.

Candidates come from SimHash fingerprints in the index of deletion variants and from bands of MinHash values; every
candidate is verified. A bucket of a band never makes all its pairs: its members are compared with one of them, the
pivot, and where they stay apart, with a centre, the shingles most of them have. What tells two variants of one
original apart is their difference to the centre, so they meet again only where these differences have a MinHash
value in common: variants that have nothing in common but the original never meet.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import BROADCAST_ROWS, Memory, held, join_hot, modest, one_of_each, slices, text_class
from tideline.llm.components import connected_components
from tideline.llm.simhash import TO_LOWER, fingerprint_links
from tideline.session import drop_staged, settled, short_shuffles, stage

SIZE = 5
LEAST = 0.8
#: A pair of similarity 0.8 meets in none of the bands with probability (1 - 0.8 ** 5) ** 30 = 0.000007.
BANDS = 30
ROWS = 5
#: Members of a bucket up to which all its pairs are compared.
SMALL = 4
#: About so many members of a larger bucket, chosen by hash, vote on its centre; any centre finds the same or more pairs.
VOTERS = 24
#: MinHash values of a difference; two members of a bucket meet if they share one.
TURNS = 6
#: Texts of a similarity of 0.8 differ in more than so many of 64 SimHash bits with a probability of 0.0003.
MOST_BITS = 20
#: Sets up to so many bytes are broadcast where much of a table is compared with one of them.
BROADCAST_SET = 1 << 20
ODD = np.uint64(0x9E3779B97F4A7C15)
_seeds = np.random.default_rng(7).integers(0, 1 << 64, (2, BANDS * ROWS), np.uint64)
TIMES, PLUS = _seeds[0] | np.uint64(1), _seeds[1]


def _words() -> Memory:
    return held("shingles", lambda: Memory(xxhash.xxh64_intdigest, 200_000, 64))


def shingles(text: str | None, size: int = SIZE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``size``-word shingles, lower-cased in ASCII; a shorter text is one shingle."""
    words = (text or "").encode().translate(TO_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    marks = np.fromiter(map(_words().__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    n = len(words) - size + 1
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = out * ODD + marks[k : k + n]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(32)
    return np.unique(out)


def band_keys(marks: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of ``ROWS`` MinHash values; texts without a word share theirs."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(marks), 256):
        values = TIMES[:, None] * marks[at : at + 256]
        values += PLUS[:, None]
        np.minimum(least, values.min(axis=1), out=least)
    raw = least.reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(row.tobytes(), k) for k, row in enumerate(raw)], np.uint64)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted sets; 1 for two empty ones."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 1.0


def simhash_of(marks: np.ndarray) -> int:
    """64-bit SimHash of a set of hashes, as a signed integer; 0 for an empty set."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(marks), 4_096):
        part = marks[at : at + 4_096].astype("<u8").view(np.uint8)
        ones += np.unpackbits(part.reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(marks), bitorder="little").view("<i8")[0])


def _sketches(texts: DataFrame) -> DataFrame:
    """``(node, n, fp, keys)`` of every class: number of shingles, their SimHash, one key a band."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingles(t) for t in batch.column(1).to_pylist()]
            keys = pa.array([band_keys(s).view(np.int64) for s in sets], pa.list_(pa.int64()))
            sizes, fps = pa.array([len(s) for s in sets], pa.int64()), pa.array([simhash_of(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, fps, keys], names=["node", "n", "fp", "keys"])

    made = texts.mapInArrow(run, "node long, n long, fp long, keys array<long>")
    return made.groupBy("node").agg(F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("keys").alias("keys"))


def _sets(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(node, marks)``: the shingles of the classes in ``nodes``, as bytes; each class once."""
    wanted = stage(nodes.select("node").distinct(), "wanted")
    side = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches):
            nodes, sets = [], []
            for node, text in zip(*(c.to_pylist() for c in batch.columns)):
                if node not in seen:
                    seen.add(node)
                    nodes.append(node)
                    sets.append(shingles(text).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], names=["node", "marks"])

    sets = texts.join(side, "node", "left_semi").mapInArrow(run, "node long, marks binary")
    return stage(sets.groupBy("node").agg(F.first("marks").alias("marks")), "sets")


def _near(texts: DataFrame, pairs: DataFrame, least: float) -> DataFrame:
    """Those of ``pairs`` (a, b) whose shingles have a Jaccard similarity of at least ``least``.

    Each end that is in very many pairs is marked first, while a pair is two numbers: its set is broadcast if it is
    not long. So every pair meets each of its sets once.
    """
    sets = _sets(texts, pairs.select(F.explode(F.array("a", "b")).alias("node")))
    least_uses = pairs.count() // 200
    marked, hot = pairs.select("a", "b"), {}
    for end in ("a", "b"):
        often = pairs.groupBy(end).agg(F.count(F.lit(1)).alias("uses")).where(F.col("uses") > least_uses)
        short = sets.where(F.octet_length("marks") <= BROADCAST_SET).withColumnRenamed("node", end)
        hot[end] = stage(short.join(F.broadcast(often.select(end)), end), "hot")
        mark = F.broadcast(hot[end].select(end, F.lit(True).alias(f"hot_{end}")))
        marked = marked.join(mark, end, "left").withColumn(f"hot_{end}", F.coalesce(f"hot_{end}", F.lit(False)))
    met = stage(marked, "marked")
    for end, name in (("a", "x"), ("b", "y")):
        often, seldom = (met.where(F.col(f"hot_{end}") == F.lit(is_hot)) for is_hot in (True, False))
        often = often.join(F.broadcast(hot[end].withColumnRenamed("marks", name)), end)
        met = often.unionByName(seldom.join(sets.select(F.col("node").alias(end), F.col("marks").alias(name)), end))

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            x, y = ([np.frombuffer(v.as_buffer(), np.uint64) for v in batch.column(k)] for k in (2, 3))
            near = pa.array([jaccard(p, q) >= least for p, q in zip(x, y)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(near)

    return met.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long")


def _fits(left: str, right: str, least: float) -> Column:
    """Whether numbers of shingles and fingerprints leave two classes a chance to be near."""
    x, y = F.col(f"{left}n"), F.col(f"{right}n")
    few = F.bit_count(F.col(f"{left}fp").bitwiseXOR(F.col(f"{right}fp"))) <= MOST_BITS
    return (F.least(x, y) >= least * F.greatest(x, y)) & few


def _ordered(one: str, other: str) -> list[Column]:
    return [F.least(one, other).alias("a"), F.greatest(one, other).alias("b")]


def _fingerprints(sketches: DataFrame) -> DataFrame:
    """``(fp, rep, of)``: the first class of each fingerprint and their number."""
    return sketches.groupBy("fp").agg(F.min("node").alias("rep"), F.count(F.lit(1)).alias("of"))


def _of_one_fingerprint(sketches: DataFrame, fps: DataFrame) -> DataFrame:
    """Pairs of each class with the first of its fingerprint."""
    same = join_hot(sketches.select("fp", "node"), fps.where("of > 1"), "fp", "of").where("node != rep")
    return same.select(*_ordered("node", "rep"))


def _by_fingerprint(fps: DataFrame, groups: DataFrame) -> DataFrame:
    """Pairs of the firsts of near fingerprints that ``groups`` does not connect yet.

    Near copies have near fingerprints, so all links of a group would grow with its square.
    """
    named = fps.join(groups.withColumnRenamed("node", "rep"), "rep", "left")
    named = stage(named.select("fp", "rep", F.coalesce("component", "rep").alias("component")), "named")
    rep = named.select("fp", "rep")
    linked = fingerprint_links(named.select("fp", "component"), group_col="component")
    linked = linked.join(rep.select(F.col("fp").alias("a"), F.col("rep").alias("u")), "a")
    linked = linked.join(rep.select(F.col("fp").alias("b"), F.col("rep").alias("v")), "b")
    return linked.select(*_ordered("u", "v"))


def _centres(rows: DataFrame) -> DataFrame:
    """``(key, centre)``: the shingles that more than half of a bucket's voters have; ``rows`` are these with their sets."""
    voters = rows.groupBy("key").agg(F.collect_list("marks").alias("sets"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 200):
            centres = []
            for sets in batch.column(1).to_pylist():
                marks, votes = np.unique(np.frombuffer(b"".join(sets), np.uint64), return_counts=True)
                centres.append(marks[votes * 2 > len(sets)].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(centres, pa.binary())], names=["key", "centre"])

    return voters.mapInArrow(run, "key long, centre binary")


def difference_keys(key: int, marks: np.ndarray, centre: np.ndarray) -> tuple[int, list[int]]:
    """Size of the difference of a set to a centre, and one key per MinHash value of the difference."""
    apart = np.setxor1d(marks, centre, assume_unique=True)
    least = np.full(TURNS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(apart), 4_096):
        values = TIMES[:TURNS, None] * apart[at : at + 4_096] + PLUS[:TURNS, None]
        np.minimum(least, values.min(axis=1), out=least)
    seed = key & 0xFFFFFFFFFFFFFFFF
    return len(apart), [xxhash.xxh64_intdigest(bytes([k]) + v.tobytes(), seed) for k, v in enumerate(least)]


def _apart(texts: DataFrame, large: DataFrame) -> DataFrame:
    """Members of large buckets in the buckets of their differences to the centres.

    ``rank`` is the size of the difference. Each bucket also stays as it is, marked ``last``: there its members
    meet the one nearest to the centre, and no more.
    """
    sets = _sets(texts, large)
    share = F.pmod(F.xxhash64("node", "key"), F.lit(1 << 20)) * F.col("members")
    voters = large.where(share < VOTERS << 20).select("key", "node").join(sets, "node")
    sizes = large.groupBy("key").agg(F.count(F.lit(1)).alias("n_rows"))
    centres = sizes.join(_centres(voters), "key", "left").withColumn("centre", F.coalesce("centre", F.lit(b"")))
    joined = join_hot(large, stage(centres, "centres"), "key", "n_rows", share=200).join(sets, "node")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rank, keys = [], []
            for key, marks, centre in zip(*(c.to_pylist() for c in batch.columns[3:])):
                size, own = difference_keys(key, np.frombuffer(marks, np.uint64), np.frombuffer(centre, np.uint64))
                own.append(xxhash.xxh64_intdigest(b"last", key & 0xFFFFFFFFFFFFFFFF))
                rank.append(size)
                keys.append(np.array(own, np.uint64).view(np.int64))
            made = [*batch.columns[:3], pa.array(rank, pa.int64()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(made, names=["node", "n", "fp", "rank", "keys"])

    out = joined.select("node", "n", "fp", "key", "marks", "centre").mapInArrow(run, "node long, n long, fp long, rank long, keys array<long>")
    return out.select("node", "n", "fp", "rank", F.posexplode("keys").alias("turn", "key")).select(
        "key", "node", "n", "fp", "rank", (F.col("turn") == TURNS).alias("last")
    )


def _meeting(rows: DataFrame, groups: DataFrame | None) -> DataFrame:
    """Rows of buckets whose members lie in several components, with the bucket's size and pivot (the row of least rank)."""
    if groups is None:
        rows = rows.withColumn("component", F.col("node"))
    else:
        rows = rows.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    rows = stage(rows, "rows")
    pivot = F.min(F.struct("rank", "node", "n", "fp", "component")).alias("p")
    found = rows.groupBy("key").agg(F.count(F.lit(1)).alias("met"), F.min("component").alias("lo"), F.max("component").alias("hi"), pivot)
    found = found.where("lo < hi").select(
        "key", "met", F.col("met").alias("members"), F.col("p.node").alias("p_node"), F.col("p.n").alias("p_n"),
        F.col("p.fp").alias("p_fp"), F.col("p.component").alias("p_component"),
    )
    return join_hot(rows, stage(found, "buckets"), "key", "met")


def components(texts: DataFrame, least: float = LEAST) -> DataFrame:
    """``(node, component)`` of every class of ``texts`` (node, text) that is linked to another.

    Classes are linked if their similarity is at least ``least``, transitively. Each turn compares the members of all
    buckets with their pivots; where a bucket still holds several components, all its pairs are compared if they
    are few, or its members go on to the buckets of their differences to its centre. Those share the part of the
    difference they were dealt by, which the next centre takes in, so the turns end.
    """
    spark = texts.sparkSession
    with short_shuffles(spark):
        return settled(spark, "components", lambda: _turns(modest(texts), least))


def _turns(texts: DataFrame, least: float) -> DataFrame:
    """``components``; of what a turn writes, the next finds only its buckets, pairs, links and groups."""
    spark = texts.sparkSession
    sketches = stage(_sketches(texts), "sketches")
    fps = stage(_fingerprints(sketches), "fps")
    rows = sketches.select(F.explode("keys").alias("key"), "node", "n", "fp", F.xxhash64("node").alias("rank"), F.lit(False).alias("last"))
    met = settled(spark, "meeting", lambda: _meeting(rows, None))
    wanted = _of_one_fingerprint(sketches, fps)
    links: list[DataFrame] = []
    first = True
    while True:
        star = met.where((F.col("component") != F.col("p_component")) & _fits("", "p_", least)).select(*_ordered("node", "p_node"))
        pairs = stage(wanted.unionByName(star).distinct(), "pairs")
        links.append(settled(spark, "near", lambda: _near(texts, pairs, least)))
        groups = settled(spark, "groups", lambda: connected_components(reduce(DataFrame.unionByName, links), "a", "b"))
        again = met.where("not last").select("key", "node", "n", "fp", "rank", "last")
        left = settled(spark, "meeting", lambda: _meeting(again, groups))
        few = left.where(F.col("members") <= SMALL).select("key", "node", "n", "fp", "component")
        both = few.alias("l").join(
            few.alias("r").hint("merge"),
            (F.col("l.key") == F.col("r.key"))
            & (F.col("l.node") < F.col("r.node"))
            & (F.col("l.component") != F.col("r.component"))
            & _fits("l.", "r.", least),
        )
        both = both.select(F.col("l.node").alias("a"), F.col("r.node").alias("b"))
        wanted = settled(spark, "few", lambda: (both.unionByName(_by_fingerprint(fps, groups)) if first else both).distinct())
        first = False
        drop_staged(met)
        drop_staged(pairs)
        large = left.where(F.col("members") > SMALL).select("node", "n", "fp", "key", "members")
        if large.isEmpty():
            break
        met = settled(spark, "meeting", lambda: _meeting(_apart(texts, large), groups))
        drop_staged(left)
        drop_staged(groups)
    if not wanted.isEmpty():
        links.append(settled(spark, "near", lambda: _near(texts, wanted, least)))
        groups = connected_components(reduce(DataFrame.unionByName, links), "a", "b")
    return groups


def keep_one(docs: DataFrame, least: float = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group of near copies, that of the smallest id, with all columns of ``docs``.

    The row is chosen by its id and its text, so that two texts under one id do not stand for each other. Of
    rows of one id and one text the smallest (by its columns in order) stays. A row without an id stays.
    """
    node = text_class(text_col)
    named = components(docs.select(node.alias("node"), F.col(f"`{text_col}`").alias("text")), least)
    return one_of_each(docs, node, named, id_col)
