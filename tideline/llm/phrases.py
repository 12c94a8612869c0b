"""Phrase collocations: frequent phrases by the partition scheme (SON), scored by their weakest cut.

The documents are dealt into few shards. A phrase that occurs ``support`` times in all must reach, in some shard, at
least the shard's share of that support. So each shard is mined completely, level by level, at its own lowered
support, and the union of what the shards found holds every frequent phrase. One more pass counts that union exactly.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import join_hot, modest, slices
from tideline.session import stage

SUPPORT = 10
SHARDS = 4
LONGEST = 3
TOP = 2_000
NO_LANG = "und"
#: Bits of the fixed-size filter that tells which phrases are worth counting; what it lets through wrongly is counted in vain.
FILTER_BITS = 26
CELLS_AT_ONCE = 1 << 19
#: Counts are summed in so many groups of hashes, so a group holds about so small a part of all distinct phrases.
BUCKET_BITS = 11
SALTS = 64

# Characters that end a piece.
BREAKS = b".,;:!?\n\x0b\x0c\r"
BLANK, BREAK = 32, 46
_PLAIN = bytes.maketrans(bytes(range(65, 91)) + b"\t" + BREAKS, bytes(range(97, 123)) + b" " + b"." * len(BREAKS))
_TURNS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
_BYTES = np.random.default_rng(12).integers(0, 1 << 64, (2, 256), np.uint64)
_BASES = (0x2545F4914F6CDD1D, 0x369DEA0F31A53F85)
CHARS_AT_ONCE = 1 << 18
#: Names of the columns that counts travel in, after the hash.
PACKED = ("n", "other", "text")
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """``base ** k`` for k up to ``n`` at least, in 64 bits."""
    held = _powers.get(base)
    if held is None or len(held) <= n:
        factors = np.full(max(n + 1, CHARS_AT_ONCE), base, np.uint64)
        factors[0] = 1
        held = _powers[base] = np.multiply.accumulate(factors)
    return held


class Words:
    """The words of some texts: their bytes, lower-cased, where each begins and ends, and the piece it lies in."""

    def __init__(self, texts: Iterable[str | None]):
        raw = [t.encode() for t in texts if t]
        self.data = b"\n".join(raw).translate(_PLAIN)
        self.texts = np.fromiter(map(xxhash.xxh32_intdigest, raw), np.uint32, len(raw))
        self.text_ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1)
        self.bytes = np.frombuffer(self.data, np.uint8)
        inside = np.concatenate([[False], (self.bytes != BLANK) & (self.bytes != BREAK), [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = edges[::2], edges[1::2]
        self.piece = np.cumsum(self.bytes == BREAK)[self.starts] if len(self.starts) else self.starts

        self._marks: dict[int, np.ndarray] = {}
        self._text_of: np.ndarray | None = None

    def marks(self, which: int = 0) -> np.ndarray:
        """A 64-bit hash of every word: a polynomial of its bytes, by differences of sums over all bytes."""
        if which in self._marks:
            return self._marks[which]
        base, n = _BASES[which], len(self.bytes)
        upto = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTES[which][self.bytes] * _power(base, n)[:n], out=upto[1:])
        back = _power(pow(base, -1, 1 << 64), n)
        self._marks[which] = _mixed((upto[self.ends] - upto[self.starts]) * back[self.starts])
        return self._marks[which]

    def text_of(self, places: np.ndarray) -> np.ndarray:
        """A 32-bit hash of the text that each of these words lies in."""
        if self._text_of is None:
            self._text_of = self.texts[np.searchsorted(self.text_ends, self.starts, "right")]
        return self._text_of[places]

    def phrase(self, first: int, size: int) -> bytes:
        """The words from number ``first`` on, joined by single blanks."""
        return b" ".join(self.data[a:b] for a, b in zip(self.starts[first : first + size], self.ends[first : first + size]))


def _mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(32))) * _TURNS[1]
    return value ^ (value >> np.uint64(29))


def phrase_places(words: Words, size: int) -> np.ndarray:
    """Numbers of the words at which a phrase of ``size`` words begins, all in one piece."""
    n = max(len(words.starts) - size + 1, 0)
    return np.flatnonzero(words.piece[:n] == words.piece[size - 1 : size - 1 + n])


def phrase_marks(marks: np.ndarray, places: np.ndarray, size: int, salt: int) -> np.ndarray:
    """A 64-bit hash of the phrases of ``size`` words at these places, from the hashes of all words."""
    value = np.full(len(places), (salt + size) & 0xFFFFFFFFFFFFFFFF, np.uint64)
    for k in range(size):
        value = _mixed(value * _TURNS[0] + marks[places + k])
    return value


def _salt(name: str) -> int:
    """Sets the phrases of one language, or those of one shard, apart."""
    return xxhash.xxh64_intdigest(name)


class Filter:
    """A set of 64-bit hashes in ``1 << bits`` bits: says yes to all members and, rarely, to others."""

    def __init__(self, bits: int, cells: np.ndarray):
        self.bits, self.cells = bits, cells

    def has(self, marks: np.ndarray) -> np.ndarray:
        at = marks >> np.uint64(64 - self.bits)
        return (self.cells[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def filter_of(marks: DataFrame, mark: Column, bits: int) -> Filter:
    """The filter of a column of hashes (as signed 64-bit integers); at most ``1 << (bits - 6)`` rows come to the driver."""
    place = F.shiftrightunsigned(mark, 64 - bits)
    bit = F.expr("shiftleft(1L, cast(place & 63 as int))").alias("bit")
    words = marks.select(place.alias("place")).select(F.shiftrightunsigned("place", 6).alias("word"), bit)
    rows = words.groupBy("word").agg(F.bit_or("bit").alias("set")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[rows.column("word").to_numpy()] = rows.column("set").to_numpy()
    return Filter(bits, out.view(np.uint8))


def _sources(docs: DataFrame, shards: int, text_col: str, lang_col: str) -> DataFrame:
    """``(text, lang, shard)``; rows are dealt by a hash of all their plain columns, so copies are dealt as well."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(NO_LANG))
    keys = [F.xxhash64(F.col(f"`{c}`").cast("string")) for c, kind in docs.dtypes if kind in ("bigint", "int", "string")]
    return modest(docs).select(text.alias("text"), lang.alias("lang"), F.pmod(F.xxhash64(F.lit(0), *keys), F.lit(shards)).cast("int").alias("shard"))


def _groups(batch: pa.RecordBatch, by_shard: bool) -> Iterator[tuple[str, int | None, Words]]:
    """Words of a batch by language, and by shard if asked for, in stretches of whole texts of bounded size."""
    out: dict = {}
    shards = batch.column(2).to_pylist() if by_shard else [None] * batch.num_rows
    for text, lang, shard in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), shards):
        texts, size = out.get((lang, shard), ([], 0))
        texts.append(text)
        out[lang, shard] = texts, size + len(text)
        if size + len(text) >= CHARS_AT_ONCE:
            yield lang, shard, Words(texts)
            del out[lang, shard]
    for (lang, shard), (texts, _) in out.items():
        yield lang, shard, Words(texts)


def _packed(cell: int, marks: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    """One row for each bucket of ``marks``, which are sorted: the bucket, the cell, and each column's part as bytes."""
    bucket = (marks >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    ends = np.append(first, len(marks)).astype(np.int32)
    parts = []
    for c in (marks, *columns):
        offsets = pa.py_buffer((ends * np.int32(c.itemsize)).tobytes())
        parts.append(pa.Array.from_buffers(pa.binary(), len(first), [None, offsets, pa.py_buffer(c.tobytes())]))
    cells = pa.array(np.full(len(first), cell, np.int32))
    return pa.RecordBatch.from_arrays([pa.array(bucket[first]), cells, *parts], names=["bucket", "cell", "mark", *PACKED[: len(columns)]])


def _unpacked(group: pa.Table) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The rows of one bucket: the columns of each cell."""
    of = group.column("cell").to_numpy()
    kinds = {"mark": np.uint64, "n": np.uint32, "other": np.uint64, "text": np.uint32}
    for cell in np.unique(of).tolist():
        rows = group.filter(pa.array(of == cell))
        yield cell, [np.frombuffer(b"".join(rows.column(c).to_pylist()), kinds[c]) for c in rows.column_names[2:]]


def _starts(*sorted_by: np.ndarray) -> np.ndarray:
    """Where a new value begins in sorted columns."""
    new = np.zeros(len(sorted_by[0]), bool)
    new[:1] = True
    for c in sorted_by:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _summed(marks: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in their order, and the sums of ``n``."""
    order = np.argsort(marks)
    marks = marks[order]
    first = _starts(marks)
    return marks[first], np.add.reduceat(n[order], first, dtype=np.int64) if len(first) else n


def _shard_salts(shards: int) -> list[int]:
    return [_salt(f"shard {k}") for k in range(shards)]


def mined(sources: DataFrame, sizes: tuple[int, ...], least: dict[int, int], shorter: Filter | None, salts: list[int]) -> DataFrame:
    """``(words, mark, shard)`` of every phrase of such ``sizes`` that is frequent within a shard, by its support ``least``.

    ``shorter`` holds the phrases of one word less that are frequent in their shard: a phrase whose first or last
    words are not among them cannot be frequent there. Tasks count what they hold before anything is shuffled, and
    the counts of a bucket of hashes travel together.
    """
    shared = sources.sparkSession.sparkContext.broadcast(shorter)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n_held = shared.value, 0
        cells: dict[int, list[np.ndarray]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for cell, parts in cells.items():
                marks, n = np.unique(np.concatenate(parts), return_counts=True)
                if len(marks):
                    yield _packed(cell, marks, n.astype(np.uint32))
            cells.clear()

        for batch in slices(batches):
            for lang, shard, words in _groups(batch, True):
                marks, salt = words.marks(), _salt(lang)
                for size in sizes:
                    places = phrase_places(words, size)
                    if known is not None:
                        starts = phrase_places(words, size - 1)
                        good = np.zeros(len(marks) + 1, bool)
                        good[starts] = known.has(phrase_marks(marks, starts, size - 1, salt) ^ np.uint64(salts[shard]))
                        places = places[good[places] & good[places + 1]]
                    value = phrase_marks(marks, places, size, salt)
                    cells.setdefault(size * len(salts) + shard, []).append(value)
                    n_held += len(value)
            if n_held >= CELLS_AT_ONCE:
                yield from flush()
                n_held = 0
        yield from flush()

    def merge(group: pa.Table) -> pa.Table:
        out = [(np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int32))]
        for cell, (marks, n) in _unpacked(group):
            size, shard = divmod(cell, len(salts))
            marks, n = _summed(marks, n)
            marks = marks[n >= least.get(shard, 1)].view(np.int64)
            out.append((np.full(len(marks), size, np.int32), marks, np.full(len(marks), shard, np.int32)))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*out)], names=["words", "mark", "shard"])

    counts = sources.mapInArrow(run, "bucket int, cell int, mark binary, n binary")
    return counts.groupBy("bucket").applyInArrow(merge, "words int, mark long, shard int")


def _sized(sources: DataFrame) -> DataFrame:
    """``(lang, shard, n)``: numbers of words."""
    words = F.regexp_count("text", F.lit(r"[^ \t.,;:!?\x0A-\x0D]+")).cast("long")
    return sources.groupBy("lang", "shard").agg(F.sum(words).alias("n"))


def local_supports(words: dict[int, int], support: int) -> dict[int, int]:
    """Support of each shard in proportion to its words, rounded up: below all of them a phrase is below ``support``."""
    total = sum(words.values())
    return {shard: max(1, -(-support * n // total)) if total else 1 for shard, n in words.items()}


def _kept(words: Words, size: int, salt: int, known: Filter) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, first and second hashes of the phrases of ``size`` words that the filter may hold."""
    places = phrase_places(words, size)
    value = phrase_marks(words.marks(), places, size, salt)
    keep = known.has(value)
    return places[keep], value[keep], phrase_marks(words.marks(1), places[keep], size, salt ^ 1)


def counted(sources: DataFrame, candidates: list[Filter], support: int) -> DataFrame:
    """``(mark, other, place, n)``: exact counts of all phrases the filters may hold; those of ``support``.

    A phrase of a language is known by two hashes of 64 bits that have nothing in common, so two phrases are never
    taken for one. ``place`` is its hash mixed with that of one of the texts that have it.
    """
    shared = sources.sparkSession.sparkContext.broadcast(candidates)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        n_held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for size, parts in held.items():
                value, second, text = (np.concatenate(p) for p in zip(*parts))
                if len(value):
                    marks, n, *rest = _distinct(value, np.ones(len(value), np.uint32), second, text)
                    yield _packed(size, marks, n.astype(np.uint32), *rest)
            held.clear()

        for batch in slices(batches):
            for lang, _, words in _groups(batch, False):
                for size, known in enumerate(shared.value, 1):
                    places, value, second = _kept(words, size, _salt(lang), known)
                    held.setdefault(size, []).append((value, second, words.text_of(places)))
                    n_held += len(value)
            if n_held >= CELLS_AT_ONCE:
                yield from flush()
                n_held = 0
        yield from flush()

    def merge(group: pa.Table) -> pa.Table:
        out = [tuple(np.zeros(0, np.int64) for _ in range(4))]
        for _, columns in _unpacked(group):
            marks, n, other, text = _distinct(*columns)
            enough = n >= support
            marks, other = marks[enough], other[enough]
            out.append((marks.view(np.int64), other.view(np.int64), _placed(marks, text[enough]).view(np.int64), n[enough]))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*out)], names=["mark", "other", "place", "n"])

    rows = sources.mapInArrow(run, "bucket int, cell int, mark binary, n binary, other binary, text binary")
    return rows.groupBy("bucket").applyInArrow(merge, "mark long, other long, place long, n long")


def _distinct(marks: np.ndarray, n: np.ndarray, other: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, ...]:
    """One row for each pair of hashes: the sum of ``n`` and the text of one row. Sorted by ``marks``."""
    order = np.argsort(marks)
    sorted_marks, second = marks[order], other[order]
    first = _starts(sorted_marks)
    if len(_starts(sorted_marks, second)) != len(first):  # other phrases of one first hash
        order = np.lexsort((other, marks))
        sorted_marks, second = marks[order], other[order]
        first = _starts(sorted_marks, second)
    sums = np.add.reduceat(n[order], first, dtype=np.int64) if len(first) else n
    return sorted_marks[first], sums, second[first], text[order][first]


def _placed(marks: np.ndarray, texts: np.ndarray) -> np.ndarray:
    return _mixed(marks * _TURNS[0] + texts)


def named(sources: DataFrame, found: DataFrame, longest: int, bits: int) -> DataFrame:
    """``(lang, phrase, words, n)`` of counted phrases: their words, from the texts that they were seen in."""
    known = filter_of(found, F.col("place"), bits)
    shared = sources.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for lang, _, words in _groups(batch, False):
                for size in range(1, longest + 1):
                    salt, places = _salt(lang), phrase_places(words, size)
                    value = phrase_marks(words.marks(), places, size, salt)
                    keep = shared.value.has(_placed(value, words.text_of(places)))
                    places, value = places[keep], value[keep]
                    second = phrase_marks(words.marks(1), places, size, salt ^ 1)
                    _, first = np.unique(value ^ second, return_index=True)
                    phrases = [words.phrase(k, size) for k in places[first].tolist()]
                    columns = [value[first].view(np.int64), second[first].view(np.int64), np.full(len(first), size, np.int32)]
                    text = [pa.array([lang] * len(first), pa.string()), pa.array(phrases, pa.binary()).cast(pa.string())]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, columns), *text], names=["mark", "other", "words", "lang", "phrase"])

    seen = sources.mapInArrow(run, "mark long, other long, words int, lang string, phrase string")
    names = seen.dropDuplicates(["mark", "other"])
    return found.join(names, ["mark", "other"]).select("lang", "phrase", "words", "n")


def frequent(sources: DataFrame, by_shard: dict[int, int], longest: int, support: int, bits: int) -> DataFrame:
    """``(lang, phrase, words, n)`` of every phrase of up to ``longest`` words with at least ``support`` occurrences.

    ``by_shard`` has the number of words of each shard.
    """
    least, salts = local_supports(by_shard, support), _shard_salts(max(by_shard, default=0) + 1)
    own = F.lit(0).cast("long")
    for shard, salt in enumerate(salts):
        own = F.when(F.col("shard") == shard, F.lit(int(np.uint64(salt).astype(np.int64)))).otherwise(own)
    local, union = None, []
    for sizes in [(1, 2), *((n,) for n in range(3, longest + 1))]:
        found = stage(mined(sources, sizes, least, local, salts), "mined")
        union += [filter_of(found.where(F.col("words") == n), F.col("mark"), bits) for n in sizes]
        if sizes[-1] < longest:
            local = filter_of(found.where(F.col("words") == sizes[-1]), F.col("mark").bitwiseXOR(own), bits)
    return named(sources, stage(counted(sources, union, support), "counted"), longest, bits)


def _by_cut(found: DataFrame, longest: int) -> DataFrame:
    """Candidates with the counts of their parts and their score at the weakest cut."""
    phrase = F.struct("lang", "phrase").alias("key")
    words = F.split("phrase", " ")
    joined = lambda a, n: F.array_join(F.slice(words, a, n), " ")
    candidates = found.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.select("*", joined(F.lit(1), F.col("k")).alias("head"), joined(F.col("k") + 1, F.col("words") - F.col("k")).alias("tail"))
    cuts = stage(cuts, "cuts")
    parts = found.where(F.col("words") < longest).select(phrase, F.col("n").alias("part_n"))
    for side, name in (("head", "l"), ("tail", "r")):
        key = F.struct("lang", F.col(side).alias("phrase"))
        uses = cuts.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("uses"))
        small = stage(uses.join(parts, "key").select("key", F.col("part_n").alias(name), "uses"), "parts")
        cuts = join_hot(cuts.withColumn("key", key), small, "key", "uses").drop("key")
    big = lambda c: F.col(c).cast("decimal(19,0)")
    cuts = cuts.withColumn("over", (big("a") * big("a")).cast("decimal(31,0)") * F.lit(1_000_000).cast("decimal(7,0)"))
    cuts = cuts.withColumn("under", (big("l") * big("r")).cast("decimal(38,0)"))
    cuts = cuts.withColumn("score", F.expr("over div under"))
    weakest = F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("cut")
    return cuts.groupBy("lang", "phrase", "words", "a").agg(weakest).select("lang", "phrase", "words", "a", "cut.*")


def _without_covered(scored: DataFrame, found: DataFrame, longest: int) -> DataFrame:
    """Candidates whose words do not lie in a longer candidate that has at least half as many occurrences."""
    words = F.split("phrase", " ")
    inner = F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("words") - 1),
        lambda n: F.transform(F.sequence(F.lit(1), F.col("words") - n + 1), lambda a: F.array_join(F.slice(words, a, n), " ")),
    ))
    longer = found.where("words > 2").select("lang", F.col("n").alias("around"), F.explode(inner).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    kept = scored.join(longer, ["lang", "phrase"], "left")
    return kept.where(F.coalesce(100 * F.col("around") < 50 * F.col("a"), F.lit(True))).drop("around")


def collocations(
    docs: DataFrame,
    support: int = SUPPORT,
    longest: int = LONGEST,
    top: int = TOP,
    shards: int = SHARDS,
    bits: int = FILTER_BITS,
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` phrases of each language by score.

    Texts are lower-cased in ASCII, split into pieces at ``BREAKS`` and into words at blanks. ``a`` counts a phrase of 2
    to ``longest`` words, ``l`` and ``r`` the two parts of its weakest cut, ``n`` the words of its language; a null
    language is ``und``, a null text empty. The score is ``floor(10**6 * a * a / (l * r))``, exact beyond 64 bits. Phrases
    that lie in a longer candidate of at least half their count are dropped. Equal scores go by ``a``, then by the
    phrase's bytes. Repeated rows count each; other columns are ignored. No words give no rows.
    """
    sources = _sources(docs, shards, text_col, lang_col)
    sizes = stage(_sized(sources), "sizes")
    by_shard = {r["shard"]: r["n"] for r in sizes.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    found = stage(frequent(sources, by_shard, longest, support, bits), "frequent")
    scored = _without_covered(stage(_by_cut(found, longest), "scored"), found, longest)
    order: list[Column] = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # Ranked within salts first, so that no task sorts all phrases of a language.
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    words = sizes.groupBy("lang").agg(F.sum("n").alias("n"))
    out = ranked.join(words, "lang")
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
