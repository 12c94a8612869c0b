"""Mixing sources to target weights by Poisson replication. DataFrame functions only."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rates beyond this are made of equal parts of at most so much, each with a number of its own.
MOST_RATE = 64.0
#: Copies of one part are numbered from a multiple of this; a part of ``MOST_RATE`` never has so many.
PART_COPIES = 512
PARTS_AT_ONCE = 4_096
REST = None  # the key, in weights and rates, of all sources without a weight of their own


def unit(key: Column, salt: str, seed: int, part: Column) -> Column:
    """A number in [0, 1) of 52 hashed bits of ``key`` and part (from 0); a null key counts as the word null."""
    text = F.concat_ws("|", F.lit(salt), F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit("null")))
    text = F.when(part == 0, text).otherwise(F.concat_ws("|", text, part.cast("string")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def steps(rate: float) -> list[float]:
    """P(count <= k) for k = 0, 1, ... of a Poisson count, until no 52-bit number lies above."""
    out, k, total = [], 0, 0.0
    while True:
        total += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1)) if rate > 0 else float(k == 0)
        out.append(min(total, 1.0))
        if k >= rate and 1.0 - total < 2.0**-52:
            return out
        k += 1
        if k > rate + 20 * math.sqrt(rate) + 60:
            return out


def parts_of(rate: float) -> int:
    """Equal parts of a rate that are at most ``MOST_RATE``: a Poisson count is the sum of the counts of its parts."""
    return max(1, math.ceil(rate / MOST_RATE))


def group_of(source: Column, weights: Mapping[str | None, float]) -> Column:
    """The source itself if it has a weight, else null, the rest."""
    named = [s for s in weights if s is not REST]
    return F.when(source.isin(*named), source) if named else F.lit(None).cast("string")


def rates(docs: DataFrame, weights: Mapping[str | None, float], epochs: float = 1.0, source_col: str = "source") -> dict[str | None, float]:
    """Mean repetitions per source that give its texts the wanted share of ``epochs`` times all characters.

    Sources without a weight share that under ``REST`` (none: they get 0). Weights of sources that have no
    characters are left out and the others scaled to one. The result is as long as ``weights``, whatever the data.
    """
    size = F.sum(F.coalesce(F.char_length("text"), F.lit(0)).cast("long"))
    sums = docs.groupBy(group_of(F.col(source_col), weights).alias("g")).agg(size.alias("n")).collect()
    sizes = {r["g"]: r["n"] for r in sums if r["n"]}
    wanted = {g: w for g, w in weights.items() if w > 0 and g in sizes}
    whole = sum(sizes.values()) * epochs
    total = sum(wanted.values())
    return {g: whole * w / total / sizes[g] for g, w in wanted.items()}


def mixed(
    docs: DataFrame,
    weights: Mapping[str | None, float],
    seed: int = 17,
    epochs: float = 1.0,
    id_col: str = "doc_id",
    source_col: str = "source",
) -> DataFrame:
    """Every row as often as its Poisson count says, with ``copy`` (from 0) and ``order_key``, shuffled globally.

    The count inverts the Poisson distribution of the source's rate at a number hashed from the id, so it is
    the same on every run; rows of one id share their count. A rate over ``MOST_RATE`` is cut into equal parts, whose
    counts, each inverted at a number of its own, add up; so neither the plan nor an array of a row grows with the
    rate. ``copy`` numbers the copies of part ``p`` from ``p * PART_COPIES``. A null or empty text is repeated like others
    of its source. The rows are dealt out by ``order_key``, a hash of id and copy, and sorted by it inside
    partitions: no source, id or group of copies can meet in one of them. No rows, or none with characters, give none.
    Columns of ``docs`` named ``copy`` or ``order_key`` are replaced.
    """
    found = rates(docs, weights, epochs, source_col)
    group = group_of(F.col(source_col), weights)
    kept = [c for c in docs.columns if c not in ("copy", "order_key")]
    names = [f"`{c}`" for c in kept]
    parts = F.lit(0).cast("long")
    for g, rate in found.items():
        own = group.isNull() if g is REST else group == g
        parts = F.when(own, F.lit(parts_of(rate)).cast("long")).otherwise(parts)
    rows = docs.select(*[docs[f"`{c}`"] for c in kept], group.alias("__group"), parts.alias("__parts")).where("__parts > 0")
    most = max((parts_of(rate) for rate in found.values()), default=1)
    part = F.lit(0).cast("long")
    if most > 1:
        # Two explodes in a row, so that the arrays of parts stay short.
        block = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(__parts - 1) div {PARTS_AT_ONCE}"))).alias("__block")
        rows = rows.select(*names, "__group", "__parts", block)
        last = F.least(F.lit(PARTS_AT_ONCE - 1), F.col("__parts") - 1 - F.col("__block") * PARTS_AT_ONCE)
        inner = F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("__inner")
        rows = rows.select(*names, "__group", "__block", inner)
        part = F.col("__block") * PARTS_AT_ONCE + F.col("__inner")
    rows = rows.withColumn("__part", part)
    u = unit(F.col(id_col), "count", seed, F.col("__part"))
    count = F.lit(0)
    for g, rate in found.items():
        own = F.col("__group").isNull() if g is REST else F.col("__group") == g
        table = F.array(*[F.lit(x) for x in steps(rate / parts_of(rate))])
        count = F.when(own, F.size(F.filter(table, lambda x: x <= u))).otherwise(count)
    counted = rows.select(*names, "__part", count.alias("__n")).where("__n > 0")
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1)).alias("__copy")
    copies = counted.select(*names, "__part", copy).select(*names, (F.col("__part") * PART_COPIES + F.col("__copy")).alias("copy"))
    place = F.concat_ws("|", F.lit("order"), F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("null")), "copy")
    keyed = copies.withColumn("order_key", F.xxhash64(place))
    return keyed.repartition("order_key").sortWithinPartitions("order_key")
