"""Near duplicates by HyperMinHash registers, verified on full shingle sets.

A document's set of word shingles is summarised in registers. The hashes of its shingles
are dealt to buckets, and each bucket keeps of its smallest hash only the number of leading
zeros and the bits that follow, in 16 bits. Bands of registers are join keys: documents
with an equal band are candidates. The share of equal registers, corrected for registers
that coincide by chance, estimates how alike two candidates are; only those that may reach
the threshold are compared on their full sets.

Sets smaller than the number of buckets would leave most buckets empty. Each shingle of a
small set therefore counts as several, at a level that depends on the size of the set; sets
near the bound of two levels are summarised at both, so any two alike sets share a level.

Documents with the same set are one document to all this. Within a group of candidates the
pairs are not listed: every document is first compared with the most central one of its
groups, the links found make components, and groups that lie within one component are done.
In the others, the largest component's most central document is the measure: two documents
can only be linked if what each has beyond and lacks of it has enough in common, so the
rarest part of that, the prefix, shares an element. Only such pairs are compared.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from rollbook.llm.tables import HOT_PARTS, HOT_SHARE, join_groups, stage, texts
from rollbook.llm.words import NOWHERE, parts, split_white
from rollbook.operators.pairs import join_pairs

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MANTISSA_BITS = 10
_BAND_BYTES = 8  # four registers of 16 bits


@dataclass(frozen=True)
class Likeness:
    """Documents are linked from ``percent`` of common shingles among all theirs on.

    With 32 bands of four registers a pair just at 85 percent is missed with a probability
    of (1 - 0.85^4)^32, below 10^-10. Estimates count as possible down to ``deviations``
    standard deviations below the threshold.
    """

    percent: int = 85
    shingle_words: int = 5
    bands: int = 32
    deviations: float = 6.0

    @property
    def registers(self) -> int:
        return self.bands * 4

    @property
    def least_estimate(self) -> float:
        share = self.percent / 100
        return share - self.deviations * math.sqrt(share * (1 - share) / self.registers)

    def levels(self, size: int) -> list[int]:
        """How many times each shingle of a set of this size counts, at its level or two."""
        power = size.bit_length() - 1
        wanted = [power]
        if 100 * size >= self.percent << (power + 1):
            wanted.append(power + 1)
        return list(dict.fromkeys(max(1, -(-4 * self.registers >> p)) for p in wanted))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, size: int = 5) -> list[np.ndarray]:
    """The sorted 64-bit hashes of each text's different shingles; A-Z count as a-z.

    A text with fewer words than ``size`` has one shingle, all its words; one without
    words has none.
    """
    words = split_white(pc.ascii_lower(texts))
    own = np.array([xxhash.xxh64_intdigest(w) for w in words.unique.cast(pa.large_binary()).to_pylist()], dtype=np.uint64)
    hashes = own[words.codes] if len(words.codes) else np.zeros(0, dtype=np.uint64)
    n = len(hashes) - size + 1
    rolled = np.zeros(max(n, 0), dtype=np.uint64)
    for k in range(size if n > 0 else 0):
        rolled += hashes[k : k + n] * _odd(k)
    rolled = _mixed(rolled)
    out = []
    for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(rolled[a : b - size + 1]))
        elif b > a:
            few = sum(int(h) * int(_odd(k)) for k, h in enumerate(hashes[a:b])) + (b - a)
            out.append(_mixed(np.array([few % 2**64], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def _odd(k: int) -> np.uint64:
    return _mixed(np.array([(k + 1) * int(_STEP) % 2**64], dtype=np.uint64))[0] | np.uint64(1)


def registers(hashes: np.ndarray, times: int, count: int) -> np.ndarray:
    """The registers of a set each of whose hashes counts ``times`` times; empty: 0."""
    spread = hashes if times == 1 else (hashes[:, None] + np.arange(times, dtype=np.uint64) * _STEP).ravel()
    spread = np.sort(_mixed(spread + _STEP))
    bits = count.bit_length() - 1
    bucket = (spread >> np.uint64(64 - bits)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    rest = spread[first] << np.uint64(bits)
    _, exponent = np.frexp((rest >> np.uint64(11)).astype(np.float64))
    zeros = 53 - exponent
    mantissa = (rest << (zeros + 1).astype(np.uint64)) >> np.uint64(64 - _MANTISSA_BITS)
    out = np.zeros(count, dtype=np.uint16)
    out[bucket[first]] = (((zeros + 1) << _MANTISSA_BITS) | mantissa.astype(np.int64)).astype(np.uint16)
    return out


def _chance(load_a: float, load_b: float) -> float:
    """How often registers with these mean numbers of hashes, none common, coincide."""
    zeros = np.arange(0, 54)[:, None]
    cells = np.arange(1 << _MANTISSA_BITS)[None, :]
    width = np.exp2(-(zeros + 1.0 + _MANTISSA_BITS))
    low = np.exp2(-(zeros + 1.0)) + cells * width

    def odds(load: float) -> np.ndarray:
        return np.exp(-load * low) * -np.expm1(-load * width)

    return float((odds(load_a) * odds(load_b)).sum() + math.exp(-load_a - load_b))


def _rounded(load: float) -> float:
    return float(f"{load:.1e}")


def estimate(
    a: np.ndarray, b: np.ndarray, size_a: int, size_b: int, times: int, chance: Callable = _chance
) -> float:
    """The Jaccard similarity of two sets by their registers at a common level."""
    equal = float(np.mean(a == b))
    collided = chance(*sorted((_rounded(size_a * times / len(a)), _rounded(size_b * times / len(b)))))
    return (equal - collided) / (1 - collided)


def signatures(docs: DataFrame, likeness: Likeness = Likeness()) -> DataFrame:
    """doc_id, text_id, n_shingles, set_id (a digest of the set; null if empty), times, registers.

    ``times`` and ``registers`` are arrays with an element for each level.
    """
    count, size = likeness.registers, likeness.shingle_words

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            # a text is never cut here: its shingles reach over any place
            for rows, part in parts(batch.column("text"), NOWHERE):
                sizes, names, times, found = [], [], [], []
                for hashes in shingle_sets(part, size):
                    levels = likeness.levels(len(hashes)) if len(hashes) else []
                    sizes.append(len(hashes))
                    names.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None)
                    times.append(levels)
                    found.append([registers(hashes, t, count).astype("<u2").tobytes() for t in levels])
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(rows)),
                        batch.column("text_id").take(pa.array(rows)),
                        pa.array(sizes, pa.int64()),
                        pa.array(names, pa.binary()),
                        pa.array(times, pa.list_(pa.int32())),
                        pa.array(found, pa.list_(pa.binary())),
                    ],
                    ["doc_id", "text_id", "n_shingles", "set_id", "times", "registers"],
                )

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_id}, text_id long, n_shingles long, set_id binary, times array<int>, registers array<binary>"
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_id")).mapInArrow(signed, schema)


def near_duplicates(spark: SparkSession, docs: DataFrame, likeness: Likeness = Likeness()) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Words are runs of other than white space, A-Z in lower case. Two documents are linked
    if 100 * common shingles >= percent * shingles of either; every link between candidates
    is confirmed on the full sets. ``component_id`` is the smallest doc_id that links lead
    to; ``kept`` marks it. A document without words (a null or empty text too) is linked
    with nothing. Rows that repeat a doc_id are one document: one of its texts, that with the
    smallest hash, stands for all; rows without an id are linked with nothing and kept. Texts are taken whole, however long:
    a task holds the shingles of one of them. Other columns of ``docs`` are not read.
    """
    staged = stage(spark)
    signed = staged.table("signed", signatures(docs, likeness))
    real = signed.filter("set_id IS NOT NULL AND doc_id IS NOT NULL")
    several = (
        real.groupBy("doc_id")
        .agg(F.count("*").alias("n"), F.min("text_id").alias("first"), F.max_by("set_id", -F.col("text_id")).alias("own_set"), F.max("text_id").alias("last"))
        .filter("first <> last")
        .drop("last")
    )
    marked = join_groups(signed, staged.table("several", several), ["doc_id"], F.col("text_id"), "left").drop("n")
    sets = staged.table(
        "sets",
        marked.filter("set_id IS NOT NULL AND doc_id IS NOT NULL AND coalesce(text_id = first, true)")
        .groupBy("set_id")
        .agg(
            F.min("doc_id").alias("id"),
            F.min_by("text_id", "doc_id").alias("text_id"),
            F.count("*").alias("n"),
            F.max("n_shingles").alias("size"),
            F.first("times").alias("times"),
            F.first("registers").alias("registers"),
        ),
    )
    labels = _labels(staged, docs, signed, sets, likeness)
    named = sets.join(labels, "id", "left").select(
        "set_id", "n", F.coalesce("label", "id").alias("component_id")
    )
    of_id = marked.select("doc_id", "n_shingles", F.coalesce("own_set", "set_id").alias("set_id"))
    joined = join_groups(of_id, named, ["set_id"], F.col("doc_id"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return joined.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def _labels(staged, docs: DataFrame, signed: DataFrame, sets: DataFrame, likeness: Likeness) -> DataFrame:
    """(id, label): the component of every set's document that some link joins to another."""
    grouped = _candidate_groups(staged, sets, likeness)
    ids = staged.table("ids", grouped.select("id").distinct())
    alike = staged.table("texts", _texts_of(docs, signed, sets.join(ids, "id").select("id", "text_id")))
    live = staged.table("live", _linkable(ids, alike, sets, likeness))
    rows = staged.table("rows", grouped.join(live, "id").withColumn("label", F.col("id")))

    def compare(name: str, pairs: DataFrame) -> DataFrame:
        possible = staged.table(f"possible_{name}", _possible(staged, name, pairs, sets, likeness))
        return staged.table(f"links_{name}", _confirmed(staged, name, possible, alike, likeness))

    # Every document with the most central candidate of all its groups.
    star = _star(rows, likeness).groupBy("id").agg(F.min(F.struct("own", "hub")).alias("best"))
    tested = staged.table("pairs_0", star.select("id", "best.hub").select(*_pair("id", "hub")).distinct())
    links = compare("0", tested)
    labels = _components(staged, "stars", links)
    left = staged.table("open", _open(staged, rows.drop("label"), labels))
    if left.isEmpty():
        return labels
    pairs = _across(staged, left, alike, likeness)
    found = compare("1", staged.table("pairs_1", pairs.join(tested, ["a", "b"], "left_anti")))
    return labels if found.isEmpty() else _components(staged, "all", links.unionByName(found))


def _texts_of(docs: DataFrame, signed: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, text) for the rows of ``docs`` with these ids and texts, each once."""
    counts = signed.groupBy(F.col("doc_id").alias("id"), "text_id").agg(F.count("*").alias("n"))
    own = docs.select(F.col("doc_id").alias("id"), "text", F.xxhash64("text").alias("text_id"))
    met = join_groups(own, counts.join(wanted, ["id", "text_id"]), ["id", "text_id"], F.rand(7), "inner")
    return met.groupBy("id").agg(F.min("text").alias("text"))


def _candidate_groups(staged, sets: DataFrame, likeness: Likeness) -> DataFrame:
    """(key, id): the documents that have a band equal to another's, by the band."""
    at = F.explode(F.arrays_zip("times", "registers")).alias("level")
    band = F.explode(F.sequence(F.lit(0), F.lit(likeness.bands - 1))).alias("band")
    registers = F.substring(F.col("level.registers"), F.col("band") * _BAND_BYTES + 1, F.lit(_BAND_BYTES))
    banded = (
        sets.select("id", at)
        .select("id", "level", band)
        .select(F.xxhash64(registers, "band", "level.times").alias("key"), "id")
    )
    groups = staged.table(
        "groups", banded.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    )
    total = groups.agg(F.sum("n")).first()[0] or 0
    part, parts_of = _parts("key", _hot(groups, "key", total), F.col("id"))
    spread = groups.select("key", F.explode(parts_of).alias("part"))
    return staged.table("grouped", banded.withColumn("part", part).join(spread, ["key", "part"]).select("key", "id"))


def _hot(groups: DataFrame, column: str, total: int) -> list:
    """The values with more than 1 in HOT_SHARE of ``total`` rows. There are fewer than
    HOT_SHARE of them, so they can be part of an expression."""
    return [r[0] for r in groups.filter(F.col("n") * HOT_SHARE > total).select(column).collect()]


def _parts(column: str, hot: list, deal):
    """The part a row goes to, dealt by ``deal`` if its value is hot, and the parts of a value."""
    is_hot = F.col(column).isin(hot) if hot else F.lit(False)
    part = F.when(is_hot, F.pmod(F.xxhash64(deal), F.lit(HOT_PARTS))).otherwise(0).cast("int")
    return part, F.when(is_hot, F.sequence(F.lit(0), F.lit(HOT_PARTS - 1))).otherwise(F.array(F.lit(0)))


def _with(rows: DataFrame, column: str, table: DataFrame, deal) -> DataFrame:
    """``rows`` with the columns of ``table``, which has ``column`` once; many rows may hold one
    value of it, which are then dealt by ``deal``. ``rows`` are read to count them first."""
    counts = rows.groupBy(column).agg(F.count("*").alias("n"))
    part, parts_of = _parts(column, _hot(counts, column, rows.count()), deal)
    spread = table.withColumn("_part", F.explode(parts_of))
    return rows.withColumn("_part", part).join(spread, [column, "_part"]).drop("_part")


def _open(staged, grouped: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of the groups that hold several components, with their label and the group's
    ``hub``, the most central document of its largest component, ``hub_label``."""
    labelled = grouped.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    spread = (
        labelled.groupBy("key", "label")
        .agg(F.count("*").alias("m"))
        .groupBy("key")
        .agg(F.sum("m").alias("n"), F.count("*").alias("labels"), F.max_by("label", F.struct("m", "label")).alias("label"))
        .filter("labels > 1")
    )
    spread = staged.table("spread", spread)
    central = labelled.groupBy("label").agg(F.min(F.struct("own", "id")).alias("hub"))
    hubs = _with(spread.drop("n"), "label", central.select("label", F.col("hub.id").alias("hub")), F.col("key"))
    hubs = staged.table("hubs", hubs.withColumnRenamed("label", "hub_label"))
    total = spread.agg(F.sum("n")).first()[0] or 0
    part, parts_of = _parts("key", _hot(spread, "key", total), F.col("id"))
    return labelled.withColumn("_part", part).join(hubs.withColumn("_part", F.explode(parts_of)), ["key", "_part"]).drop("_part", "labels")


def _across(staged, rows: DataFrame, alike: DataFrame, likeness: Likeness) -> DataFrame:
    """The pairs of open groups in different components that may be linked, by their prefixes.

    Sets A and B are linked if they differ in at most s * (|A| + |B|) shingles, where s is
    (100 - percent) / (100 + percent). Each is given by its difference to the hub's set, what
    it has beyond it and what it lacks; A and B differ in |dA| + |dB| - 2 * |dA and dB|
    shingles. So the differences of linked sets have at least a number of elements in common,
    and in one order of all elements, the prefixes that leave out one less of them than that
    share one already. Elements beyond the hub's set, which are rare, come first. The bound is
    one or more unless both are linked to the hub: with A that is not, |dA| is more than
    s * (|A| + |hub|), and the size of dB at least the difference of |B| and |hub|.
    """
    size, percent = likeness.shingle_words, likeness.percent

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, batch.num_rows // max(1, batch.nbytes // 8_000_000))
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                at, elements = [], []
                mine, measures = (shingle_sets(part.column(c), size) for c in ("text", "hub_text"))
                for row, (a, hub) in enumerate(zip(mine, measures)):
                    beyond = np.setdiff1d(a, hub, assume_unique=True)
                    lacking = np.setdiff1d(hub, a, assume_unique=True)
                    found = np.concatenate([beyond, lacking])
                    n = len(found)
                    missing = 100 - percent
                    if 100 * (len(a) - len(beyond)) >= percent * (len(a) + len(lacking)):
                        # linked to the hub, so what is looked for is a partner that is not
                        common = (n * (100 + percent) + missing * (len(hub) - len(a))) // (2 * (100 + percent)) + 1
                    else:  # the partner is larger by a share of this one's size at most
                        common = n - missing * len(a) // percent
                    prefix = found[: max(0, n - max(common, 1) + 1)]
                    at.append(np.full(len(prefix), row))
                    elements.append(prefix)
                at = pa.array(np.concatenate(at))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c).take(at) for c in ("id", "label", "size", "own", "hub")),
                        pa.array(np.concatenate(elements).view(np.int64)),
                    ],
                    ["id", "label", "size", "own", "hub", "element"],
                )

    kind = dict(rows.dtypes)["id"]
    measures = staged.table("measures", rows.select("id", "label", "size", "own", "hub", "hub_label").distinct())
    hub_texts = alike.select(F.col("id").alias("hub"), F.col("text").alias("hub_text"))
    # an id has a hub for each of its groups at most; a hub has any number of ids
    measured = _with(measures, "hub", hub_texts, F.col("id")).join(alike, "id").select("id", "label", "size", "own", "hub", "text", "hub_text")
    elements = staged.table(
        "prefixes",
        measured.mapInArrow(listed, f"id {kind}, label {kind}, size long, own long, hub {kind}, element long"),
    )
    # elements of several components; the smaller of two linked documents has few shingles of
    # its own for its size, so it takes one side alone
    mixed = (
        elements.groupBy("hub", "element")
        .agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"))
        .filter("low < high")
        .select("hub", "element", "n")
    )
    met = staged.table("met", join_groups(elements, staged.table("mixed", mixed), ["hub", "element"], F.col("id"), "inner").drop("n"))
    strong = met.filter(f"100 * (size - own) >= {percent} * (size + own)")
    other = met.select("hub", "element", *[F.col(c).alias(f"o_{c}") for c in ("id", "label", "size", "own")])
    wanted = f"size <= o_size AND label <> o_label AND {_allowed('', 'o_', likeness)}"
    pairs = join_pairs(strong, other, ["hub", "element"], "id", "o_id", wanted).select(*_pair("o_id", "id"))
    # and each with the hub itself, where that was not its star
    stars = measures.filter("label <> hub_label")
    return pairs.union(stars.select(*_pair("id", "hub"))).distinct()


def _linkable(ids: DataFrame, alike: DataFrame, sets: DataFrame, likeness: Likeness) -> DataFrame:
    """(id, size, own): the documents that may be linked with another one of ``ids``.

    ``own`` counts a document's shingles that no other of these documents has. No link has
    them in common, so too many of them rule out every link of the document.
    """
    size = likeness.shingle_words

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for numbers, part in parts(batch.column("text"), NOWHERE):
                found = shingle_sets(part, size)
                owners = np.repeat(numbers, [len(x) for x in found])
                hashes = np.concatenate(found).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(owners)), pa.array(hashes)], ["id", "shingle"])

    kind = dict(alike.dtypes)["id"]
    shingles = alike.select("id", "text").mapInArrow(listed, f"id {kind}, shingle long")
    own = (
        shingles.groupBy("shingle")
        .agg(F.min("id").alias("id"), F.max("id").alias("last"))
        .filter("id = last")
        .groupBy("id")
        .agg(F.count("*").alias("own"))
    )
    counted = sets.join(ids, "id").join(own, "id", "left").select("id", "size", F.coalesce("own", F.lit(0)).alias("own"))
    return counted.filter(f"100 * (size - own) >= {likeness.percent} * size")


def _pair(a: str, b: str) -> list:
    return [F.greatest(a, b).alias("a"), F.least(a, b).alias("b")]


def _allowed(a: str, b: str, likeness: Likeness) -> str:
    """Whether sizes and own shingles of two documents leave room for a link."""
    common = f"least({a}size - {a}own, {b}size - {b}own)"
    either = f"greatest({a}size + {b}own, {b}size + {a}own)"
    return f"100 * {common} >= {likeness.percent} * {either}"


def _star(rows: DataFrame, likeness: Likeness) -> DataFrame:
    """Each document with the most central one of each of its groups, the one with fewest
    shingles of its own, unless they are joined already: (id, hub, own), own the hub's."""
    drawn = rows.groupBy("key").agg(
        F.count("*").alias("n"), F.min(F.struct("own", "id", "label", "size")).alias("hub")
    )
    joined = join_groups(rows, drawn.filter("n > 1"), ["key"], F.col("id"), "inner")
    wanted = joined.filter("label <> hub.label").filter(_allowed("", "hub.", likeness))
    return wanted.select("id", F.col("hub.id").alias("hub"), F.col("hub.own").alias("own"))


def _sides(staged, name: str, pairs: DataFrame, side: Callable[[str], DataFrame]) -> DataFrame:
    """Pairs with what ``side`` has for their two documents, either of which many may share."""
    first = _with(pairs, "a", side("a"), F.col("b"))
    counts = staged.table(f"counts_{name}", pairs.groupBy("b").agg(F.count("*").alias("n")))
    part, parts_of = _parts("b", _hot(counts, "b", pairs.count()), F.col("a"))
    return first.withColumn("_part", part).join(side("b").withColumn("_part", F.explode(parts_of)), ["b", "_part"])


def _possible(staged, name: str, pairs: DataFrame, sets: DataFrame, likeness: Likeness) -> DataFrame:
    """The pairs whose registers allow the threshold."""
    least = likeness.least_estimate

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chance = lru_cache(maxsize=20_000)(_chance)
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(2, 8)]
            stays = []
            for size_a, times_a, found_a, size_b, times_b, found_b in zip(*columns):
                best = 0.0
                for t in set(times_a) & set(times_b):
                    a, b = (np.frombuffer(f[ts.index(t)], dtype="<u2") for f, ts in ((found_a, times_a), (found_b, times_b)))
                    best = max(best, estimate(a, b, size_a, size_b, t, chance))
                stays.append(best >= least)
            yield batch.filter(pa.array(stays, pa.bool_())).select([0, 1])

    def side(name: str) -> DataFrame:
        return sets.select(F.col("id").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("size", "times", "registers")])

    joined = _sides(staged, f"possible_{name}", pairs, side).select("a", "b", *[f"{c}_{x}" for x in "ab" for c in ("size", "times", "registers")])
    # sizes further apart than the threshold allows need no registers
    near = f"100 * least(size_a, size_b) >= {likeness.percent} * greatest(size_a, size_b)"
    kind = dict(pairs.dtypes)["a"]
    return joined.filter(near).mapInArrow(kept, f"a {kind}, b {kind}")


def _confirmed(staged, name: str, pairs: DataFrame, alike: DataFrame, likeness: Likeness) -> DataFrame:
    """The pairs that reach the threshold on their full sets."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, batch.num_rows // max(1, batch.nbytes // 8_000_000))
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                sets_a = shingle_sets(part.column("text_a"), likeness.shingle_words)
                sets_b = shingle_sets(part.column("text_b"), likeness.shingle_words)
                stays = []
                for a, b in zip(sets_a, sets_b):
                    common = len(np.intersect1d(a, b, assume_unique=True))
                    stays.append(100 * common >= likeness.percent * (len(a) + len(b) - common))
                yield part.filter(pa.array(stays, pa.bool_())).select([0, 1])

    def side(name: str) -> DataFrame:
        return alike.select(F.col("id").alias(name), F.col("text").alias(f"text_{name}"))

    joined = _sides(staged, f"links_{name}", pairs, side).select("a", "b", "text_a", "text_b")
    kind = dict(pairs.dtypes)["a"]
    return joined.mapInArrow(kept, f"a {kind}, b {kind}")


def _components(staged, name: str, links: DataFrame) -> DataFrame:
    """(id, label): the smallest id that links lead to, for every id in a link."""
    ways = staged.table(
        f"ways_{name}", links.select(F.col("a").alias("id"), F.col("b").alias("to")).union(links.select("b", "a"))
    )
    labels = staged.table(
        f"labels_{name}_0", ways.groupBy("id").agg(F.min("to").alias("to")).select("id", F.least("id", "to").alias("label"))
    )
    number = 0
    while True:
        number += 1
        # the smallest label beside each id, and one step further, the label of that label
        beside = labels.select(F.col("id").alias("to"), F.col("label").alias("beside"))
        lowest = _with(ways, "to", beside, F.col("id")).groupBy("id").agg(F.min("beside").alias("beside"))
        lower = labels.join(lowest, "id").select("id", F.col("label").alias("old"), F.least("label", "beside").alias("label"))
        lower = staged.table(f"lower_{name}_{number}", lower)
        if lower.filter("old <> label").isEmpty():
            return labels
        jump = labels.select(F.col("id").alias("label"), F.col("label").alias("next"))
        jumped = _with(lower, "label", jump, F.col("id")).select("id", F.least("label", "next").alias("label"))
        labels = staged.table(f"labels_{name}_{number}", jumped)
