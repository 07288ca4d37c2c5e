"""Near duplicates by SimHash, searched with the generalised pigeonhole principle.

A bit of a text's 64-bit fingerprint is set if it is set in over half the hashes of its shingles. Fingerprints that differ
in few bits are linked, and linked documents make components.

The 64 bits are cut into m parts. If two fingerprints differ in T bits at most and thresholds of the parts add up to
T - m + 1, then in some part they differ by no more than its threshold (-1 leaves a part out). Bits that go together are
put into the same part, so that the parts say different things; the thresholds, and m itself, are those of least cost by
dynamic programming over the expected numbers of probes and candidates. Both are planned on a bounded sample, which has a
say in the cost only, never in the result.

Each fingerprint, once however many texts have it, goes to the buckets of its parts' values and of those within the
thresholds. A bucket is gone through in one task on whole fingerprints; what comes out are the links of a spanning forest,
never all pairs. A bucket of more than ``BLOCK`` members is dealt to several tasks, each with the same few pivots among its
members, so that a dense cluster holds together through them; only members outside the bucket's largest class so far are
then compared with all others.

Null and empty texts have the fingerprint zero, which is linked like any other. Documents without id take part and get
their component's least id, null if none has one; repeated rows stay. An empty table gives no row. Other columns are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageglean.llm import words as W
from pageglean.llm.components import components
from pageglean.llm.runs import changes, whole_groups
from pageglean.session import materialize

BITS = 64
DISTANCE = 4
SHINGLE = 4
SEED = 42
# About so many fingerprints, chosen by hash, are looked at to plan the search.
SAMPLE = 2048
# A row sent to a bucket costs about as much as so many comparisons.
ROW_COST = 400
# Members of a bucket that one task compares with each other.
BLOCK = 1 << 15
# Members of a larger bucket that go to all of its tasks.
PIVOTS = 256
# Rows that a task takes up at once, where buckets are small.
ROWS = 1 << 16
# Buckets up to this size are gone through together.
TOGETHER = 64


# ---- fingerprints ---------------------------------------------------------------------------------------------------

def fingerprint(blob: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of a text's runs of ``shingle`` words (a shorter text is one run), taken in pieces."""
    counts, n, held = np.zeros(BITS, dtype=np.int64), 0, []
    pieces = list(W.cut(blob.lower()))
    for k, piece in enumerate(pieces):
        words = held + piece.split()
        if len(words) < shingle and k < len(pieces) - 1:
            held = words
            continue
        runs = [b" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)]
        if not runs and words and not n:
            runs = [b" ".join(words)]
        if runs:
            hashes = np.fromiter((xxhash.xxh64_intdigest(r, seed) for r in runs), dtype="<u8", count=len(runs))
            counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            n += len(runs)
        held = words[max(0, len(words) - shingle + 1):]
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0]) if n else 0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``id`` and ``fp`` (the 64 bits as a signed number) of every row."""
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches):
            blobs = batch.column("text").cast(pa.binary()).to_pylist()
            found = np.array([fingerprint(b or b"", shingle, seed) for b in blobs], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found.view(np.int64))], ["id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(mark, "id long, fp long")


# ---- the plan of the search -----------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Part:
    """Bit positions, and in how many of them fingerprints may differ to meet in a bucket."""

    bits: tuple[int, ...]
    threshold: int

    def mask(self) -> int:
        return sum(1 << b for b in self.bits)

    def flips(self) -> list[int]:
        """What a value is combined with to get all values within the threshold."""
        return [sum(1 << b for b in chosen) for e in range(self.threshold + 1) for chosen in combinations(self.bits, e)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def group_bits(bits: np.ndarray, parts: int) -> list[tuple[int, ...]]:
    """Bit positions in ``parts`` groups of nearly equal size, each grown by the bit that goes most with those it has."""
    spread = bits.std(axis=0) if len(bits) else np.zeros(BITS)
    ties = np.zeros((BITS, BITS))
    live = np.flatnonzero(spread > 0)
    if len(live) > 1:
        ties[np.ix_(live, live)] = np.abs(np.corrcoef(bits[:, live], rowvar=False))
    np.fill_diagonal(ties, 0)
    free, groups = list(range(BITS)), []
    for k in range(parts):
        size = BITS // parts + (k < BITS % parts)
        group = [max(free, key=lambda b: ties[b][free].sum())]
        free.remove(group[0])
        while len(group) < size:
            group.append(max(free, key=lambda b: ties[b][group].sum()))
            free.remove(group[-1])
        groups.append(tuple(sorted(group)))
    return groups


def _shares(sample: np.ndarray, bits: np.ndarray, group: tuple[int, ...], most: int) -> list[float]:
    """Expected share of pairs that differ in at most 0, 1, ... ``most`` bits of a group.

    The larger of what the sample's pairs show and of what its bits alone would give, as rare meetings do not show.
    """
    counted, pairs = np.zeros(BITS + 1), 0
    masked = sample & np.uint64(sum(1 << b for b in group))
    for at in range(0, len(masked), 256):
        apart = np.bitwise_count(masked[at:at + 256, None] ^ masked[None, :])
        counted += np.bincount(apart.ravel(), minlength=BITS + 1)
        pairs += apart.size
    counted[0] -= len(masked)
    alone = np.ones(1)
    for b in group:
        p = bits[:, b].mean() if len(bits) else 0.5
        alone = np.convolve(alone, [1 - 2 * p * (1 - p), 2 * p * (1 - p)])
    shown = np.cumsum(counted)[:most + 1] / max(1, pairs - len(masked))
    return [float(max(a, b)) for a, b in zip(shown, np.cumsum(np.append(alone, np.zeros(most)))[:most + 1])]


def plan(sample: np.ndarray, n: int, distance: int = DISTANCE) -> list[Part]:
    """Parts and thresholds that find all pairs within ``distance`` among ``n`` fingerprints at the least expected cost."""
    bits = (sample[:, None] >> np.arange(BITS, dtype=np.uint64)[None, :]) & np.uint64(1) if len(sample) else np.zeros((0, BITS))
    best: tuple[float, list[Part]] | None = None
    for m in range(1, distance + 2):
        groups = group_bits(bits.astype(float), m)
        costs = []
        for group in groups:
            shares = _shares(sample, bits, group, distance)
            probes = np.cumsum([comb(len(group), e) for e in range(distance + 1)])
            costs.append([0.0] + [float(n * probes[e] * ROW_COST + n * n / 2 * shares[e]) for e in range(distance + 1)])
        # Thresholds from -1 on, written as steps above -1; they add up to distance - m + 1, so the steps to distance + 1.
        reach: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for cost in costs:
            step: dict[int, tuple[float, list[int]]] = {}
            for used, (paid, chosen) in reach.items():
                for more in range(distance + 2 - used):
                    total = paid + cost[more]
                    if used + more not in step or total < step[used + more][0]:
                        step[used + more] = (total, [*chosen, more - 1])
            reach = step
        paid, chosen = reach[distance + 1]
        if best is None or paid < best[0]:
            best = paid, [Part(g, t) for g, t in zip(groups, chosen) if t >= 0]
    return best[1]


# ---- links ----------------------------------------------------------------------------------------------------------

def _forest(fps: np.ndarray, only_met: np.ndarray, begins: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that span the near pairs of each group; a group begins at each of ``begins``.

    A row is compared with all later ones of its group, unless it is ``only_met`` (such rows come last in their group).
    """
    n = len(fps)
    ends = np.repeat(np.append(begins[1:], n), np.diff(np.append(begins, n)))
    parent, found = list(range(n)), []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    label, step, active = np.arange(n), 1, np.flatnonzero(~only_met)
    active = active[active + 1 < ends[active]]
    while len(active):
        apart = label[active] != label[active + step]
        a = active[apart]
        a = a[np.bitwise_count(fps[a] ^ fps[a + step]) <= distance]
        for i in a.tolist():
            x, y = root(i), root(i + step)
            if x != y:
                parent[max(x, y)] = min(x, y)
                if fps[i] != fps[i + step]:
                    found.append((int(fps[i]), int(fps[i + step])))
        if len(a):
            label = np.array(parent)
            while True:
                above = label[label]
                if (above == label).all():
                    break
                label = above
        step += 1
        active = active[active + step < ends[active]]
    return found


def link_buckets(rows: DataFrame, keys: list[str], distance: int) -> DataFrame:
    """Links ``a``, ``b`` that span the near pairs of each bucket; ``rows`` have ``fp`` and ``met`` (1: not compared among themselves)."""
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in whole_groups(batches, [*keys, "fp", "met"], keys, ROWS):
            fps, met = piece["fp"].astype(np.int64).view(np.uint64), piece["met"].astype(bool)
            begins = changes([piece[k] for k in keys])
            sizes = np.diff(np.append(begins, len(fps)))
            small = np.repeat(sizes <= TOGETHER, sizes)
            found = []
            if small.any():
                found += _forest(fps[small], met[small], np.concatenate([[0], np.cumsum(sizes[sizes <= TOGETHER])[:-1]]), distance)
            for at, size in zip(begins[sizes > TOGETHER].tolist(), sizes[sizes > TOGETHER].tolist()):
                found += _forest(fps[at:at + size], met[at:at + size], np.zeros(1, dtype=np.int64), distance)
            if found:
                ends = np.array(found, dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

    dealt = rows.select(*keys, "fp", "met").repartition(*keys).sortWithinPartitions(*keys, "met")
    return dealt.mapInArrow(link, "a long, b long")


def buckets(fps: DataFrame, parts: list[Part]) -> DataFrame:
    """One row per fingerprint and bucket: ``part``, ``value``, and ``met``, 0 where the value is the fingerprint's own."""
    def places(k: int, part: Part) -> Column:
        own = F.col("fp").bitwiseAND(F.lit(_signed(part.mask())))
        flips = F.array(*[F.struct(F.lit(_signed(x)).cast("long").alias("x"), F.lit(int(x != 0)).alias("met")) for x in part.flips()])
        return F.transform(flips, lambda f: F.struct(F.lit(k).alias("part"), own.bitwiseXOR(f["x"]).alias("value"), f["met"].alias("met")))

    return fps.select("fp", F.inline(F.flatten(F.array(*[places(k, part) for k, part in enumerate(parts)]))))


def near_links(fps: DataFrame, distance: int = DISTANCE, block: int = BLOCK, pivots: int = PIVOTS, sample: int = SAMPLE) -> DataFrame:
    """Links that connect all different fingerprints of a stored table ``fp`` that differ in at most ``distance`` bits."""
    n = fps.count()
    turn = F.pmod(F.xxhash64("fp", F.lit(7)), F.lit(1 << 40))
    drawn = fps.filter(turn < int(min(1.0, sample / max(1, n)) * (1 << 40))).select("fp").toArrow().column("fp").to_numpy()
    parts = plan(np.sort(drawn.astype(np.int64)).view(np.uint64), max(2, n), distance)
    rows, key = buckets(fps, parts), ["part", "value"]
    crowded = materialize(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("members")).filter(F.col("members") > block))
    if crowded.isEmpty():
        return link_buckets(rows, key, distance)
    links = link_buckets(rows.join(crowded, key, "left_anti"), key, distance)
    inside = rows.join(crowded, key).withColumn("tasks", F.ceil(F.col("members") / block).cast("int"))
    at = F.pmod(F.xxhash64("fp", F.lit(11)), F.col("tasks")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("tasks") - 1))
    # A pivot is a member of all of its bucket's tasks; about so many are drawn whatever the bucket's size.
    shared = inside.filter(F.pmod(F.xxhash64("fp", F.lit(13)), F.col("members")) < pivots).withColumn("task", every)
    dealt = inside.withColumn("task", at).unionByName(shared).select(*key, "task", "fp", "met")
    links = materialize(links.unionByName(link_buckets(dealt, [*key, "task"], distance)))
    # What is not in its bucket's largest class may still be near to any member of the bucket.
    labels = components(links).withColumnRenamed("node", "fp")
    known = materialize(inside.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp")))
    sizes = known.groupBy(*key, "label").agg(F.count(F.lit(1)).alias("size"))
    largest = sizes.groupBy(*key).agg(F.max_by("label", F.struct("size", "label")).alias("largest"))
    outside = materialize(known.join(largest, key).filter(F.col("label") != F.col("largest")).select(*key, "fp", "tasks", "members"))
    rest = outside.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("shares"))
    members = inside.join(rest, key).withColumn("task", at).withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
    asking = outside.join(rest, key).withColumn("share", F.pmod(F.xxhash64("fp", F.lit(17)), F.col("shares")).cast("int")).withColumn("task", every)
    columns = [*key, "task", "share", "fp"]
    compared = asking.select(*columns, F.lit(0).alias("met")).unionByName(members.select(*columns, F.lit(1).alias("met")))
    return links.unionByName(link_buckets(compared, [*key, "task", "share"], distance))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = DISTANCE, shingle: int = SHINGLE, seed: int = SEED,
                    block: int = BLOCK, pivots: int = PIVOTS) -> DataFrame:
    """Every row's ``fingerprint`` (16 hex digits) and ``component_id``, the least id among what links lead to."""
    marked = materialize(fingerprints(docs, id_col, text_col, shingle, seed))
    different = materialize(marked.groupBy("fp").agg(F.min("id").alias("least")))
    labels = components(near_links(different.select("fp"), distance, block, pivots)).withColumnRenamed("node", "fp")
    known = materialize(different.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp")))
    named = known.groupBy("label").agg(F.min("least").alias("component_id"))
    found = materialize(known.join(named, "label").select("fp", "component_id"))
    return marked.join(found, "fp").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
