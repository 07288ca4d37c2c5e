"""N-gram Jaccard join by chosen paths.

A text is the set of its runs of five words; one of fewer words is one run. Sets are sketched by 128 minimum hashes.
Each run of the search draws some of the 128 places and puts a set into a bucket for each place's value: sets of
similarity s share the drawn value with probability s. A bucket that is too large is compared with some of
its members, its pivots; what does not hang together then is split again by further drawn places (a path), a small one is gone through pair by pair on the sketches, and runs are repeated until a pair
at the threshold is missed less often than the target allows. What is found links candidates into groups. Each
candidate's whole set then goes to its group once, where similarities are computed exactly, block against block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageglean.llm import words as W
from pageglean.llm.components import components
from pageglean.session import materialize

SHINGLE = 5
THRESHOLD = 0.8
PLACES = 128
MISSED = 1e-5
# A larger bucket is split again, this often at most; then its pairs are taken in blocks.
BUCKET = 1024
DEPTH = 4
# A large bucket has about so many pivots, which all members are compared with.
PIVOTS = 16
# Members this like a pivot are linked to it and done; members less like all pivots than the second number have no link to
# those. Both leave room for the sketches' deviations and for the triangle inequality.
SAME, FAR = 0.8, 0.24
# What lies between, or outside the component of most members, is compared with the whole bucket while it is no more than this.
BETWEEN = 4096
# Expected places drawn for a shared one while splitting again.
AGAIN = 3.0
# Sketches of pairs at the threshold fall this many standard deviations below it at most.
DEVIATIONS = 4.5
# A block of a group has about so many members, and so many bytes of their sets; a longer set is a block of its own.
# Each set goes to as many tasks as its group has blocks, so blocks are as large as a worker bears.
BLOCK = 1024
BLOCK_BYTES = 8 << 20


def shingle_sets(texts: list[str | None], size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted 64-bit hashes of the runs of words of each text; none for a text without words."""
    hashes, begins = W.word_hashes(texts)
    found = []
    for i in range(len(texts)):
        own = hashes[begins[i]:begins[i + 1]]
        found.append(np.unique(W.window_hashes(own, min(size, len(own)))) if len(own) else own)
    return found


_SEEDS = W.mixed(np.arange(PLACES), 23) | np.uint64(1)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Minimum of each of the hash functions over a set, as 32 bits."""
    least = np.full(PLACES, np.iinfo(np.uint64).max, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), 4096):
            part = shingles[at:at + 4096]
            np.minimum(least, (part[None, :] * _SEEDS[:, None]).min(axis=1), out=least)
    return (W.mixed(least, 3) >> np.uint64(32)).astype(np.uint32)


def runs_needed(threshold: float = THRESHOLD, missed: float = MISSED) -> int:
    """Runs until a pair at the threshold is missed with less than this probability."""
    hit = 1 - (1 - threshold / (threshold * PLACES)) ** PLACES
    return math.ceil(math.log(missed) / math.log(1 - hit))


def first_places(runs: int, threshold: float = THRESHOLD) -> list[tuple[int, int]]:
    """The (run, place) pairs drawn at the root, each with probability 1 / (threshold x places)."""
    draws = W.mixed(np.arange(runs * PLACES), 41).astype(float) / 2.0**64
    return [(int(k) // PLACES, int(k) % PLACES) for k in np.flatnonzero(draws < 1 / (threshold * PLACES))]


def _paths(run_places: list[tuple[int, int]], sketches: np.ndarray) -> np.ndarray:
    """Bucket of each sketch (rows) for each drawn place (columns)."""
    return np.stack([W.mixed(sketches[:, p].astype(np.uint64), 100 + r * PLACES + p) for r, p in run_places], axis=1).view(np.int64)


def _next_paths(paths: np.ndarray, sketches: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows and paths of the children: each path draws its own places."""
    share = AGAIN / (threshold * PLACES)
    places = np.arange(PLACES, dtype=np.uint64)
    drawn = W.mixed(paths.view(np.uint64)[:, None] ^ W.mixed(places, 77)[None, :], 5).astype(float) / 2.0**64 < share
    rows, chosen = np.nonzero(drawn)
    values = sketches[rows, chosen].astype(np.uint64) << np.uint64(8) | chosen.astype(np.uint64)
    return rows, W.mixed(paths.view(np.uint64)[rows] ^ W.mixed(values, 9), 6).view(np.int64)


def _labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least member of each one's component in a small graph."""
    label = np.arange(n)
    while True:
        least = label.copy()
        np.minimum.at(least, a, label[b])
        np.minimum.at(least, b, label[a])
        least = least[least]
        if (least == label).all():
            return label
        label = least


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches that never part rows of equal keys, for rows that come sorted by the keys. Holds one group and a batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        new = np.zeros(batch.num_rows, dtype=bool)
        for k in keys:
            column = batch.column(k).to_numpy()
            new[1:] |= column[1:] != column[:-1]
            new[0] |= bool(held) and held[-1].column(k)[-1].as_py() != column[0]
        starts = np.flatnonzero(new)
        if not len(starts):
            held.append(batch)
            continue
        if held or starts[0] > 0:
            yield pa.concat_batches([*held, batch.slice(0, starts[0])])
        held = [batch.slice(starts[-1])]
        if starts[-1] > starts[0]:
            yield batch.slice(starts[0], starts[-1] - starts[0])
    if held:
        yield pa.concat_batches(held)


def _sketches(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("sketch").to_pylist()), dtype=np.uint16).reshape(batch.num_rows, PLACES)


def _alike(sketches: np.ndarray, a: np.ndarray, b: np.ndarray, least: int) -> np.ndarray:
    """Which of these pairs agree in enough places."""
    found = np.zeros(len(a), dtype=bool)
    for at in range(0, len(a), 8192):
        found[at:at + 8192] = (sketches[a[at:at + 8192]] == sketches[b[at:at + 8192]]).sum(axis=1) >= least
    return found


def _bucket_links(least: int):
    """Goes through buckets and links each member to the least one it hangs together with."""
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _groups(batches, ["path"]):
            path, node, marks = batch.column("path").to_numpy(), batch.column("node").to_numpy(), _sketches(batch)
            label = np.arange(len(path))
            # Rows of a bucket stand together: pairs are rows at distance 1, 2, ... while any bucket is that long. Pairs
            # that hang together already need no look, and none are kept.
            for lag in range(1, len(path)):
                a = np.flatnonzero(path[:-lag] == path[lag:])
                if not len(a):
                    break
                a = a[label[a] != label[a + lag]]
                a = a[_alike(marks, a, a + lag, least)]
                if len(a):
                    label = _labels(len(path), label[a], label[a + lag])[label]
            far = node[label] != node
            yield pa.RecordBatch.from_arrays([pa.array(node[far]), pa.array(node[label[far]])], ["a", "b"])

    return link


def candidate_links(sketched: DataFrame, threshold: float = THRESHOLD, bucket: int = BUCKET, depth: int = DEPTH) -> DataFrame:
    """Links ``a``, ``b`` that hold together all ``node``s whose ``sketch``es are near: at most one per node and bucket.

    ``sketched`` has the nodes with their sketches and their ``paths`` from the root.
    """
    least = math.floor(PLACES * (threshold - DEVIATIONS * math.sqrt(threshold * (1 - threshold) / PLACES)))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, 2048):
            rows, paths = _next_paths(batch.column("path").to_numpy(), _sketches(batch), threshold)
            taken = pa.array(rows)
            yield pa.RecordBatch.from_arrays([pa.array(paths), batch.column("node").take(taken), batch.column("sketch").take(taken)], ["path", "node", "sketch"])

    def leaves(small: DataFrame) -> DataFrame:
        rows = small.select("path", "node", "sketch").repartition("path").sortWithinPartitions("path")
        return rows.mapInArrow(_bucket_links(least), "a long, b long")

    def sized(rows: DataFrame) -> DataFrame:
        """Rows of buckets with more than one member, with the members' number and the least of them."""
        sizes = materialize(rows.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("pivot")).filter(F.col("n") > 1))
        return rows.join(sizes, "path")

    # Most texts share no bucket, so sketches follow only the others, and of large buckets they are stored with the members.
    members = materialize(sized(sketched.select(F.explode("paths").alias("path"), "node")))
    marks = sketched.select("node", "sketch")
    links, level = [leaves(members.filter(F.col("n") <= bucket).join(marks, "node"))], 1
    large = members.filter(F.col("n") > bucket)
    if not large.isEmpty():
        large = materialize(large.join(marks, "node"))
    while not large.isEmpty():
        rest, more = _around_pivots(large, least, bucket)
        rest = materialize(sized(rest))
        links += [*more, leaves(rest.filter(F.col("n") <= bucket))]
        large = rest.filter(F.col("n") > bucket)
        if large.isEmpty():
            break
        if level >= depth:
            links.append(_large_links(large, least, bucket))
            break
        held = materialize(sized(large.select("path", "node", "sketch").mapInArrow(split, "path long, node long, sketch binary")))
        links.append(leaves(held.filter(F.col("n") <= bucket)))
        large, level = held.filter(F.col("n") > bucket), level + 1
    found = links[0]
    for more in links[1:]:
        found = found.unionByName(more)
    return found


def _pivot_links(least: int):
    """Likeness of each member to the pivot it is most like, the pivot it hangs on, and which pivots hang together through members.

    A pivot stands for all that are seen to hang together with it in one go; these are told once.
    """
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
        for whole in _groups(batches, ["seat"]):
            seat = whole.column("seat").to_numpy()
            bounds = np.concatenate([[0], np.flatnonzero(seat[1:] != seat[:-1]) + 1, [len(seat)]])
            for low, high in zip(bounds[:-1], bounds[1:]):
                batch = whole.slice(low, high - low)
                marks, node = _sketches(batch), batch.column("node").to_numpy()
                ids = node[batch.column("chosen").to_numpy(zero_copy_only=False)].tolist()
                own = np.flatnonzero(batch.column("own").to_numpy(zero_copy_only=False))
                alike = np.stack([(marks[own] == m).sum(axis=1) for m in marks[:len(ids)]], axis=1)
                member, pivot = np.nonzero(alike >= least)
                label = _labels(len(ids) + len(own), len(ids) + member, pivot)
                hung = [ids[at] if at < len(ids) else None for at in label[len(ids):].tolist()]
                merged = [[{"a": ids[i], "b": ids[at]} for i, at in enumerate(label[:len(ids)].tolist()) if i != at]] + [[]] * (len(own) - 1)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).take(pa.array(own)) for c in ("path", "node", "sketch")], pa.array(alike.max(axis=1).astype(np.int64)), pa.array(hung, pa.int64()),
                     pa.array(merged[:len(own)], pairs)], ["path", "node", "sketch", "same", "hung", "merged"])

    return measure


def _main_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pivots of each bucket's largest part: its members, those very like one of its pivots, and all members and far ones."""
    for batch in batches:
        found = []
        for row in batch.to_pylist():
            ids = sorted({p["hung"] for p in row["parts"] if p["hung"] is not None} | {x for link in row["merged"] for x in (link["a"], link["b"])})
            place = {x: i for i, x in enumerate(ids)}
            label = _labels(len(ids), np.array([place[x["a"]] for x in row["merged"]], dtype=np.int64), np.array([place[x["b"]] for x in row["merged"]], dtype=np.int64))
            held, like = np.zeros(len(ids), dtype=np.int64), np.zeros(len(ids), dtype=np.int64)
            for p in row["parts"]:
                if p["hung"] is not None:
                    held[label[place[p["hung"]]]] += p["n"]
                    like[label[place[p["hung"]]]] += p["like"]
            most = int(held.argmax())
            every, far = sum(p["n"] for p in row["parts"]), sum(p["far"] for p in row["parts"])
            found.append((row["path"], [x for x, at in zip(ids, label) if at == most], int(held[most]), every, every - far - int(like[most])))
        kinds = (pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.int64())
        columns = list(zip(*found)) or [()] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["path", "main", "held", "all", "between"])


def _around_pivots(large: DataFrame, least: int, bucket: int) -> tuple[DataFrame, list[DataFrame]]:
    """Takes out of large buckets what hangs on their pivots: the members that are left, and the links found.

    Members that hang together through pivots need no comparison with each other. A bucket of which few members are
    outside its largest such part is done when these are compared with the whole bucket. Else members very like a pivot of
    that part are taken out, those between like and far are compared with the whole bucket, and the far ones are left. A
    bucket with too many between is left whole.
    """
    # Pivots go to each seat of their bucket and come first there; they are members in one seat only.
    chosen = (F.col("node") == F.col("pivot")) | (F.pmod(F.xxhash64("node", F.lit(7)), F.col("n")) < PIVOTS)
    seats = F.ceil(F.col("n") / bucket).cast("int")
    place = F.pmod(F.xxhash64("node", F.lit(3)), seats).cast("int")
    dealt = large.select("path", "node", "sketch", chosen.alias("chosen"), place.alias("place"), F.explode(
        F.when(chosen, F.sequence(F.lit(0), seats - 1)).otherwise(F.array(place))).alias("seat"))
    seated = dealt.select(F.xxhash64("path", "seat").alias("seat"), "path", "node", "sketch", "chosen", (F.col("place") == F.col("seat")).alias("own"))
    told = materialize(seated.repartition("seat").sortWithinPartitions("seat", F.desc("chosen"), "node").mapInArrow(
        _pivot_links(least), "path long, node long, sketch binary, same long, hung long, merged array<struct<a:long,b:long>>"))
    stars = told.filter(F.col("hung") != F.col("node")).select(F.col("node").alias("a"), F.col("hung").alias("b")).unionByName(told.select(F.inline("merged")))
    like, far = F.col("same") >= math.ceil(SAME * PLACES), F.col("same") < math.floor(FAR * PLACES)
    parts = told.groupBy("path", "hung").agg(F.count(F.lit(1)).alias("n"), F.count_if(like).alias("like"), F.count_if(far).alias("far"),
                                             F.flatten(F.collect_set("merged")).alias("merged"))
    whole = parts.groupBy("path").agg(F.collect_list(F.struct("hung", "n", "like", "far")).alias("parts"), F.flatten(F.collect_list("merged")).alias("merged"))
    most = whole.mapInArrow(_main_parts, "path long, main array<long>, held long, all long, between long")
    outside = ~F.coalesce(F.array_contains("main", F.col("hung")), F.lit(False))
    placed = materialize(told.drop("merged").join(most, "path").withColumn("outside", outside).withColumn("middle", (F.col("outside") | ~like) & ~far).withColumn(
        "done", F.col("all") - F.col("held") <= BETWEEN).withColumn("peeled", ~F.col("done") & (F.col("between") <= BETWEEN)).drop("main", "hung"))
    asking = F.when(F.col("done"), F.col("outside")).otherwise(F.col("middle"))
    some = F.when(F.col("done"), F.col("all") > F.col("held")).otherwise(F.col("peeled") & (F.col("between") > 0))
    blocks = F.ceil(F.col("all") / bucket).cast("int")
    own = F.pmod(F.xxhash64("node", F.lit(3)), blocks).cast("int")
    seats = placed.filter(some).withColumn("asking", asking).withColumn(
        "block", F.explode(F.when(F.col("asking"), F.sequence(F.lit(0), blocks - 1)).otherwise(F.array(own))))
    asked = seats.select(F.xxhash64("path", "block").alias("path"), "node", F.col("asking").alias("middle"), "sketch")
    compared = asked.repartition("path").sortWithinPartitions("path", F.desc("middle")).mapInArrow(_middle_links(least), "a long, b long")
    return placed.filter(~F.col("done") & (~F.col("peeled") | far)).select("path", "node", "sketch"), [stars, compared]


def _middle_links(least: int):
    """In each block, compares the members marked as middle, which come first, with all."""
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _groups(batches, ["path"]):
            path = whole.column("path").to_numpy()
            bounds = np.concatenate([[0], np.flatnonzero(path[1:] != path[:-1]) + 1, [len(path)]])
            for low, high in zip(bounds[:-1], bounds[1:]):
                batch = whole.slice(low, high - low)
                marks, node = _sketches(batch), batch.column("node").to_numpy()
                label = np.arange(len(node))
                for i in range(int(batch.column("middle").to_numpy(zero_copy_only=False).sum())):
                    others = np.flatnonzero(label != label[i])
                    near = others[(marks[others] == marks[i]).sum(axis=1) >= least]
                    if len(near):
                        label = _labels(len(node), np.full(len(near), label[i]), label[near])[label]
                gone = node[label] != node
                yield pa.RecordBatch.from_arrays([pa.array(node[gone]), pa.array(node[label[gone]])], ["a", "b"])

    return link


def _large_links(members: DataFrame, least: int, bucket: int) -> DataFrame:
    """Links in buckets that no path makes smaller: their members in blocks, each two blocks in a task."""
    blocks = F.ceil(F.col("n") / (bucket / 2)).cast("int")
    own = F.pmod(F.xxhash64("node", F.lit(3)), blocks).cast("int")
    other = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    pair = F.xxhash64("path", F.least("own", "other"), F.greatest("own", "other"))
    return other.withColumn("path", pair).select("path", "node", "sketch").repartition("path").sortWithinPartitions(
        "path").mapInArrow(_bucket_links(least), "a long, b long")


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the pairwise intersections of sets: products of their incidence columns, some thousands at a time."""
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, place, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count[place] > 1
    column = (np.cumsum(count > 1) - 1)[place[shared]]
    owner, order = owner[shared], np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    # Sums of ones are exact in single precision far beyond the size of any set.
    total, step = np.zeros((len(sets), len(sets)), dtype=np.float32), max(256, (1 << 21) // len(sets))
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        low, high = np.searchsorted(column, [at, at + step])
        held = np.zeros((len(sets), step), dtype=np.float32)
        held[owner[low:high], column[low:high] - at] = 1
        total += held @ held.T
    return total


def _exact(threshold: float):
    """Exact similarities in each pair of blocks: linked copies of each member, and the least member it hangs together with."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _groups(batches, ["pair"]):
            pair = whole.column("pair").to_numpy()
            bounds = np.concatenate([[0], np.flatnonzero(pair[1:] != pair[:-1]) + 1, [len(pair)]])
            nodes, counts, labels = [], [], []
            for low, high in zip(bounds[:-1], bounds[1:]):
                batch = whole.slice(low, high - low)
                node, own, other, copies = (batch.column(c).to_numpy() for c in ("node", "own", "other", "copies"))
                sets = [np.frombuffer(s, dtype=np.uint64) for s in batch.column("shingles").to_pylist()]
                both = _intersections(sets)
                sizes = np.array([len(s) for s in sets])
                # both >= threshold * union, row by row, so that no second table of this size is held.
                near = np.stack([b >= (threshold * (sizes + sizes[i]) - 1e-9) / (1 + threshold) for i, b in enumerate(both)])
                del both
                near &= (own[:, None] != own[None, :]) if (own != other).any() else ~np.eye(len(node), dtype=bool)
                a, b = np.nonzero(near)
                nodes.append(node)
                counts.append(np.bincount(a, weights=copies[b], minlength=len(node)))
                labels.append(node[_labels(len(node), a, b)])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (nodes, counts, labels)], ["node", "links", "label"])

    return compare


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, missed: float = MISSED,
                    bucket: int = BUCKET, depth: int = DEPTH, block: int = BLOCK) -> DataFrame:
    """``doc_id``, ``class_id`` (least id of its class) and ``n_links`` (other documents of similarity at the threshold or more).

    A class is what links hold together. Equal texts are one member of the search, however many there are, and count as
    linked copies of each other. A text without words has no runs: it is linked to equal texts only. A null text is
    linked to nothing. Repeated rows are copies; null ids are carried; other columns are not looked at.
    """
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = plain.schema["doc_id"].dataType.simpleString()

    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches):
            sets = shingle_sets(batch.column("text").to_pylist())
            full = [sketch(s) if len(s) else None for s in sets]
            # A path hangs on all 32 bits; to compare two sketches 16 are enough.
            marks = [None if m is None else m.astype(np.uint16).tobytes() for m in full]
            paths = [None if m is None else _paths(places, m[None, :])[0] for m in full]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(marks, pa.binary()), pa.array(paths, pa.list_(pa.int64())),
                                              pa.array([s.nbytes for s in sets], pa.int64())], ["doc_id", "key", "sketch", "paths", "bytes"])

    places = first_places(runs_needed(threshold, missed), threshold)
    keyed = plain.filter(F.col("text").isNotNull()).select("doc_id", F.md5("text").alias("key"), "text")
    rows = keyed.mapInArrow(sketches, f"doc_id {kind}, key string, sketch binary, paths array<long>, bytes long")
    different = materialize(rows.groupBy("key").agg(
        F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.any_value("sketch").alias("sketch"), F.any_value("paths").alias("paths"), F.max("bytes").alias("bytes"),
    ).withColumn("node", F.monotonically_increasing_id()))
    sketched = different.filter(F.col("sketch").isNotNull()).select("node", "sketch", "paths")
    groups = components(candidate_links(sketched, threshold, bucket, depth)).withColumnRenamed("label", "group")
    found = groups.join(different.select("node", "key", "first_id", "copies", "bytes"), "node")
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / block, F.sum("bytes") / BLOCK_BYTES)).cast("int")
    wanted = found.drop("bytes").join(found.groupBy("group").agg(blocks.alias("blocks")), "group")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches):
            found = [s.tobytes() for s in shingle_sets(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("node", "group", "blocks", "copies")] + [pa.array(found, pa.binary())],
                                             ["node", "group", "blocks", "copies", "shingles"])

    # One row of each candidate text: that of its least id, once if the row itself is repeated. Null ids join as -1, and
    # the rows are dealt by what they are joined by, so taking one of each shuffles nothing more.
    def joined_by(df: DataFrame, name: str) -> DataFrame:
        return df.withColumn("joined_id", F.coalesce(name, F.lit(-1).cast(kind))).drop(name)

    texts = joined_by(wanted, "first_id").join(joined_by(keyed, "doc_id"), ["key", "joined_id"]).dropDuplicates(["key", "joined_id"])
    members = texts.mapInArrow(sets, "node long, group long, blocks int, copies long, shingles binary")
    own = F.pmod(F.xxhash64("node", F.lit(5)), F.col("blocks")).cast("int")
    paired = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    dealt = paired.select(F.xxhash64("group", low, high).alias("pair"), "node", F.when(low == high, 0).otherwise(F.col("own")).alias("own"),
                          F.when(low == high, 0).otherwise(1 + F.col("own") + F.col("other")).alias("other"), "copies", "shingles")
    compared = materialize(dealt.repartition("pair").sortWithinPartitions("pair").mapInArrow(_exact(threshold), "node long, links long, label long"))
    links = compared.groupBy("node").agg(F.sum("links").alias("links"))
    labels = components(compared.select(F.col("node").alias("a"), F.col("label").alias("b")))
    near = different.select("node", "key", "first_id", "copies").join(links, "node", "left").join(labels, "node", "left")
    labelled = near.withColumn("label", F.coalesce("label", "node"))
    classes = labelled.groupBy("label").agg(F.min("first_id").alias("class_id"))
    known = labelled.join(classes, "label").select("key", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    listed = plain.select("doc_id", F.md5("text").alias("key"))
    return listed.join(known, "key", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
