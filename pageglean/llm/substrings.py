"""Substring dedup by prefix-partitioned suffix trees, over words.

A run of words is removed where all of it also stands in a document with a smaller id. What can repeat is found first:
every window of 13 words has an anchor, the five words in it of least hash, and equal windows have equal anchors, so
only anchors that two different texts share go on. The suffixes that reach a window from such an anchor are dealt to
tasks by the anchor's words, their prefix, which splits them into groups that fit in memory; a prefix that too many
texts share is made longer: equal stretches around it are looked at once, window by window. The suffixes of a group are
ranked by prefix doubling, which gives the nodes of the group's suffix tree by depth. A node 13 words deep with several
leaves is a repeat; runs of such nodes are the maximal repeats, and the least document below a node keeps its words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageglean.llm import words as W
from pageglean.llm.jaccard_join import _groups
from pageglean.session import materialize

WINDOW = 13
PREFIX = 5
# A prefix in more texts than this is extended to the whole stretch that its windows cover, and to these windows.
GROUP = 2048


def anchors(hashes: np.ndarray, window: int = WINDOW, prefix: int = PREFIX) -> tuple[np.ndarray, np.ndarray]:
    """For each window of a text the place of its anchor, and for each place the hash of the words from there.

    The anchor is the first of the least hashes in the window.
    """
    grams = W.window_hashes(hashes, prefix)
    if len(hashes) < window:
        return np.zeros(0, dtype=np.int64), grams
    spans = np.lib.stride_tricks.sliding_window_view(grams, window - prefix + 1)
    return spans.argmin(axis=1) + np.arange(len(spans)), grams


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """Row, bytes and word hashes of each text of a batch."""
    texts = batch.column("text").to_pylist()
    hashes, begins = W.word_hashes(texts)
    for i, text in enumerate(texts):
        yield i, W.encoded(text), hashes[begins[i]:begins[i + 1]]


def _kept_sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _rank(values: np.ndarray, later: np.ndarray) -> np.ndarray:
    """Ranks of pairs of ranks."""
    return np.unique(values * (later.max() + 1) + later, return_inverse=True)[1] if len(values) else values


def deep_nodes(ids: np.ndarray, depth: int = WINDOW) -> np.ndarray:
    """The node at this depth on the way to each suffix, by prefix doubling: suffixes with equal first words share it.

    The last ``depth - 1`` suffixes are shorter and have none.
    """
    length, ranks = 1, {1: ids}
    while length * 2 <= depth:
        r = ranks[length]
        ranks[length * 2] = _rank(r[:len(r) - length], r[length:])
        length *= 2
    rest = depth - length
    nodes, reached = ranks[length], length
    for step in sorted(ranks, reverse=True):
        while rest >= step:
            tail = ranks[step][reached:]
            n = min(len(nodes), len(tail))
            nodes = _rank(nodes[:n], tail[:n])
            reached, rest = reached + step, rest - step
    return nodes


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


_WHO = ["doc_id", "text_key"]


def _base(plain: DataFrame, window: int) -> DataFrame:
    """Per document: number of words, hash of all words, and its different anchors."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches):
            sizes, shas, found = [], [], []
            for _, blob, hashes in _texts(batch):
                places, grams = anchors(hashes, window)
                sizes.append(len(hashes))
                shas.append(_kept_sha(blob.split()))
                found.append(np.unique(grams[np.unique(places)]).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(sizes, pa.int64()), pa.array(shas, pa.string()),
                                              pa.array(found, pa.list_(pa.int64()))], [*_WHO, "n_words", "sha", "anchors"])

    return plain.mapInArrow(measure, "doc_id long, text_key long, n_words long, sha string, anchors array<long>")


def _segments(flagged: DataFrame, window: int, key: bool) -> DataFrame:
    """What the flagged anchors of each text reach: ``prefix``, the document, the first windows, and the words.

    One row per anchor and different words. With ``key``, a hash of anchor and words, ``segment``, stands in place of the prefix.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, 128):
            rows: list[tuple] = []
            who = [batch.column(c).to_pylist() for c in _WHO]
            wanted = batch.column("wanted")
            for i, blob, hashes in _texts(batch):
                places, grams = anchors(hashes, window)
                flags = np.isin(grams.view(np.int64)[places], wanted[i].values.to_numpy(zero_copy_only=False))
                # Windows of one anchor stand together.
                change = np.flatnonzero(np.diff(places)) + 1
                starts, ends = np.concatenate([[0], change]), np.concatenate([change, [len(places)]])
                kept = flags[starts] if len(places) else np.zeros(0, dtype=bool)
                starts, ends = starts[kept] if len(places) else starts[:0], ends[kept] if len(places) else ends[:0]
                if not len(starts):
                    continue
                parts, keys = blob.split(), grams.view(np.int64)[places[starts]]
                # A text that repeats itself reaches the same words from many places; they are one suffix with many starts.
                places_of: dict[tuple, list[int]] = {}
                for a, b, at in zip(starts.tolist(), ends.tolist(), keys.tolist()):
                    places_of.setdefault((at, b" ".join(parts[a:b + window - 1])), []).append(a)
                rows += [(hashlib.sha256(b"%d " % at + words).digest() if key else at, who[0][i], who[1][i], found, words) for (at, words), found in places_of.items()]
            for at in range(0, len(rows), 5000):
                columns = list(zip(*rows[at:at + 5000]))
                kinds = (pa.binary() if key else pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.binary())
                names = ["segment" if key else "prefix", *_WHO, "starts", "words"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    prefix = "segment binary" if key else "prefix long"
    return flagged.mapInArrow(cut, f"{prefix}, doc_id long, text_key long, starts array<int>, words binary")


def _windows(segments: DataFrame, window: int) -> DataFrame:
    """The windows of different segments, by hash, each with its place in the segment."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, 2048):
            rows, hashes, at = [], [], []
            for i, words in enumerate(batch.column("words").to_pylist()):
                parts = words.split()
                for a in range(len(parts) - window + 1):
                    rows.append(i)
                    hashes.append(hashlib.sha256(b" ".join(parts[a:a + window])).digest())
                    at.append(a)
            taken = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.binary()), batch.column("segment").take(taken), batch.column("first").take(taken),
                                              pa.array(at, pa.int32())], ["window", "segment", "first", "at"])

    return segments.mapInArrow(cut, "window binary, segment binary, first long, at int")


def _tree_repeats(window: int):
    """Goes through groups of suffixes and gives the runs of windows that a smaller document has too."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _groups(batches, ["prefix"]):
            doc = batch.column("doc_id").to_numpy()
            blobs = batch.column("words").to_pylist()
            data = b"\n".join(blobs)
            spans = W.spans(data)
            ids = np.unique(W.span_hashes(data, *spans), return_inverse=True)[1]
            row = np.searchsorted(np.cumsum([len(b) + 1 for b in blobs]), spans[0], side="right")
            nodes = deep_nodes(ids, window)
            # A suffix counts where its whole window lies in its own row.
            inside = np.flatnonzero(row[:len(nodes)] == row[window - 1:window - 1 + len(nodes)])
            node, owner = nodes[inside], doc[row[inside]]
            least = np.full(int(node.max()) + 1 if len(node) else 0, np.iinfo(np.int64).max)
            np.minimum.at(least, node, owner)
            flags = np.zeros(len(ids) + 1, dtype=bool)
            flags[inside] = least[node] < owner
            # A gap of at least 12 words without a flag lies between two rows, so runs never join.
            a, b = _runs(flags)
            first = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(blobs)))])
            at = row[a]
            columns = [batch.column(c).take(pa.array(at)) for c in (*_WHO, "starts")] + [
                pa.array((a - first[at]).astype(np.int32)), pa.array((b - first[at]).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, [*_WHO, "starts", "begin", "end"])

    return find


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` of every document.

    Removed is each word of a window of words that also starts in a document with a smaller id; windows are judged on
    the input. Documents of equal text are searched once, for the one of least id; all windows of the others repeat. A
    null text has no words; a document without id keeps all words and takes none from others; repeated rows take none
    from each other. Other columns are not looked at.
    """
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn(
        "text_key", F.xxhash64("text"))
    base = materialize(_base(plain, window))
    first = base.filter(F.col("doc_id").isNotNull()).groupBy("text_key", "sha").agg(F.min("doc_id").alias("first_id"))
    spread = base.filter(F.col("doc_id").isNotNull()).select(*_WHO, F.explode("anchors").alias("prefix"))
    shared = materialize(spread.groupBy("prefix").agg(F.min("text_key").alias("a"), F.max("text_key").alias("b"), F.count(F.lit(1)).alias("n")).filter(
        F.col("a") < F.col("b")).select("prefix", (F.col("n") > group).alias("long")))
    leading = base.join(first, ["text_key", "sha"]).filter(F.col("doc_id") == F.col("first_id")).select(*_WHO).distinct()
    flagged = materialize(spread.join(shared, "prefix").groupBy(*_WHO).agg(
        F.collect_set(F.when(~F.col("long"), F.col("prefix"))).alias("short"), F.collect_set(F.when(F.col("long"), F.col("prefix"))).alias("long")).join(
        leading, _WHO, "left_semi"))

    def texts_with(column: str) -> DataFrame:
        some = flagged.filter(F.size(column) > 0).select(*_WHO, F.col(column).alias("wanted"))
        return plain.join(some, _WHO).select(*_WHO, "text", "wanted").dropDuplicates(_WHO)

    suffixes = _segments(texts_with("short"), window, False).repartition("prefix").sortWithinPartitions("prefix")
    found = suffixes.mapInArrow(_tree_repeats(window), "doc_id long, text_key long, starts array<int>, begin int, end int")
    if not shared.filter("long").isEmpty():
        # A prefix in many texts is mostly followed by the same words: equal ones are one segment, which is cut into windows once.
        reached = _segments(texts_with("long"), window, True)
        segments = reached.groupBy("segment").agg(F.min("doc_id").alias("first"), F.any_value("words").alias("words"))
        windows = _windows(segments, window)
        least = windows.groupBy("window").agg(F.min("first").alias("least"))
        known = windows.join(least, "window").groupBy("segment").agg(F.collect_list(F.struct("at", "least")).alias("known"))
        deep = reached.select("segment", *_WHO, "starts").join(known, "segment").withColumn(
            "at", F.array_sort(F.transform(F.filter("known", lambda k: k["least"] < F.col("doc_id")), lambda k: k["at"]))).filter(F.size("at") > 0)
        # Windows that follow each other make a run.
        begins = F.filter("at", lambda a: ~F.array_contains("at", a - 1))
        ends = F.filter("at", lambda a: ~F.array_contains("at", a + 1))
        runs = deep.select(*_WHO, "starts", F.explode(F.arrays_zip(begins.alias("begin"), ends.alias("last"))).alias("run"))
        found = found.unionByName(runs.select(*_WHO, "starts", F.col("run.begin").alias("begin"), (F.col("run.last") + 1).alias("end")))
    lists = found.groupBy(*_WHO).agg(F.collect_list(F.struct("starts", "begin", "end")).alias("runs"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches):
            removed, shas = [], []
            for text, runs in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist()):
                words = W.encoded(text).split()
                turns = np.zeros(len(words) + 1, dtype=np.int64)
                for r in runs:
                    starts = np.array(r["starts"])
                    np.add.at(turns, starts + r["begin"], 1)
                    np.add.at(turns, starts + r["end"] + window - 1, -1)
                gone = np.cumsum(turns[:-1]) > 0
                removed.append(int(gone.sum()))
                shas.append(_kept_sha([w for w, g in zip(words, gone.tolist()) if not g]))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in _WHO], pa.array(removed, pa.int64()), pa.array(shas, pa.string())], [*_WHO, "gone", "kept"])

    changed = plain.join(lists, _WHO).select(*_WHO, "text", "runs").dropDuplicates(_WHO).mapInArrow(keep, "doc_id long, text_key long, gone long, kept string")
    known = base.select(*_WHO, "n_words", "sha").join(first, ["text_key", "sha"], "left").join(changed, _WHO, "left")
    copy = (F.col("first_id") < F.col("doc_id")) & (F.col("n_words") >= window)
    return known.select("doc_id", "n_words", F.when(copy, F.col("n_words")).otherwise(F.coalesce("gone", F.lit(0))).cast("long").alias("n_removed"),
                        F.when(copy, F.lit(_kept_sha([]))).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"))
