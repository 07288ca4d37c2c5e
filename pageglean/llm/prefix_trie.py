"""A trie of conversations by their turns.

A node is a prefix of turns. It is known by its depth and a 128-bit hash of the prefix: two sums of random values of
(turn, position), so that the hash of any prefix comes from sums alone and no conversation has to be held as a whole.
Conversations go on as strings of at most ``SEGMENT`` turns, and each string starts at the hash of what is before it.

A task inserts its strings, batch by batch, into a z-fast trie. Such a trie keeps only nodes that branch or end, in a hash
table under their handle: their prefix at the two-fattest depth of their edge, the one divisible by the highest power of
two. Where a string leaves the trie is found by a binary search over those depths. Then the edges are expanded to one row
per depth, and rows of the same prefix from all batches are added up, so a prefix that a third of the conversations share
costs a row per batch.

What belongs to a whole subtree is not summed over nodes but over members. Each node is owned by its smallest member; the
nodes that a conversation owns end its path, so sums of owned words and owned leaves over a node's members, taken by a second
pass through tries, give the sums over the nodes below it (``trie_nodes``).

Turns are taken by ``turn``, nulls first; those with the same turn by a hash of role and text. Null role and text are
empty. Rows without conversation id take no part; a repeated turn counts as often as it stands there. An empty table has no
node. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as Wd
from pyspark.sql import functions as F

from pageglean.llm.runs import changes, whole_groups
from pageglean.operators.numbering import numbered
from pageglean.session import materialize

# Turns of a conversation that one string holds.
SEGMENT = 1024
# Turns of the strings that go into one trie.
BATCH_TURNS = 1 << 15
# Conversation ids that are written together before they are hashed.
CHUNK_IDS = 4096


def two_fattest(low: int, high: int) -> int:
    """The number above ``low``, up to ``high``, that is divisible by the highest power of two."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


class Strings:
    """Strings of one batch: string ``i`` reaches from depth ``low[i]`` to ``high[i]`` and knows the hash of each of its prefixes."""

    def __init__(self, low: list[int], high: list[int], hashes: list[list[tuple[int, int]]]):
        self.low, self.high, self.hashes = low, high, hashes

    def prefix(self, i: int, depth: int) -> tuple[int, int, int]:
        return depth, *self.hashes[i][depth - self.low[i]]


class ZFastTrie:
    """Compacted nodes under their handles. Node ``k`` reaches from depth ``top[k]`` (excluded) to ``end[k]`` on string ``text[k]``."""

    def __init__(self, strings: Strings):
        self.strings, self.handles, self.roots = strings, {}, {}
        self.top, self.end, self.text, self.parent, self.children = [], [], [], [], []
        # The node at whose end each inserted string stops.
        self.stop: dict[int, int] = {}

    def _node(self, top: int, end: int, text: int, parent: int) -> int:
        self.top.append(top), self.end.append(end), self.text.append(text), self.parent.append(parent), self.children.append({})
        k = len(self.end) - 1
        if end > top:
            self.handles[self._handle(k)] = k
        return k

    def _handle(self, k: int) -> tuple[int, int, int]:
        return self.strings.prefix(self.text[k], two_fattest(self.top[k], self.end[k]))

    def _agree(self, i: int, k: int, low: int) -> int:
        """How deep string ``i``, which agrees with node ``k`` down to ``low``, agrees with it at all."""
        high = min(self.strings.high[i], self.end[k])
        while low < high:
            middle = (low + high + 1) // 2
            if self.strings.prefix(i, middle) == self.strings.prefix(self.text[k], middle):
                low = middle
            else:
                high = middle - 1
        return low

    def locate(self, i: int) -> tuple[int, int]:
        """The exit node of string ``i``, and the depth where it leaves the trie."""
        s = self.strings
        low, high = s.low[i], s.high[i]
        k = self.roots[s.prefix(i, low)]
        while low < high:
            f = two_fattest(low, high)
            found = self.handles.get(s.prefix(i, f))
            if found is None:
                high = f - 1
            else:
                k, low = found, self.end[found]
        depth = self._agree(i, k, self.top[k]) if self.end[k] > self.top[k] else self.end[k]
        if depth == self.end[k] and s.high[i] > depth:
            # The string may still leave inside the edge of a child, above the child's handle.
            child = self.children[k].get(s.prefix(i, depth + 1))
            if child is not None:
                return child, self._agree(i, child, depth + 1)
        return k, depth

    def insert(self, i: int) -> None:
        s = self.strings
        low, high = s.low[i], s.high[i]
        if s.prefix(i, low) not in self.roots:
            self.roots[s.prefix(i, low)] = self._node(low, low, i, -1)
        k, depth = self.locate(i)
        if depth < self.end[k]:
            k = self._split(k, depth)
        if high > depth:
            leaf = self._node(depth, high, i, k)
            self.children[k][s.prefix(i, depth + 1)] = leaf
            k = leaf
        self.stop[i] = k

    def _split(self, k: int, depth: int) -> int:
        """A new node at ``depth`` on the edge of node ``k``, which keeps what is below."""
        del self.handles[self._handle(k)]
        above, first = self.parent[k], self.strings.prefix(self.text[k], self.top[k] + 1)
        upper = self._node(self.top[k], depth, self.text[k], above)
        self.children[above][first] = upper
        self.top[k], self.parent[k] = depth, upper
        self.handles[self._handle(k)] = k
        self.children[upper][self.strings.prefix(self.text[k], depth + 1)] = k
        return upper


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64), pa.int64())


def _expanded(rows: dict[str, np.ndarray], weights: list[str]) -> pa.RecordBatch:
    """The nodes of the trie of whole strings, which lie one after another in ``rows``, an edge expanded to a row per depth."""
    conv, seg, depth = rows["conv"], rows["seg"], rows["depth"]
    starts = changes((conv, seg))
    sizes = np.diff(np.append(starts, len(conv)))

    def running(column: str, offset: str) -> np.ndarray:
        """Sums along each string, itself included, on top of what is before the string."""
        with np.errstate(over="ignore"):
            total = np.cumsum(rows[column].view(np.uint64))
            before = total[starts] - rows[column][starts].view(np.uint64)
            return total - np.repeat(before - rows[offset][starts].view(np.uint64), sizes)

    sums = [running("m1", "o1"), running("m2", "o2")]
    path = running("words", "words_before").view(np.int64)
    pairs = list(zip(sums[0].tolist(), sums[1].tolist()))
    # A string that begins a conversation has the root among its rows; others begin below their first row.
    begins = list(zip(rows["o1"][starts].view(np.uint64).tolist(), rows["o2"][starts].view(np.uint64).tolist()))
    low, high, hashes = [], [], []
    for start, size, begin in zip(starts.tolist(), sizes.tolist(), begins):
        whole = int(depth[start]) == 0
        low.append(int(depth[start]) - (not whole)), high.append(int(depth[start + size - 1]))
        hashes.append(pairs[start:start + size] if whole else [begin, *pairs[start:start + size]])
    trie = ZFastTrie(Strings(low, high, hashes))
    # Equal strings are inserted once.
    same: dict[tuple, int] = {}
    chosen = [same.setdefault((low[i], hashes[i][0], high[i], hashes[i][-1]), i) for i in range(len(low))]
    for i in same.values():
        trie.insert(i)
    n = len(trie.end)
    least, sums_of = np.full(n, np.iinfo(np.int64).max), np.zeros((len(weights), n), dtype=np.int64)
    stops = np.array([trie.stop[i] for i in chosen], dtype=np.int64)
    np.minimum.at(least, stops, conv[starts])
    for w, name in enumerate(weights):
        np.add.at(sums_of[w], stops, rows[name][starts])
    for k in sorted(range(n), key=trie.end.__getitem__, reverse=True):
        above = trie.parent[k]
        if above >= 0:
            least[above] = min(least[above], least[k])
            sums_of[:, above] += sums_of[:, k]
    owner, at = [], []
    for k in range(n):
        i = trie.text[k]
        # A root has a row of its own only at depth 0.
        first = trie.top[k] + (trie.end[k] > 0)
        base = int(starts[i]) - (low[i] + (low[i] > 0))
        if first <= trie.end[k]:
            at.append(np.arange(base + first, base + trie.end[k] + 1))
            owner.append(np.full(trie.end[k] + 1 - first, k))
    at, owner = np.concatenate(at), np.concatenate(owner)
    above = [sums[lane][at] - rows[f"m{lane + 1}"][at].view(np.uint64) for lane in (0, 1)]
    columns = [pa.array(depth[at]), _signed(sums[0][at]), _signed(sums[1][at]), _signed(above[0]), _signed(above[1]), pa.array(rows["words"][at]), pa.array(path[at]),
               pa.array(least[owner]), *(pa.array(sums_of[w][owner]) for w in range(len(weights)))]
    return pa.RecordBatch.from_arrays(columns, [*NODE, "least", *weights])


NODE = ("depth", "p1", "p2", "q1", "q2", "words", "path")


def fold_tries(turns: DataFrame, weights: list[str]) -> DataFrame:
    """Nodes with their least member and the sums of the members' ``weights``, which are the same on all rows of a conversation."""
    names = ["conv", "seg", "depth", "m1", "m2", "words", "o1", "o2", "words_before", *weights]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, names, ("conv", "seg"), BATCH_TURNS):
            yield _expanded(rows, weights)

    schema = ", ".join(f"{name} long" for name in (*NODE, "least", *weights))
    strings = turns.select(*names).repartition("conv", "seg").sortWithinPartitions("conv", "seg", "depth")
    found = strings.mapInArrow(fold, schema).groupBy("depth", "p1", "p2")
    return found.agg(*[F.max(c).alias(c) for c in NODE[3:]], F.min("least").alias("least"), *[F.sum(w).alias(w) for w in weights])


def _wrapped(values: Column, over=None) -> Column:
    """Sum of 64-bit numbers modulo 2^64."""
    low, high = F.sum(values.bitwiseAND(F.lit(0xFFFFFFFF))), F.sum(F.shiftright(values, 32))
    if over is not None:
        low, high = low.over(over), high.over(over)
    low, high = F.coalesce(low, F.lit(0)), F.coalesce(high, F.lit(0))
    return F.shiftleft(high + F.shiftright(low, 32), 32).bitwiseOR(low.bitwiseAND(F.lit(0xFFFFFFFF)))


def read_turns(conversations: DataFrame) -> DataFrame:
    """``conv``, ``turn``, a hash of role and text in two parts, and the words of the text; texts stay where they are read."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), F.xxhash64(role, text).alias("k1"),
        F.xxhash64(F.lit(1), text, role).alias("k2"), F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")).cast("long").alias("words"))
    return materialize(rows.withColumn("row", F.monotonically_increasing_id()))


def rebuild(turns: DataFrame, stride: int = 20, shared: int = 4) -> tuple[DataFrame, DataFrame]:
    """The conversations with their first turns taken from the one that begins their group of ids, and the turns of these.

    Of conversation c, crc32(c) modulo ``shared`` first turns are replaced by as many of conversation c - c % ``stride``, all
    if it has fewer, none if it is absent. The turns are ``conv``, ``depth`` from 1, ``m1``, ``m2`` and ``words``.
    """
    placed = numbered(turns, "conv", F.asc_nulls_first("turn"), "k1", "k2", "row").drop("turn", "row")
    convs = placed.groupBy("conv").agg(F.min("number").alias("first"), F.count(F.lit(1)).alias("n"))
    convs = materialize(convs.withColumn("cut", F.crc32(F.col("conv").cast("string").cast("binary")) % shared).withColumn(
        "base", F.col("conv") - F.col("conv") % stride))
    given = convs.select(F.col("conv").alias("base"), F.col("n").alias("given"))
    convs = materialize(convs.join(given, "base", "left").withColumn("taken", F.least("cut", F.coalesce("given", F.lit(0)))).drop("given", "n"))
    own = placed.join(convs.drop("base"), "conv").withColumn("pos", F.col("number") - F.col("first"))
    kept = own.filter(F.col("pos") >= F.col("cut")).withColumn("depth", F.col("pos") - F.col("cut") + F.col("taken") + 1)
    # At most ``shared`` - 1 turns of each conversation, for the ids of its group.
    heads = own.filter(F.col("pos") < shared - 1).select(F.col("conv").alias("base"), (F.col("pos") + 1).alias("depth"), "k1", "k2", "words")
    lent = heads.join(convs.select("base", "conv", "taken"), "base").filter(F.col("depth") <= F.col("taken"))
    columns = ("conv", "depth", "k1", "k2", "words")
    rebuilt = kept.select(*columns).unionByName(lent.select(*columns))
    return convs.select("conv"), rebuilt.select("conv", "depth", F.xxhash64("k1", "k2", "depth").alias("m1"), F.xxhash64("depth", "k2", "k1").alias("m2"), "words")


def as_strings(convs: DataFrame, turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The turns, with a row of depth 0 for every conversation, in strings ``seg`` that know the sums before them."""
    zero = F.lit(0).cast("long")
    roots = convs.select("conv", *[zero.alias(c) for c in ("depth", "m1", "m2", "words")])
    rows = turns.unionByName(roots).withColumn("seg", F.floor((F.greatest("depth", F.lit(1)) - 1) / segment))
    before = Wd.partitionBy("conv").orderBy("seg").rowsBetween(Wd.unboundedPreceding, -1)
    sizes = rows.groupBy("conv", "seg").agg(_wrapped(F.col("m1")).alias("m1"), _wrapped(F.col("m2")).alias("m2"), F.sum("words").alias("words"))
    starts = sizes.select("conv", "seg", _wrapped(F.col("m1"), before).alias("o1"), _wrapped(F.col("m2"), before).alias("o2"),
                          F.coalesce(F.sum("words").over(before), F.lit(0)).alias("words_before"))
    return materialize(rows.join(starts, ["conv", "seg"]))


def end_digests(convs: DataFrame, chunk: int = CHUNK_IDS) -> DataFrame:
    """SHA-256 of the ids, ascending and joined by commas, of the conversations (``conv``, ``depth``, ``p1``, ``p2``) that end at each node.

    Ids are sorted over the cluster and written in chunks where they lie. SHA-256 takes its input in order, so one task goes
    through the chunks of a node, but it never holds more than one.
    """
    key = ("depth", "p1", "p2")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids, done = None, [], []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in (*key, "conv"))):
                if row[:3] != node or len(ids) >= chunk:
                    if ids:
                        done.append((*node, ids[0], ",".join(map(str, ids))))
                    node, ids = row[:3], []
                ids.append(row[3])
            if done:
                yield _chunks(done)
                done = []
        if ids:
            yield _chunks([(*node, ids[0], ",".join(map(str, ids)))])

    def _chunks(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], [*key, "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, done = None, None, []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in (*key, "ids"))):
                if row[:3] == node:
                    state.update(b",")
                else:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = row[:3], hashlib.sha256()
                state.update(row[3].encode())
            if done:
                yield _digests(done)
                done = []
        if node is not None:
            yield _digests([(*node, state.hexdigest())])

    def _digests(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], [*key, "ends_sha256"])

    order = (*key, "conv")
    written = convs.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(write, "depth long, p1 long, p2 long, first long, ids string")
    dealt = written.repartition(*key).sortWithinPartitions(*key, "first")
    return dealt.mapInArrow(digest, "depth long, p1 long, p2 long, ends_sha256 string")


def trie_nodes(convs: DataFrame, turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row per node of the trie over all conversations, the root included.

    ``conv_id`` (its smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` (the words that would be read again if each member were read on its own, over the whole subtree) and
    ``ends_sha256`` of the members that end here.
    """
    key = ["depth", "p1", "p2"]
    strings = as_strings(convs, turns, segment)
    nodes = materialize(fold_tries(strings.withColumn("n_convs", F.lit(1).cast("long")), ["n_convs"]).withColumnRenamed("least", "conv_id"))
    children = nodes.filter(F.col("depth") > 0).groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(
        F.count(F.lit(1)).alias("n_children"))
    nodes = materialize(nodes.join(children, key, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))))
    # What each conversation owns: the words and leaves of the nodes whose smallest member it is.
    owned = nodes.groupBy(F.col("conv_id").alias("conv")).agg(F.sum("words").alias("owned"), F.count_if(F.col("n_children") == 0).alias("leaves"))
    whole = strings.groupBy("conv").agg(F.max("depth").alias("depth"), _wrapped(F.col("m1")).alias("p1"), _wrapped(F.col("m2")).alias("p2"), F.sum("words").alias("total"))
    scalars = materialize(whole.join(owned, "conv", "left").withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("owned", "leaves")}))
    below = fold_tries(strings.join(scalars.select("conv", "owned", "leaves", "total"), "conv"), ["owned", "leaves", "total"])
    below = below.select(*key, F.col("owned").alias("all_owned"), F.col("leaves").alias("n_leaves"), F.col("total").alias("all_total"))
    mine = scalars.select(F.col("conv").alias("conv_id"), "owned", "total")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    found = nodes.join(below, key).join(end_digests(scalars), key, "left").join(parents, ["depth", "q1", "q2"], "left").join(mine, "conv_id")
    # Words of all members from here on, less the words of the nodes here and below, each counted once.
    before = F.col("path") - F.col("words")
    saved = F.col("all_total") - F.col("all_owned") - (F.col("n_convs") - 1) * before + F.col("owned") - F.col("total")
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", saved.alias("saved_tokens"),
                        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, stride: int = 20, shared: int = 4, segment: int = SEGMENT) -> DataFrame:
    """The trie of the rebuilt conversations of a table ``conv_id``, ``turn``, ``role``, ``text``."""
    return trie_nodes(*rebuild(read_turns(conversations), stride, shared), segment)
