"""BPE encoding and decoding, with long unsplit text encoded in halves that are joined again like a tree.

White space never stands inside a token here, so texts are cut at it into words and every different word of a batch is
encoded once; a long text goes through in pieces that end at white space. A long run without a place to cut is brought to
its normal form and halved until the halves are short. The halves are encoded apart, on any executor, and neighbours are
joined: a window around the join is encoded again and grown until its tokens agree with the left half on one side and with
the right half on the other.

A run that holds a special token, or whose normal form is not final, is encoded as one piece.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageglean.llm.words import slices

# A run of more code points without white space is halved, and its halves are rows of their own.
HALVE_ABOVE = 1 << 15
# A text is gone through in pieces of about so many code points.
PIECE = 1 << 20
# Tokens on each side of a join in the first window.
FIRST_WINDOW = 8
# Words remembered by a task.
REMEMBERED = 200_000

_SPACES = re.compile("[ \t\n\v\f\r]+")
_MARK = "\x01"


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """The tokenizer of a file on this executor, without padding and truncation.

    A bare file name is looked up among the public tokenizers that are installed there.
    """
    from tokenizers import Tokenizer

    if "/" not in path:
        import public_tokenizers

        path = public_tokenizers.path(path)
    loaded = Tokenizer.from_file(path)
    loaded.no_padding()
    loaded.no_truncation()
    return loaded


@dataclass
class Encoded:
    """A text with its token ids and where each token stands in it."""

    text: str
    ids: list[int]
    begins: list[int]
    ends: list[int]


def encode(tok, text: str) -> Encoded:
    found = tok.encode(text, add_special_tokens=False)
    spots = found.offsets
    return Encoded(text, found.ids, [a for a, _ in spots], [b for _, b in spots])


def _letter(c: str) -> bool:
    return "a" <= c <= "z" or "A" <= c <= "Z"


def _edge(text: str, at: int) -> str | None:
    """What kind of place this is to cut (both tokens beside it being whole characters): ``free`` beside white space, ``inner`` deep in a run of plain letters, or none.

    Nothing is merged over a free edge. At an inner edge all that is cut is one word, so that only the merges next to
    the edge can differ from those of the whole.
    """
    if at in (0, len(text)) or text[at - 1] in " \t\n\v\f\r" or text[at] in " \t\n\v\f\r":
        return "free"
    near = text[max(0, at - 4):at + 1]
    return "inner" if len(near) == 5 and all(map(_letter, near)) else None


def join(tok, left: Encoded, right: Encoded) -> Encoded:
    """The encoding of both texts as one, made by encoding only a window around their join again.

    Tokens of byte-pair encoding are those of the whole text as soon as each two neighbours are those of some text
    around them. So the window may replace what is around the join if its first token is the left half's token there,
    and some later token but its last is the right half's token there. The window grows until this holds; at its
    largest it is the whole.
    """
    text, shift = left.text + right.text, len(left.text)
    width = FIRST_WINDOW
    while True:
        i, j = len(left.ids) - width, width - 1
        while i > 0 and (left.begins[i] < left.ends[i - 1] or _edge(text, left.begins[i]) is None):
            i -= 1
        begin = left.begins[i] if i > 0 else 0
        while j < len(right.ids) - 1 and (right.begins[j + 1] < right.ends[j] or _edge(text, right.ends[j] + shift) is None):
            j += 1
        end = right.ends[j] + shift if j < len(right.ids) - 1 else len(text)
        window = encode(tok, text[begin:end])
        begins, ends = [b + begin for b in window.begins], [e + begin for e in window.ends]
        keep, rest, meets = max(i, 0), None, False
        if i <= 0 or _edge(text, begin) == "free":
            meets = True
        elif window.ids and (window.ids[0], begins[0], ends[0]) == (left.ids[i], left.begins[i], left.ends[i]):
            meets = True
        if end == len(text):
            rest, stop = len(right.ids), len(window.ids)
        elif _edge(text, end) == "free":
            rest, stop = j + 1, len(window.ids)
        else:
            places = {(b + shift, e + shift, t): k for k, (t, b, e) in enumerate(zip(right.ids[:j + 1], right.begins, right.ends))}
            for n in range(len(window.ids) - 2, 0, -1):
                spot = (begins[n], ends[n], window.ids[n])
                if begins[n] >= max(shift, ends[n - 1]) and begins[n + 1] >= ends[n] and spot in places:
                    rest, stop = places[spot] + 1, n + 1
                    break
        if meets and rest is not None:
            return Encoded(
                text, left.ids[:keep] + window.ids[:stop] + right.ids[rest:], left.begins[:keep] + begins[:stop] + [b + shift for b in right.begins[rest:]],
                left.ends[:keep] + ends[:stop] + [e + shift for e in right.ends[rest:]])
        if begin == 0 and end == len(text):
            return window
        width *= 2


def halves(text: str, above: int = HALVE_ABOVE) -> list[str]:
    """The text in 2^k pieces of nearly equal length, none longer than ``above``."""
    depth = 0
    while len(text) > above << depth:
        depth += 1
    n = 1 << depth
    return [text[len(text) * i // n:len(text) * (i + 1) // n] for i in range(n)]


def joined(tok, pieces: list[Encoded]) -> Encoded:
    """Neighbours joined two by two, and these again, up to the whole text."""
    while len(pieces) > 1:
        pairs = [join(tok, pieces[i], pieces[i + 1]) for i in range(0, len(pieces) - 1, 2)]
        pieces = pairs + pieces[len(pieces) - len(pieces) % 2:]
    return pieces[0]


def splits_safely(tok, text: str) -> bool:
    """Whether the halves of a text may be encoded apart: no special token in it, and its normal form is final."""
    if any(t.content in text for t in tok.get_added_tokens_decoder().values()):
        return False
    normal = tok.normalizer.normalize_str(text) if tok.normalizer else text
    return len(normal) == len(text) and (text.isascii() or tok.normalizer is None or tok.normalizer.normalize_str(normal) == normal)


def normal_form(tok, run: str) -> str:
    """The normal form of a run, whose tokens are those of the run; the run itself where it has none that is final."""
    if tok.normalizer is None or splits_safely(tok, run):
        return run
    normal = tok.normalizer.normalize_str(run)
    return normal if splits_safely(tok, normal) and not any(t.content in run for t in tok.get_added_tokens_decoder().values()) else run


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """A long text in pieces that end at white space."""
    at = 0
    while len(text) - at > size:
        found = _SPACES.search(text, at + size)
        if found is None:
            break
        yield text[at:found.end()]
        at = found.end()
    yield text[at:]


class Words:
    """Encodes texts word by word and remembers the words: the ids of each, and its tokens, both joined by a blank."""

    def __init__(self, path: str):
        self.tok = tok = tokenizer(path)
        self.ids: dict[str, str] = {}
        self.tokens: dict[str, str] = {}
        self.bare: set[str] = set()  # words without tokens
        size = tok.get_vocab_size(with_added_tokens=True)
        self.number = [str(i) for i in range(size)]
        self.name = [tok.id_to_token(i) or "" for i in range(size)]
        marks = tok.encode(_MARK, add_special_tokens=False).ids
        self.mark = marks[0] if len(marks) == 1 else None

    def _put(self, word: str, ids: list[int]) -> None:
        self.ids[word] = " ".join([self.number[i] for i in ids])
        self.tokens[word] = " ".join([self.name[i] for i in ids])
        if not ids:
            self.bare.add(word)

    def learn(self, words: set[str]) -> None:
        """Encodes the words that are new: many in one text, a mark that is a token of its own between two of them."""
        if len(self.ids) > REMEMBERED:
            self.ids, self.tokens, self.bare = {}, {}, set()
        new = [w for w in words if w not in self.ids]
        groups = [new[i:i + 512] for i in range(0, len(new), 512)]
        between = f" {_MARK} "
        for group, found in zip(groups, self.tok.encode_batch_fast([between.join(g) for g in groups], add_special_tokens=False)):
            ids, at = found.ids, 0
            ends = [k for k, i in enumerate(ids) if i == self.mark] + [len(ids)] if self.mark is not None else []
            if len(ends) == len(group):
                for word, end in zip(group, ends):
                    self._put(word, ids[at:end])
                    at = end + 1
            else:  # the mark stands in one of the words
                for word in group:
                    self._put(word, self.tok.encode(word, add_special_tokens=False).ids)

    def words(self, text: str) -> list[str]:
        """The words of a text. Python also splits at four control characters that are no white space to a tokenizer."""
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return [w for w in _SPACES.split(text) if w]
        return text.split()

    def strings(self, words: list[str]) -> tuple[str, str]:
        """The ids and the tokens of words that are known, each joined by a blank."""
        if self.bare:
            words = [w for w in words if w not in self.bare]
        return " ".join(map(self.ids.__getitem__, words)), " ".join(map(self.tokens.__getitem__, words))

    def digest(self, words: list[str]) -> tuple[int, str, str]:
        """Number of tokens, hash of the ids and hash of the decoded text."""
        state = Digest(self.tok)
        state.add(*self.strings(words))
        return state.result()

    def digest_long(self, text: str, size: int = PIECE) -> tuple[int, str, str]:
        """The same of a text that is gone through piece by piece."""
        state = Digest(self.tok)
        for piece in pieces(text, size):
            words = self.words(piece)
            self.learn(set(words))
            state.add(*self.strings(words))
        return state.result()


class Digest:
    """Number of tokens, hash of the ids and hash of the decoded text, of strings that come one after another."""

    def __init__(self, tok):
        self.tok, self.n, self.ids, self.decoded = tok, 0, hashlib.sha256(), hashlib.sha256()
        # Without a decoder, decoding joins the tokens by blanks; one that does more needs all ids at once.
        self.held: list[int] | None = None if tok.decoder is None else []

    def add(self, ids: str, tokens: str) -> None:
        if not ids:
            return
        between = " " if self.n else ""
        self.n += ids.count(" ") + 1
        self.ids.update((between + ids).encode())
        if self.held is None:
            self.decoded.update((between + tokens).encode("utf-8", "replace"))
        else:
            self.held += map(int, ids.split())

    def result(self) -> tuple[int, str, str]:
        decoded = self.decoded.hexdigest() if self.held is None else _sha(self.tok.decode(self.held, skip_special_tokens=False))
        return self.n, self.ids.hexdigest(), decoded


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "replace")).hexdigest()


_DIGEST = "n_tokens long, ids_sha256 string, decoded_sha256 string"
_STRINGS = "text_key string, piece int, ids string, tokens string"


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", halve_above: int = HALVE_ABOVE) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of every whole text (null: empty).

    Texts are encoded where they are read, long ones piece by piece. Of texts that hold a run of more than ``halve_above``
    code points without white space, each different one is encoded once, as rows for its pieces and for the halves of its
    runs, so that a run of any length keeps many tasks busy; what comes back to a document is its digest. Repeated rows,
    empty tables and null ids are kept as they are; other columns are not looked at.
    """
    plain = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = plain.schema["doc_id"].dataType.simpleString()
    # Runs are tried at their beginning only, so the test is linear.
    unsplit = (F.length("text") > halve_above) & F.col("text").rlike(rf"(?:\A|[ \t\n\x0B\f\r])[^ \t\n\x0B\f\r]{{{halve_above + 1}}}")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(path)
        for batch in slices(batches):
            texts, rows, at = batch.column("text").to_pylist(), [], 0
            while at < len(texts):
                if len(texts[at]) > PIECE:
                    rows.append(words.digest_long(texts[at]))
                    at += 1
                    continue
                found, size = [], 0
                while at < len(texts) and size < PIECE and len(texts[at]) <= PIECE:
                    found.append(words.words(texts[at]))
                    size += len(texts[at])
                    at += 1
                words.learn(set().union(*found))
                rows += [words.digest(w) for w in found]
            columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    split = plain.filter(~unsplit).mapInArrow(digests, f"doc_id {kind}, {_DIGEST}")
    keyed = plain.filter(unsplit).select("doc_id", F.sha2("text", 256).alias("text_key"), "text")
    found = unsplit_digests(keyed.select("text_key", "text"), path, halve_above)
    whole = keyed.select("doc_id", "text_key").join(found, "text_key").drop("text_key")
    return split.unionByName(whole)


def unsplit_digests(texts: DataFrame, path: str, halve_above: int = HALVE_ABOVE) -> DataFrame:
    """Digests of texts ``text_key``, ``text`` with long runs; equal keys mean equal texts and give one row."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(path)

        def rows(text: str) -> Iterator[tuple[int, int, str]]:
            """Number of the piece, number of the half (-1 for a piece of whole words), and text."""
            n, short, size = 0, [], 0
            for word in words.words(text):
                if len(word) > halve_above:
                    if short:
                        yield n, -1, " ".join(short)
                        n, short, size = n + 1, [], 0
                    run = normal_form(words.tok, word)
                    for k, half in enumerate(halves(run, halve_above) if splits_safely(words.tok, run) else [run]):
                        yield n, k, half
                    n += 1
                    continue
                short.append(word)
                size += len(word) + 1
                if size > PIECE:
                    yield n, -1, " ".join(short)
                    n, short, size = n + 1, [], 0
            if short or not n:
                yield n, -1, " ".join(short)

        for batch in batches:
            for key, text in zip(batch.column("text_key").to_pylist(), batch.column("text").to_pylist()):
                made = list(rows(text))
                columns = [pa.array([key] * len(made)), *(pa.array([r[k] for r in made], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.string())))]
                yield pa.RecordBatch.from_arrays(columns, ["text_key", "piece", "half", "text"])

    def encode_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(path)
        for batch in batches:
            found = []
            for text in batch.column("text").to_pylist():
                split = text.split(" ") if text else []
                words.learn(set(split))
                found.append(words.strings(split))
            yield pa.RecordBatch.from_arrays([batch.column("text_key"), batch.column("piece"), *(pa.array([f[k] for f in found], pa.string()) for k in (0, 1))],
                                             ["text_key", "piece", "ids", "tokens"])

    def encode_halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path)
        for batch in batches:
            found = [encode(tok, t) for t in batch.column("text").to_pylist()]
            numbers = [pa.array([getattr(e, n) for e in found], pa.list_(pa.int32())) for n in ("ids", "begins", "ends")]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("text_key", "piece", "half", "text")] + numbers,
                                             ["text_key", "piece", "half", "text", "ids", "begins", "ends"])

    def concatenate(key: tuple, table: pa.Table) -> pa.Table:
        tok = tokenizer(path)
        rows = sorted(table.to_pylist(), key=lambda r: r["half"])
        ids = joined(tok, [Encoded(r["text"], r["ids"], r["begins"], r["ends"]) for r in rows]).ids
        return pa.table({"text_key": [key[0].as_py()], "piece": pa.array([key[1].as_py()], pa.int32()), "ids": [" ".join(map(str, ids))],
                         "tokens": [" ".join(tok.id_to_token(i) or "" for i in ids)]})

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, key, state = tokenizer(path), None, None

        def row(key: str, state: Digest) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in (key, *state.result())], ["text_key", "n_tokens", "ids_sha256", "decoded_sha256"])

        for batch in batches:
            for name, ids, tokens in zip(*(batch.column(c).to_pylist() for c in ("text_key", "ids", "tokens"))):
                if name != key:
                    if key is not None:
                        yield row(key, state)
                    key, state = name, Digest(tok)
                state.add(ids, tokens)
        if key is not None:
            yield row(key, state)

    once = texts.groupBy("text_key").agg(F.any_value("text").alias("text"))
    cuts = once.mapInArrow(cut, "text_key string, piece int, half int, text string").repartition("text_key", "piece", "half")
    coded = cuts.filter("half >= 0").mapInArrow(encode_halves, "text_key string, piece int, half int, text string, ids array<int>, begins array<int>, ends array<int>")
    runs = coded.groupBy("text_key", "piece").applyInArrow(concatenate, _STRINGS)
    strings = cuts.filter("half < 0").mapInArrow(encode_words, _STRINGS).unionByName(runs)
    # The pieces of a text go through one task in order, one at a time.
    return strings.repartition("text_key").sortWithinPartitions("text_key", "piece").mapInArrow(digests, f"text_key string, {_DIGEST}")
