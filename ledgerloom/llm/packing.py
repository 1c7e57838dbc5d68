"""Retrieval packing: fixed token windows filled with lexically similar documents.

Documents are tokenised once and written. Token document frequencies over all documents
(one count per vocabulary entry) give the BM25 weights. Each task then reads its rows in
shards of about ``SHARD_TOKENS`` tokens, builds a BM25 inverted index over the shard's
pieces and fills windows: a seed, then its best unused neighbours, the last one cut to fit;
the cut-off rest seeds the next window, by the ids it holds. A document longer than a window
first fills whole windows by itself, whether or not another window is open. The window open at the end of a task is cut into powers of two, so
nothing is padded.

Of pieces with equal BM25 scores the earlier one comes first; which of them make the last
places of one search is left open, but the same at every run. Every id lies in exactly one piece. Null text is an empty document of one closing id.
Sequence ids are unique across tasks and the same when a task runs again. Repeated rows are
packed as often as they occur; only ``doc_id`` and ``text`` are read. Empty input gives no
rows.
"""

from __future__ import annotations

import os
import string
from array import array
from collections.abc import Iterator
from typing import NamedTuple
from unicodedata import normalize

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import blocks, text_slices

WINDOW = 4096
SHARD_TOKENS = 1 << 21
COMMON = 4  # a term held by more than 1/COMMON of a shard's pieces has a full row of weights
NEIGHBOURS = 16  # taken from one search at least; a window that needs more searches again
K1, B = 1.2, 0.75
CACHED_WORDS = 300_000  # of each of two generations
BLOCK = 1 << 19  # characters encoded at once; a task holds some 50 bytes for each
SEQUENCE_BITS = 40  # sequences a task may number

_PUNCTUATION = string.punctuation.encode()
_MARK, _LETTER = (
    np.isin(np.arange(256), list(letters.encode()))
    for letters in (string.punctuation, string.ascii_letters)
)
_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # the first n bytes
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


class _ByteLetters(dict):
    """The vocabulary's spelling of a character: one printable letter for each UTF-8 byte.

    Fixed values: bytes that are printable in Latin-1 stand for themselves, the others for
    the characters from 256 on, in order.
    """

    def __init__(self):
        printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
        others = iter(range(256, 512))
        self.bytes = [chr(b) if b in printable else chr(next(others)) for b in range(256)]

    def __missing__(self, code: int) -> str:
        self[code] = spelt = "".join(self.bytes[b] for b in chr(code).encode())
        return spelt


def _alike(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of one of each value, and for every value which of them it equals.

    Any place will do, so the sort need not be stable, as that of ``np.unique`` is.
    """
    order = np.argsort(values)
    new = np.diff(values[order], prepend=values[order[:1]] + np.uint64(1)) != 0
    kind = np.empty(len(values), np.int64)
    kind[order] = np.cumsum(new) - 1
    return order[new], kind


def _by_token(token: np.ndarray, terms: int) -> np.ndarray:
    """Stable order by token; 16-bit numbers are put in order without comparisons."""
    return np.argsort(token.astype(np.uint16) if terms <= 1 << 16 else token, kind="stable")


def _plain(text: str) -> str:
    """Blanks for line breaks; lower case where that changes no ids."""
    try:
        text.encode("latin-1")  # no marks that could join a letter before it is lower-cased
        text = text.lower()
    except UnicodeEncodeError:
        pass
    return text.replace("\n", " ")


def _ends_in_letter(stem: bytes) -> bool:
    """Some letters end in a mark when normalised, which joins what follows."""
    if stem[-1:].isascii():
        return stem[-1:].isalpha()
    return normalize("NFC", stem.decode()[-1:]).lower().isalpha()


class Encoder(dict):
    """Token ids of texts, word by word; as a dict, those of the words met so far.

    The vocabulary's own splitting never joins characters across a blank or line break, so
    ids of a text are those of its blank-separated words. In a block of texts equal words are
    found in numpy, by their first 16 bytes and length, and looked up once by their UTF-8
    bytes; longer words one by one. Words met again move on when the memory is full, the others are forgotten.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings are ordinary text
        self.model = self.tokenizer.model
        self.letters = _ByteLetters()
        self.earlier: dict[bytes, bytes] = {}

    def _spelt(self, word: str) -> str | None:
        """How the model spells a word of letters alone, which is one part to it.

        For words beyond ASCII, and only of scripts whose letters all versions of the character tables agree on. A
        capital sigma is lower-cased by its place in Python, but not by the vocabulary.
        """
        if not word.isalpha():
            return None
        if max(word) > "\u052f" or "\u03a3" in word:
            return None
        low = normalize("NFC", word).lower()
        return low.translate(self.letters) if low.isalpha() else None

    def __missing__(self, word: bytes) -> bytes:
        """Words, in UTF-8, of letters alone go straight to the model, others through
        normalisation and splitting, too. Closing ASCII punctuation after a letter is a part
        of its own."""
        found = self.earlier.get(word)
        if found is None:
            if word.isalpha():  # ASCII letters alone
                found = self._direct(word.lower().decode())
            else:
                stem = word.rstrip(_PUNCTUATION)
                if len(stem) < len(word) and _ends_in_letter(stem):
                    found = self[stem] + self[word[len(stem) :]]
                else:
                    text = word.decode()
                    spelt = self._spelt(text)
                    found = self._direct(spelt) if spelt else self._split(text)
        self[word] = found
        return found

    def __contains__(self, word: object) -> bool:
        """Whether a word's ids are known, by itself or by the parts it is cut into."""
        word = word.encode() if isinstance(word, str) else word
        stem = word.rstrip(_PUNCTUATION)
        known = super().__contains__
        return known(word) or stem != word and known(stem) and known(word[len(stem) :])

    def _direct(self, spelt: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(spelt)]).tobytes()

    def _split(self, word: str) -> bytes:
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def ids(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Unsigned 32-bit ids of all texts in a row, and how many each text has."""
        out, sizes = [np.zeros(0, "<u4")], np.zeros(len(texts), np.int64)
        for a, b in blocks([len(t or "") for t in texts], BLOCK):
            plain = [_plain(t or "") for t in texts[a:b]]
            # A longer text is a block of its own and goes through in slices.
            runs = [[s] for s in text_slices(plain[0])] if b - a == 1 else [plain]
            for run in runs:
                ids, n = self._block(run)
                out.append(ids)
                sizes[a:b] += n
        return np.concatenate(out), sizes

    def _block(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self) > CACHED_WORDS:
            self.earlier = dict(self)
            self.clear()
        encoded = [t.encode() for t in texts]
        data = b" ".join(encoded) + b" " * 17  # words are read 16 bytes at a time
        blank = np.frombuffer(data, np.uint8) == 32
        edges = np.diff(blank.view(np.int8), prepend=1)
        starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
        # One closing mark after an ASCII letter is a part of its own: the word is cut there,
        # and is looked up as the same word with or without it.
        codes = np.frombuffer(data, np.uint8)
        cut = ends[_MARK[codes[ends - 1]] & _LETTER[codes[ends - 2]] & (ends - starts > 1)] - 1
        starts, ends = np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))
        lengths = ends - starts
        eights = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
        low = eights[starts] & _BYTES[np.minimum(lengths, 8)]
        high = eights[starts + 8] & _BYTES[np.clip(lengths - 8, 0, 8)]
        mark = (low * _ODD ^ (high + lengths.astype(np.uint64))) * _MIX
        mark ^= mark >> np.uint64(29)
        first, word = _alike(mark)
        # Equal marks are words only if all they stand for is equal.
        same = first[word]
        own = (lengths > 16) | (low != low[same]) | (high != high[same]) | (lengths != lengths[same])
        alone = np.flatnonzero(own)
        word[alone] = len(first) + np.arange(len(alone))
        at = np.concatenate([first, alone])
        spans = zip(starts[at].tolist(), ends[at].tolist())
        found = [self[data[i:j]] for i, j in spans]
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), "<u4")
        each = size[word]
        before = np.concatenate([[0], np.cumsum(each)])
        place = np.repeat((np.cumsum(size) - size)[word] - before[:-1], each)
        ids = flat[place + np.arange(len(place))]
        text_at = np.cumsum([0] + [len(e) + 1 for e in encoded])
        return ids, np.diff(before[np.searchsorted(starts, text_at)])


def tokenise(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """(doc_id, ids, found): ids are little-endian unsigned 32-bit, closed by ``end_id``.

    Each task adds a row without ids at its end: ``found`` holds how many of its documents
    hold each token, as 64-bit integers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer_path)
        terms = max(encoder.tokenizer.get_vocab_size(), end_id + 1)
        found = np.zeros(terms, np.int64)
        small = np.uint32 if 500 * terms < 1 << 32 else np.uint64
        kind = None
        names = ["doc_id", "ids", "found"]
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids, sizes = encoder.ids(part["text"].to_pylist())
                ids = np.insert(ids, np.cumsum(sizes), end_id)
                ends = np.concatenate([[0], np.cumsum(sizes + 1)])
                for a, b in blocks((sizes + 1).tolist(), 1 << 22):
                    own = ids[ends[a] : ends[b]]
                    # At most 500 documents: 32 bits hold place and token.
                    held = np.repeat(np.arange(b - a, dtype=small), sizes[a:b] + 1) * small(terms)
                    held += own
                    held.sort()
                    held = held[np.diff(held, prepend=np.iinfo(small).max) != 0] % small(terms)
                    found += np.bincount(held, minlength=terms)
                    offsets = ((ends[a : b + 1] - ends[a]) * 4).astype(np.int32)
                    rows = pa.Array.from_buffers(
                        pa.binary(),
                        b - a,
                        [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(own.tobytes())],
                    )
                    columns = [part["doc_id"].slice(a, b - a), rows, pa.nulls(b - a, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=names)
        if kind is not None:
            counts = pa.array([found.tobytes()], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, kind), pa.nulls(1, pa.binary()), counts], names=names
            )

    schema = docs.select("doc_id").schema.add("ids", "binary").add("found", "binary")
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def document_frequencies(tokens: DataFrame) -> tuple[np.ndarray, int, float]:
    """Documents per token id, documents, and mean tokens of a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = None
        for batch in batches:
            for found in batch["found"]:
                counts = np.frombuffer(found.as_buffer(), "<i8")
                seen = counts.copy() if seen is None else seen + counts
        if seen is not None:
            at = np.flatnonzero(seen)
            yield pa.RecordBatch.from_pydict({"token": at, "n": seen[at]})

    # One row per vocabulary entry at most.
    rows = (
        tokens.filter("found IS NOT NULL")
        .select("found")
        .mapInArrow(run, "token long, n long")
        .groupBy("token")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    whole = tokens.agg(F.count("ids"), F.avg(F.octet_length("ids") / 4)).first()
    out = np.zeros(int(rows["token"].max()) + 1 if len(rows) else 1, np.int64)
    out[rows["token"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return out, whole[0], whole[1] or 1.0


class ShardIndex:
    """BM25 inverted index over the pieces of one shard."""

    def __init__(self, pieces: list[np.ndarray], idf: np.ndarray, mean: float):
        n, terms = len(pieces), len(idf)
        lengths = np.array([len(p) for p in pieces], np.int64)
        keys = np.repeat(np.arange(n, dtype=np.int64), lengths) * terms
        keys += np.concatenate(pieces).astype(np.int64)
        keys, tf = np.unique(keys, return_counts=True)
        piece, token = np.divmod(keys, terms)
        norm = K1 * (1 - B + B * lengths[piece] / mean)
        weight = idf[token] * tf * (K1 + 1) / (tf + norm)
        # By piece, for taking a seed's terms.
        self.rows = np.searchsorted(piece, np.arange(n + 1))
        self.row_token = token
        # By token: the postings.
        order = _by_token(token, terms)
        self.post_piece, self.post_weight = piece[order], weight[order]
        found = np.bincount(token, minlength=terms)
        self.post_at = np.concatenate([[0], np.cumsum(found)])
        # Most of a seed's postings are those of common terms, which add up faster as rows:
        # at most COMMON times the postings they stand for.
        common = np.flatnonzero(found > n / COMMON)
        self.common_row = np.full(terms, -1)
        self.common_row[common] = np.arange(len(common))
        self.common = np.zeros((len(common), n))
        row = self.common_row[token]
        self.common[row[row >= 0], piece[row >= 0]] = weight[row >= 0]
        self.n = n

    def terms(self, piece: int) -> np.ndarray:
        """The piece's distinct tokens."""
        return self.row_token[self.rows[piece] : self.rows[piece + 1]]

    def neighbours(self, seed: int, unused: np.ndarray, wanted: int) -> np.ndarray:
        """Unused pieces that share a term with the seed, best first."""
        return self.search(self.terms(seed), unused, wanted)

    def search(self, terms: np.ndarray, unused: np.ndarray, wanted: int) -> np.ndarray:
        """Unused pieces by their BM25 score for all of the distinct terms, best first."""
        row = self.common_row[terms]
        scores = self.common[row[row >= 0]].sum(0)
        rare = terms[row < 0]
        start = self.post_at[rare]
        sizes = self.post_at[rare + 1] - start
        at = np.arange(sizes.sum()) + np.repeat(start - np.cumsum(sizes) + sizes, sizes)
        scores += np.bincount(self.post_piece[at], self.post_weight[at], self.n)
        scores *= unused
        if wanted < self.n:
            best = np.argpartition(scores, -wanted)[-wanted:]
        else:
            best = np.arange(self.n)
        best = best[scores[best] > 0]
        return best[np.lexsort((best, -scores[best]))]


class Unused:
    """The pieces of a shard that lie in no window yet.

    The index is built anew whenever half of its pieces are used, and one search returns what
    the open window has room for, so that short pieces do not make searching quadratic.
    """

    def __init__(self, pieces: list[np.ndarray], idf: np.ndarray, mean: float):
        self.pieces, self.idf, self.mean = pieces, idf, mean
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        # Long pieces seed first: short ones then fill what they leave.
        self.order = iter(np.argsort(-self.sizes, kind="stable").tolist())
        self.left, self.tokens = len(pieces), int(self.sizes.sum())
        self._index(np.arange(len(pieces)))

    def _index(self, members: np.ndarray) -> None:
        self.members = members
        self.unused = np.ones(len(members), bool)
        self.place = np.full(len(self.pieces), -1)
        self.place[members] = np.arange(len(members))
        if len(members):
            self.index = ShardIndex([self.pieces[m] for m in members], self.idf, self.mean)

    def _is_unused(self, piece: int) -> bool:
        return self.place[piece] >= 0 and self.unused[self.place[piece]]

    def terms(self, piece: int) -> np.ndarray:
        return self.index.terms(self.place[piece])

    def take(self, piece: int) -> None:
        self.unused[self.place[piece]] = False
        self.left -= 1
        self.tokens -= int(self.sizes[piece])
        if self.left and 2 * self.left < len(self.members):
            self._index(self.members[self.unused])

    def longest(self) -> int:
        return next(p for p in self.order if self._is_unused(p))

    def search(self, terms: np.ndarray, room: int) -> list[int]:
        """The terms' best neighbours, about as many as ``room`` tokens hold."""
        wanted = max(NEIGHBOURS, -(-room * self.left // max(self.tokens, 1)))
        return self.members[self.index.search(terms, self.unused, wanted)].tolist()


class Doc(NamedTuple):
    doc_id: object
    ids: np.ndarray


class Windows:
    """Collects pieces (document, start, length) into windows."""

    def __init__(self, window: int, first_sequence: int):
        self.window, self.sequence = window, first_sequence
        self.open: list[tuple[Doc, int, int]] = []
        self.filled = 0
        self.done: list[tuple[Doc, int, int, int, int]] = []  # and sequence, offset

    def _close(self, pieces: list[tuple[Doc, int, int]]) -> None:
        offset = 0
        for doc, start, length in pieces:
            self.done.append((doc, start, length, self.sequence, offset))
            offset += length
        self.sequence += 1

    def add(self, doc: Doc, start: int, length: int) -> int:
        """Put in what fits; how many ids are left over."""
        taken = min(length, self.window - self.filled)
        self.open.append((doc, start, taken))
        self.filled += taken
        if self.filled == self.window:
            self._close(self.open)
            self.open, self.filled = [], 0
        return length - taken

    def whole(self, doc: Doc, start: int) -> None:
        """A window of one document's ids; the open window stays open."""
        self._close([(doc, start, self.window)])

    def finish(self) -> None:
        """Cut the open window into sequences whose lengths are powers of two."""
        rest, left = self.open, self.filled
        while left:
            size = 1 << (left.bit_length() - 1)
            taken, room = [], size
            while room:
                doc, start, length = rest.pop(0)
                part = min(length, room)
                taken.append((doc, start, part))
                if part < length:
                    rest.insert(0, (doc, start + part, length - part))
                room -= part
            self._close(taken)
            left -= size
        self.open, self.filled = [], 0


def fill(docs: list[Doc], idf: np.ndarray, mean: float, windows: Windows) -> None:
    """Pack one shard's documents; the last window may stay open."""
    rest: list[tuple[Doc, int, int]] = []  # below a window's length
    for doc in docs:
        whole = len(doc.ids) - len(doc.ids) % windows.window
        for start in range(0, whole, windows.window):
            windows.whole(doc, start)
        if len(doc.ids) > whole:
            rest.append((doc, whole, len(doc.ids) - whole))
    pieces = [doc.ids[start : start + n] for doc, start, n in rest]
    heavy = np.array([idf[p].max() > 0 for p in pieces], bool)
    shard = Unused([p for p, h in zip(pieces, heavy) if h], idf, mean)
    names = np.flatnonzero(heavy)
    seed: np.ndarray | None = None  # tokens that the open window's neighbours are found by
    queue: list[int] = []
    while shard.left:
        if not queue and seed is not None and windows.filled:
            queue = shard.search(seed, windows.window - windows.filled)[::-1]
        pick = queue.pop() if queue else shard.longest()
        if not windows.filled:
            seed = shard.terms(pick)
        shard.take(pick)
        doc, start, length = rest[names[pick]]
        left = windows.add(doc, start, length)
        if left:  # the rest of a cut piece seeds the next window, by the ids it holds
            start += length - left
            seed, queue = np.unique(doc.ids[start : start + left]).astype(np.int64), []
            windows.add(doc, start, left)
        if not windows.filled:
            queue = []
    # Nothing is a neighbour of pieces whose tokens all documents hold: they go in order.
    for i in np.flatnonzero(~heavy).tolist():
        doc, start, length = rest[i]
        left = windows.add(doc, start, length)
        if left:
            windows.add(doc, start + length - left, left)


def pack(
    tokens: DataFrame, frequencies: tuple[np.ndarray, int, float], window: int = WINDOW
) -> DataFrame:
    """Pieces of the packed documents, each with its ids.

    ``tokens`` is a stored table of (doc_id, ids): a task that runs again must see the same
    rows in the same order.
    """
    found, documents, mean = frequencies
    idf = np.log1p((documents - found + 0.5) / (found + 0.5)).astype(np.float32)
    idf[found >= documents] = 0  # what all documents hold says nothing
    shared = tokens.sparkSession.sparkContext.broadcast(idf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf = shared.value
        windows = Windows(window, TaskContext.get().partitionId() << SEQUENCE_BITS)
        kind = pa.null()

        def finished() -> Iterator[pa.RecordBatch]:
            for at in range(0, len(windows.done), 256):
                part = windows.done[at : at + 256]
                columns = {
                    "doc_id": pa.array([p[0].doc_id for p in part], kind),
                    "start": pa.array([p[1] for p in part], pa.int64()),
                    "length": pa.array([p[2] for p in part], pa.int64()),
                    "doc_tokens": pa.array([len(p[0].ids) for p in part], pa.int64()),
                    "sequence_id": pa.array([p[3] for p in part], pa.int64()),
                    "offset": pa.array([p[4] for p in part], pa.int64()),
                    "ids": pa.array([p[0].ids[p[1] : p[1] + p[2]].tobytes() for p in part]),
                }
                yield pa.RecordBatch.from_pydict(columns)
            windows.done = []

        shard: list[Doc] = []
        size = 0
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for doc_id, ids in zip(batch["doc_id"], batch["ids"]):
                shard.append(Doc(doc_id.as_py(), np.frombuffer(ids.as_py(), "<u4")))
                size += len(shard[-1].ids)
                if size >= SHARD_TOKENS:
                    fill(shard, idf, mean, windows)
                    yield from finished()
                    shard, size = [], 0
        fill(shard, idf, mean, windows)
        windows.finish()
        yield from finished()

    schema = tokens.select("doc_id").schema
    for name in ("start", "length", "doc_tokens", "sequence_id", "offset"):
        schema = schema.add(name, "long")
    rows = tokens.filter("ids IS NOT NULL").select("doc_id", "ids")
    return rows.mapInArrow(run, schema.add("ids", "binary"))


def packed(docs: DataFrame, tokenizer_path: str, end_id: int, keep, window: int = WINDOW):
    """Tokenise, count and pack ``docs``; ``keep(df, name)`` stores a table and reads it."""
    tokens = keep(tokenise(docs, tokenizer_path, end_id), "tokens")
    return pack(tokens, document_frequencies(tokens), window)
