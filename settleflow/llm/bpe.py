"""Byte-pair encoding and decoding with a tokenizer file, by a pair occurrence index.

The words of a stretch of text lie behind each other in one array of symbols. An index maps each pair
to all positions where it occurs. Ranks that occur are taken in ascending order from a heap; a rank is
applied to all its positions from left to right, and the pairs that arise at a merged symbol join the
lists of their ranks. Within a word this is the usual rule, lowest rank first and leftmost first: where
a merge brings up a pair of a lower rank, the later positions of that word wait until it has had its turn.

Text is split at spaces, tabs and newlines first, which no rule of the file looks across, and each
distinct chunk of a task is worked out once; what is remembered is bounded by ``REMEMBERED``. A text is
read in stretches of ``STRETCH`` characters, so a task holds the ids of a text but never a word list of
all of it.

The file (its path is a parameter) is read on the driver and sent to the tasks once; its size is that
of a vocabulary and does not grow with the data. Files whose rules differ from those handled here are
refused by ``Vocabulary``.

Results: a null text counts as empty and has no ids; an empty text has no ids and decodes to an empty
text. Strings of the special tokens are those tokens, also inside words. Characters that Python's
Unicode tables do not know yet are normalised and split by the library's own rules. Repeated rows are
encoded alike. A column of the input with the name of a result is replaced, all others stay; an empty
table gives an empty one.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import sys
import unicodedata
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from functools import cached_property
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import types as T

STRETCH = 1 << 20  # characters whose words are looked up together
REMEMBERED = 400_000  # chunks, and words, whose ids a task keeps
ROWS = 512  # rows handed on at a time


def byte_letters() -> list[str]:
    """The visible letter that stands for each byte in a byte-level vocabulary."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


def unknown_letters() -> regex.Pattern:
    """Characters without an entry in Python's Unicode tables."""
    spans, start = [], None
    for c in range(sys.maxunicode + 2):
        new = c <= sys.maxunicode and unicodedata.category(chr(c)) == "Cn"
        if new and start is None:
            start = c
        elif not new and start is not None:
            spans.append(f"{chr(start)}-{chr(c - 1)}")
            start = None
    return regex.compile(f"[{''.join(spans)}]")


class Vocabulary:
    """A tokenizer file: ids of bytes, ranks of pairs, how text is normalised and split."""

    def __init__(self, text: str):
        rules = json.loads(text)
        model, steps = rules["model"], rules["normalizer"]["normalizers"]
        split, level = rules["pre_tokenizer"]["pretokenizers"]
        handled = (
            [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"] and steps[1]["pattern"] == {"Regex": r"\s+"} and steps[1]["content"] == " "
            and split["behavior"] == "Removed" and split["invert"] and level["type"] == "ByteLevel" and not level["add_prefix_space"] and not level["use_regex"]
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
            and rules["decoder"] is None and rules["post_processor"] is None
            and not any(t[k] for t in rules["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")))
        if not handled:
            raise ValueError("the tokenizer file has rules that are not handled")
        self.rules, ids, end = text, model["vocab"], model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in rules["added_tokens"]}
        self.words = regex.compile(split["pattern"]["Regex"])
        self.at_special = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        self.size = 1 + max([*ids.values(), *self.special.values()])
        self.tokens = [""] * self.size
        for token, k in [*ids.items(), *self.special.items()]:
            self.tokens[k] = token
        self.inner = [ids[c] for c in byte_letters()]
        self.last = [ids[c + end] for c in byte_letters()]
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for r, (a, b) in enumerate(model["merges"]):
            self.rank[ids[a] * self.size + ids[b]] = r
            self.made.append(ids[a + b])
        self.unknown = unknown_letters()
        self.chunk_ids: dict[str, bytes] = {}
        self.word_ids: dict[str, bytes] = {}

    @cached_property
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self.rules)

    def split(self, chunk: str) -> list[str]:
        """Words and special tokens of a chunk, in order."""
        found, at = [], 0
        for m in self.at_special.finditer(chunk):
            found += [*self._plain(chunk[at:m.start()]), m.group()]
            at = m.end()
        return found + self._plain(chunk[at:])

    def _plain(self, text: str) -> list[str]:
        if text.isascii():
            return self.words.findall(text.lower())
        if self.unknown.search(text):
            normal = self.library.normalizer.normalize_str(text)
            letters = {c: b for b, c in enumerate(byte_letters())}
            return [bytes(letters[c] for c in word).decode() for word, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]
        # lower case letter by letter: a sigma at the end of a word has no form of its own here
        return self.words.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def merge(self, words: list[str]) -> list[bytes]:
        """Ids of each word, by the pair occurrence index over all of them."""
        symbols: list[int] = []
        starts: list[int] = []
        after: list[int] = []
        for word in words:
            data = word.encode()
            starts.append(len(symbols))
            symbols += [self.inner[b] for b in data[:-1]]
            symbols.append(self.last[data[-1]])
            after += range(starts[-1] + 1, len(symbols))
            after.append(-1)
        before = [-1] * len(symbols)
        here = [-1] * len(symbols)  # the rank of the pair that begins at a position
        places: dict[int, list[int]] = {}
        rank, size = self.rank.get, self.size
        for p, q in enumerate(after):
            if q >= 0:
                before[q] = p
                r = here[p] = rank(symbols[p] * size + symbols[q], -1)
                if r >= 0:
                    places.setdefault(r, []).append(p)
        active = list(places)
        heapq.heapify(active)

        def note(p: int, r: int) -> None:
            here[p] = r
            if r >= 0:
                if r in places:
                    places[r].append(p)
                else:
                    places[r] = [p]
                    heapq.heappush(active, r)

        while active:
            r = heapq.heappop(active)
            made, wait_until = self.made[r], 0
            later = []
            for p in sorted(places.pop(r)):
                if here[p] != r:
                    continue
                if p < wait_until:
                    later.append(p)
                    continue
                q = after[p]
                n = after[p] = after[q]
                o = before[p]
                symbols[p], here[q] = made, -1
                lowest = r
                if n >= 0:
                    before[n] = p
                    new = rank(made * size + symbols[n], -1)
                    note(p, new)
                    lowest = new if 0 <= new < lowest else lowest
                else:
                    here[p] = -1
                if o >= 0:
                    new = rank(symbols[o] * size + made, -1)
                    note(o, new)
                    lowest = new if 0 <= new < lowest else lowest
                if lowest < r:
                    k = bisect_right(starts, p)
                    wait_until = starts[k] if k < len(starts) else len(symbols)
            if later:
                places[r] = later
                heapq.heappush(active, r)
        found = []
        for p in starts:
            ids = []
            while p >= 0:
                ids.append(symbols[p])
                p = after[p]
            found.append(np.array(ids, "<u4").tobytes())
        return found

    def _learn(self, chunks: set[str]) -> None:
        """Ids of chunks that are not remembered."""
        if len(self.chunk_ids) > REMEMBERED:
            self.chunk_ids.clear()
        if len(self.word_ids) > REMEMBERED:
            self.word_ids.clear()
        for token, k in self.special.items():  # no ordinary word is one of their strings
            self.word_ids[token] = np.array([k], "<u4").tobytes()
        words = {chunk: self.split(chunk) for chunk in chunks}
        fresh = list({w for some in words.values() for w in some if w not in self.word_ids})
        self.word_ids.update(zip(fresh, self.merge(fresh)))
        for chunk, some in words.items():
            self.chunk_ids[chunk] = b"".join([self.word_ids[w] for w in some])

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        waiting: list[tuple[list[str], bool]] = []  # chunks of a stretch, and whether its text ends there
        size, parts = 0, []

        def ready() -> Iterator[bytes]:
            needed = {c for chunks, _ in waiting for c in chunks}
            if len(self.chunk_ids) > REMEMBERED:
                self._learn(needed)
            else:
                self._learn({c for c in needed if c not in self.chunk_ids})
            for chunks, ends in waiting:
                parts.append(b"".join([self.chunk_ids[c] for c in chunks]))
                if ends:
                    yield b"".join(parts)
                    parts.clear()
            waiting.clear()

        for text in texts:
            for stretch, ends in stretches(text or ""):
                waiting.append((stretch.replace("\n", " ").replace("\t", " ").split(" "), ends))
                size += len(stretch) + 64
                if size >= STRETCH:
                    yield from ready()
                    size = 0
        yield from ready()

    def decode(self, ids: bytes) -> str:
        """Text of ids: without a decoder in the file, its tokens with a space between them."""
        return " ".join([self.tokens[k] for k in np.frombuffer(ids, "<u4").tolist()])


def stretches(text: str) -> Iterator[tuple[str, bool]]:
    """Parts of a text of about ``STRETCH`` characters, cut at spaces, and whether a part is the last."""
    at = 0
    while True:
        cut = text.find(" ", at + STRETCH) if len(text) - at > STRETCH else -1
        if cut < 0:
            yield text[at:], True
            return
        yield text[at:cut], False
        at = cut


def _sent(frame: DataFrame, path: str) -> Broadcast:
    return frame.sparkSession.sparkContext.broadcast(Path(path).read_text(encoding="utf-8"))


def _with(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    kept = [k for k, n in enumerate(batch.schema.names) if n != name]
    return pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), column], names=[*(batch.schema.names[k] for k in kept), name])


def _schema(frame: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*(f for f in frame.schema.fields if f.name != name), T.StructField(name, kind)])


def encode(docs: DataFrame, path: str, text: str = "text", name: str = "ids") -> DataFrame:
    """The rows with the ids of a text column as an array of integers."""
    sent = _sent(docs, path)

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(sent.value)
        for batch in _pieces(batches):
            found = list(vocabulary.encode(batch.column(text).to_pylist()))
            ends = np.cumsum([0, *(len(x) // 4 for x in found)], dtype=np.int32)
            column = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(found), "<i4")))
            yield _with(batch, name, column)

    return docs.mapInArrow(ids, _schema(docs, name, T.ArrayType(T.IntegerType())))


def decode(frame: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """The rows with the text of an array of ids; a null array gives an empty text."""
    sent = _sent(frame, path)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(sent.value)
        for batch in _pieces(batches):
            found = [vocabulary.decode(np.array(x or [], "<u4").tobytes()) for x in batch.column(ids).to_pylist()]
            yield _with(batch, name, pa.array(found, pa.string()))

    return frame.mapInArrow(texts, _schema(frame, name, T.StringType()))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document its number of ids, and digests of the ids and of their decoded text."""
    sent = _sent(docs, path)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(sent.value)
        for batch in _pieces(batches):
            counts, ids, decoded = [], [], []
            for found in vocabulary.encode(batch.column("text").to_pylist()):
                counts.append(len(found) // 4)
                ids.append(hashlib.sha256(found).hexdigest())
                decoded.append(hashlib.sha256(vocabulary.decode(found).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kept = docs.select("doc_id", "text")
    schema = T.StructType([kept.schema["doc_id"], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])
    return kept.mapInArrow(rows, schema)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)
