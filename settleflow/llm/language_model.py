"""Scores of documents by masked pseudo-likelihood.

A small network predicts a token from ``REACH`` tokens on both sides: their embeddings, weighted by position, are
added and squashed, and a two-level softmax gives the class of the token and the token within its class. A document's score
is the sum of the log-probabilities of all its tokens, each predicted from both sides with itself masked.

Tokens are lower-cased runs of letters and digits. The vocabulary is the most frequent ones, counted over all documents;
any other token falls into one of ``RARE`` buckets by its hash. The network predicts the bucket; the word itself has the share of its cell
(a finer hash, ``CELLS`` in all) in the bucket's occurrences, counted over all documents with one added, so rare words cost what they are worth.
Texts are split into numbers once; these are stored, and training and scoring read them.

Training is data-parallel: in each round every task starts from the shared weights and learns, in numpy, from all its documents;
the rounds share out the tokens, so that each token is learned from once. The tasks' weights are averaged, weighted by what they have seen, in
groups of ``FAN_IN`` by shuffles until one set is left. So what is gathered from the corpus (word counts and weights) grows with the input, while
the weights that come to the driver and go out again have a fixed size.

Defined results: null texts and texts without a token have no tokens, a ``log_likelihood`` of 0 and a null ``mean_log_probability``.
The first and last tokens see padding. Texts of any length are scored whole, in batches. Rows do not depend on each other, so
repeated rows have equal scores up to rounding.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settleflow.llm.common import dropped, stored, words as split_words

CLASSES = 64
MEMBERS = 64
RARE = 1024
WORDS = CLASSES * MEMBERS - RARE
CELLS = 1 << 18
PAD = CLASSES * MEMBERS
WIDTH = 32
REACH = 2
BATCH = 8192
CHUNK = 1 << 14  # tokens
SCORED = 1 << 13  # tokens at a time
BLOCK = 1 << 10  # tokens whose logits are made at a time, so that they stay in a core's cache
FAN_IN = 64
_SHAPES = {"embed": (PAD + 1, WIDTH), "place": (2 * REACH, WIDTH), "bias": (WIDTH,), "to_class": (WIDTH, CLASSES), "class_bias": (CLASSES,),
           "to_member": (CLASSES, WIDTH, MEMBERS), "member_bias": (CLASSES, MEMBERS)}
_OFFSETS = [k for k in range(-REACH, REACH + 1) if k]

Weights = dict[str, np.ndarray]


class _Ids(dict):
    """Numbers of the words of the vocabulary."""

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of a text's words, the places of words outside the vocabulary and the cells of these."""
        found = split_words(text) if text else []
        numbers = np.fromiter(map(self.get, found, repeat(-1)), np.int64, len(found))
        rare = np.flatnonzero(numbers < 0)
        hashes = b"".join([xxhash.xxh64_digest(found[k], 42) for k in rare.tolist()])
        return numbers, rare, (np.frombuffer(hashes, ">u8") % CELLS).astype(np.intp)


def vocabulary(docs: DataFrame, *, text: str = "text") -> tuple[list[str], np.ndarray]:
    """The most frequent words of all documents, most frequent first, and the log-share of each cell of other words in its bucket."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()

        def frame() -> pd.DataFrame:
            return pd.DataFrame({"word": [w.decode() for w in seen], "n": list(seen.values())})

        for batch in batches:
            for t in batch["text"]:
                if t:
                    seen.update(split_words(t))
                if len(seen) > 300_000:
                    yield frame()
                    seen = Counter()
        if seen:  # pandas gives no typed text column for an empty frame
            yield frame()

    counts = stored(docs.select(F.col(text).alias("text")).mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    listed = [r["word"] for r in counts.orderBy(F.desc("n"), "word").limit(WORDS).collect()]
    top = docs.sparkSession.createDataFrame([(w,) for w in listed], "word string")  # WORDS rows at most
    cell = F.xxhash64("word").bitwiseAND(F.lit(CELLS - 1)).cast("int").alias("cell")
    cells = counts.join(F.broadcast(top), "word", "left_anti").groupBy(cell).agg(F.sum("n").alias("n")).toPandas()  # CELLS rows at most
    dropped(counts)
    seen = np.ones(CELLS)
    seen[cells["cell"].to_numpy(np.intp)] += cells["n"].to_numpy(np.float64)
    seen = seen.reshape(-1, RARE)  # cell c belongs to bucket c % RARE
    return listed, np.log(seen / seen.sum(axis=0)).ravel().astype(np.float32)


def initial(seed: int = 7) -> Weights:
    rng = np.random.default_rng(seed)
    w = {k: (rng.standard_normal(s) * 0.1).astype(np.float32) for k, s in _SHAPES.items()}
    w["place"][:] = 1.0
    for k in ("bias", "class_bias", "member_bias"):
        w[k][:] = 0
    return w


def _pack(w: Weights) -> np.ndarray:
    return np.concatenate([w[k].ravel() for k in _SHAPES])


def _unpack(flat: np.ndarray) -> Weights:
    out, at = {}, 0
    for k, shape in _SHAPES.items():
        n = int(np.prod(shape))
        out[k] = flat[at:at + n].reshape(shape).astype(np.float32)
        at += n
    return out


def _by_class(ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
    """Order of the places by the class of their tokens, the classes and members in that order, and class, first and end of each class met."""
    order = np.argsort((ids[at] // MEMBERS).astype(np.uint8), kind="stable")
    classes, members = np.divmod(ids[at[order]], MEMBERS)
    edges = np.searchsorted(classes, np.arange(CLASSES + 1)).tolist()
    return order, classes, members, [(c, i, j) for c, (i, j) in enumerate(zip(edges, edges[1:])) if i < j]


def _hidden(w: Weights, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    context = [ids[at + k] for k in _OFFSETS]
    total = np.tile(w["bias"], (len(at), 1))
    for k in range(0, len(at), BLOCK):
        for place, c in zip(w["place"], context):
            part = w["embed"][c[k:k + BLOCK]]
            part *= place
            total[k:k + BLOCK] += part
    return np.tanh(total, out=total), context


def _of_classes(w: Weights, h: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Logits of the classes, block by block; a column for each token, so that sums run over long rows. The next block takes the place of the last."""
    z = np.empty((CLASSES, BLOCK), np.float32)
    for i in range(0, len(h), BLOCK):
        block = slice(i, min(i + BLOCK, len(h)))
        part = z[:, :block.stop - i]
        np.add(w["to_class"].T @ h[block].T, w["class_bias"][:, None], out=part)
        yield block, part


def _of_members(w: Weights, h: np.ndarray, met: list[tuple[int, int, int]]) -> Iterator[tuple[slice, np.ndarray, list[tuple[int, int, int]]]]:
    """Logits of the members of the token's class, in blocks of whole classes, with the classes of the block."""
    z = np.empty((MEMBERS, BLOCK), np.float32)
    group: list[tuple[int, int, int]] = []
    for k, (c, i, j) in enumerate(met):
        group.append((c, i, j))
        if k + 1 < len(met) and met[k + 1][2] - group[0][1] <= BLOCK:
            continue
        block = slice(group[0][1], j)
        part = z[:, :j - block.start] if j - block.start <= BLOCK else np.empty((MEMBERS, j - block.start), np.float32)
        for c, i, j in group:
            np.add(w["to_member"][c].T @ h[i:j].T, w["member_bias"][c][:, None], out=part[:, i - block.start:j - block.start])
        yield block, part, group
        group = []


def log_probabilities(w: Weights, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log-probability of the tokens at the given places of a padded sequence, each from its two sides."""
    order, classes, members, met = _by_class(ids, at)
    h, _ = _hidden(w, ids, at[order])
    columns, found = np.arange(len(at)), np.zeros(len(at), np.float32)
    for blocks, picked in ((_of_classes(w, h), classes), (_of_members(w, h, met), members)):
        for block, z, *_ in blocks:
            z -= z.max(axis=0)
            found[block] += z[picked[block], columns[:z.shape[1]]]
            found[block] -= np.log(np.exp(z, out=z).sum(axis=0))
    out = np.empty_like(found)
    out[order] = found
    return out


def _errors(z: np.ndarray, picked: np.ndarray, n: np.float32) -> None:
    """Logits become the gradients of the loss by them, ``n`` for the weight of a token."""
    z -= z.max(axis=0)
    np.exp(z, out=z)
    z *= n / z.sum(axis=0)
    z[picked, np.arange(len(picked))] -= n


def _learn(w: Weights, squares: Weights, ids: np.ndarray, at: np.ndarray, rate: float) -> None:
    """One Adagrad step; weights that it has no gradient for stay as they are."""
    order, classes, members, met = _by_class(ids, at)
    h, context = _hidden(w, ids, at[order])
    n = np.float32(1 / len(at))
    g = {k: np.zeros(s, np.float32) for k, s in _SHAPES.items()}
    back = np.empty_like(h)
    for block, z in _of_classes(w, h):
        _errors(z, classes[block], n)
        back[block] = z.T @ w["to_class"].T
        g["to_class"] += h[block].T @ z.T
        g["class_bias"] += z.sum(axis=1)
    for block, z, group in _of_members(w, h, met):
        _errors(z, members[block], n)
        g["member_bias"][[c for c, _, _ in group]] = np.add.reduceat(z, [i - block.start for _, i, _ in group], axis=1).T
        for c, i, j in group:
            d = z[:, i - block.start:j - block.start].T
            np.matmul(h[i:j].T, d, out=g["to_member"][c])
            back[i:j] += d @ w["to_member"][c].T
    h *= h
    h *= back
    back -= h
    g["bias"] = back.sum(axis=0)
    for k, c in enumerate(context):
        by_token = np.argsort(c.astype(np.uint16), kind="stable")
        c = c[by_token]
        first = np.flatnonzero(np.diff(c, prepend=-1))
        rows, sums = c[first], np.add.reduceat(back[by_token], first, axis=0)
        g["place"][k] = (sums * w["embed"][rows]).sum(axis=0)
        sums *= w["place"][k]
        g["embed"][rows] += sums
    rows = {"embed": np.flatnonzero(np.bincount(np.concatenate(context), minlength=PAD + 1))}
    if len(met) < CLASSES:
        rows["to_member"] = rows["member_bias"] = np.array([c for c, _, _ in met])
    for k, own in g.items():
        changed = rows.get(k, slice(None))
        own = own[changed]
        seen = squares[k][changed] + own * own
        squares[k][changed] = seen
        seen += 1e-8
        np.sqrt(seen, out=seen)
        own *= rate
        own /= seen
        w[k][changed] -= own


def _sequences(texts: Iterator[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, list[int], list[int]]]:
    """Padded sequences of about CHUNK tokens: ids, places of the tokens, number of the text of each piece, and tokens of the piece.

    A long text comes in pieces that see their neighbours' tokens.
    """
    pad = np.full(REACH, PAD, np.uint16)
    parts, size, places, which, lengths = [pad], REACH, [], [], []
    for k, mine in enumerate(texts):
        for a in range(0, len(mine), CHUNK):
            b = min(a + CHUNK, len(mine))
            left, right = mine[max(0, a - REACH):a], mine[b:b + REACH]
            parts += [pad, left, mine[a:b], right, pad]
            first = size + REACH + len(left)
            places.append(np.arange(first, first + b - a))
            size = first + b - a + len(right) + REACH
            which.append(k)
            lengths.append(b - a)
            if size > CHUNK:
                yield np.concatenate(parts).astype(np.intp), np.concatenate(places), which, lengths
                parts, size, places, which, lengths = [pad], REACH, [], [], []
    if places:
        yield np.concatenate(parts).astype(np.intp), np.concatenate(places), which, lengths


def _numbers(column: pa.Array) -> Iterator[np.ndarray]:
    return (np.frombuffer(b, np.uint16) for b in column.to_pylist())


def numbered(text: str | None, ids: _Ids, shares: np.ndarray) -> tuple[np.ndarray, float]:
    """Tokens of the network for a text, and the summed log-shares of its other words in their buckets."""
    numbers, rare, cells = ids.of(text)
    numbers[rare] = WORDS + cells % RARE
    return numbers.astype(np.uint16), float(shares[cells].sum(dtype=np.float64))


def encode(docs: DataFrame, words: list[str], shares: np.ndarray, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` (the tokens' numbers with two bytes each) and ``rare`` of every row. Ids of rows stay in Arrow, also null ones."""
    shared = docs.sparkSession.sparkContext.broadcast((words, shares))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, shares = shared.value
        ids = _Ids((v.encode(), k) for k, v in enumerate(words))
        for batch in batches:
            found = [numbered(x, ids, shares) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([n.tobytes() for n, _ in found], pa.binary()), pa.array([r for _, r in found], pa.float64())], ["doc_id", "ids", "rare"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, f"doc_id {kind}, ids binary, rare double")


def of_round(places: np.ndarray, round_: int, rounds: int) -> np.ndarray:
    """The places a round learns from; together the rounds take each place once."""
    return places[round_::rounds]


def learn(rows: DataFrame, *, rounds: int = 2, rate: float = 0.1) -> Weights:
    """Weights learned from all tokens of all rows of ``encode``."""
    weights = initial()
    context = rows.sparkSession.sparkContext
    slices = 32
    for round_ in range(rounds):
        shared = context.broadcast(_pack(weights))

        def one_task(batches: Iterator[pa.RecordBatch], round_: int = round_, shared=shared) -> Iterator[pa.RecordBatch]:
            w = _unpack(shared.value.copy())
            squares, seen = {k: np.zeros(s, np.float32) for k, s in _SHAPES.items()}, 0
            for batch in batches:
                for sequence, places, _, _ in _sequences(_numbers(batch.column(0))):
                    masked = of_round(places, round_, rounds)
                    for at in range(0, len(masked), BATCH):
                        _learn(w, squares, sequence, masked[at:at + BATCH], rate)
                    seen += len(masked)
            if seen:
                task = TaskContext.get().partitionId()
                yield pa.RecordBatch.from_arrays([
                    pa.array([task] * slices, pa.int64()), pa.array(range(slices), pa.int32()), pa.array([seen] * slices, pa.int64()),
                    pa.array([p.astype(np.float32).tobytes() for p in np.array_split(_pack(w), slices)], pa.binary())], ["task", "slice", "n", "weights"])

        def average(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values("task")
            parts = [np.frombuffer(p, np.float32).astype(np.float64) * n for p, n in zip(group["weights"], group["n"])]
            total = int(group["n"].sum())
            return pd.DataFrame({"task": [int(group["task"].iloc[0]) // FAN_IN], "slice": [int(group["slice"].iloc[0])], "n": [total],
                                 "weights": [(sum(parts) / total).astype(np.float32).tobytes()]})

        schema = "task long, slice int, n long, weights binary"
        learned = rows.select("ids").mapInArrow(one_task, schema)
        left = learned.rdd.getNumPartitions()
        while True:
            learned = learned.groupBy(F.expr(f"task div {FAN_IN}"), "slice").applyInPandas(average, schema)
            left = -(-left // FAN_IN)
            if left <= 1:
                break
        got = sorted(learned.collect(), key=lambda r: r["slice"])  # the weights of one network
        if got:
            weights = _unpack(np.concatenate([np.frombuffer(r["weights"], np.float32) for r in got]))
    return weights


def train(docs: DataFrame, *, text: str = "text", **options) -> tuple[list[str], np.ndarray, Weights]:
    """Vocabulary, log-shares of other words and weights learned from all documents."""
    words, shares = vocabulary(docs, text=text)
    rows = stored(encode(docs, words, shares, doc_id=text, text=text).select("ids"), "tokens")
    weights = learn(rows, **options)
    dropped(rows)
    return words, shares, weights


def score_encoded(rows: DataFrame, weights: Weights) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``log_likelihood`` and ``mean_log_probability`` of every row of ``encode``."""
    shared = rows.sparkSession.sparkContext.broadcast(_pack(weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = _unpack(shared.value)
        for batch in batches:
            total, count = batch.column(2).to_numpy(zero_copy_only=False).copy(), np.zeros(batch.num_rows, np.int64)
            for sequence, places, which, lengths in _sequences(_numbers(batch.column(1))):
                found = np.concatenate([log_probabilities(w, sequence, places[at:at + SCORED]) for at in range(0, len(places), SCORED)])
                starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
                np.add.at(total, which, np.add.reduceat(found.astype(np.float64), starts))
                np.add.at(count, which, lengths)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(count), pa.array(total)], ["doc_id", "n_tokens", "log_likelihood"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.select("doc_id", "ids", "rare").mapInArrow(run, f"doc_id {kind}, n_tokens long, log_likelihood double")
    return scored.withColumn("mean_log_probability", F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")))


def score(docs: DataFrame, model: tuple[list[str], np.ndarray, Weights], *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens``, ``log_likelihood`` and ``mean_log_probability`` of every row."""
    return score_encoded(encode(docs, *model[:2], doc_id=doc_id, text=text), model[2])


def train_and_score(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Scores of documents by a network learned from them; texts are split into tokens' numbers once, which are stored."""
    rows = stored(encode(docs, *vocabulary(docs, text=text), doc_id=doc_id, text=text), "tokens")
    return score_encoded(rows, learn(rows, **options))
