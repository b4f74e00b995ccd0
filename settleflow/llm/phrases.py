"""Frequent phrases that belong together, by a weighted de Bruijn graph.

Texts are lower-cased in A-Z, split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those at spaces and tabs
into words. Everything is counted per language.

* **Edges.** The longest grams (``LONGEST`` words) are the edges of the graph; an edge leads from the node
  of its first four words to that of its last four, which overlap in three. Tasks add up equal edges
  before the shuffle, Spark adds them up over the corpus.
* **Flow.** A node is left once for each of its occurrences, but for those at the end of a piece. So a
  shorter phrase's count is the weight of the edges that leave it plus the number of pieces that end with
  it. The four-word nodes with their counts are in turn the edges between three-word nodes.
  All counts are exact. Besides the longest grams only single words and pairs are read off the texts, which have to be known before.
* **Compaction.** A node through which one edge carries the whole flow is no phrase of its own: it lies
  inside of that edge's longer phrase, and is merged into it. Frequent edges whose ends are merged on both sides
  form unary paths, which ``passages`` returns as whole passages; paths grow by doubling, so a path of n
  edges takes log n joins.
* **Score.** A phrase is cut after each of its words in turn; the cut with the lowest score counts.

Before the edges are made, a piece is cut at words, and between neighbours, that are too rare for a frequent
phrase: no frequent phrase holds them, so no count that is asked for changes, and the graph keeps the part of the
text that matters. For this, words and then pairs of frequent words are counted first. Whether one is frequent is looked up in a
bitmap of ``SIEVE_BITS`` bits, whose size does not grow with the corpus; a rare one that shares the bit of a frequent one
only makes the graph larger.

Results: a null text counts as empty, a null language as ``und``; empty texts, and an empty table, add
nothing. Repeated rows count as often as they occur. Very long texts are read piece by piece. Only the
two named columns are read, so further columns never clash.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from settleflow.llm.common import stored, word_blocks

LONGEST = 5
SIEVE_BITS = 1 << 24
SUMMED = 500_000  # different rows a task adds up before it hands them on
REMEMBERED = 250_000  # words of a language whose hash a task remembers
_MARK, _BETWEEN = b"\xff", b" \xff "  # stands between pieces; no UTF-8 text has this byte
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\x0d", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9)


def _texts(docs: DataFrame, step, schema: str) -> DataFrame:
    """Apply ``step``, a function from (language, lower-cased text) pairs to Arrow columns, to each partition."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).cast("binary").alias("_lang"), F.col("text").cast("binary").alias("_text")).where("_text is not null")
    names = [field.split()[0] for field in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = ((lang, text.translate(_LOWER)) for batch in batches for lang, text in zip(batch.column("_lang").to_pylist(), batch.column("_text").to_pylist()))
        for columns in step(texts):
            whole = pa.RecordBatch.from_arrays(columns, names=names)
            for at in range(0, whole.num_rows, 20_000):
                yield whole.slice(at, 20_000)

    return rows.mapInArrow(run, schema)


def _strings(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


def word_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``phrase`` (one word) and its count ``cnt``."""

    def count(texts: Iterator[tuple[bytes, bytes]]) -> Iterator[list[pa.Array]]:
        counters: defaultdict[bytes, Counter] = defaultdict(Counter)

        def out() -> Iterator[list[pa.Array]]:
            for lang, words in counters.items():
                yield [_strings([lang] * len(words)), _strings(list(words)), pa.array(list(words.values()), pa.int64())]
            counters.clear()

        for lang, text in texts:
            for block in word_blocks(text):
                counters[lang].update(block)
            if sum(map(len, counters.values())) > SUMMED:
                yield from out()
        yield from out()

    return _texts(docs, count, "lang string, phrase string, cnt long").groupBy("lang", "phrase").agg(F.sum("cnt").alias("cnt"))


def sieve(hashes: DataFrame, bits: int = SIEVE_BITS) -> Broadcast:
    """Bitmap of the column ``hash``: at most ``bits`` bits, whatever the size of the corpus."""
    cells = hashes.select(F.pmod("hash", F.lit(bits)).alias("p")).groupBy(F.shiftright("p", 5).alias("cell")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p & 31 as int))")).alias("set"))
    found = cells.toPandas()  # a row for each 32 bits of the bitmap at most
    bitmap = np.zeros(bits // 32, "<u4")
    bitmap[found["cell"].to_numpy(np.int64)] = found["set"].to_numpy(np.int64)
    return hashes.sparkSession.sparkContext.broadcast(bitmap)


def _passes(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes (signed, as Spark has them) are in a bitmap."""
    p = np.mod(hashes, len(bitmap) * 32)
    return bitmap[p >> 5] >> (p & 31).astype(np.uint32) & 1 == 1


def word_sieve(words: DataFrame, least: int) -> Broadcast:
    return sieve(words.where(F.col("cnt") >= least).select(F.xxhash64(F.concat_ws("\n", "lang", "phrase")).alias("hash")))


class _Hashes(dict):
    """Hash of each word of a language that passes the word sieve, 0 of the others and of the mark between pieces."""

    def __init__(self, bitmap: np.ndarray, lang: bytes):
        self.bitmap, self.lang = bitmap, lang
        self[_MARK] = 0

    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
            self[_MARK] = 0
        h = xxhash.xxh64_intdigest(self.lang + b"\n" + word, 42)
        h = h - (1 << 64) if h >> 63 else h
        p = h % (len(self.bitmap) * 32)
        self[word] = h = h if self.bitmap[p >> 5] >> (p & 31) & 1 else 0
        return h


def _hashed(bitmap: np.ndarray):
    """Function from a language and a text to its words, with a mark between pieces, and per pair of neighbours whether both pass and their hash."""
    known: dict[bytes, _Hashes] = {}

    def pairs(lang: bytes, text: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        if lang not in known:
            known[lang] = _Hashes(bitmap, lang)
        of = known[lang]
        words = text.replace(b"\n", _BETWEEN).split()
        h = np.array([of[w] for w in words], np.int64)
        a, b = h[:-1], h[1:]
        mixed = a.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.view(np.uint64)
        mixed ^= mixed >> np.uint64(29)
        return words, (a != 0) & (b != 0), (mixed * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)

    return pairs


def pair_counts(docs: DataFrame, frequent: Broadcast, least: int) -> DataFrame:
    """``lang``, ``phrase`` (two neighbouring words) and ``cnt`` of the pairs that occur ``least`` times or more."""

    def count(texts: Iterator[tuple[bytes, bytes]]) -> Iterator[list[pa.Array]]:
        pairs = _hashed(frequent.value)
        counters: defaultdict[bytes, Counter] = defaultdict(Counter)

        def out() -> Iterator[list[pa.Array]]:
            for lang, found in counters.items():
                yield [_strings([lang] * len(found)), _strings(list(found)), pa.array(list(found.values()), pa.int64())]
            counters.clear()

        for lang, text in texts:
            words, both, _ = pairs(lang, text)
            counters[lang].update([b" ".join(words[k:k + 2]) for k in np.flatnonzero(both).tolist()])
            if sum(map(len, counters.values())) > SUMMED:
                yield from out()
        yield from out()

    counted = _texts(docs, count, "lang string, phrase string, cnt long").groupBy("lang", "phrase").agg(F.sum("cnt").alias("cnt"))
    return counted.where(F.col("cnt") >= least)


def pair_sieve(pairs: DataFrame, frequent: Broadcast) -> Broadcast:
    """Sieve of neighbouring words from the frequent pairs."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _hashed(frequent.value)
        for batch in batches:
            found = [int(of(lang.encode(), phrase.encode())[2][0]) for lang, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], names=["hash"])

    return sieve(pairs.select("lang", "phrase").mapInArrow(hashes, "hash long"))


def edges_and_ends(docs: DataFrame, words: Broadcast, pairs: Broadcast) -> DataFrame:
    """``lang``, ``phrase``, ``cnt`` and ``ended``: the longest grams with their counts and how often a run ends with them, and shorter runs as a whole.

    A run is a stretch of a piece, three words or more, in which every two neighbours pass the sieves.
    """

    def count(texts: Iterator[tuple[bytes, bytes]]) -> Iterator[list[pa.Array]]:
        hashed, bitmap = _hashed(words.value), pairs.value
        counters: defaultdict[bytes, tuple[Counter, Counter, Counter]] = defaultdict(lambda: (Counter(), Counter(), Counter()))

        def out() -> Iterator[list[pa.Array]]:
            for lang, (edges, ended, short) in counters.items():
                grams, shorts = list(edges), list(short)
                yield [_strings([lang] * len(grams)), _strings(grams), pa.array(list(edges.values()), pa.int64()), pa.array([ended[g] for g in grams], pa.int64())]
                yield [_strings([lang] * len(shorts)), _strings(shorts), pa.array(list(short.values()), pa.int64()), pa.array(list(short.values()), pa.int64())]
            counters.clear()

        for lang, text in texts:
            found, both, hashes = hashed(lang, text)
            at = np.flatnonzero(both)
            at = at[_passes(bitmap, hashes[at])]  # words at and at + 1 are neighbours in a run
            if not len(at):
                continue
            ends = np.flatnonzero(np.r_[at[1:] != at[:-1] + 1, True])
            begins = np.r_[0, ends[:-1] + 1]
            lengths = ends - begins + 1  # pairs of a run
            ends, begins, lengths = (x[lengths > 1] for x in (ends, begins, lengths))
            long = lengths >= LONGEST - 1
            starts = np.concatenate([np.arange(b, e - LONGEST + 3) for b, e in zip(at[begins[long]].tolist(), at[ends[long]].tolist())] or [np.zeros(0, np.int64)])
            edges, ended, short = counters[lang]
            edges.update([b" ".join(found[k:k + LONGEST]) for k in starts.tolist()])
            ended.update([b" ".join(found[k + 2 - LONGEST:k + 2]) for k in at[ends[long]].tolist()])
            short.update([b" ".join(found[i:j + 2]) for i, j in zip(at[begins[~long]].tolist(), at[ends[~long]].tolist())])
            if sum(len(edges) + len(short) for edges, _, short in counters.values()) > SUMMED:
                yield from out()
        yield from out()

    return _texts(docs, count, "lang string, phrase string, cnt long, ended long")


def _words(phrase: Column) -> Column:
    return F.length(phrase) - F.length(F.replace(phrase, F.lit(" "), F.lit(""))) + 1


def _first(phrase: Column, n: int) -> Column:
    return F.substring_index(phrase, " ", n)


def _last(phrase: Column, n: int) -> Column:
    return F.substring_index(phrase, " ", -n)


def phrase_counts(docs: DataFrame, least: int = 100) -> tuple[DataFrame, DataFrame]:
    """Counts of all single words, and of all phrases of two to ``LONGEST`` words that occur ``least`` times or more."""
    words = stored(word_counts(docs), "words")
    frequent_words = word_sieve(words, least)
    pairs = stored(pair_counts(docs, frequent_words, least), "pairs")
    frequent_pairs = pair_sieve(pairs, frequent_words)
    grams = stored(edges_and_ends(docs, frequent_words, frequent_pairs).groupBy("lang", "phrase").agg(F.sum("cnt").alias("cnt"), F.sum("ended").alias("ended")), "grams")
    edge = _words(F.col("phrase")) == LONGEST
    flow = grams.where(edge).select("lang", "phrase", "cnt")
    tails = grams.where("ended > 0").select("lang", _last(F.col("phrase"), LONGEST - 1).alias("phrase"), F.col("ended").alias("cnt"))
    tails = tails.withColumn("n", _words(F.col("phrase")))
    frequent = [flow.where(F.col("cnt") >= least), pairs]
    for n in range(LONGEST - 1, 2, -1):
        leaving = flow.select("lang", _first(F.col("phrase"), n).alias("phrase"), "cnt")
        ending = tails.where(F.col("n") >= n).select("lang", _last(F.col("phrase"), n).alias("phrase"), "cnt")
        flow = leaving.union(ending).groupBy("lang", "phrase").agg(F.sum("cnt").alias("cnt"))
        frequent.append(flow.where(F.col("cnt") >= least))
    out = frequent[0]
    for level in frequent[1:]:
        out = out.union(level)
    return words, stored(out, "phrases")


def merged_nodes(phrases: DataFrame) -> DataFrame:
    """``lang``, ``phrase`` of the phrases through which one longer phrase carries the whole flow.

    A longer phrase that holds this one occurs no more often than the one between them that is a word
    longer, so phrases that are one word longer decide.
    """
    longer = phrases.where(F.instr("phrase", " ") > 0).withColumn("n", _words(F.col("phrase"))).where("n > 2")
    inner = F.array(F.expr("substring(phrase, 1, length(phrase) - length(substring_index(phrase, ' ', -1)) - 1)"),
                    F.expr("substring(phrase, length(substring_index(phrase, ' ', 1)) + 2)"))
    most = longer.select("lang", F.explode(inner).alias("phrase"), "cnt").groupBy("lang", "phrase").agg(F.max("cnt").alias("_most"))
    return phrases.join(most, ["lang", "phrase"]).where(F.col("_most") * 100 >= F.col("cnt") * 100).select("lang", "phrase")


def collocations(docs: DataFrame, least: int = 100, top: int = 2000) -> DataFrame:
    """The first ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    ``a``, ``l`` and ``r`` count the phrase and the two parts of its weakest cut, ``n`` all words of the
    language; the score is floor(1000 a n / (l r)).
    """
    words, phrases = phrase_counts(docs, least)
    totals = words.groupBy("lang").agg(F.sum("cnt").alias("n"))
    parts = phrases.union(words.where(F.col("cnt") >= least))
    cut = F.explode(F.expr("transform(sequence(1, length(phrase) - length(replace(phrase, ' ', ''))), "
                           "k -> named_struct('k', k, 'left', substring_index(phrase, ' ', k), "
                           "'right', substring(phrase, length(substring_index(phrase, ' ', k)) + 2)))"))
    kept = phrases.join(merged_nodes(phrases), ["lang", "phrase"], "left_anti")
    cuts = kept.select("lang", "phrase", F.col("cnt").alias("a"), cut.alias("cut")).select("lang", "phrase", "a", "cut.*")
    left = parts.select("lang", F.col("phrase").alias("left"), F.col("cnt").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("right"), F.col("cnt").alias("r"))
    score = F.expr("cast((1000BD * cast(a as decimal(20,0)) * n) div (cast(l as decimal(19,0)) * r) as long)")
    scored = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(totals, "lang").withColumn("score", score)
    weakest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("w")).select("lang", "phrase", "a", "n", "w.*")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # a language is ranked in parts first, so that the last window gets a bounded number of rows
    part = W.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    ranked = weakest.withColumn("_place", F.row_number().over(part)).where(F.col("_place") <= top)
    ranked = ranked.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def passages(phrases: DataFrame) -> DataFrame:
    """Unary paths of the frequent edges as passages: ``lang``, ``passage``, ``words`` and its count ``cnt``.

    ``phrases`` is the second result of ``phrase_counts``. An edge goes on to the next one where the node between
    them occurs as often as both. No text goes round in a circle for ever, so every path has a first edge.
    """
    n = LONGEST - 1
    longest = phrases.withColumn("n", _words(F.col("phrase")))
    nodes = longest.where(F.col("n") == n).select("lang", F.col("phrase").alias("node"), F.col("cnt").alias("flow"))
    edges = longest.where(F.col("n") == LONGEST).select("lang", "phrase", "cnt", _first(F.col("phrase"), n).alias("from"), _last(F.col("phrase"), n).alias("to"))
    into = edges.join(nodes, (edges["lang"] == nodes["lang"]) & (edges["to"] == nodes["node"]) & (edges["cnt"] == nodes["flow"])).select(
        edges["lang"], F.col("phrase").alias("a"), "to", "cnt")
    onward = into.join(edges.select("lang", F.col("phrase").alias("b"), F.col("from").alias("to"), "cnt"), ["lang", "to", "cnt"]).select("lang", "a", "b")
    # each edge points towards the first edge of its path, at a distance that doubles in every round
    steps = stored(edges.select("lang", "phrase", "cnt").join(onward.select("lang", F.col("b").alias("phrase"), F.col("a").alias("back")), ["lang", "phrase"], "left")
                   .select("lang", "phrase", "cnt", F.coalesce("back", "phrase").alias("head"), F.col("back").isNotNull().cast("long").alias("far")), "paths")
    while True:
        ahead = steps.select("lang", F.col("phrase").alias("head"), F.col("head").alias("_head"), F.col("far").alias("_far"))
        after = stored(steps.join(ahead, ["lang", "head"]).select("lang", "phrase", "cnt", F.col("_head").alias("head"), (F.col("far") + F.col("_far")).alias("far")), "paths")
        if after.agg(F.sum("far")).first()[0] == steps.agg(F.sum("far")).first()[0]:
            break
        steps = after
    # one row for each edge of a path: its text is as long as the passage
    joined = steps.groupBy("lang", "head", "cnt").agg(
        F.array_sort(F.collect_list(F.struct("far", _last(F.col("phrase"), 1).alias("word")))).alias("rest"), F.count(F.lit(1)).alias("edges"))
    return joined.select(
        "lang", F.concat_ws(" ", _first(F.col("head"), n), F.array_join(F.col("rest.word"), " ")).alias("passage"), (F.col("edges") + n).alias("words"), "cnt")
