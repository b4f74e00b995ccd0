"""Each operator against a plain version of its rule on small tables, and on odd and empty ones."""

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from settleflow.llm import decontaminate, digests, language_id, language_model, licences, mixing, near_dedup, passages, pii, quality
from settleflow.llm.common import remainder, stored, word_blocks, words
from settleflow.llm.graph import components

WORDS = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "tu", "ro", "sa", "vi") for b in ("ban", "der", "fol", "gim", "hus", "jat", "kel", "pon", "rus")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def changed(text, rng, n):
    words = text.split()
    for k in rng.sample(range(len(words)), n):
        words[k] = rng.choice(WORDS) + "x"
    return " ".join(words)


def collected(frame):
    return [tuple(r) for r in frame.collect()]


# helpers

def test_word_blocks_lose_nothing():
    data = b" aa  bbb\tc " + b"x" * 50 + b" dd e" * 30
    for size in (1, 3, 7, 64, 1000):
        assert [w for block in word_blocks(data, size=size) for w in block] == data.split()


def test_remainder_is_crc32_of_the_id_as_text(make):
    import zlib
    rows = collected(make([(k, "") for k in range(30)]).select("doc_id", remainder(F.col("doc_id"), 5)))
    assert all(r == zlib.crc32(str(k).encode()) % 5 for k, r in rows)


def test_components_of_a_chain_a_star_and_a_pair(spark):
    edges = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(8, 30)] + [(2, 1), (1, 2), (5, 5)]
    found = dict(collected(components(spark.createDataFrame(edges, "a long, b long"))))
    assert all(found[k] == 100 for k in range(100, 141)) and all(found[k] == 7 for k in range(7, 30)) and found[2] == 1
    assert collected(components(spark.createDataFrame([], "a long, b long"))) == []


def test_stored_rows_come_back(make):
    assert collected(stored(make([(1, "a")]), "t")) == [(1, "a", None, None, 1)]


# 1 language identification

def test_language_accuracy_on_held_out_rows(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = language_id.train(docs.where(remainder(F.col("doc_id"), 3) != 1))
    found = language_id.identify(docs, model).where(remainder(F.col("doc_id"), 3) == 1).where("lang is not null")
    right, total = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right >= 0.95 * total


def plain_posteriors(rows, text):
    """Log posteriors of multinomial naive Bayes from counts of n-grams, each in the bucket its hash gives."""
    def grams(t):
        framed = f" {t.lower()} "
        for n in language_id.ORDERS:
            for k in range(len(framed) - n + 1):
                h = n
                for c in framed[k:k + n]:
                    h = ((h ^ ord(c)) * 0x9E3779B1) & 0xFFFFFFFF
                    h ^= h >> 15
                yield h % language_id.BUCKETS

    out = {}
    for lang in sorted({r[2] for r in rows}):
        mine = [r[1] for r in rows if r[2] == lang]
        counts = Counter(g for t in mine for g in grams(t))
        total = sum(counts.values()) + language_id.SMOOTHING * language_id.BUCKETS
        out[lang] = np.log(len(mine) / len(rows)) + sum(np.log((counts[g] + language_id.SMOOTHING) / total) for g in grams(text))
    return out


def test_language_is_that_of_the_highest_posterior(make):
    rng = random.Random(31)
    rows = [(k, prose(rng, 12), "aa", None) for k in range(40)] + [(99, "der hund und die katze im garten der stadt", "bb", None), (100, "the dog and the cat", "cc", None)]
    model = language_id.train(make(rows))
    # long texts of the rare languages, of mixed ones, short ones
    texts = ["der hund und die katze " * 60, "the dog and the cat " * 80, prose(rng, 300), "die katze and the dog", "hund", prose(rng, 3) + " der hund"]
    best, score = language_id._score(model, texts)
    for text, k, s in zip(texts, best, score):
        want = plain_posteriors(rows, text)
        assert model.languages[k] == max(want, key=want.get) and 0 < s <= 1


def test_only_letters_make_a_language(make):
    model = language_id.train(make([(1, "der hund", "de", None), (2, "the dog", "en", None)]))
    found = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(make([(1, "½ ² Ⅷ 12_3"), (2, "½ ² a"), (3, "漢"), (4, "①")]), model).collect()}
    assert found[1] == found[4] == "und" and found[2] != "und" and found[3] != "und"


def test_language_pieces_count_every_gram_once(monkeypatch):
    text = "".join(random.Random(1).choice("abcdef ") for _ in range(500))
    count = lambda: sum(np.bincount(language_id._buckets(p, s)[0].ravel(), minlength=language_id.BUCKETS + 1)[:-1] for _, p, s in language_id._pieces([text]))
    whole = count()
    monkeypatch.setattr(language_id, "PIECE", 17)
    assert (count() == whole).all()


def test_language_of_odd_rows(odd, nothing):
    model = language_id.train(odd)
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify(odd, model).collect()}
    assert found[1] == found[2] == found[3] == ("und", 0.0) and found[4][0] == "de" and found[5][0] == "en" and found[7][0] == "fr"
    untrained = language_id.train(nothing)
    assert {tuple(r) for r in language_id.identify(odd, untrained).select("lang_pred", "score").collect()} == {("und", 0.0)}
    assert language_id.identify(nothing, model).count() == 0


# 2 SimHash near-duplicates

def plain_simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, bits):
    root = {d: d for d in prints}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a, b in itertools.combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= bits:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {d: find(d) for d in prints}


@pytest.mark.parametrize("long_list", [400, 2])
def test_near_duplicates_agree_with_all_pairs(make, monkeypatch, long_list):
    monkeypatch.setattr(near_dedup, "LONG_LIST", long_list)
    rng = random.Random(5)
    texts = [prose(rng, 300) for _ in range(15)]
    texts += [changed(t, rng, k) for t in texts[:8] for k in (0, 1, 2)] + ["", " ", None, "a B", "A b", "É x y", "é x y"]
    prints = {k: plain_simhash(t) for k, t in enumerate(texts)}
    want = plain_components(prints, 2)
    found = collected(near_dedup.cluster(make(list(enumerate(texts)))))
    assert {(d, f, c) for d, f, c in found} == {(d, f"{prints[d]:016x}", want[d]) for d in prints}


def test_links_at_one_bit_and_at_long_lists(spark, monkeypatch):
    rng = random.Random(2)
    base = [rng.getrandbits(63) for _ in range(6)]
    prints = sorted({b ^ (1 << i) ^ (1 << j) for b in base for i in range(8) for j in range(8)} | set(base))
    frame = spark.createDataFrame([(p,) for p in prints], "_fp long")
    for limit, bits in ((400, 1), (3, 1), (400, 2), (3, 2)):
        monkeypatch.setattr(near_dedup, "LONG_LIST", limit)
        roots = dict(collected(components(near_dedup.links(frame, bits))))
        want = plain_components(dict(zip(prints, prints)), bits)
        same = lambda m: {frozenset(p for p in prints if m.get(p, p) == r) for r in {m.get(p, p) for p in prints}}
        assert same(roots) == same(want)


def test_one_row_of_each_group_stays(odd, nothing):
    kept = near_dedup.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [1, 4, 5, 7]
    assert near_dedup.keep_one(nothing).count() == near_dedup.cluster(nothing).count() == 0
    assert {(r[0], r[2]) for r in near_dedup.cluster(odd).collect()} == {(1, 1), (2, 1), (3, 1), (4, 4), (5, 5), (6, 5), (None, 5), (None, 1), (7, 7)}


# 3 benchmark decontamination

def plain_similarity(a, b):
    shared = sum((Counter(a) & Counter(b)).values())
    return shared / (len(a) + len(b) - shared)


def test_decontamination_agrees_with_every_window(make, spark):
    rng = random.Random(8)
    items = [prose(rng, n) for n in (14, 20, 33, 47, 60)] + ["Tiny item", "tiny item"]
    texts = []
    for k, item in enumerate(items[:5]):
        texts += [prose(rng, 50) + " " + item.upper().replace(" ", ", ", 2) + " " + prose(rng, 40), item, changed(item, rng, 1) + ".", prose(rng, 9) + " " + changed(item, rng, 1 + k // 2) + " " + prose(rng, 30), " ".join(item.split()[2:])]
    texts += [prose(rng, 200) for _ in range(10)] + ["a tiny item here", "tiny", "", None]
    want = {}
    for d, text in enumerate(texts):
        words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
        for i, item in enumerate(items):
            own = [w for w in re.split(r"[\W_]+", item.lower()) if w]
            size = min(5, len(own))
            target, all_ = ([tuple(v[k:k + size]) for k in range(len(v) - size + 1)] for v in (own, words))
            best = max((plain_similarity(all_[s:s + len(target)], target) for s in range(max(1, len(all_) - len(target) + 1))), default=0) if all_ else 0
            if best >= 0.8:
                want[d, i] = best
    docs, bench = make(list(enumerate(texts))), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontaminate.contaminated(docs, bench).collect()}
    assert found == pytest.approx(want) and len(want) > 15
    assert {r[0] for r in decontaminate.clean(docs, bench).select("doc_id").collect()} == set(range(len(texts))) - {d for d, _ in want}


def test_decontamination_runs_no_python(make, spark):
    plan = decontaminate.contaminated(make([(1, "a b c d e f")]), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string"))
    assert not re.search("Python|Arrow|Pandas", plan._jdf.queryExecution().executedPlan().toString())


def test_decontamination_of_odd_rows(odd, nothing, spark):
    bench = spark.createDataFrame([(1, "one short text"), (1, "one short text"), (2, None), (3, "")], "item_id long, text string")
    assert Counter((r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(odd, bench).collect()) == Counter({(5, 1): 2, (6, 1): 1, (None, 1): 1})
    left = decontaminate.clean(odd, bench)
    assert left.columns[:5] == odd.columns[:5] and left.count() == odd.count() - 4
    assert decontaminate.contaminated(nothing, bench).count() == 0 and decontaminate.clean(odd, bench.limit(0)).count() == odd.count()


# 4 quality classifier

def test_quality_on_held_out_rows(spark, small):
    folder = small.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels.where(remainder(F.col("doc_id"), 5) != 0))
    found = quality.classify(docs, model).join(labels.where(remainder(F.col("doc_id"), 5) == 0), "doc_id")
    right, total = found.agg(F.sum((F.col("quality") == F.col("predicted")).cast("int")), F.count("*")).first()
    assert right >= 0.9 * total


def test_quality_of_odd_rows(odd, nothing, spark):
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(1, 8)] + [(1, 1, 0), (None, 1, 0), (3, None, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")
    for model in (quality.train(odd, labels), quality.train(odd, labels.limit(0)), quality.train(nothing, labels)):
        rows = quality.classify(odd, model).collect()
        assert len(rows) == 10 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
        assert len({r["score"] for r in rows if r["doc_id"] in (1, 2)}) == 1 and quality.classify(nothing, model).count() == 0
    assert {r["score"] for r in quality.classify(odd, quality.train(odd, labels.limit(0))).collect()} == {0.5}


def test_quality_bounds_hold_and_training_rows_alone_matter(make, spark):
    rng = random.Random(3)
    docs = make([(k, prose(rng, 60) if k % 2 else "buy now " * 40 + str(k)) for k in range(200)])
    labels = spark.createDataFrame([(k, k % 2) for k in range(200)], "doc_id long, quality int")
    bounds = quality.Bounds(dictionary_rows=20, calibration_rows=40, sample_bytes=20_000)
    scores = quality.classify(docs, quality.train(docs, labels, bounds)).select("doc_id", "predicted").collect()
    assert all(r["predicted"] == r["doc_id"] % 2 for r in scores)


# 5 document fingerprints

def test_entropy_of_windows_is_exact():
    rng = random.Random(4)
    parts = [bytes(rng.choice(b"abcdefgh ") for _ in range(n)) for n in (200, 64, 10, 130)]
    bins, inside, offsets = digests._bins(parts)
    for part, o in zip(parts, offsets):
        for k in range(max(0, len(part) - 63)):
            counts = np.array(list(Counter(part[k:k + 64]).values()))
            want = -(counts / 64 * np.log2(counts / 64)).sum() / 6 * 1000
            assert inside[o + k] and abs(bins[o + k] - want) <= 1.01
    assert inside.sum() == sum(max(0, len(p) - 63) for p in parts)


def test_features_do_not_depend_on_segments_or_neighbours(monkeypatch):
    rng = random.Random(6)
    texts = [prose(rng, n).encode() for n in (700, 90, 3, 260)] + [b"", b"a" * 500]
    ranks = digests.ranks_of(np.arange(digests.BINS)[::-1])
    together = digests._features(texts, ranks)
    alone = [digests._features([t], ranks)[0] for t in texts]
    monkeypatch.setattr(digests, "SEGMENT", 97)
    cut = digests._features(texts, ranks)
    for a, b, c in zip(together, alone, cut):
        assert a.tolist() == b.tolist() == c.tolist()
    x, ranked = texts[0], []
    bins = digests._bins([x])[0]
    for k in range(len(x) - 63):
        ranked.append((int(ranks[bins[k]]), k))
    points = Counter(min(ranked[max(0, s):s + 64])[1] for s in range(-63, len(ranked)))
    want = [xxhash.xxh64_intdigest(x[k:k + 64], 0) for k in sorted(points) if points[k] >= digests.POINTS and ranked[k][0] < digests._NONE]
    assert together[0].tolist() == list(dict.fromkeys(want)) and len(want) > 20


@pytest.mark.parametrize("block_rows", [1000, 3])
def test_fingerprints_follow_the_order_of_ids(make, monkeypatch, block_rows):
    monkeypatch.setattr(digests, "BLOCK_ROWS", block_rows)
    rng = random.Random(7)
    docs = [(k * 3, prose(rng, rng.randint(0, 150)) if k % 7 else None) for k in range(25)]
    found = {r["doc_id"]: r for r in digests.fingerprints(make(docs)).collect()}
    order = sorted(docs, reverse=True)
    assert len(found) == 25
    for k, (d, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % 25][1] or ""
        cut = len(text) // 3
        edited = text[:len(text) - cut] + after[:cut]
        assert found[d]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and found[d]["n_chars"] == len(text)
        if len(text) > 600:
            assert found[d]["near_edited"] > 0.3 > found[d]["near_next"]


def test_fingerprints_of_odd_rows(odd, nothing, make):
    rows = digests.fingerprints(odd).collect()
    assert len(rows) == odd.count() and len({r["fingerprint"] for r in rows if r["n_chars"] == 14}) == 1
    assert {r["fingerprint"] for r in rows if r["n_chars"] == 0} == {""}
    assert digests.fingerprints(nothing).count() == 0
    only = digests.fingerprints(make([(1, "x" * 300)])).first()
    assert only["near_next"] == 1.0 and digests.fingerprints(make([(None, None)])).first()["near_next"] == 1.0


# 6 licence scan

def test_licences_found_and_plain_text_left_alone(make):
    rng = random.Random(9)
    rows = [(k, prose(rng, 40) + "\n" + prose(rng, 30)) for k in range(40)]
    lines = {100: ("MIT", "Released under the MIT License."), 101: ("Apache-2.0", "licensed under the apache license, version 2.0!"), 102: ("GPL-3.0", licences.TEMPLATES["GPL-3.0"][1]),
             103: ("CC-BY-NC", "Licensed under CC BY-NC 4.0."), 104: ("CC-BY", "Licensed under CC BY 4.0.")}
    rows += [(d, prose(rng, 30) + "\n" + line + "\n" + prose(rng, 20)) for d, (_, line) in lines.items()] + [(105, "I lost my driving license under the bridge."), (106, None), (107, ""), (100, rows[0][1])]
    docs = make(rows)
    model = licences.train(docs)
    found = licences.scan(docs, model)
    assert not re.search("Python|Arrow|Pandas", found._jdf.queryExecution().executedPlan().toString())
    assert {(r["doc_id"], r["paragraph"], r["family"]) for r in found.where("confirmed").collect()} == {(d, 1, f) for d, (f, _) in lines.items()}
    assert all(0 <= r["probability"] <= 1 for r in found.collect())


def test_licences_of_odd_rows(odd, nothing):
    model = licences.train(odd)
    assert licences.scan(odd, model).where("confirmed").count() == 0 and licences.scan(nothing, licences.train(nothing)).count() == 0


# 7 personal data

def plain_spans(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c.isdigit()]
        doubled = sum(d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(reversed(digits)))
        out += [("card", *m.span())] if 14 <= len(digits) <= 19 and doubled % 10 == 0 else []
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= sum(c.isdigit() for c in m.group()) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_plain_spans_agree_with_the_patterns():
    rng = random.Random(10)
    for _ in range(20_000):
        text = "".join(rng.choice("a1.@-+ 90(b4") for _ in range(rng.randint(0, 40)))
        assert [s[:3] for s in pii.find_spans(text) if s[3]] == plain_spans(text)
    for text in ("4111 1111 1111 1111", "+1 (555) 010-9999 x", "300.1.1.1 1.2.3.4.5.6.7.8", "é" * 5 + "x@y.zz"):
        assert [s[:3] for s in pii.find_spans(text) if s[3]] == plain_spans(text)


@pytest.mark.parametrize("text, kind, found", [
    ("write bob [at] example [dot] com", "email", "bob [at] example [dot] com"),
    ("jane.doe at mail dot example dot org please", "email", "jane.doe at mail dot example dot org"),
    ("x bоb@exаmple.com y", "email", "bоb@exаmple.com"),
    ("ｂｏｂ＠ｅｘａｍｐｌｅ．ｃｏｍ", "email", "ｂｏｂ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
    ("call plus one five five five one two three four five six seven", "phone", "plus one five five five one two three four five six seven"),
    ("host one two seven dot zero dot zero dot one up", "ip", "one two seven dot zero dot zero dot one"),
    ("no 4111 1111 1111 1l11", "card", "4111 1111 1111 1l11")])
def test_disguised_spans_map_back_to_the_source(text, kind, found):
    assert [(k, text[i:j], plain) for k, i, j, plain in pii.find_spans(text)] == [(kind, found, False)]


@pytest.mark.parametrize("text", ["look at example.com", "one two three", "polka dot dress at home", "at dot", "", None, "(at)", "seven of nine"])
def test_plain_words_are_left_alone(text):
    assert pii.find_spans(text) == []


def test_personal_data_takes_time_in_proportion():
    for text in ("a" * 200_000 + "@", "1" * 100_000 + ".", " " * 100_000 + "dot", "one " * 30_000, "[" * 50_000 + " dot "):
        assert pii.find_spans(text) == []


def test_personal_data_of_odd_rows(odd, nothing):
    rows = {r["doc_id"]: r for r in pii.digest(pii.detect(odd)).collect()}
    assert rows[7]["n_email"] == 40 and rows[7]["spans"].startswith("email:5:20,email:30:45")
    plain = ",".join(":".join(map(str, s)) for s in plain_spans("mail bob@example.com now " * 40))
    assert rows[7]["base_sha256"] == hashlib.sha256(plain.encode()).hexdigest()
    assert rows[1]["spans"] == "" and rows[1]["base_sha256"] == hashlib.sha256(b"").hexdigest() and len(pii.detect(odd).collect()) == odd.count()
    redacted = {r["doc_id"]: r["text"] for r in pii.redact(odd).collect()}
    assert redacted[7] == "mail <EMAIL> now " * 40 and redacted[1] is None and redacted[2] == ""
    assert pii.detect(nothing).count() == pii.redact(nothing).count() == 0


# 8 scores of a language model

def test_scores_agree_with_one_token_at_a_time(make):
    rng = random.Random(11)
    docs = make([(k, prose(rng, 60)) for k in range(30)] + [(99, "neu wort kaban")])
    docs = docs.union(make([(200 + k, f"selten{k % 1500} und{k} mehr") for k in range(2500)]))  # more words than the vocabulary holds
    words, shares, w = language_model.train(docs)
    found = {r["doc_id"]: r for r in language_model.score(docs, (words, shares, w)).collect()}
    assert {r["doc_id"]: r["n_tokens"] for r in language_model.train_and_score(docs).collect()} == {d: r["n_tokens"] for d, r in found.items()}
    number = {v: k for k, v in enumerate(words)}
    counts = Counter(t for r in docs.collect() for t in r["text"].split())
    assert len(words) == language_model.WORDS < len(counts)
    cells, buckets = Counter(), Counter()
    for t, n in counts.items():
        if t not in number:
            cells[xxhash.xxh64_intdigest(t, 42) % language_model.CELLS] += n
            buckets[xxhash.xxh64_intdigest(t, 42) % language_model.RARE] += n
    for d, text in [(r["doc_id"], r["text"]) for r in docs.collect()]:
        ids, total = [], 0.0
        for t in text.split():
            h = xxhash.xxh64_intdigest(t, 42)
            ids.append(number.get(t, language_model.WORDS + h % language_model.RARE))
            if t not in number:
                total += np.log((cells[h % language_model.CELLS] + 1) / (buckets[h % language_model.RARE] + language_model.CELLS // language_model.RARE))
        ids = [language_model.PAD] * 2 + ids + [language_model.PAD] * 2
        for k in range(2, len(ids) - 2):
            h = np.tanh(w["bias"] + sum(w["embed"][ids[k + o]] * p for o, p in zip((-2, -1, 1, 2), w["place"])))
            c, m = divmod(ids[k], language_model.MEMBERS)
            for z, pick in ((h @ w["to_class"] + w["class_bias"], c), (h @ w["to_member"][c] + w["member_bias"][c], m)):
                total += float(z[pick] - np.log(np.exp(z).sum()))
        assert found[d]["log_likelihood"] == pytest.approx(total, rel=1e-4) and found[d]["n_tokens"] == len(ids) - 4


def test_training_lowers_the_loss_and_gradients_are_right():
    rng = np.random.default_rng(1)
    ids = np.concatenate([[language_model.PAD] * 2, np.tile(np.arange(40), 60), [language_model.PAD] * 2])
    at = np.arange(2, len(ids) - 2)
    w, squares = language_model.initial(), {k: np.zeros(s, np.float32) for k, s in language_model._SHAPES.items()}
    before = language_model.log_probabilities(w, ids, at).mean()
    for _ in range(40):
        language_model._learn(w, squares, ids, rng.permutation(at)[:512], 0.1)
    assert language_model.log_probabilities(w, ids, at).mean() > before + 3


def test_the_rounds_learn_from_every_token_once():
    places = np.arange(3, 1001)
    for rounds in (1, 2, 3):
        assert sorted(np.concatenate([language_model.of_round(places, k, rounds) for k in range(rounds)])) == places.tolist()


def test_pieces_of_long_texts_score_the_same(monkeypatch):
    w, shares = language_model.initial(3), np.zeros(language_model.CELLS, np.float32)
    texts = [language_model.numbered(t, language_model._Ids(), shares)[0] for t in (prose(random.Random(12), 300), None, "a")]

    def total():
        return sum(language_model.log_probabilities(w, s, at).sum() for s, at, _, _ in language_model._sequences(iter(texts)))

    whole = total()
    monkeypatch.setattr(language_model, "CHUNK", 13)
    assert total() == pytest.approx(whole, rel=1e-5)


def test_scores_of_odd_rows(odd, nothing):
    model = language_model.train(odd)
    rows = {r["doc_id"]: r for r in language_model.score(odd, model).collect()}
    assert [rows[k]["n_tokens"] for k in (1, 2, 3, 4, 5)] == [0, 0, 0, 60_000, 3]
    assert rows[1]["log_likelihood"] == 0 and rows[1]["mean_log_probability"] is None and rows[5]["log_likelihood"] == pytest.approx(rows[6]["log_likelihood"])
    assert language_model.score(nothing, language_model.train(nothing)).count() == language_model.train_and_score(nothing).count() == 0


def test_scores_keep_large_ids_beside_null_ones(make):
    docs = make([(None, "one two"), ((1 << 60) + 1, "one two"), ((1 << 60) + 3, None)])
    rows = {r["doc_id"]: r["n_tokens"] for r in language_model.train_and_score(docs).collect()}
    assert rows == {None: 2, (1 << 60) + 1: 2, (1 << 60) + 3: 0}


def test_words_are_runs_of_letters_and_digits():
    rng = random.Random(31)
    odd = "aZ_9 ,.\t\n\x00\x1f\x85\xa0\xb2\xdf\u0130\u212a\u03a3\u2028\u200b\u4e00\u0661\U0001f600\U0001d7d8\u0301"
    for _ in range(300):
        text = "".join(rng.choice(odd) for _ in range(60))
        assert [w.decode() for w in words(text)] == re.findall(r"[^\W_]+", text.lower())


@pytest.mark.parametrize("n", [3, 900])
def test_a_training_step_is_the_plain_gradient_and_leaves_the_rest(n):
    rng = np.random.default_rng(5)
    ids = np.concatenate([[language_model.PAD] * 2, rng.integers(0, 700, n), [language_model.PAD] * 2])
    at = np.arange(2, n + 2)
    w, squares = language_model.initial(4), {k: np.zeros(s, np.float32) for k, s in language_model._SHAPES.items()}
    plain = {k: np.zeros(s) for k, s in language_model._SHAPES.items()}
    for k in at:
        around = [ids[k + o] for o in (-2, -1, 1, 2)]
        h = np.tanh(w["bias"] + sum(w["embed"][i] * p for i, p in zip(around, w["place"])))
        c, m = divmod(ids[k], language_model.MEMBERS)
        back = 0
        for name, bias, own, pick in (("to_class", "class_bias", ..., c), ("to_member", "member_bias", c, m)):
            z = np.exp(h @ w[name][own] + w[bias][own])
            d = z / z.sum()
            d[pick] -= 1
            plain[name][own] += np.outer(h, d) / n
            plain[bias][own] += d / n
            back = back + w[name][own] @ d / n
        back = back * (1 - h * h)
        plain["bias"] += back
        for j, i in enumerate(around):
            plain["embed"][i] += back * w["place"][j]
            plain["place"][j] += back * w["embed"][i]
    before = {k: v.copy() for k, v in w.items()}
    language_model._learn(w, squares, ids, at, 0.1)
    for k, g in plain.items():
        assert np.allclose(np.sqrt(squares[k]), np.abs(g), rtol=1e-3, atol=1e-6)
        assert np.allclose(before[k] - w[k], 0.1 * g / np.sqrt(g * g + 1e-8), atol=2e-3) and (w[k] == before[k])[g == 0].all()


# 9 repeated passages

def plain_windows(s, width):
    keys = (passages._mix(s, 1) & ~passages._LOW) | np.arange(len(s), dtype=np.uint64)
    want = set()
    for c in range(len(s)):
        left = right = c
        while left and keys[left - 1] > keys[c]:
            left -= 1
        while right + 1 < len(s) and keys[right + 1] > keys[c]:
            right += 1
        if right - left + 1 >= width:
            want.add((c, left, right))
    return want


def test_compact_windows_are_all_stretches_with_their_least_shingle():
    s = np.random.default_rng(2).integers(0, 40, 120).astype(np.uint64)
    c, smaller_l, smaller_r = passages.compact_windows(passages.signatures(s, 1, 10, np.ones(111, bool)))
    assert set(zip(c.tolist(), (smaller_l + 1).tolist(), (np.minimum(smaller_r, 120) - 1).tolist())) == plain_windows(s, 10)


@pytest.mark.parametrize("joined", [1, 300, 1 << 16])
def test_windows_do_not_depend_on_neighbouring_texts(make, monkeypatch, joined):
    monkeypatch.setattr(passages, "JOINED", joined)
    rng = random.Random(12)
    texts = {k: prose(rng, n) for k, n in enumerate((30, 50, 51, 400, 60, 3, 52, 200))}
    frame = make(list(texts.items())).select(F.col("doc_id").alias("tid"), "text").coalesce(1)
    rows = passages._windows(frame, 2, 46).collect()
    for k, text in texts.items():
        s = passages.shingle_hashes(text, passages._WordHashes())
        mine = [(r["c"], r["c"] - r["reach_l"], r["c"] + r["reach_r"]) for r in rows if r["tid"] == k and r["fn"] == 0]
        assert len(mine) == len(set(mine)) and set(mine) == plain_windows(s, 46)
    assert sorted((r["key"], r["tid"]) for r in rows) == sorted(tuple(r) for r in passages._keys(frame, 2, 46).collect())


def test_stretches_hold_eight_in_nine_wherever_the_misses_lie():
    for at in range(1, 55):
        matched = np.ones(56, bool)
        matched[max(0, at - 4):at + 1] = False
        (first, last), *more = passages._stretches(matched)
        assert (first, last) == (0 if at > 4 else at + 1, 55) and not more
    assert passages._stretches(np.zeros(5, bool)) == []
    assert passages._stretches(np.array([1] * 60 + [0] * 11 + [1] * 60, bool)) == [(0, 59), (71, 130)]
    assert passages._stretches(np.array([1] * 3 + [0] * 5 + [1] * 20, bool)) == [(0, 2), (8, 27)]


def test_repeated_passages_are_found_and_others_are_not(make):
    rng = random.Random(13)
    shared, other = prose(rng, 60), prose(rng, 50)
    near = changed(shared, rng, 1)
    texts = {1: prose(rng, 80) + " " + shared + " " + prose(rng, 70), 2: shared + " " + prose(rng, 90), 3: prose(rng, 30) + " " + near, 4: prose(rng, 200),
             5: prose(rng, 40) + " " + other.upper(), 6: other + " " + prose(rng, 10), 7: prose(rng, 70), 8: " ".join(shared.split()[:40]) + " " + prose(rng, 100), 9: prose(rng, 60)}
    texts[10] = texts[9]
    found = {r["doc_id"]: r for r in passages.repeated(make(list(texts.items()))).collect()}
    assert set(found) == {1, 2, 3, 5, 6, 9, 10}
    assert {d: r["class_id"] for d, r in found.items()} == {1: 1, 2: 1, 3: 1, 5: 5, 6: 5, 9: 9, 10: 9}
    (span,) = found[1]["passages"]
    assert span["start_word"] <= 81 and span["end_word"] >= 139 and span["end_word"] - span["start_word"] <= 66
    assert [tuple(s) for s in found[10]["passages"]] == [(0, 60)] and all(r["n_links"] >= 1 for r in found.values())


def test_every_exact_repeat_of_fifty_words_is_covered(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    words = {r["doc_id"]: re.findall(r"[^\W_]+", r["text"].lower()) for r in docs.collect()}
    where = {}
    for d, w in words.items():
        for k in range(len(w) - 49):
            where.setdefault(tuple(w[k:k + 50]), set()).add(d)
    found = {r["doc_id"]: r["passages"] for r in passages.repeated(docs).collect()}
    for d, w in words.items():
        for k in range(len(w) - 49):
            if len(where[tuple(w[k:k + 50])]) > 1:
                assert any(p["start_word"] <= k and k + 50 <= p["end_word"] for p in found[d])


def test_passages_of_odd_rows(odd, nothing, make):
    assert passages.repeated(odd).count() == 0 and passages.repeated(nothing).count() == 0
    text = prose(random.Random(14), 70)
    assert {r["doc_id"] for r in passages.repeated(make([(1, text), (2, text), (None, text), (3, "x")])).collect()} == {1, 2}


# 10 mixing

@pytest.mark.parametrize("weights", [[1, 1, 1], [0.5, 0.3, 0.2], [100, 1, 7, 3], [1], [2 ** 0.5, 1, 0.37, 1], [k ** 0.5 for k in range(1, 40)], [0.9, 1e-4, 0.05, 0.0499]])
def test_a_source_is_less_than_one_block_off_its_target_weight(weights):
    slots = 120_000
    lanes = np.array(mixing.earliest_deadline_first([slots if len(weights) == 1 else 10 ** 9] * len(weights), weights, slots)[0])
    assert len(lanes) == slots
    for k, w in enumerate(weights):  # the weights as they were given
        taken = np.r_[0, np.cumsum(lanes == k)]
        assert np.abs(taken - np.arange(slots + 1) * (w / sum(weights))).max() < 1


def test_a_new_phase_begins_when_a_source_ends():
    blocks, weights = [40, 9000, 3, 70, 5], [0.5, 0.4, 0.1, 0, 0]
    lanes = mixing.schedule(blocks, weights)
    assert [lanes.count(k) for k in range(5)] == blocks and set(lanes[-75:]) == {3, 4}
    left, at = list(blocks), 0
    for live, pull in (([0, 1, 2], weights), ([3, 4], blocks)):
        live = list(live)
        while live:
            start, total = at, sum(pull[k] for k in live)
            done = dict.fromkeys(live, 0)
            while all(left[k] for k in live):
                done[lanes[at]] += 1
                left[lanes[at]] -= 1
                at += 1
                assert all(abs(done[k] - pull[k] / total * (at - start)) < 1 for k in live)
            live = [k for k in live if left[k]]


def test_block_sizes_keep_the_schedule_bounded(make, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_BLOCKS", 20)
    monkeypatch.setattr(mixing, "MAX_LANES", 4)
    monkeypatch.setattr(mixing, "LEAST_ROWS", 1)
    docs = make([(k, "t", None, f"s{k % 7}" if k % 3 else "big") for k in range(700)])
    rows = sorted(mixing.mix(docs).collect(), key=lambda r: r["position"])
    assert [r["position"] for r in rows] == list(range(700)) and {r["doc_id"] for r in rows} == set(range(700)) and len({r["slot"] for r in rows}) <= 20


def test_mixing_keeps_columns_with_inner_names(make):
    docs = make([(k, "t", None, "ab"[k % 2]) for k in range(30)])
    for name in ("_order", "_lane", "_mix_lane", "_mix_block", "_place", "lane", "start", "rows", "name"):
        docs = docs.withColumn(name, F.concat(F.lit(name), F.col("doc_id").cast("string")))
    found = mixing.mix(docs, block_rows=4)
    assert set(found.columns) == {*docs.columns, "slot", "position"}
    assert all(r[n] == f"{n}{r['doc_id']}" for r in found.collect() for n in ("_order", "_lane", "_mix_lane", "_mix_block", "_place", "lane", "start", "rows", "name"))


def test_every_row_has_one_place(make):
    rng = random.Random(15)
    docs = make([(k, "t", None, rng.choice("aaaaab") if k % 50 else None) for k in range(1500)])
    rows = sorted(mixing.mix(docs, {"a": 0.5, "b": 0.5}, block_rows=16).collect(), key=lambda r: r["position"])
    assert [r["position"] for r in rows] == list(range(1500)) and {r["doc_id"] for r in rows} == set(range(1500))
    blocks = [(s, {r["source"] for r in g}) for s, g in ((s, list(g)) for s, g in itertools.groupby(rows, key=lambda r: r["slot"]))]
    assert [s for s, _ in blocks] == list(range(len(blocks))) and all(len(k) == 1 for _, k in blocks)
    taken = np.cumsum([k == {"a"} for _, k in blocks[:20]])
    assert np.abs(taken - 0.5 * np.arange(1, 21)).max() < 1.1


def test_digests_at_block_borders_and_of_large_ids(make, monkeypatch):
    """Long texts right behind a block's copy of the next head, and ids that floats can't tell apart next to a null."""
    monkeypatch.setattr(digests, "BLOCK_ROWS", 3)
    rng = random.Random(21)
    texts = {k: prose(rng, 12_000 if k % 3 else 30) for k in range(1, 21)}
    found = {r["doc_id"]: r for r in digests.fingerprints(make(list(texts.items()))).collect()}
    order = sorted(texts, reverse=True)
    assert set(found) == set(texts)
    for k, after in zip(order, [*order[1:], order[0]]):
        own, cut = texts[k], len(texts[k]) // 3
        assert found[k]["edited_sha256"] == hashlib.sha256((own[:len(own) - cut] + texts[after][:cut]).encode()).hexdigest()
    big = [2 ** 60 + 1, 2 ** 60 + 3, None]
    assert {r["doc_id"] for r in digests.fingerprints(make([(d, f"text {d}") for d in big])).collect()} == set(big)


def test_long_paragraphs_do_not_slow_licence_training(make):
    import time
    words = " ".join(f"wort{k % 5003}" for k in range(20_000))
    docs = make([(k, f"{words} {k}") for k in range(4)])
    begin = time.time()
    licences.train(docs)
    assert time.time() - begin < 150


def test_mixing_of_odd_rows(odd, nothing):
    rows = mixing.mix(odd).collect()
    assert sorted(r["position"] for r in rows) == list(range(10)) and mixing.mix(nothing).count() == 0
    assert sorted(r["position"] for r in mixing.mix(odd, {"a": 1.0, "missing": 2.0, "c": 0.0}).collect()) == list(range(10))
    assert sorted(r["position"] for r in mixing.mix(odd, {None: 1.0, "a": 3.0}, block_rows=1).collect()) == list(range(10))
    assert sorted(r["position"] for r in mixing.mix(odd, {}, block_rows=1).collect()) == list(range(10))


def _words(rng, n):
    return ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(n)]


def _with_decoys():
    """Pairs of texts that share a passage each, and texts that share only a third of words with it, at either end."""
    import random
    rng = random.Random(5)
    rows = []
    for k in range(4):
        shared = _words(rng, 60)
        rows += [(100 * k + j, " ".join(_words(rng, 30) + shared + _words(rng, 30))) for j in range(2)]
        rows += [(100 * k + 10 + j, " ".join(_words(rng, 30) + (shared[:45] if j % 2 else shared[15:]) + _words(rng, 30))) for j in range(16)]
    return rows


def _found(docs):
    return {r["doc_id"]: ([tuple(p) for p in r["passages"]], r["n_links"], r["class_id"]) for r in passages.repeated(docs).collect()}


def test_passages_link_all_texts_of_a_passage(make):
    import random
    rng = random.Random(3)
    shared = _words(rng, 70)
    found = _found(make([(k, " ".join(_words(rng, 40) + shared + _words(rng, 40))) for k in range(5)]))
    assert {k: v[1:] for k, v in found.items()} == {k: (4, 0) for k in range(5)}


@pytest.mark.parametrize("paired", [1, 32])
def test_passages_need_not_lie_in_the_first_text_of_a_division(make, monkeypatch, paired):
    monkeypatch.setattr(passages, "PAIRED", paired)
    found = _found(make(_with_decoys()))
    assert {k: v[1:] for k, v in found.items()} == {100 * k + j: (1, 100 * k) for k in range(4) for j in range(2)}
    assert all(p == [(30, 90)] for p, _, _ in found.values())


def test_texts_with_a_line_in_common_are_not_read_for_it(make, monkeypatch):
    checked, verified = [], passages._verified
    monkeypatch.setattr(passages, "PAIRED", 1)
    monkeypatch.setattr(passages, "_verified", lambda texts, pairs, *more: (checked.append(pairs.count()), verified(texts, pairs, *more))[1])
    rng = random.Random(8)
    line, shared = _words(rng, 34), _words(rng, 60)
    rows = [(k, " ".join(_words(rng, 40) + line + _words(rng, 40))) for k in range(30)]
    rows += [(100 + k, " ".join(_words(rng, 40) + shared + _words(rng, 40))) for k in range(2)]
    assert {k: v[1:] for k, v in _found(make(rows)).items()} == {100: (1, 100), 101: (1, 100)}
    assert sum(checked) < 10


def test_neighbourhoods_tell_pairs_without_a_passage():
    rng = np.random.default_rng(9)
    width, reach = 46, 90
    a, b = (rng.integers(1, 1 << 16, 2 * reach + 1).astype(np.uint16) for _ in range(2))

    def may(first, end, left=1000, right=1000, shift=0, wrong=()):
        other = b.copy()
        other[first + shift:end + shift] = a[first:end]
        other[list(wrong)] = 0
        return bool(passages.may_share(a[None], other[None], np.array([left]), np.array([right]), width)[0])

    for first in range(46, 90):
        assert may(first, first + 46) and may(first, first + 46, 90 - first, first + 45 - 90) and may(first, first + 46, shift=10)
        assert not may(first, first + 46, 90 - first, first + 44 - 90)
    assert not any(may(first, first + 40) for first in range(56, 85))
    assert may(60, 111, wrong=range(70, 75)) and not may(60, 106, wrong=range(70, 80))
    assert may(90, 181) and may(0, 91) and not may(91, 91)


def test_likeness_and_stretches_agree_with_plain_ones():
    rng = np.random.default_rng(10)
    for _ in range(200):
        a, b = rng.integers(0, 12, rng.integers(1, 30)).astype(np.uint64), rng.integers(0, 12, rng.integers(1, 30)).astype(np.uint64)
        x, y = Counter(a.tolist()), Counter(b.tolist())
        assert passages._similarity(a, b) == (x & y).total() / (x | y).total()
        assert np.array_equal(passages._among(a, np.sort(b)), np.isin(a, b))
    assert not passages._among(a, a[:0]).any()


@pytest.mark.parametrize("block", [1 << 10, 15])
def test_all_links_of_a_large_division_count(make, monkeypatch, block):
    monkeypatch.setattr(passages, "BLOCK", block)
    rng = random.Random(21)
    shared = _words(rng, 70)
    found = _found(make([(k, " ".join(_words(rng, 20) + shared + _words(rng, 20))) for k in range(50)]))
    assert found == {k: ([(20, 90)], 49, 0) for k in range(50)}


def test_passages_of_texts_of_one_class_are_all_marked(make):
    """All texts share one passage; in another large division two of them share more than their first."""
    rng = random.Random(22)
    shared, more = _words(rng, 60), _words(rng, 60)
    rows = [(k, " ".join(shared + _words(rng, 20) + (more[:40] if 1 < k < 38 else more) + _words(rng, 20))) for k in range(40)]
    found = _found(make(rows))
    for k in (0, 1, 38, 39):
        assert found[k] == ([(0, 60), (80, 140)], 39, 0)
    assert all(found[k] == ([(0, 60)], 39, 0) for k in range(2, 38))


def test_runs_of_a_phrase_are_repeated_as_a_whole(make):
    rng = random.Random(23)
    rows = [(k, " ".join(_words(rng, 30) + ["on", "and"] * n + _words(rng, 30))) for k, n in enumerate((500, 40, 60))]
    found = _found(make(rows))
    for k, n in enumerate((500, 40, 60)):
        ((first, end),), links, of = found[k]
        assert 28 <= first <= 32 and 2 * n + 28 <= end <= 2 * n + 32 and (links, of) == (2, 0)


def test_signatures_inside_a_run_are_left_out():
    s = np.concatenate([np.random.default_rng(24).integers(1 << 40, 1 << 50, 100, dtype=np.uint64), np.tile(np.array([7, 8, 9], np.uint64), 200)])
    c = (passages.signatures(s, 1, 46, np.ones(len(s) - 45, bool)) & passages._LOW).astype(np.int64)
    kept, head = passages._runs(s, c, np.zeros(len(c), np.int64), 22)
    step, run = passages._begun(c, kept, head)
    assert kept.sum() < 12 < len(c) and step.max() == 3 and run.max() > 500
    assert passages._runs(s, c[:0], c[:0], 22)[0].tolist() == []


def test_stretches_around_a_window_are_the_longest():
    rng = np.random.default_rng(25)
    for _ in range(300):
        matched = rng.random((1, 61)) < rng.choice([0.8, 0.9, 0.95])
        matched[0, 30] = True
        within = passages._within_gaps(matched)[0]
        best = max((j - i + 1 for i in range(31) for j in range(30, 61) if within[i] and within[j] and 9 * within[i:j + 1].sum() >= 8 * (j - i + 1)))
        first, last, hits = passages._around(matched, 10)
        assert last[0] - first[0] + 1 == best and hits[0] == (within[first[0]:last[0] + 1].sum() if best >= 10 else 0)
