"""Conversation repair, byte-pair encoding and phrases against plain versions of their rules."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from settleflow.llm import bpe, conversations, phrases
from settleflow.llm.catalogue import QUERIES, SQL
from settleflow.llm.common import stored

ROW = "conv_id long, turn long, role string, text string"
FILE = public_tokenizers.path("word_bpe_49k.json")


def collected(frame):
    return [tuple(r) for r in frame.collect()]


# 11 conversation repair

def plain_damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        out[conv] += []
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        out[conv] += [(turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode())) for c, r in out.items()}


def row_faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        out.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "o")
        seen.add((role, text))
    return out


def plain_repair(rows):
    """Cost, audit and repaired rows of least (cost, audit), one row and role order after another."""
    ways = {"": (0, "", [])}  # initials so far in short: "", s, u, a
    follow = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    full = {"u": "user", "a": "assistant"}

    def offer(into, state, way):
        if state not in into or way[:2] < into[state][:2]:
            into[state] = way

    def inserts(ways):
        for _ in range(4):
            for state, (cost, audit, made) in list(ways.items()):
                for who in "ua":
                    if (state, who) in follow:
                        offer(ways, follow[state, who], (cost + 3, audit + "I", [*made, (full[who], "")]))
        return ways

    ways = inserts(ways)
    for (_, role, text), fault in zip(rows, row_faults(rows)):
        new = {}
        for state, (cost, audit, made) in ways.items():
            offer(new, state, (cost + 4, audit + "D", made))
            if fault in "bd":
                continue
            more = 3 * (fault == "t")
            if (state, role[:1]) in follow:
                offer(new, follow[state, role[:1]], (cost + more, audit + "K", [*made, (role, text)]))
            for who in "ua":
                if (state, who) in follow:
                    offer(new, follow[state, who], (cost + 3 + more, audit + "R", [*made, (full[who], text)]))
        ways = inserts(new)
    return min((w for s, w in ways.items() if s in ("", "a")), key=lambda w: w[:2])


def plain_report(rows):
    out = {}
    for conv, kept in plain_damage(rows).items():
        cost, audit, made = plain_repair(kept)
        found, turns = Counter(row_faults(kept)), [t for t, _, _ in kept if t is not None]
        pairs = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, found["b"], found["d"], found["t"], pairs, cost, audit, digest)
    return out


def all_sequences(code, most):
    """Least (cost, audit) of all edit sequences up to a cost, by trying every one."""
    best = None
    todo = [(0, "", 0, conversations.START)]
    while todo:
        cost, audit, i, state = todo.pop()
        if 2 * i == len(code) and state in conversations.ACCEPTED and (best is None or (cost, audit) < best):
            best = cost, audit
        for step, letter, j, then in conversations._edits(code, i, state):
            if cost + step <= most:
                todo.append((cost + step, audit + letter, j, then))
    return best


def test_least_audit_agrees_with_all_edit_sequences():
    rng = random.Random(4)
    for _ in range(150):
        code = "".join(rng.choice("suax") + rng.choice("bdtooo") for _ in range(rng.randint(0, 4)))
        found = conversations.cheapest(code)
        assert found == all_sequences(code, found[0])


def test_stretches_joined_agree_with_the_whole():
    rng = random.Random(8)
    for _ in range(60):
        code = "".join(rng.choice("suaax") + rng.choice("bdtooo") for _ in range(rng.randint(2, 24)))
        size = 2 * rng.randint(1, 4)
        parts = [code[k:k + size] for k in range(0, len(code), size)]
        rows = list(conversations._solve((7, k, part, len(parts) == 1) for k, part in enumerate(parts)))
        joined = list(conversations._join(iter(rows)))
        assert [x[2] for x in joined] == parts and all(x[0] == 7 for x in joined)
        assert "".join(x[3] for x in joined) == conversations.cheapest(code)[1]
        assert all(len(edits.replace("I", "")) == len(part) // 2 for _, _, part, edits in joined)


def turns(rng, convs, longest):
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \t", "Yes. ", "naïve…", None]
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant", "user", "assistant"]
    rows = []
    for conv in convs:
        n = rng.randint(1, longest)
        for k in range(n):
            turn = rng.choice([None, k, k, k, k, k + 3])
            rows.append((conv, turn, rng.choice(roles) if rng.random() < 0.4 else ["user", "assistant"][k % 2], rng.choice(texts)))
    return rows + rows[:5]


@pytest.mark.parametrize("chunk", [512, 3])
def test_conversation_reports_agree_with_a_plain_version(spark, chunk):
    rows = turns(random.Random(3), [*range(60), None], 14)
    frame = spark.createDataFrame(rows, ROW).repartition(5)
    found = conversations.audit(conversations.damaged(frame), chunk)
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r[0]: r[1:] for r in collected(found)} == plain_report(rows)


def test_repaired_rows_have_a_legal_order_and_no_faults(spark):
    rows = turns(random.Random(5), range(30), 9)
    made = defaultdict(list)
    for conv, position, role, text in sorted(collected(conversations.repair(spark.createDataFrame(rows, ROW), 4))):
        assert position == len(made[conv])
        made[conv].append((role, text))
    assert all(re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in some)) for some in made.values())
    kept = {c: sorted([(t, " " if r is None else r, " " if x is None else x) for v, t, r, x in rows if v == c],
                      key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode())) for c in range(30)}
    assert all(made[c] == plain_repair(kept[c])[2] for c in range(30))


def test_a_long_conversation_is_solved_in_stretches(spark):
    rng = random.Random(6)
    rows = [(1, k, rng.choice(["user", "assistant", "assistant", "system"]), f"text {rng.randint(0, 900)}{rng.choice(['.', '.', ''])}") for k in range(1500)]
    rows += [(1, 9, "user", "same.")] * 300 + [(2, 0, "user", "alone.")]
    found = {r[0]: r[1:] for r in collected(conversations.audit(conversations.damaged(spark.createDataFrame(rows, ROW).repartition(4)), 64))}
    assert found == plain_report(rows)


def test_conversations_of_the_given_table(spark, small):
    table = spark.read.parquet(f"{small}/conversations.parquet")
    rows = collected(table.select("conv_id", "turn", "role", "text"))
    assert {r[0]: r[1:] for r in collected(QUERIES["op11_conversation_repair"](spark, small))} == plain_report(rows)


def test_odd_conversations(spark):
    empty = spark.createDataFrame([], ROW)
    assert collected(conversations.audit(conversations.damaged(empty))) == [] and collected(conversations.repair(empty)) == []
    rows = [(1, None, None, None), (2, 5, "user", "x" * 3_000_000), (2, 5, "user", "x" * 3_000_000), (None, None, None, "a."), (3, 1, "", "b."), (3, 2, "assistant", "")]
    wide = spark.createDataFrame(rows, ROW)
    for name in ("_row", "_tie", "gone_", "first", "code", "edits", "audit", "cost", "_copy", "_hit", "_kind"):
        wide = wide.withColumn(name, F.lit("mine"))
    assert {r[0]: r[1:] for r in collected(conversations.audit(conversations.damaged(wide)))} == plain_report(rows)
    # a conversation that loses all of its rows
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    found = collected(conversations.audit(conversations.damaged(spark.createDataFrame([(gone, 0, "user", "Hi.")], ROW))))
    assert found == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


# 12 byte-pair encoding

@pytest.fixture(scope="module")
def vocabulary():
    with open(FILE, encoding="utf-8") as f:
        return bpe.Vocabulary(f.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def same(vocabulary, library, texts):
    for text, found in zip(texts, vocabulary.encode(texts)):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(found, "<u4").tolist() == want, text
        assert vocabulary.decode(found) == library.decode(want, skip_special_tokens=False)


ODD = [None, "", " ", "a", "'s'S'll I'd've", "1234 x9y", "Hello, World!!", "ΟΔΥΣΣΕΥΣ Σ σ ς", "İstanbul ß ﬁ Å é ́x", "tab\tnew\nline\r\nx y z　", "\x1c\x1d a\x1fb\x85c",
       "<|startoftext|>a<|endoftext|>", "x<|endoftext|<|endoftext|>|>", "日本語 тест עברית 🙂👍🏽", "꟝Ᲊ \U00016ea0", "aaaa" * 50, "\0 \x7f", "don’t “q” …", "½ ² Ⅷ 一2"]


def test_encoding_agrees_with_the_library_on_odd_texts(vocabulary, library):
    same(vocabulary, library, ODD)


def test_encoding_agrees_with_the_library_on_random_texts(vocabulary, library):
    rng = random.Random(1)
    alphabet = [*"abcdefghinorstuAEST'.,!? \t\n019", "é", "ß", "ñ", "́", "Σ", "中", "🙂", "<|endoftext|>", " ", " "]
    same(vocabulary, library, ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(3000)])
    letters = "etaoinshr"
    same(vocabulary, library, [" ".join("".join(rng.choices(letters[:rng.randint(1, 9)], k=rng.randint(1, 25))) for _ in range(20)) for _ in range(500)])


def test_every_character_is_split_as_by_the_library(vocabulary, library):
    texts = [f"a{chr(c)}b 1{chr(c)}!{chr(c)}" for c in itertools.chain(range(0x3000), range(0xA000, 0xA800), range(0xF900, 0x10000), range(0x10000, 0x1FC00, 7)) if not 0xD800 <= c < 0xE000]
    same(vocabulary, library, texts)


def test_a_later_pair_of_lower_rank_goes_first():
    """Merges whose result is also a part of an earlier one: lowest rank, then leftmost, decides anew after each merge."""
    rng = random.Random(9)
    vocabulary = object.__new__(bpe.Vocabulary)
    for _ in range(300):
        names, merges = list("abc"), []
        for _ in range(7):
            a, b = rng.choices(names, k=2)
            if (a, b) not in merges:
                merges.append((a, b))
                names += [a + b] * (a + b not in names)
        rng.shuffle(merges)  # so that a part may be made after the pair that needs it
        ids = {n: k for k, n in enumerate(names)}
        vocabulary.size, vocabulary.rank = len(names), {ids[a] * len(names) + ids[b]: r for r, (a, b) in enumerate(merges)}
        vocabulary.made = [ids[a + b] for a, b in merges]
        vocabulary.inner = vocabulary.last = defaultdict(int, {ord(c): ids[c] for c in "abc"})
        words = ["".join(rng.choices("abc", k=rng.randint(1, 12))) for _ in range(6)]
        for word, found in zip(words, vocabulary.merge(words)):
            parts = list(word)
            while True:
                pairs = [(merges.index(p), k) for k, p in enumerate(zip(parts, parts[1:])) if p in merges]
                if not pairs:
                    break
                k = min(pairs)[1]
                parts[k:k + 2] = [parts[k] + parts[k + 1]]
            assert [names[i] for i in np.frombuffer(found, "<u4")] == parts


def test_long_texts_and_forgotten_words(monkeypatch, library):
    monkeypatch.setattr(bpe, "STRETCH", 40)
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    with open(FILE, encoding="utf-8") as f:
        small = bpe.Vocabulary(f.read())
    rng = random.Random(2)
    texts = ["\n".join("".join(rng.choices("the quick-brown é", k=200)) for _ in range(5)), "x" * 500, None, "", "end"]
    same(small, library, texts + ODD)
    assert "".join(part for part, _ in bpe.stretches(texts[0])) == texts[0]


def test_documents_round_trip(spark, small, library):
    rows = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    found = collected(QUERIES["op12_bpe_round_trip"](spark, small))
    assert len(found) == len(rows)
    for doc, n, ids_digest, decoded_digest in found:
        ids = library.encode(rows[doc] or "", add_special_tokens=False).ids
        assert (n, ids_digest) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert decoded_digest == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_encoding_of_odd_rows(odd, nothing, library):
    frame = odd.withColumn("ids", F.lit("mine"))
    ids = bpe.encode(frame, FILE)
    assert sorted(ids.columns) == sorted(frame.columns) and dict(ids.dtypes)["ids"] == "array<int>"
    back = bpe.decode(ids, FILE).select("text", "ids", "decoded", "score")
    for text, found, decoded, mine in collected(back):
        assert list(found) == library.encode(text or "", add_special_tokens=False).ids and decoded == library.decode(found, skip_special_tokens=False) and mine == "mine"
    assert bpe.digests(odd, FILE).count() == odd.count()
    assert bpe.encode(nothing, FILE).count() == 0 and bpe.digests(nothing, FILE).count() == 0


def test_other_rules_are_refused():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f, pytest.raises((ValueError, KeyError, TypeError)):
        bpe.Vocabulary(f.read())


# 13 phrases

def plain_counts(rows):
    counts = defaultdict(Counter)
    for _, text, lang, _ in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = [w for w in re.split("[\x20\x09]", piece) if w]
            for k in range(1, 6):
                counts["und" if lang is None else lang].update(" ".join(words[i:i + k]) for i in range(len(words) - k + 1))
    return counts


def plain_collocations(rows, least, top):
    out = []
    for lang, f in plain_counts(rows).items():
        n = sum(v for p, v in f.items() if " " not in p)
        frequent = {p: a for p, a in f.items() if a >= least and " " in p}
        kept = []
        for p, a in frequent.items():
            if any(len(q) > len(p) and f" {p} " in f" {q} " and 100 * b >= 100 * a for q, b in frequent.items()):
                continue
            words = p.split(" ")
            cuts = [(" ".join(words[:k]), " ".join(words[k:])) for k in range(1, len(words))]
            score, _, l, r = min((1000 * a * n // (f[x] * f[y]), k, f[x], f[y]) for k, (x, y) in enumerate(cuts))
            kept.append((-score, -a, p.encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n, -score))
    return sorted(out)


def wordy(rng, n):
    words = ["a", "b", "c", "D", "eé", "f\x1cg", "rare", "x", "y"]
    stops = [" ", " ", " ", " ", " ", "  ", "\t", ". ", ", ", "\n", "\x0b"]
    rows = []
    for k in range(n):
        text = "".join(rng.choices(words, weights=[9, 7, 5, 4, 3, 2, 0.2, 2, 2])[0] + rng.choice(stops) for _ in range(rng.randint(0, 40)))
        rows.append((k, rng.choice([text, text, text + " one long passage that comes again and again in full. ", None if k % 9 == 0 else text]), rng.choice(["en", "de", None]), None))
    return rows


@pytest.mark.parametrize("least,top,bits,summed", [(5, 2000, 1 << 24, 300_000), (3, 20, 32, 40), (12, 2000, 1 << 10, 7)])
def test_phrases_agree_with_a_plain_version(make, monkeypatch, least, top, bits, summed):
    monkeypatch.setattr(phrases, "SUMMED", summed)
    build = phrases.sieve
    monkeypatch.setattr(phrases, "sieve", lambda hashes: build(hashes, bits))
    rows = wordy(random.Random(least), 120)
    found = collected(phrases.collocations(make(rows).repartition(3), least, top))
    assert sorted(found) == plain_collocations(rows, least, top)


def test_counts_from_the_flow_agree_with_counts_from_texts(make):
    rows = wordy(random.Random(1), 80)
    _, found = phrases.phrase_counts(make(rows), 4)
    want = {(lang, p): a for lang, f in plain_counts(rows).items() for p, a in f.items() if a >= 4 and " " in p}
    assert {(lang, p): a for lang, p, a in collected(found)} == want


def test_the_sieves_keep_what_is_frequent_and_little_else(spark):
    words = spark.createDataFrame([("en", f"wé{k}", 100 if k % 50 == 0 else 99) for k in range(5000)], "lang string, phrase string, cnt long")
    often, rare = " ".join(f"wé{k}" for k in range(0, 5000, 50)), " ".join(f"wé{k}" for k in range(1, 5000, 50))
    docs = spark.createDataFrame([("en", often), ("en", often), ("en", rare), ("en", rare), ("en", "wé50 wé0 wé100")], "lang string, text string")
    by_word = phrases.word_sieve(words, 100)
    kept = phrases._Hashes(by_word.value, b"en")
    assert all((kept[f"wé{k}".encode()] != 0) == (k % 50 == 0) for k in range(5000))
    pairs = phrases.pair_counts(docs, by_word, 2)
    assert {(r["phrase"], r["cnt"]) for r in pairs.collect()} == {(f"wé{k} wé{k + 50}", 2) for k in range(0, 4950, 50)}
    by_pair = phrases.pair_sieve(pairs, by_word)

    def passes(text):
        _, both, hashes = phrases._hashed(by_word.value)(b"en", text.encode())
        return (both & phrases._passes(by_pair.value, hashes)).tolist()

    assert passes("wé0 wé50 wé0 wé50") == [True, False, True] and passes("wé1 wé51") == [False] and passes("wé0\nwé50") == [False, False]
    summed = phrases.edges_and_ends(docs, by_word, by_pair).groupBy("phrase").agg(F.sum("cnt"), F.sum("ended"))
    found = {p: (c, e) for p, c, e in collected(summed)}
    assert len(found) == 96 and sum(c for c, _ in found.values()) == 2 * 96 and {p: e for p, (_, e) in found.items() if e} == {" ".join(often.split()[-5:]): 2}


def test_large_numbers_stay_exact(spark, monkeypatch, make):
    big = 3 * 10**15
    words = stored(spark.createDataFrame([("en", "a", big), ("en", "b", big // 3 + 1)], "lang string, phrase string, cnt long"), "big")
    pairs = stored(spark.createDataFrame([("en", "a b", big // 7), ("en", "b a", 101)], "lang string, phrase string, cnt long"), "big")
    monkeypatch.setattr(phrases, "phrase_counts", lambda docs, least: (words, pairs))
    n = big + big // 3 + 1
    want = {p: 1000 * a * n // (big * (big // 3 + 1)) for p, a in (("a b", big // 7), ("b a", 101))}
    assert {r["phrase"]: r["score"] for r in phrases.collocations(make([])).collect()} == want


def test_passages_are_the_unary_paths(make):
    long = " ".join(f"w{k}" for k in range(40))
    rows = [(k, f"{long}. {'x y z u v w' if k % 2 else 'q y z u v w'}", "en", None) for k in range(10)]
    _, found = phrases.phrase_counts(make(rows), 5)
    paths = {(p, n, c) for _, p, n, c in collected(phrases.passages(found))}
    assert (long, 40, 10) in paths and ("y z u v w", 5, 10) in paths and ("x y z u v", 5, 5) in paths and len(paths) == 4


def test_phrases_of_odd_rows(odd, nothing):
    found = collected(phrases.collocations(odd, 2, 50))
    assert any(r[2] == "one short text" and r[0] == "en" for r in found) and {r[0] for r in found} <= {"en", "de", "fr", "und"}
    assert collected(phrases.collocations(nothing)) == [] and collected(phrases.passages(phrases.phrase_counts(nothing)[1])) == []


def test_phrases_of_the_given_table_agree_with_sql(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    want = con.execute(SQL["op13_phrase_collocations"]).fetchall()
    assert sorted(collected(QUERIES["op13_phrase_collocations"](spark, folder))) == sorted(want) and len(want) > 50
