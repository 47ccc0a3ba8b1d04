"""Periodic runs, the prefix trie and token counts against brute force, SQL and odd inputs."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from auditflow.llm import prefix_trie, queries, runs, token_counts

DOCS = "doc_id long, text string, runs string, collapsed string, n_bytes string, sid_hi string"
ODD = [
    (1, "a b c d " * 4 + "e"), (2, None), (3, ""), (None, "x y " * 9), (None, None), (5, " \t\n "), (6, "same " * 40_000), (1, "a b c d " * 4 + "e"),
    (7, "Éa　b é \x1c " * 7), (8, " ".join(f"w{k % 4001}" for k in range(12_003))), (9, "one"), (10, "a a b " * 3 + "a a b a a"), (11, "<|endoftext|> the cat's \x85 中文 123"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "r", "c", "n", "s") for i, t in ODD], DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def documents(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet").cache()


# --- 11 periodic runs


def brute_runs(words, need=12):
    """Every period, every stretch of places that agree with those a period on; the least period of a stretch counts."""
    found = {}
    for p in range(1, len(words) // 2 + 1):
        at = 0
        while at + p < len(words):
            start = at
            while at + p < len(words) and words[at] == words[at + p]:
                at += 1
            if at - start + p >= max(need, 2 * p) and at > start:
                found.setdefault((start, at - start + p), p)
            at += 1
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def brute_collapsed(words, found):
    gone = {k for s, n, p in found for k in range(s + p, s + n)}
    return b" ".join(w for k, w in enumerate(words) if k not in gone).decode()


def odd_words(rng):
    n = rng.choice([0, 1, 5, 12, 13, 30, 60, 100])
    words = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(n)]
    if n and rng.random() < 0.6:
        a = rng.randrange(n)
        p = 1 + rng.randrange(max(1, (n - a) // 2))
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    if rng.random() < 0.3:
        words = words + words[:rng.randrange(len(words) + 1)] + words
    return words


@pytest.mark.parametrize(("seed", "need"), [(1, 12), (2, 12), (3, 4), (4, 2), (5, 1)])
def test_runs_match_brute_force(seed, need):
    rng = random.Random(seed)
    for _ in range(60):
        texts = [odd_words(rng) for _ in range(rng.randrange(1, 20))]
        for words, found in zip(texts, runs.find_runs([np.array(t, np.int64) for t in texts], need), strict=True):
            assert [tuple(map(int, r)) for r in found] == brute_runs(words, need)
            kept = runs.kept_words(len(words), found).tolist()
            assert kept == [k for k in range(len(words)) if not any(s + p <= k < s + n for s, n, p in found)]


@pytest.mark.parametrize("seed", [1, 2])
def test_grammar_extends_as_words_do(seed):
    rng = random.Random(seed)
    words = [rng.randrange(2) for _ in range(300)] + [1] * 200 + [0, 1, 1] * 60 + [rng.randrange(9) for _ in range(200)]
    x = np.array([-1, *words, *words[100:500], -2])
    grammar = runs.Grammar(x)
    i, j = (np.array([rng.randrange(1, len(x) - 1) for _ in range(3000)]) for _ in range(2))
    i, j = i[i != j], j[i != j]

    def brute(a, b, step):
        n = 0
        while x[a] == x[b]:
            a, b, n = a + step, b + step, n + 1
        return n

    assert grammar.forward(i, j).tolist() == [brute(a, b, 1) for a, b in zip(i, j, strict=True)]
    assert grammar.backward(i, j).tolist() == [brute(a, b, -1) for a, b in zip(i, j, strict=True)]
    assert len(grammar.symbol) < 8 * len(x)


def planted(doc_id, text):
    words, h = (text or "").encode().split(), zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def run_row(doc_id, words):
    found = brute_runs(words)
    top = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    shown = (top[0], top[1], top[2], 1000 * top[1] // top[2]) if top else (None,) * 4
    prints = ["".join(f"{s},{n},{p}\n" for s, n, p in found), brute_collapsed(words, found)]
    return (doc_id, len(found), *shown, *[hashlib.sha256(t.encode()).hexdigest() for t in prints])


def test_run_query_matches_brute_force(spark, data, documents):
    want = [run_row(r.doc_id, planted(r.doc_id, r.text)) for r in documents.collect() if len((r.text or "").split()) < 2500]
    long = [r.doc_id for r in documents.collect() if len((r.text or "").split()) >= 2500]
    got = queries.op11_periodic_runs(spark, data)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(want) + len(long)
    assert sorted(r for r in rows if r[0] not in long) == sorted(want)
    assert sum(r[1] for r in want) > 20


def test_runs_of_odd_rows(spark, odd, nothing):
    got = {r.doc_id if r.doc_id is not None else r.n_words: r for r in runs.periodic_runs(odd, block_words=50).collect()}
    assert runs.periodic_runs(odd).count() == len(ODD)
    assert [tuple(r) for r in got[1].runs] == [(0, 16, 4)] and got[1].collapsed == "a b c d e"
    assert got[2].n_words == got[3].n_words == got[5].n_words == 0 and got[2].collapsed == "" and got[2].runs == []
    assert [tuple(r) for r in got[6].runs] == [(0, 40_000, 1)] and got[6].collapsed == "same"
    assert [tuple(r) for r in got[8].runs] == [(0, 12_003, 4001)]
    assert [tuple(r) for r in got[18].runs] == [(0, 18, 2)]  # the row without an id
    assert runs.periodic_runs(nothing).count() == 0
    assert runs.digests(runs.periodic_runs(nothing)).count() == 0
    assert runs.with_planted_periods(odd).count() == len(ODD)


# --- 12 prefix trie


def brute_trie(said):
    """Rows of the query from rebuilt conversations {id: [(role, text)]}, all prefixes written out."""
    members = defaultdict(list)
    for c, turns in said.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for path, ids in members.items():
        below = [p for p in members if p[:len(path)] == path]
        children = [p for p in below if len(p) == len(path) + 1]
        leaves = sum(not any(q[:len(p)] == p and len(q) == len(p) + 1 for q in members) for p in below)
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        ends = ",".join(str(c) for c in sorted(c for c in ids if len(said[c]) == len(path)))
        up = min(members[path[:-1]]) if path else None
        out.append((min(ids), len(path), up, len(ids), len(children), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def by_conversation(rows):
    out = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            out[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in out.items()}


def brute_rebuilt(said):
    out = {}
    for c, turns in said.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = said.get(c - c % 5, [])[:h] + turns[h:]
    return out


def odd_talk(seed):
    rng = random.Random(seed)
    rows = []
    for c in range(120):
        n = rng.choice([1, 2, 3, 9, 14])
        shared = c % 3
        for t in range(n):
            text = "hello" if t == 0 and c % 2 else f"é{rng.randrange(2)}" if t > 3 else f"t{t}{shared}"
            rows.append((c, None if t == 0 and c % 7 == 0 else t, ("user", "assistant", None)[(t + c) % 3 if c % 11 == 0 else t % 2], text if rng.random() < 0.9 else None))
    for c in range(200, 230):
        rows += [(c, t, "user", f"copy{t}") for t in range(40)]
    return [*rows, (None, 0, "user", "nobody"), (301, 0, "", ""), (302, 0, None, None)]


TALK = "conv_id long, turn long, role string, text string, seq string, sid_hi string"


@pytest.mark.parametrize(("seed", "limit"), [(1, 1), (2, 5), (3, 40), (4, 100_000)])
def test_trie_matches_brute_force(spark, seed, limit):
    rows = odd_talk(seed)
    said = prefix_trie.turn_sequences(spark.createDataFrame([(*r, "q", "s") for r in rows], TALK).repartition(4))
    for made, want in ((said, by_conversation(rows)), (prefix_trie.rebuilt(said), brute_rebuilt(by_conversation(rows)))):
        got = prefix_trie.digests(prefix_trie.prefix_trie(made, limit))
        assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
        assert sorted(map(tuple, got.collect()), key=repr) == brute_trie(want)


def test_trie_joins_by_shuffle(spark, monkeypatch):
    rows = odd_talk(7)
    monkeypatch.setattr(prefix_trie, "BROADCAST_ROWS", 0)
    said = prefix_trie.turn_sequences(spark.createDataFrame([(*r, "q", "s") for r in rows], TALK))
    got = prefix_trie.digests(prefix_trie.prefix_trie(said, 3))
    assert sorted(map(tuple, got.collect()), key=repr) == brute_trie(by_conversation(rows))


def test_trie_without_conversations_and_turns(spark):
    empty = prefix_trie.turn_sequences(spark.createDataFrame([], TALK))
    assert prefix_trie.digests(prefix_trie.prefix_trie(prefix_trie.rebuilt(empty))).count() == 0
    none = spark.createDataFrame([(4, [], []), (3, [], [])], "conv_id long, seq array<long>, sizes array<long>")
    got = prefix_trie.digests(prefix_trie.prefix_trie(none)).collect()
    assert [tuple(r) for r in got] == [(3, 0, None, 2, 0, 1, 0, hashlib.sha256(b"3,4").hexdigest())]


def test_trie_query_matches_sql(spark, data):
    got = queries.op12_prefix_trie(spark, data)
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{data}/conversations.parquet'")
        found = con.execute(prefix_trie.ORACLE)
        names = [d[0] for d in found.description]
        want = found.fetchall()
    assert names == got.columns and sorted(want, key=repr) == sorted(map(tuple, got.collect()), key=repr)


# --- 13 token counts


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(token_counts.vocabulary())


PARTS = ["a", "b", " ", "  ", "\n", "\t", "'s", "'", "’", "é", "1", "23", "<|endoftext|>", "<|endof", "中", "文字", " 　", "\x1c", "\x85", "\xa0", "!", "?!",
         "\U0001F600", "ǅ", "²", "Ⅷ", "the", " the", "​", "٣", "́", "﻿", "don't", "'LL", "'ll", "\x00", "straße", " Zürich", "_", "-"]


@pytest.mark.parametrize("block", [3, 50, 1 << 18])
def test_counts_are_the_librarys(monkeypatch, block):
    monkeypatch.setattr(token_counts, "BLOCK_CHARS", block)
    rng, counter, tokenizer = random.Random(block), token_counts.Counter(token_counts.prove()), library()
    for _ in range(3000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randrange(40)))
        assert counter.count(text) == len(tokenizer.encode(text, add_special_tokens=False).ids), text


def test_proof_holds_for_every_string():
    proof, tokenizer = token_counts.prove(), library()
    assert len(proof.whole) > 45_000 and proof.names == ("<|endoftext|>",)
    assert {len(e.ids) for e in tokenizer.encode_batch(sorted(proof.whole), add_special_tokens=False)} == {1}
    with pytest.raises(ValueError, match="byte-level"):
        token_counts.prove(token_counts.vocabulary("word_bpe_49k.json"))


def test_count_query_matches_the_library(spark, data, documents):
    tokenizer = library()
    want = []
    for r in documents.collect():
        n = len(tokenizer.encode(r.text or "", add_special_tokens=False).ids)
        want.append((r.doc_id, len((r.text or "").encode()), n, n > 1024))
    got = queries.op13_token_counts(spark, data)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_counts_of_odd_rows(odd, nothing):
    tokenizer = library()
    want = [(i, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in ODD]
    got = token_counts.token_counts(odd, 10).collect()
    assert sorted((tuple(r)[:3] for r in got), key=repr) == sorted(want, key=repr)
    assert all(r.over_limit == (r.n_tokens > 10) for r in got)
    assert token_counts.token_counts(nothing, 10).count() == 0
