"""The operators for training text against brute force, round trips and odd inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from auditflow.llm import chat, exact_dedup, gru_lm, kneser_ney, mixing, packing, queries, simhash, url_filter, voronoi, warc
from auditflow.llm.components import connected_components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, uid string, row_key string, key string, size string, fp string, component string"
MESSY = [
    (1, "The cat sat on the mat again and again", "en", "a"), (2, "the CAT sat on the mat again and again", "en", "b"),
    (2, "the CAT sat on the mat again and again", "en", "b"), (3, None, "en", "a"), (4, "", None, None), (None, "", "en", "a"),
    (None, "The cat sat on the mat again and again", None, "c"), (5, " \t\n ", "de", None), (6, "Éa é É", "fr", "b"), (7, "éa é É", "fr", "b"),
    (8, "long " * 30_000, "en", "c"), (9, "\x1codd!\x1c \u3000 x", "en", "d"), (10, "one", "xx", "d"), (11, "a b c d", "en", "a"),
]


@pytest.fixture(scope="module")
def messy(spark):
    rows = [(i, t, lang, s, None, "u", "r", "k", "s", "f", "c") for i, t, lang, s in MESSY]
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def documents(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet").cache()


def words(text):
    return (text or "").encode().lower().split()


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def duck(sql, **tables):
    with duckdb.connect() as c:
        for name, frame in tables.items():
            c.register(name, frame)
        return sorted((tuple(r) for r in c.execute(sql).fetchall()), key=repr)


# --- components


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1060)]
    edges += [(5000, 6000 + i) for i in range(300)] + [(7, 7), (9999, 9999)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    found = connected_components(spark.createDataFrame([*edges, (None, 3), (None, None)], "a long, b long"), "a", "b")
    assert {(r.node, r.component) for r in found.collect()} == {(x, find(x)) for x in parent}
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


# --- 1 url filter


def brute_urls(pages, rules, edges):
    def split(url):
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
        return ("".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")

    graph = defaultdict(set)
    for a, b in edges:
        a, b = split(a), split(b)
        graph[a].add(b)
        graph[b].add(a)

    def own(address):
        host, path = address
        fits = [(len(h + p), a == "allow", h + p, a) for a, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fits)[2:] if fits and host else None

    out = []
    for page_id, url in pages:
        at = split(url)
        seen, todo = {at}, [at] if at[0] else []
        while todo:
            for other in graph[todo.pop()] - seen:
                seen.add(other)
                todo.append(other)
        actions = {own(x)[1] for x in seen if own(x)}
        rule, verdict = own(at) or (None, "allow" if "allow" in actions else "block" if "block" in actions else "allow")
        out.append((page_id, *at, rule, verdict))
    return sorted(out, key=repr)


def test_url_verdicts_reach_aliases(spark):
    pages = [
        (1, "https://a.NET/x?q", ""), (2, "http://b.com/de/1", '<link rel="canonical" href="https://a.net/x">'),
        (3, "http://shop.example.com/de/", "<LINK href='http://b.com/de/1' rel=canonical>"), (4, "http://c.com/z", '<meta http-equiv="refresh" content="0; URL=//b.com/de/1?x">'),
        (5, "http://d.com/a/b", '<link rel="canonical" href="c">'), (6, "http://d.com/a/c", '<link rel="canonical" href="https://example.net/en/ok">'),
        (7, "http://d.com/a/c#f", '<link rel=canonical href="http://x.net/bad">'), (8, None, '<link rel="canonical" href="http://x.net/bad">'),
        (9, "no scheme", None), (10, "http://net", ""), (11, "http://sub.example.net/en/", None), (12, "http://k.org/fr/1", '<link rel="canonical" href="/fr/2">'),
        (13, "http://k.org/fr", '<link rel="stylesheet" href="http://x.net/bad">'), (1, "https://a.NET/x?q", ""), (None, "ftp://e.com/de/", "<link rel=canonical href=#top>"),
        (15, "a://b://net/", ""), (16, "http://hop.com/", ""),
    ]
    edges = [("http://b.com/de/1", "https://a.net/x"), ("http://shop.example.com/de/", "http://b.com/de/1"), ("http://c.com/z", "http://b.com/de/1"),
             ("http://d.com/a/b", "http://d.com/a/c"), ("http://d.com/a/c", "https://example.net/en/ok"), ("http://d.com/a/c", "http://x.net/bad"),
             ("http://k.org/fr/1", "http://k.org/fr/2"), ("http://hop.com/", "http://mid.com/"), ("http://mid.com/", "http://z.net/")]
    table = spark.createDataFrame([(*p, "h", "n") for p in pages], "page_id long, url string, html string, host string, node string")
    extra = spark.createDataFrame(edges[-2:], "from_url string, to_url string")
    found = url_filter.judge_urls(table, url_filter.rules_table(spark), extra).drop("component")
    assert rows_of(found) == brute_urls([p[:2] for p in pages], url_filter.RULES, edges)
    without = url_filter.judge_urls(table, url_filter.rules_table(spark)).drop("component")
    assert rows_of(without) == duck(url_filter.ORACLE, pages=pd.DataFrame(pages, columns=["page_id", "url", "html"]).astype({"page_id": "Int64"}))
    assert url_filter.judge_urls(table.limit(0), url_filter.rules_table(spark)).count() == 0


# --- 2 quality


def brute_kneser_ney(train, min_count):
    grams = {2: Counter(), 3: Counter()}
    for text in train:
        tokens = ["<s>", *(text or "").encode().split(), "</s>"]
        for n in (2, 3):
            grams[n].update(tuple(tokens[i:i + n]) for i in range(len(tokens) - n + 1))
    adjusted = {3: dict(grams[3])}
    before = Counter(g[1:] for g in grams[3])
    adjusted[2] = {g: c if g[0] == "<s>" else before.get(g, c) for g, c in grams[2].items()}
    adjusted[1] = dict(Counter(g[1:] for g in grams[2]))

    def discounts(counts):
        n = [float(sum(c == i for c in counts.values())) for i in range(1, 5)]
        if min(n) == 0:
            return [0.5, 1.0, 1.5]
        y = n[0] / (n[0] + 2 * n[1])
        return [min(max(i + 1 - (i + 2) * y * n[i + 1] / n[i], 0.05), i + 0.95) for i in range(3)]

    d = {n: discounts(adjusted[n]) for n in (1, 2, 3)}
    cut = {n: {g: a - d[n][min(a, 3) - 1] for g, a in adjusted[n].items() if n == 1 or grams[n][g] >= min_count} for n in (1, 2, 3)}
    total, kept = {n: Counter() for n in (1, 2, 3)}, {n: Counter() for n in (1, 2, 3)}
    for n in (1, 2, 3):
        for g, a in adjusted[n].items():
            total[n][g[:-1]] += a
            kept[n][g[:-1]] += cut[n].get(g, 0)

    def prob(g):
        n = len(g)
        if n == 0:
            return 1 / (len(adjusted[1]) + 1)
        ctx = g[:-1]
        if not total[n][ctx]:
            return prob(g[1:])
        return cut[n].get(g, 0) / total[n][ctx] + (1 - kept[n][ctx] / total[n][ctx]) * prob(g[1:])

    def log_prob(text):
        tokens = ["<s>", *(text or "").encode().split(), "</s>"]
        return sum(math.log10(prob(tuple(tokens[max(0, i - 2):i + 1]))) for i in range(1, len(tokens)))

    vocabulary = [g[0] for g in adjusted[1]] + ["never seen"]
    return log_prob, lambda ctx: sum(prob((*ctx, w)) for w in vocabulary)


@pytest.mark.parametrize("hot", [1 << 18, 5])
def test_kneser_ney_matches_its_definition(spark, documents, messy, hot):
    texts = [r.text for r in documents.orderBy("doc_id").limit(60).collect()]
    log_prob, sums_to = brute_kneser_ney(texts, 2)
    assert sums_to(("<s>",)) == pytest.approx(1) and sums_to((b"of", b"the")) == pytest.approx(1)
    grams = kneser_ney.count_grams(spark.createDataFrame([(t,) for t in texts], "text string"))
    weights, unknown = kneser_ney.train(grams)
    docs = documents.select("doc_id", "text", "lang").union(messy.select("doc_id", "text", "lang"))
    found = kneser_ney.score(docs, weights, unknown, hot=hot).select("doc_id", "n_tokens", "log10_prob")
    want = sorted(((r.doc_id, len((r.text or "").encode().split()) + 1, log_prob(r.text)) for r in docs.collect()), key=repr)
    got = rows_of(found)
    assert len(got) == len(want)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    for g, w in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert g[:2] == w[:2] and g[2] == pytest.approx(w[2], rel=1e-9, abs=1e-9)


def test_quality_thresholds(spark, messy, nothing, data):
    docs, labels = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet")
    found = kneser_ney.quality_scores(docs, labels, max_train_docs=30).toPandas()
    assert len(found) == docs.count()
    judged = found.merge(labels.toPandas(), on="doc_id")
    assert judged[judged.quality == 1].kept.mean() > 0.97
    junk = spark.createDataFrame([(10**6, "Xq9### " * 40 + "zz*** " * 40, "en")], "doc_id long, text string, lang string")
    both = docs.select("doc_id", "text", "lang").union(junk)
    assert not kneser_ney.quality_scores(both, labels, max_train_docs=30).where("doc_id = 1000000").first().kept
    odd = labels.union(spark.createDataFrame([(None, 1, 0), (1, 1, 0), (1, 1, 0), (77, None, None)], labels.schema))
    assert kneser_ney.quality_scores(messy, odd).count() == len(MESSY)
    free = kneser_ney.quality_scores(messy, labels.limit(0))
    assert free.count() == len(MESSY) and free.where("NOT kept").count() == 0
    assert kneser_ney.quality_scores(nothing, labels).count() == 0


def test_thresholds_exist_at_the_default_bound(spark, documents, data):
    labels = spark.read.parquet(f"{data}/labels.parquet")
    junk = spark.createDataFrame([(10**6, "Xq9### " * 40 + "zz*** " * 40, "en")], "doc_id long, text string, lang string")
    found = kneser_ney.quality_scores(documents.select("doc_id", "text", "lang").union(junk), labels).toPandas()
    assert found.threshold.notna().all() and not found[found.doc_id == 10**6].kept.any()
    judged = found.merge(labels.toPandas(), on="doc_id")
    assert judged[judged.quality == 1].kept.mean() > 0.9


def test_training_documents_per_language(spark):
    rows = [(i, "en") for i in range(4000)] + [(10_000 + i, "de") for i in range(300)] + [(20_000 + i, None) for i in range(20)]
    drawn = kneser_ney.draw_per_language(spark.createDataFrame(rows, "t_id long, lang string"), 500)
    assert Counter(r.t_id // 10_000 for r in drawn.collect()) == {0: 240, 1: 240, 2: 20}
    assert kneser_ney.draw_per_language(spark.createDataFrame(rows[3990:], "t_id long, lang string"), 3000).count() == 330
    assert kneser_ney.MAX_TRAIN_DOCS >= 3000 and kneser_ney.KEEP_FROM == 1


def test_quantile_per_language(spark):
    rows = [("en", i / 100) for i in range(1, 101)] + [(None, 5.0)] + [("de", 2.0)] * 7
    got = {(r.every, r.lang): r.threshold for r in kneser_ney.thresholds(spark.createDataFrame(rows, "lang string, level double"), 0.9).collect()}
    assert got == {(False, "en"): 0.9, (False, None): 5.0, (False, "de"): 2.0, (True, None): 0.98}


# --- 3 exact duplicates


def brute_exact(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[(text or "").encode().lower()].append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        stays = False
        for i in ids:
            kept = i == keep and not stays
            stays |= kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(text).hexdigest()))
    return sorted(out, key=repr)


def test_exact_dedup(spark, messy, nothing, documents):
    for docs in (messy, documents, nothing):
        found = exact_dedup.exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")))
        assert rows_of(found) == brute_exact([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_cuckoo_filter_inserts_deletes_and_resizes():
    rng = random.Random(3)
    keys = [rng.getrandbits(64) | 1 for _ in range(3000)]
    live = exact_dedup.CuckooFilter()
    for key in keys:
        live.insert(key)
    assert live.buckets > 64 and live.live == len(keys) and all(live.hit(k) for k in keys)
    assert sorted(live.stored()) == sorted(keys)
    for key in keys[::2]:
        assert live.delete(key)
    assert not live.delete(keys[0]) and all(live.hit(k) for k in keys[1::2])
    assert sum(live.hit(k) for k in keys[::2]) < 100
    twins = [(7 << 20 | 5) | (i << 40) for i in range(40)]  # one fingerprint for all
    for key in twins:
        live.insert(key)
    assert all(live.hit(k) for k in twins) and live.delete(twins[3]) and twins[4] in live.stored()
    again = exact_dedup.CuckooFilter.read(pd.Series(live.row(1)))
    assert sorted(again.stored()) == sorted(live.stored())


def test_index_tables(spark):
    keys = spark.range(1, 4000).select(F.xxhash64("id").alias("key"))
    index = exact_dedup.update_index(None, keys.union(keys), 8)
    assert index.agg(F.sum("live")).first()[0] == 3999
    assert exact_dedup.probe_index(index, keys, 8).count() == 3999
    gone = keys.limit(1000)
    less = exact_dedup.update_index(index, gone, 8, delete=True)
    assert less.agg(F.sum("live")).first()[0] == 2999
    assert exact_dedup.probe_index(less, gone, 8).count() < 30
    assert exact_dedup.probe_index(less, keys.where("key IS NULL"), 8).count() == 0


# --- 4 chat


def test_chat_reads_back(spark):
    control = "</s>[INST] ok [/INST]"
    turns = [(1, 0, "system", "be [SYS] nice"), (1, 1, "user", "a\\s\\b[OUT] </s>"), (1, 2, "assistant", "\\[/INST]\n"), (2, 0, "assistant", "first"), (2, 1, "assistant", None),
             (3, 5, "user", ""), (3, 5, "user", ""), (4, None, None, "nobody [/ROLE]"), (4, 0, "tool [/ROLE] x\\", control), (None, 0, "user", "lost"),
             (5, 0, "user", "x" * 200_000), (5, 1, "assistant", control * 1000), (6, 0, "start", "s"), (6, 1, "user", "[/INST"), (6, 2, "assistant", "[/INST]</")]
    frame = spark.createDataFrame([(*t, "c", "f") for t in turns], "conv_id long, turn long, role string, text string, turns string, formatted string")
    made = chat.format_chats(frame)
    expected = duck(chat.ORACLE, conversations=pd.DataFrame(turns, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"}))
    assert rows_of(chat.digests(made)) == [r for r in expected if r[0] != -1]
    by_id = {r.conv_id: r for r in made.collect()}
    assert by_id[1].formatted.count("[SYS]") == 1 and by_id[1].first_fault is None and by_id[1].complete
    assert by_id[2].first_fault == 0 and by_id[6].first_fault == 0 and not by_id[3].complete and by_id[3].first_fault == 1
    assert [s.loss for s in by_id[1].segments] == [False] * 7 + [True, False]
    assert chat.format_chats(frame.limit(0)).count() == 0
    with pytest.raises(ValueError):
        chat.Template(other=("[A[B]", "[/ROLE]", "</s>"))


# --- 5 mixing


def test_mix_matches_sql(spark, messy, nothing, documents):
    odd = documents.select("doc_id", "text", "source").union(messy.select("doc_id", "text", "source"))
    for docs in (documents.select("doc_id", "text", "source"), odd, messy.select("doc_id", "text", "source")):
        found = mixing.fair_mix(docs).select("doc_id", "size", "source_size", "target", "taken")
        assert rows_of(found) == duck(mixing.ORACLE, documents=docs.toPandas().astype({"doc_id": "Int64"}))
    assert mixing.fair_mix(nothing).count() == 0


def test_mix_comes_near_its_targets(documents):
    found = mixing.fair_mix(documents).toPandas()
    assert (found.taken <= 2 * found["size"]).all()
    by = found.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), size=("source_size", "first"), most=("size", "max"))
    assert ((by.taken - by.target).abs() <= by.most).all() and (by.target <= 2 * by["size"] + 1e-6).all()
    assert by.target.sum() == pytest.approx(1.5 * by["size"].sum()) and by.taken.sum() <= 1.5 * by["size"].sum()


# --- 6 top-k


def test_top_k_is_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 6)]) for i in range(300)] + [(400 + i, [0.5] * 6) for i in range(120)]
    rows += [(20, [0.5] * 6), (1000, None), (1001, [1.0, None]), (1002, [float("nan")]), (1003, [float("inf")]), (None, [1.0] * 6), (1004, []), (1005, [2.0]),
             (1020, [1e7, -1e7, 3e7, 0.0, 0.0, 1.0])]
    table = spark.createDataFrame([(*r, "c", 1) for r in rows], "vec_id long, embedding array<double>, vec string, cell int").repartition(4)
    found = voronoi.top_k(table, F.col("vec_id") % 20 == 0, pivots=9, group_queries=7, block_rows=90)
    used = [(i, [math.floor(x * 64) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for n, (i, q) in enumerate(used):
        if i % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), j) for m, (j, v) in enumerate(used) if m != n)
            want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(scored[:20])]
    assert rows_of(found) == sorted(want, key=repr)
    assert voronoi.top_k(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    few = spark.createDataFrame([(20, [1.0]), (21, [2.0])], "vec_id long, embedding array<float>")
    assert rows_of(voronoi.top_k(few, F.col("vec_id") % 20 == 0)) == [(20, 1, 21, 64 * 128)]


def test_bounds_prune_without_loss():
    centres = np.array([[100.0, 0], [0, 100.0], [-100.0, 0]])
    bounds = pd.DataFrame({"cell": 0, "pivot": [0, 1, 2], "low": [9900.0, -100, -10100], "high": [10100.0, 100, -9900], "length": 101.0, "n": 5})
    nearest = pd.DataFrame({"cell": [0] * 30, "r": np.linspace(0, 2, 30)})
    groups, reach = voronoi._plan(bounds, nearest, np.array([0]), centres, 20, 100)
    assert groups == {0: (0, 1)} and reach[0][0] < 0 and reach[0][1] > 90 and reach[0][2] > 190


# --- 7 near duplicates


def brute_fingerprint(text):
    w = words(text)
    shingles = [b" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    hashes = [xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_components(items, threshold):
    prints = np.array([p for _, p in items], dtype=np.uint64)
    label = list(range(len(items)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(items)):
        for j in np.flatnonzero(np.bitwise_count(prints[i] ^ prints[:i]) <= threshold):
            a, b = sorted((find(i), find(int(j))))
            label[b] = a
    groups = defaultdict(list)
    for i in range(len(items)):
        groups[find(i)].append(items[i][0])
    least = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    return [least[find(i)] for i in range(len(items))]


def test_near_duplicates(spark, messy, nothing, documents):
    texts = [r.text for r in documents.orderBy("doc_id").limit(15).collect()]
    near = [(1000 + i, t + " extra words here", "en") for i, t in enumerate(texts)]
    for docs in (documents.select("doc_id", "text", "lang").union(spark.createDataFrame(near, "doc_id long, text string, lang string")), messy):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        prints = [brute_fingerprint(t) for _, t in rows]
        least = brute_components([(i, p) for (i, _), p in zip(rows, prints, strict=True)], 4)
        want = sorted(((i, p - (1 << 64) if p >> 63 else p, c) for (i, _), p, c in zip(rows, prints, least, strict=True)), key=repr)
        assert rows_of(simhash.near_duplicates(docs).select("doc_id", "fp", "component_id")) == want
    assert simhash.near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("block", [8192, 16])
def test_anchors_lose_no_link(spark, block):
    rng = random.Random(block)
    prints = [rng.getrandbits(64) for _ in range(150)]
    for p in prints[:100]:
        for bits in (1, 3, 4, 4, 5, 6):
            q = p
            for b in rng.sample(range(64), bits):
                q ^= 1 << b
            prints.append(q)
    hub = rng.getrandbits(64)
    prints += [hub ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(20, 40)]
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.anchor_links(spark.createDataFrame([(p,) for p in signed], "fp long"), block=block)
    assert links.count() < 40 * len(prints)
    found = {r.node: r.component for r in connected_components(links, "a", "b").collect()}
    want = brute_components(list(zip(signed, prints, strict=True)), 4)
    assert [found.get(p, p) for p in signed] == want


def test_every_point_is_covered():
    for code in simhash.codes():
        assert code.weight[code.first[:-1]].max() == 3


# --- 8 packing


def test_packing_holds_every_token_once(spark, messy, nothing, documents):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.vocabulary())
    docs = documents.select("doc_id", "text").where("doc_id <> 1").union(messy.select("doc_id", "text")).union(
        spark.createDataFrame([(501, "<|endoftext|> I'm\u00a0here\u2003now  \n\n x\u4e2d\u6587 \u0301"), (502, "a" * 5000), (503, "plain <|endoftext|> text")], "doc_id long, text string"))
    found = packing.best_fit_pack(docs.repartition(5), carry_ids=True, open_bins=8).toPandas()
    want = Counter()
    for r in docs.collect():
        want[(r.doc_id, tuple(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + (2,))] += 1
    got, pieces = Counter(), found.sort_values(["sequence_id", "offset"])
    assert (pieces.length.between(1, 1024)).all()
    assert [zlib.crc32(b) for b in pieces.ids] == pieces.ids_crc32.tolist()
    for _, group in pieces.groupby("sequence_id"):
        assert group.offset.tolist() == (group.length.cumsum() - group.length).tolist() and group.length.sum() <= 1024
    repeated = [i for i, n in Counter(r.doc_id for r in docs.collect()).items() if n > 1 or i is None]
    for doc_id, group in found[~found.doc_id.isin(repeated) & found.doc_id.notna()].sort_values("piece").groupby("doc_id"):
        assert group.start.tolist() == (group.length.cumsum() - group.length).tolist() and group.piece.tolist() == list(range(len(group)))
        assert len(group) == 1 or (group.length.iloc[1:] == 1024).all()
        got[(int(doc_id), tuple(np.frombuffer(b"".join(group.ids), "<u4").tolist()))] += 1
    assert got == Counter({k: n for k, n in want.items() if k[0] is not None and k[0] not in repeated})
    assert found.length.sum() == sum(len(k[1]) * n for k, n in want.items())
    assert found.sequence_id.nunique() <= 1.1 * found.length.sum() / 1024 + 1
    assert packing.best_fit_pack(nothing).count() == 0


def test_best_fit_is_bounded_and_fits_best():
    fit = packing.BestFit(10, open_bins=2)
    assert [fit.add(s) for s in (6, 7, 3, 4, 5, 9)] == [(0, 0), (1, 0), (1, 7), (0, 6), (2, 0), (3, 0)]
    fit.add(8)
    assert len(fit.still_open()) == 2 and 3 not in fit.still_open()


# --- 9 recurrent model


def brute_network(flat, inputs):
    """Natural log probability, one token at a time."""
    p = {k: v.astype(float) for k, v in gru_lm.views(flat).items()}
    h, total, before, H = np.zeros(gru_lm.HIDDEN), 0.0, 0, gru_lm.HIDDEN
    sig = lambda x: 1 / (1 + np.exp(-x))
    for target in inputs:
        g, a = p["W"][before], h @ p["U"]
        z, r = sig(g[:H] + a[:H]), sig(g[H:2 * H] + a[H:2 * H])
        h = (1 - z) * np.tanh(g[2 * H:] + r * a[2 * H:]) + z * h
        e = h @ p["C"] + p["c"]
        cls = target // gru_lm.HEAD_WORDS if target < gru_lm.HEAD else target - gru_lm.HEAD + gru_lm.HEAD_CLASSES
        total += e[cls] - np.log(np.exp(e).sum())
        if target < gru_lm.HEAD:
            e = h @ p["D"][cls] + p["d"][cls]
            total += e[target % gru_lm.HEAD_WORDS] - np.log(np.exp(e).sum())
        before = target
    return total


def test_network_scores_and_gradient():
    rng = np.random.default_rng(4)
    flat = rng.normal(0, 0.3, gru_lm.SIZE).astype(np.float32)
    lengths = np.array([3, 700, 1, 90, 33])
    inputs = rng.integers(0, gru_lm.HEAD + gru_lm.TAIL_CLASSES, lengths.sum())
    found = gru_lm.document_scores(flat, inputs, lengths, window=16)
    want = [brute_network(flat, part) for part in np.split(inputs, np.cumsum(lengths)[:-1])]
    assert found == pytest.approx(want, rel=1e-4)
    flat = flat.astype(float)
    x, y = rng.integers(0, 1000, (6, 3)), rng.integers(0, gru_lm.HEAD + gru_lm.TAIL_CLASSES, (6, 3))
    keep, h = np.ones((6, 3)), rng.normal(0, 0.1, (3, gru_lm.HIDDEN))
    keep[3, 1] = 0
    gradient = np.zeros_like(flat)
    gru_lm._train_window(gru_lm.views(flat), gru_lm.views(gradient), x, y, keep, h)
    for i in [*np.argsort(-np.abs(gradient))[:12], *rng.choice(np.flatnonzero(gradient), 12)]:
        sides = []
        for d in (1e-2, -1e-2):
            moved = flat.copy()
            moved[i] += d
            sides.append(-gru_lm._train_window(gru_lm.views(moved), gru_lm.views(np.zeros_like(flat)), x, y, keep, h)[0] / 18)
        assert gradient[i] == pytest.approx((sides[0] - sides[1]) / 2e-2, rel=0.03, abs=1e-4)


@pytest.mark.parametrize("hot", [1 << 18, 3])
def test_language_model_scores(spark, messy, nothing, documents, hot):
    docs = documents.select("doc_id", "text").union(messy.select("doc_id", "text"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    out = lambda i: zlib.crc32(str(i if i is not None else "").encode()) % 10 == 0
    counts = Counter(t for i, text in rows if not out(i) for t in [*words(text), None])
    total, distinct = sum(counts.values()), len(counts)
    want = sorted(((i, out(i), len(words(t)) + 1, sum(w in counts for w in [*words(t), None]), total,
                    sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in [*words(t), None])) for i, t in rows), key=repr)
    found = sorted((tuple(r) for r in gru_lm.score_documents(docs, hot=hot, rounds=1).collect()), key=repr)
    assert len(found) == len(want)
    for f, w in zip(found, want, strict=True):
        assert f[:5] == w[:5] and f[5] == pytest.approx(w[5], rel=1e-9) and f[6] < 0
    fresh = [f for f in found if f[1] and f[2] > 20]
    assert sum(f[6] for f in fresh) > sum(f[5] for f in fresh)
    if hot == 3:
        assert gru_lm.score_documents(nothing).count() == 0


def test_every_training_document_is_taken_once(spark, documents):
    rows = documents.select("doc_id", "text").repartition(3)
    turns = Counter(r[0] for r in rows.select(gru_lm.slice_of(F.col("doc_id"), gru_lm.ROUNDS)).collect())
    assert set(turns) == set(range(gru_lm.ROUNDS)) and sum(turns.values()) == rows.count()
    lexicon = gru_lm.Lexicon(gru_lm.word_counts(rows))
    model = spark.sparkContext.broadcast((lexicon, gru_lm.first_parameters(lexicon)))
    taken = 0
    for turn in range(gru_lm.ROUNDS):
        chosen = rows.where(gru_lm.slice_of(F.col("doc_id"), gru_lm.ROUNDS) == turn).select("text")
        made = chosen.mapInArrow(gru_lm._replica(model, 0.01), "part int, replica int, words long, sums binary")
        taken += sum(r.words for r in made.where("part = 0").collect())
    assert taken == lexicon.total


# --- 10 derivatives


def test_derivatives_refer_to_their_source(spark):
    page = "<html lang=fr><head><title>A &amp; B</title><script>x<1</script></head><body><p>One&nbsp;two<br>three</p><!-- no --><a href='/u?a&amp;b'>li\nnk</a> 1 < 2"
    rows = [(1, "<urn:uuid:1>", "http://a/", "2020-02-02T00:00:00Z", "HTTP/1.1 200 OK", '{"Server":"x\\r\\n y"}', page, "sha1:GIVEN", None),
            (2, None, None, None, None, None, None, None, None), (3, "<urn:uuid:3>", "http://b/", None, None, None, "<p>open <!-- never", None, None),
            (1, "<urn:uuid:1>", "http://a/", "2020-02-02T00:00:00Z", "HTTP/1.1 200 OK", '{"Server":"x\\r\\n y"}', page, "sha1:GIVEN", None), (4, "<i>", "u", None, None, None, "w " * 100_000, None, None)]
    names = "key long, record_id string, target_uri string, date string, status string, headers string, payload string, block_digest string, payload_digest string"
    table = spark.createDataFrame(rows, names).withColumn("record", F.lit("clash"))
    made = warc.derivatives(table, with_record=True).orderBy("key", "record_type").collect()
    assert len(made) == 10 and [r.key for r in made] == [1, 1, 1, 1, 2, 2, 3, 3, 4, 4]
    text, meta = made[0], made[2]
    assert text.block == "One two\nthree\nli\nnk 1 < 2" and text.refers_to == meta.refers_to == "<urn:uuid:1>"
    assert text.source_block_digest == "sha1:GIVEN" and text.source_payload_digest == warc.sha1(page.encode())
    fields = meta.block.split("\r\n")
    assert "title: A & B" in fields and "language: fr" in fields and "outlink: /u?a&b a" in fields and "source-header-server: x y" in fields
    assert made[6].block == "open" and made[4].block == "" and text.date == "2020-02-02T00:00:00Z" and made[4].date == warc.EPOCH
    parsed = warc.parse(b"".join(r.record for r in made))
    assert [b.decode() for _, b in parsed] == [r.block for r in made]
    for (headers, block), r in zip(parsed, made, strict=True):
        assert headers["WARC-Type"] == r.record_type and headers["WARC-Refers-To"] == r.refers_to and headers["WARC-Record-ID"] == r.record_id
        assert headers["WARC-Block-Digest"] == warc.sha1(block) == r.block_digest and headers["WARC-Target-URI"] == r.target_uri
        assert headers["WARC-Payload-Digest"] == r.source_payload_digest
    assert len({r.record_id for r in made}) == 8
    assert warc.derivatives(table.limit(0)).count() == 0


@pytest.mark.parametrize("page", [
    "<head><title>t</title><body>text", "<html><head><title>t</title><meta charset=x><p>text", "<head><script>'<body>x'</script><title>t</title></head><body>text",
    "<body><noscript>text", "<template><p>text", "<noscript>x</noscript>text", "<head><title>t</title><BODY class=a><p>text</p>"])
def test_open_tags_hide_no_text(page):
    assert warc.plain_text(page) == "text"


# --- queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_match_sql(spark, data, name):
    found = queries.QUERIES[name](spark, data)
    names = sorted(found.columns)
    with duckdb.connect() as c:
        for t in ("documents", "pages", "conversations", "embeddings"):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{data}/{t}.parquet')")
        want = c.sql(queries.ORACLES[name]).select(", ".join(names)).fetchall()
    assert sorted(map(repr, (tuple(r) for r in found.select(names).collect()))) == sorted(map(repr, want))


def test_all_ten_are_registered():
    assert [re.match(r"op(\d+)_", n)[1] for n in queries.QUERIES] == [str(i) for i in range(1, 11)]
