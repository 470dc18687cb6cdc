"""Periodic runs, ranked search and repeated passages against brute force, over whole tables and odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from clockwright.llm import lexical_search, periodic_runs, substring_dedup

QUERIES = entry_points.queries()
CLASH = ("words", "runs", "collapsed", "block", "fragment", "bits", "keys", "owners", "found", "rank", "score", "query",
         "item_id", "start", "length", "period", "n", "a", "g", "h", "kept", "removed", "ids", "texts")


@pytest.fixture(scope="module")
def texts(sf_dir):
    return dict(duckdb.sql(f"select doc_id, coalesce(text, '') from '{sf_dir}/documents.parquet'").fetchall())


@pytest.fixture(scope="module")
def odd(docs_of):
    """Nulls, empties, a long text, rows that repeat in full, an id with two texts, clashing columns."""
    rng = random.Random(1)
    long = " ".join(rng.choice("alpha beta gamma delta".split()) + str(rng.randint(0, 99)) for _ in range(30_000))
    part = " ".join(long.split()[100:160])
    return docs_of([(1, None), (2, ""), (3, " \t "), (4, long), (5, part), (5, part), (5, "x " + part), (None, part),
                    (None, "naïve 漢字 \U0001f600 Text"), (7, "naïve 漢字 \U0001f600 Text")], {c: F.lit("x") for c in CLASH})


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


# --- periodic runs -----------------------------------------------------------------------------

def brute_runs(words):
    found, n = {}, len(words)
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(24, 3 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def test_runs_of_made_up_texts():
    rng = random.Random(5)
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(1, 6)):
            kinds, words = rng.choice([1, 2, 3, 20]), []
            for _ in range(rng.randint(0, 6)):
                if rng.random() < 0.6:
                    part = [rng.randint(0, kinds) for _ in range(rng.randint(1, 30))]
                    words += [part[i % len(part)] for i in range(rng.randint(1, 120))]
                else:
                    words += [rng.randint(0, kinds) for _ in range(rng.randint(0, 60))]
            known = {}
            texts.append(np.array([known.setdefault(x, len(known)) for x in words], np.int64))
        found = periodic_runs.runs_of(texts)
        for i, words in enumerate(texts):
            assert [tuple(r[1:].tolist()) for r in found if r[0] == i] == brute_runs(words.tolist())


def test_extensions():
    rng = np.random.default_rng(3)
    words = np.concatenate([rng.integers(0, 2, 200), np.tile(rng.integers(0, 3, 17), 12), rng.integers(0, 4, 50)])
    common = periodic_runs.Extensions(words)
    a, b = rng.integers(0, len(words), (2, 4000))
    a, b = a[a != b], b[a != b]
    for i, j, found in zip(a.tolist(), b.tolist(), common(a, b).tolist()):
        k = 0
        while max(i, j) + k < len(words) and words[i + k] == words[j + k]:
            k += 1
        assert found == k


def test_periodic_runs(spark, sf_dir, texts):
    rows = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, sf_dir).collect()}
    assert len(rows) == len(texts)
    some = 0
    for doc_id, text in texts.items():
        words = text.encode().split()
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute_runs(words)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        assert periodic_runs.most_repeated(runs) == best
        r = rows[doc_id]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *(best or (None,) * 3))
        assert r.exponent_milli == (best and 1000 * best[1] // best[2])
        assert r.runs_sha256 == sha("".join(f"{s},{length},{q}\n" for s, length, q in runs))
        assert r.collapsed_sha256 == sha(b" ".join(w for i, w in enumerate(words) if i not in gone))
        some += len(runs)
    assert some > 10


def test_runs_of_odd_rows(spark, odd, docs_of):
    rows = periodic_runs.periodic_runs(odd).collect()
    assert len(rows) == 10 and sum(r.n_words == 0 for r in rows) == 3 and not any(r.runs for r in rows)
    assert periodic_runs.planted(odd).count() == 10
    assert periodic_runs.periodic_runs(odd.limit(0)).count() == 0
    same = periodic_runs.periodic_runs(docs_of(["a " * 100_000, "a b " * 8, "a b c " * 40_000])).collect()
    assert [[tuple(x) for x in r.runs] for r in same] == [[(0, 100_000, 1)], [], [(0, 120_000, 3)]]
    assert [r.collapsed for r in same] == ["a", "a b " * 7 + "a b", "a b c"]
    best = spark.createDataFrame([([(0, 30, 7), (40, 60, 14), (5, 31, 7), (6, 31, 7)],), ([],)],
                                 "runs array<struct<start: long, length: long, period: long>>")
    assert [r.b and tuple(r.b) for r in best.select(periodic_runs.best_run(F.col("runs")).alias("b")).collect()] == [(5, 31, 7), None]


# --- ranked search -------------------------------------------------------------------------------

def terms(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+", lower)


def brute_search(documents, items, k):
    counted = [(i, Counter(terms(t))) for i, t in documents]
    total, count = sum(sum(c.values()) for _, c in counted), sum(bool(c) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    found = []
    for item_id, text in dict.fromkeys((i, t or "") for i, t in items):
        scores = []
        for doc_id, c in counted:
            score = 0
            for t in set(terms(text)) & set(c):
                w = math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1)))
                m = 100 - 50 + (50 * sum(c.values()) * count) // total
                score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        found += [(item_id, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores, key=lambda s: s[:3])[:k], 1)]
    return sorted(found, key=str)


@pytest.mark.parametrize("short, rows, k", [(64, 4096, 50), (2, 7, 3), (1, 40, 10), (10 ** 9, 40, 10)])
def test_search_against_brute_force(spark, docs_of, monkeypatch, short, rows, k):
    """All lists long, all short and both, in blocks of few documents, with many ties."""
    monkeypatch.setattr(lexical_search, "SHORT_PART", short)
    monkeypatch.setattr(lexical_search, "BLOCK_ROWS", rows)
    rng = random.Random(rows)
    vocabulary = [f"T{i}" for i in range(60)] + ["é", "漢字", "x9"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    texts = [(rng.choice([i, i, i, 7, None]), " -_".join(rng.choices(vocabulary, weights, k=rng.randint(0, 40)))) for i in range(300)]
    texts += [(900 + i, "t0 t1 T2") for i in range(30)] + [(3, None), (4, "...")]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 12)))) for i in range(12)]
    items += [(50, None), (51, "nowhere"), (2, "t0 t1"), (0, items[0][1]), (60, "t0 t0 t0")]
    found = lexical_search.rank_documents(docs_of(texts), spark.createDataFrame(items, "item_id long, text string"), k=k)
    assert sorted(map(tuple, found.collect()), key=str) == brute_search(texts, items, k)


def test_search_in_slices_and_on_odd_rows(spark, odd):
    items = spark.createDataFrame([(1, "alpha1 naïve"), (2, "text 漢字"), (3, "")], "item_id long, text string")
    whole = sorted(map(tuple, lexical_search.rank_documents(odd, items).collect()), key=str)
    assert sorted(map(tuple, lexical_search.rank_documents(odd, items, slice_terms=4).collect()), key=str) == whole
    assert {(r[0], r[2]) for r in whole} >= {(2, 7), (2, None), (1, 4)}
    assert [r[2] for r in whole if r[0] == 2] == [7, None]
    assert lexical_search.rank_documents(odd.limit(0), items).count() == 0
    assert lexical_search.rank_documents(odd, items.limit(0)).count() == 0


def test_walk_finds_what_reaches_the_bound():
    rng = np.random.default_rng(1)
    for _ in range(300):
        lists = []
        for _ in range(rng.integers(0, 6)):
            place = np.flatnonzero(rng.random(40) < rng.random())
            lists.append((place, rng.integers(0, 50, len(place))))
        total = np.zeros(40, np.int64)
        for place, value in lists:
            total[place] += value
        bound = int(rng.integers(0, 120))
        place, score = lexical_search.walk(lists, 40, bound)
        assert dict(zip(place.tolist(), score.tolist())) == {
            i: s for i, s in enumerate(total.tolist()) if s > 0 and s >= bound}


# --- repeated passages -----------------------------------------------------------------------------

def brute_passages(documents, width):
    """Documents as (id, text); a null id is smaller than all others."""
    order = lambda i: -(2 ** 63) if i is None else i
    least, words = {}, [(i, (t or "").encode().split()) for i, t in documents]
    for i, w in words:
        for k in range(len(w) - width + 1):
            key = tuple(w[k:k + width])
            least[key] = min(least.get(key, order(i)), order(i))
    found = []
    for i, w in words:
        gone = sorted({p for k in range(len(w) - width + 1) if least[tuple(w[k:k + width])] < order(i) for p in range(k, k + width)})
        kept = [x for p, x in enumerate(w) if p not in set(gone)]
        found.append((i, len(w), len(gone), b" ".join(kept).decode()))
    return sorted(found, key=str)


@pytest.mark.parametrize("sizes", [{}, {"block_words": 50, "fragment_words": 40, "min_fragments": 1},
                                   {"block_words": 1, "min_fragments": 3}])
def test_passages_against_brute_force(docs_of, sizes):
    rng = random.Random(8)
    passages = [[f"p{n}w{i}" for i in range(rng.randint(10, 40))] for n in range(6)]
    texts = []
    for i in range(60):
        words = []
        for _ in range(rng.randint(0, 4)):
            part = rng.choice(passages)
            cut = rng.randint(0, 8)
            words += part[cut:] + [f"own{i}x{j}" for j in range(rng.randint(0, 20))]
        texts.append((rng.choice([i, i, 5, None, -i]), rng.choice([" ", "\n", "\t "]).join(words)))
    texts += [(3, None), (3, ""), (200, "same " * 40), (201, "same " * 40)]
    found = substring_dedup.drop_repeated_passages(docs_of(texts), **sizes)
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in found.collect()), key=str) == brute_passages(texts, 13)
    for r in found.collect():
        assert sum(x.end - x.start for x in r.removed) == r.n_removed
        assert all(x.end < y.start for x, y in zip(r.removed, r.removed[1:]))


def test_passages_of_odd_rows(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    found = substring_dedup.drop_repeated_passages(odd, block_words=1000).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in found), key=str) == brute_passages(rows, 13)
    assert sum(r.n_removed for r in found) > 200
    assert substring_dedup.drop_repeated_passages(odd.limit(0)).count() == 0


def test_hashes_of_windows_depend_on_their_words_alone():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 2 ** 63, 60).astype(np.uint64)
    row = np.concatenate([rng.integers(0, 2 ** 63, 31).astype(np.uint64), words, words])
    for base in (3, 0x9E3779B97F4A7C15):
        hashes = substring_dedup.rabin_karp(row, 13, np.uint64(base))
        assert len(hashes) == len(row) - 12
        assert (hashes[31:31 + 48] == hashes[91:91 + 48]).all() and len(np.unique(hashes)) == len(hashes) - 48
    assert len(substring_dedup.rabin_karp(words[:5], 13, np.uint64(3))) == 0
