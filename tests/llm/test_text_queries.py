"""Queries without SQL against plain Python over whole tables; the others are compared with SQL elsewhere."""

import base64
import hashlib
import re
import zlib
from collections import Counter

import duckdb
import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as entry_points

QUERIES = entry_points.queries()
NAMES = {1: "exact_dedup", 2: "toxicity", 3: "line_dedup", 4: "source_mixing", 5: "secret_scan",
         6: "ngram_jaccard_join", 7: "byte_bpe", 8: "sharding", 9: "document_fingerprints", 10: "license_scan",
         11: "periodic_runs", 12: "lexical_search", 13: "substring_dedup"}


@pytest.fixture(scope="module")
def texts(sf_dir):
    return dict(duckdb.sql(f"select doc_id, coalesce(text, '') from '{sf_dir}/documents.parquet'").fetchall())


@pytest.fixture(scope="module")
def toxic(sf_dir):
    return dict(duckdb.sql(f"select doc_id, toxic from '{sf_dir}/labels.parquet'").fetchall())


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def test_all_are_registered():
    assert {f"op{n}_{name}" for n, name in NAMES.items()} | {"pipeline"} <= set(QUERIES)


def words(text):
    upper = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
    return text.encode().translate(upper).split()


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def linked_components(sets):
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    having = {}
    for i, s in sets.items():
        for g in s:
            having.setdefault(g, []).append(i)
    for i, s in sets.items():
        for j, both in Counter(j for g in s for j in having[g] if j < i).items():
            if 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: find(i) for i in sets}


def test_ngram_join(spark, sf_dir, texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    expected = linked_components(sets)
    rows = QUERIES["op6_ngram_jaccard_join"](spark, sf_dir).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == {
        i: (len(sets[i]), expected[i]) for i in texts}
    assert len(rows) == len(texts) > len(set(expected.values()))


@pytest.fixture(scope="module")
def encoding():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe(spark, sf_dir, texts, encoding):
    rows = QUERIES["op7_byte_bpe"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = encoding.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), sha(",".join(map(str, ids))), sha(texts[r.doc_id]))


ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")


def base_spans(text):
    found = [[m for m in ASSIGN.finditer(text) if len(m[2]) >= 8],
             [m for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16],
             [m for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]]
    spans = sorted((m.start(), k, m.end()) for k, matches in enumerate(found) for m in matches)
    return [len(x) for x in found], [f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans]


def test_secret_scan(spark):
    larger = "/root/testdata/sf0.01"     # the smallest tables hold no secrets
    texts = dict(duckdb.sql(f"select doc_id, coalesce(text, '') from '{larger}/documents.parquet'").fetchall())
    rows = QUERIES["op5_secret_scan"](spark, larger).collect()
    assert len(rows) == len(texts)
    hits = 0
    for r in rows:
        counts, spans = base_spans(texts[r.doc_id])
        hits += sum(counts)
        assert [r.n_assign, r.n_access, r.n_hex] == counts
        assert r.base_sha256 == sha(",".join(spans))
        assert set(spans) <= set(r.spans.split(",") if r.spans else [])
    assert hits > 0


def test_toxicity(spark, sf_dir, texts, toxic):
    rows = QUERIES["op2_toxicity"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    learned = [(toxic[r.doc_id], r.predicted) for r in rows if r.doc_id in toxic and not r.held_out]
    assert sum(a == b for a, b in learned) >= 0.95 * len(learned)


def test_pipeline(spark, sf_dir, texts, encoding):
    """Every stage on its own input: what it drops is right, and nothing else goes."""
    import corpus_pipeline
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {"documents": set(texts)}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir).cache()
        assert docs.columns == columns
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        assert docs.count() == len(kept[name])
    assert len(kept["toxicity"]) >= 0.8 * len(texts)
    largest = {}
    for i in kept["toxicity"]:
        largest[texts[i]] = max(i, largest.get(texts[i], i))
    assert kept["exact_dedup"] == set(largest.values())
    named = linked_components({i: shingles(texts[i]) for i in kept["exact_dedup"]})
    assert kept["near_dedup"] == set(named.values())
    assert kept["mixing"] < kept["near_dedup"]
    result = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r.doc_id for r in result} == kept["mixing"]
    for r in result:
        assert list(r.ids) == encoding.encode_ordinary(texts[r.doc_id]) and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == sha(texts[r.doc_id])
