"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, per operator."""

import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from clockwright.llm import (
    bpe, components, exact_dedup, fingerprints, license_scan, line_dedup, mixing, ngram_join, secret_scan, sharding,
    toxicity,
)
from clockwright.scratch import materialize, scratch_path

#: names that the operators use themselves
CLASH = (
    "digest", "keep_id", "kept", "row", "node", "n", "slot", "shard", "words", "__words", "score", "labels", "spans",
    "base", "tokens", "topic", "key", "word", "ids", "skeleton", "lines", "removed", "rows", "block", "toxic")


def prose(seed, count):
    rng = random.Random(seed)
    return " ".join(rng.choice("alpha beta gamma delta eps zeta eta theta iota kappa".split()) + str(rng.randint(0, 99))
                    for _ in range(count))


@pytest.fixture(scope="module")
def odd(docs_of):
    """Nulls, empties, a long text, and rows that repeat in full."""
    long = prose(1, 30_000)
    return docs_of([(1, None), (2, ""), (3, "   "), (4, long), (5, long), (5, long), (None, "no id here at all"),
                    (6, "no id here at all"), (7, "naïve 漢字 \U0001f600 text")], {c: F.lit("x") for c in CLASH})


@pytest.fixture(scope="module")
def empty(docs_of):
    return docs_of([])


# --- exact duplicates ------------------------------------------------------------------------

def test_exact_on_odd_rows(odd):
    rows = exact_dedup.exact_duplicates(odd).collect()
    assert len(rows) == 9
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    assert [r.keep_id for r in by_id[1]] == [2] and by_id[1][0].group_size == 2
    assert by_id[4][0].keep_id == 5 and by_id[4][0].group_size == 3 and not by_id[4][0].kept
    assert sorted(r.kept for r in by_id[5]) == [False, True]
    assert by_id[None][0].keep_id == 6 and not by_id[None][0].kept
    assert sum(r.kept for r in rows) == 5
    kept = exact_dedup.drop_exact_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 5, 6, 7]


def test_exact_against_earlier_batches(spark, docs_of, empty):
    index = exact_dedup.DigestIndex(spark, scratch_path(spark, "test-index"), 4)
    first = docs_of([(10, "a"), (11, "b"), (12, "a")])
    second = docs_of([(1, "a"), (2, "c"), (3, "c"), (4, "d")])
    assert {r.doc_id: r.kept for r in index.add(first).collect()} == {10: False, 11: True, 12: True}
    expected = {1: (12, False), 2: (3, False), 3: (3, True), 4: (4, True)}
    for _ in range(2):      # a batch that is added again ends alike
        assert {r.doc_id: (r.keep_id, r.kept) for r in index.add(second).collect()} == expected
    assert index.rows().count() == 4
    assert index.add(empty).count() == 0
    plan = index.unknown(first.select(exact_dedup.text_digest(F.col("text")).alias("digest")).distinct())
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "Bucketed: true" in text


# --- toxicity ----------------------------------------------------------------------------------

def test_toxicity_learns_words_and_bears_odd_rows(spark, docs_of, odd, empty):
    texts = [prose(i, 40) + (" you worthless scum" if i % 3 == 0 else "") for i in range(300)]
    docs = docs_of(texts)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(200)] + [(5, None), (None, 1), (999, 1)],
                                   "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, limit=150)
    scored = docs.select("doc_id", toxicity.score_column(docs, model).alias("s")).collect()
    assert all((r.s >= 0.5) == (r.doc_id % 3 == 0) for r in scored)
    strange = odd.select("text", toxicity.score_column(odd, model).alias("s")).collect()
    assert all(0 <= r.s <= 1 for r in strange)
    assert len({r.s for r in strange if not r.text}) == 1
    assert empty.select(toxicity.score_column(empty, model)).count() == 0


def test_toxicity_without_both_classes(spark, docs_of, empty):
    docs = docs_of(["a b c", "d e f"])
    one = spark.createDataFrame([(0, 0), (1, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, one)
    assert not model.weights.any() and model.score("anything") < 0.5
    assert toxicity.fit(empty, one.limit(0)).score("x") == 0.5


def test_a_repeated_id_is_one_training_row(spark, docs_of):
    docs = docs_of([(1, f"text {i}") for i in range(50)] + [(2, "other"), (3, None)])
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, toxic int")
    rows = toxicity.training_rows(docs.repartition(5), labels, F.lit(True), 4).collect()
    chosen = max((f"text {i}" for i in range(50)), key=lambda t: hashlib.sha256(t.encode()).hexdigest())
    assert sorted((r.text, r.toxic) for r in rows) == [("", 0), ("other", 0), (chosen, 1)]


def test_ngrams_do_not_depend_on_place():
    whole = set(toxicity.buckets_of("abc def").tolist())
    assert set(toxicity.buckets_of("c d").tolist()) - set(toxicity.buckets_of("q").tolist())
    assert toxicity.buckets_of("abc").size and max(whole) < toxicity.BUCKETS


# --- line runs ---------------------------------------------------------------------------------

def plain_line_dedup(rows):
    distinct = sorted({(i, hashlib.sha256(t.encode()).hexdigest(), t) for i, t in rows})
    first, result = {}, {}
    for i, digest, text in distinct:
        lines = text.split("\n")
        for k in range(len(lines) - 2):
            first.setdefault(tuple(lines[k:k + 3]), (i, digest, k))
    for i, digest, text in distinct:
        lines, gone = text.split("\n"), set()
        for k in range(len(lines) - 2):
            f = first[tuple(lines[k:k + 3])]
            if f[:2] != (i, digest) or k >= f[2] + 3:
                gone |= {k, k + 1, k + 2}
        result[i, text] = ("\n".join(x for k, x in enumerate(lines) if k not in gone), len(lines), len(gone))
    return result


def test_line_runs_against_plain_python(docs_of):
    rng = random.Random(5)
    rows = [(i, "\n".join(rng.choice("abcdef") for _ in range(rng.randint(0, 25)))) for i in range(120)]
    rows += [(200, "q\n" * 40), (201, "\n\n\n\n\n\n"), (202, rows[3][1]), (202, rows[3][1])]
    got = line_dedup.drop_repeated_lines(docs_of(rows)).collect()
    assert len(got) == len(rows)
    want = plain_line_dedup(rows)
    assert sorted((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got) == sorted(
        (i, *want[i, t]) for i, t in rows)


def test_line_runs_on_odd_rows(odd, empty):
    got = line_dedup.drop_repeated_lines(odd)
    assert got.count() == 9 and got.where("doc_id = 1 and text is null and n_lines = 1").count() == 1
    assert line_dedup.drop_repeated_lines(empty).count() == 0


def test_long_passages_on_few_lines(docs_of):
    long, half, other = prose(11, 60), prose(12, 30), prose(13, 30)
    rows = [(1, f"{long}"), (2, f"top\n{long}\nend"), (3, f"a\nb\n{half}\n{other}\nc"), (4, f"{half}\n{other}"),
            (5, f"d\n{half}\ne"), (6, f"{long}\nx\n{long}"), (7, prose(14, 49)), (8, prose(14, 49)), (8, prose(14, 49))]
    got = {(r.doc_id, r.n_lines, r.n_removed): r.text for r in line_dedup.drop_repeated_lines(docs_of(rows)).collect()}
    assert got == {(1, 1, 0): long, (2, 3, 1): "top\nend", (3, 5, 0): rows[2][1], (4, 2, 2): "", (5, 3, 0): rows[4][1],
                   (6, 3, 2): "x", (7, 1, 0): rows[6][1], (8, 1, 0): rows[7][1]}
    only_runs = line_dedup.drop_repeated_lines(docs_of(rows), passage_words=None)
    assert only_runs.where("n_removed > 0").count() == 0


# --- mixing ------------------------------------------------------------------------------------

def test_raked_shares_meet_targets(spark, docs_of):
    rng = random.Random(2)
    rows = [(i, prose(i, rng.randint(1, 30)), rng.choice(["en", "de"]), rng.choice(["a", "b", None]), 0) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    targets = mixing.Targets({"lang": {"en": 0.3, "de": 0.7}}, temper=0.5)
    got = mixing.probabilities(docs, targets).collect()
    assert len(got) == 400 and max(r.probability for r in got) == 1.0
    weight = {}
    for r in got:
        weight[r.lang] = weight.get(r.lang, 0) + r.tokens * r.probability
    assert weight["de"] / sum(weight.values()) == pytest.approx(0.7, abs=1e-4)
    assert {r.source for r in got} == {"a", "b", mixing.MISSING}
    taken = {r.doc_id for r in got if r.sampled}
    by_broadcast = mixing.sample(docs, targets)
    assert by_broadcast.columns == docs.columns
    assert {r.doc_id for r in by_broadcast.collect()} == taken and 0 < len(taken) < 400


def test_a_rare_cell_does_not_set_the_sample(spark):
    rows = [(i, prose(i, 20), ["en", "de", None, "it"][i % 4], "a", 0) for i in range(400)]
    rows.append((1000, "one short text", "de", "rare", 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    targets = mixing.Targets({"lang": {"en": 0.5, "de": 0.5}}, temper=0.3, keep_unnamed=True)
    got = mixing.probabilities(docs, targets, share=0.6, sweeps=4).collect()
    whole = sum(r.tokens for r in got)
    kept = {}
    for r in got:
        kept[r.lang] = kept.get(r.lang, 0) + r.tokens * r.probability
    assert sum(kept.values()) == pytest.approx(0.6 * whole, rel=1e-6)
    # what the rare cell lacks goes to the others, and is reported
    assert all(0.15 * whole < kept[lang] < 0.17 * whole for lang in ("en", "it", mixing.MISSING))
    rare = mixing.cell_report(docs, targets, share=0.6, sweeps=4).where("source = 'rare'").first()
    assert rare.probability == 1.0 and rare.tokens == 3 and rare.lacking > 100
    taken = {r.doc_id for r in got if r.sampled}
    assert {r.doc_id for r in mixing.sample(docs, targets, share=0.6, sweeps=4).collect()} == taken and len(taken) > 180
    with pytest.raises(ValueError):
        mixing.sample(docs, targets, share=0)


def test_blocks_stay_where_they_are(spark, docs_of):
    vocabulary = bpe.Vocabulary.load(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    texts = [prose(i, 50) for i in range(40)]
    found = bpe.encode(docs_of(texts).repartition(4), vocabulary, block_chars=1000)
    plan = found._jdf.queryExecution().executedPlan().toString()
    # the words of fragments, and ids by block; no exchange of the blocks themselves
    assert plan.count("Exchange hashpartitioning") == 2 and "Bucketed: true" in plan
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks.value, special_tokens={})
    assert {r.doc_id: list(r.ids) for r in found.collect()} == {i: plain.encode_ordinary(t) for i, t in enumerate(texts)}


def test_a_sweep_joins_shares_alone(docs_of, monkeypatch):
    plans = []

    def noted(df, label):
        if label == "raked":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return materialize(df, label)

    monkeypatch.setattr(mixing, "materialize", noted)
    got = mixing.probabilities(docs_of([prose(i, 20 + i) for i in range(30)]), sweeps=2, tolerance=0.0)
    assert got.count() == 30 and plans
    # the shares of a dimension are summed over the joins of those before it, so joins stand in the plan 1, 3 and 7 times
    assert all(plan.count("Join ") <= 7 for plan in plans)


def test_sampling_alike_beyond_the_broadcast(docs_of, monkeypatch):
    docs = docs_of([prose(i, 5 + i % 7) for i in range(200)])
    few = {r.doc_id for r in mixing.sample(docs).collect()}
    monkeypatch.setattr(mixing, "MAX_BROADCAST_CELLS", 0)
    assert {r.doc_id for r in mixing.sample(docs).collect()} == few


def test_mixing_on_odd_rows(odd, empty):
    got = mixing.probabilities(odd)
    assert got.count() == 9 and got.where("probability < 0 or probability > 1 or probability is null").count() == 0
    assert mixing.sample(odd).columns == odd.columns
    assert mixing.probabilities(empty).count() == 0 and mixing.sample(empty).count() == 0
    nothing = mixing.Targets({"lang": {"xx": 1.0}})
    assert mixing.probabilities(odd, nothing).where("sampled").count() == 0


# --- secrets -----------------------------------------------------------------------------------

def test_secrets_positions_and_added_tokens(docs_of, odd, empty):
    hexes = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(60)]
    texts = [f"ordinary_identifier_name and unremarkableword token='{h}'" for h in hexes]
    texts += ["é\U0001f600 password: abc password = abcdefgh1", "Secret=token=abcdefgh", "password:token : abcdefghijk",
              "deadbeef" * 3, f"see 9f8e7d6c5b4a39281706f5e4 or an_ordinary_identifier_name here"]
    rows = {r.doc_id: r for r in secret_scan.scan(docs_of(texts)).select(
        "*", secret_scan.as_text(F.col("base")).alias("b"), secret_scan.as_text(F.col("spans")).alias("s")).collect()}
    assert rows[60].b == "assign:17:37" and rows[61].b == "assign:0:21" and rows[62].b == ""
    assert rows[63].n_hex == 0
    assert rows[64].s == "markov:4:28" and rows[0].n_markov == 0
    strange = secret_scan.scan(odd)
    assert strange.count() == 9 and strange.where("n_assign + n_access + n_hex > 0").count() == 0
    assert secret_scan.scan(empty).count() == 0


def test_scored_tokens_on_held_out_samples(docs_of):
    """Trained on some labelled samples, precision and recall on others: secrets of several alphabets, names and numbers."""
    rng = random.Random(6)
    alnum = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    parts = "user order total index cache table value count buffer stream record handler manager config parser token list item node".split()

    def secret():
        kind = rng.randrange(3)
        return "".join(rng.choice([alnum, alnum + "+/", "0123456789abcdef"][kind]) for _ in range(rng.randint(20, 31 if kind == 2 else 44)))

    def ordinary():
        kind = rng.randrange(4)
        if kind == 0:
            return "".join(str(rng.randrange(10)) for _ in range(rng.randint(16, 24)))
        chosen = [rng.choice(parts) for _ in range(rng.randint(4, 6))]
        return "_".join(chosen) if kind == 1 else chosen[0] + "".join(w.title() for w in chosen[1:]) if kind == 2 else "-".join(chosen)

    trained = [f"token='{secret()}' and {ordinary()}; see {rng.randrange(10 ** 9)} {ordinary()}" for _ in range(600)]
    held_out = [(True, secret()) if rng.random() < 0.5 else (False, ordinary()) for _ in range(400)]
    found = {r.doc_id: r.n_markov > 0 for r in secret_scan.scan(
        docs_of(trained + [f"it is {t} here" for _, t in held_out])).collect()}
    hits = [(label, found[600 + i]) for i, (label, _) in enumerate(held_out)]
    right = sum(a and b for a, b in hits)
    assert right >= 0.9 * sum(a for a, _ in hits) and right >= 0.9 * sum(b for _, b in hits)
    assert not any(found[600 + i] for i, (_, t) in enumerate(held_out) if t.isdigit())


def test_many_secrets_in_one_text(docs_of):
    text = " ".join(f"AKIA{i:016d}" for i in range(3000))
    row = secret_scan.scan(docs_of([text])).first()
    assert row.n_access == 3000
    assert [(s.start, s.stop) for s in row.base] == [(21 * i, 21 * i + 20) for i in range(3000)]


# --- n-gram join -------------------------------------------------------------------------------

def edited(text, places, mark):
    words = text.split()
    for p in places:
        words[p] = mark
    return " ".join(words)


def near_copies():
    """A group of many near copies, a chain, and texts on both sides of the limit."""
    base = prose(7, 200)
    rng = random.Random(9)
    texts = [edited(base, [rng.randrange(200)], f"e{i}") for i in range(150)]
    chain = [prose(8, 120)]
    for i in range(12):
        chain.append(edited(chain[-1], [5 + 9 * i], f"c{i}"))
    limit = [f"w{i}" for i in range(18)]      # 14 shingles; 12 of 16 shared is 0.75
    return texts + chain + [" ".join(limit), " ".join(limit[:16] + ["x", "y"]), " ".join(limit[:15] + ["p", "q", "r"])]


def brute(texts):
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for i in range(len(texts)):
            for j in range(i):
                both = len(sets[i] & sets[j])
                if both and 100 * both >= 75 * len(sets[i] | sets[j]) and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return label, [len(s) for s in sets]


@pytest.mark.parametrize("rounds", [((1, 1), (8, 4)), ((3, 100),), ()])
def test_join_against_all_pairs(docs_of, monkeypatch, rounds):
    monkeypatch.setattr(ngram_join, "_ROUNDS", rounds)
    texts = near_copies()
    label, sizes = brute(texts)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs_of(texts)).collect()}
    assert got == {i: (sizes[i], label[i]) for i in range(len(texts))}
    assert len(set(label)) < 10


def test_every_link_is_counted(docs_of):
    texts = near_copies()
    texts = texts[:25] + texts[150:] + [texts[0], texts[0], ""]
    sets = [{tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in (t.split() for t in texts)]
    linked = {(i, j) for i in range(len(texts)) for j in range(len(texts)) if i != j and sets[i] & sets[j]
              and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])}
    docs = docs_of(texts)
    got = {r.doc_id: (r.class_size, r.n_links) for r in ngram_join.link_counts(docs).collect()}
    assert got == {i: (sets.count(s) if s else 0, sum(a == i for a, _ in linked)) for i, s in enumerate(sets)}
    members, pairs = ngram_join.class_links(docs)
    node = {r.doc_id: r.node for r in members.collect()}
    assert sorted((r.a, r.b) for r in pairs.collect()) == sorted({
        (node[i], node[j]) for i, j in linked if node[i] < node[j]})


def test_join_on_odd_rows(odd, empty):
    rows = ngram_join.near_duplicates(odd).collect()
    assert len(rows) == 9
    found = {}
    for r in rows:
        found.setdefault(r.doc_id, set()).add((r.n_shingles, r.component_id))
    assert found[1] == {(0, 1)} and found[2] == {(0, 2)} and found[3] == {(0, 3)}
    assert {c for _, c in found[4] | found[5]} == {4}
    assert {c for _, c in found[None] | found[6]} == {6}
    kept = ngram_join.drop_near_duplicates(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 6, 7]
    assert ngram_join.near_duplicates(empty).count() == 0 and ngram_join.drop_near_duplicates(empty).count() == 0


def test_rows_follow_their_own_text(docs_of):
    a, b, c, d = (prose(40 + i, 60) for i in range(4))
    near = edited(a, [59], "end")
    rows = [(1, a), (1, b), (1, c), (2, near), (None, edited(b, [0], "first")), (None, d), (3, "  "), (3, ""), (1, c)]
    kept = ngram_join.drop_near_duplicates(docs_of(rows)).collect()
    assert sorted(((r.doc_id or 0), r.text) for r in kept) == sorted([(1, a), (1, b), (1, c), (0, d), (3, "  "), (3, "")])


def test_packed_ngrams_come_back():
    grams = np.array([0, 1, 2 ** 48 - 1, 2 ** 40 + 5], np.uint64)
    assert ngram_join._unpack(ngram_join._pack(grams)).tolist() == grams.tolist()


def test_components_of_a_long_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    labels = {r.node: r.label for r in components.components(chain).collect()}
    assert labels == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert components.components(chain.limit(0)).count() == 0


# --- byte-level BPE ----------------------------------------------------------------------------

@pytest.fixture(scope="module")
def vocabulary(spark):
    return bpe.Vocabulary.load(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.mark.parametrize("sizes", [{}, {"block_chars": 1, "fragment_words": 1}, {"block_chars": 300_000, "min_fragments": 1}])
def test_ids_do_not_depend_on_blocks_and_fragments(spark, odd, vocabulary, sizes):
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                                 mergeable_ranks=vocabulary.ranks.value, special_tokens={})
    texts = {r.doc_id: r.text or "" for r in odd.collect()}
    got = bpe.encode(odd, vocabulary, **sizes).collect()
    assert len(got) == 9
    for r in got:
        assert list(r.ids) == encoding.encode_ordinary(texts[r.doc_id])
    assert bpe.encode(odd.limit(0), vocabulary).count() == 0


def test_round_trip(spark, docs_of, vocabulary):
    texts = ["", " \t\n  x", "it's <|endoftext|> 1٣", "՘ ࢏ new letters", "ab" * 40_000, "\x85\xa0\x1c  "]
    ids = bpe.encode(docs_of(texts), vocabulary)
    back = {r.doc_id: bytes(r.b).decode() for r in ids.select("doc_id", bpe.decode(vocabulary, F.col("ids")).alias("b")).collect()}
    assert back == dict(enumerate(texts))


def test_latin_texts_split_alike():
    import regex
    usual = regex.compile(public_tokenizers.PATTERN).findall
    split = bpe.splitter(public_tokenizers.PATTERN)
    rng = random.Random(4)
    for _ in range(3000):
        text = "".join(chr(rng.randrange(256)) if rng.random() < 0.5 else rng.choice(" '\nabst1") for _ in range(12))
        assert split(text) == usual(text)


# --- sharding ----------------------------------------------------------------------------------

def test_shards_are_even_and_stable():
    names = [f"s{i}" for i in range(10)]
    table = sharding.fill_table(names, 1009)
    sizes = [table.count(i) for i in range(10)]
    assert max(sizes) - min(sizes) <= 1
    fewer = sharding.fill_table(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 9)
    assert moved < 0.2 * 1009
    for bad in (["a", "a"], []):
        with pytest.raises(ValueError):
            sharding.fill_table(bad, 1009)
    with pytest.raises(ValueError):
        sharding.fill_table(names, 1008)


def test_sharding_on_odd_rows(odd, empty):
    placed = sharding.place(odd, ["a", "b", "c"], 101)
    assert sorted(placed.columns) == sorted(odd.columns) and placed.count() == 9
    assert placed.where("shard is null").count() == 0
    assert placed.where("doc_id = 5").select("shard").distinct().count() == 1
    assert sharding.place(empty, ["a"], 101).count() == 0


# --- fingerprints ------------------------------------------------------------------------------

def plain_sketch(text):
    w = text.lower().replace("\n", " ").split()
    hashes = {hashlib.md5(" ".join(w[i:i + 5]).encode()).hexdigest()[:12] for i in range(max(1, len(w) - 4))} if w else set()
    ordered = sorted(hashes)
    return [h for i, h in enumerate(ordered) if h < fingerprints.THRESHOLD or i == 0]


def test_fingerprints_against_plain_python(docs_of):
    texts = [prose(i, n) for i, n in enumerate([1, 3, 5, 40, 400, 7, 90, 2000])] + ["", prose(4, 400)]
    rows = {r.doc_id: r for r in fingerprints.fingerprint_documents(docs_of(texts), blocks=3).collect()}
    for i, text in enumerate(texts):
        following = texts[(i + 1) % len(texts)]
        cut = len(text) // 4
        changed = text[:len(text) - cut] + following[:cut]
        assert rows[i].edited_text == changed and rows[i].n_chars == len(text)
        assert rows[i].sketch == plain_sketch(text) and rows[i].edited_sketch == plain_sketch(changed)
        assert 0 <= rows[i].near_next <= 1
    assert rows[4].sketch == rows[9].sketch
    assert rows[7].near_edited > 0.6 > rows[7].near_next


def test_next_document_over_many_blocks(docs_of):
    rng = random.Random(3)
    ids = rng.sample(range(-10 ** 6, 10 ** 12), 200) + [5, 5]
    docs = docs_of([(i, f"t{k}") for k, i in enumerate(ids)])
    for blocks in (1, 7, 64):
        got = {(r.doc_id, r.text): r.next_text for r in
               fingerprints.with_next(docs.select("doc_id", "text"), ("text",), blocks).collect()}
        order = sorted((i, f"t{k}") for k, i in enumerate(ids))
        assert got == {pair: order[(n + 1) % len(order)][1] for n, pair in enumerate(order)}


def test_fingerprints_on_odd_rows(odd, empty):
    rows = fingerprints.fingerprint_documents(odd)
    assert rows.count() == 9 and rows.where("near_edited is null or near_next is null").count() == 0
    assert fingerprints.fingerprint_documents(empty).count() == 0
    assert fingerprints.fingerprint_documents(odd.where("doc_id = 7")).first().near_next == 1.0


def test_sketches_merge(spark, docs_of):
    a, b = prose(1, 300), prose(2, 200)
    df = fingerprints.with_sketch(fingerprints.with_sketch(
        spark.createDataFrame([(a, b)], "a string, b string"), "a", "sa"), "b", "sb")
    merged = df.select(fingerprints.merge(F.col("sa"), F.col("sb"))).first()[0]
    assert merged == sorted(set(plain_sketch(a)) | set(plain_sketch(b)))[:len(merged)]


def test_short_texts_are_told_alike(spark, docs_of):
    texts = [prose(20 + i, n) for i, n in enumerate([6, 9, 12, 20, 40, 60])] + [prose(30, 500), prose(31, 9)]

    def shingled(text):
        w = text.lower().split()
        return {" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))}

    for r in fingerprints.fingerprint_documents(docs_of(texts), blocks=2, least=64).collect():
        a, b = shingled(texts[r.doc_id]), shingled(r.edited_text)
        true = len(a & b) / min(len(a), len(b))
        assert abs(r.near_edited - true) <= (1e-9 if max(len(a), len(b)) < 64 else 0.2)
    a, b = prose(1, 50), prose(2, 60)
    rows = spark.createDataFrame([(a, b)], "a string, b string")
    for name in ("a", "b"):
        rows = fingerprints.with_sketch(rows, name, f"s{name}", least=64)
    merged = rows.select(fingerprints.merge(F.col("sa"), F.col("sb"), least=64)).first()[0]
    whole = sorted(hashlib.md5(x.encode()).hexdigest()[:12] for x in shingled(a) | shingled(b))
    assert merged == [h for i, h in enumerate(whole) if h < fingerprints.THRESHOLD or i < 64]


def test_long_texts_are_fingerprinted_in_linear_time(docs_of):
    def seconds(words):
        docs = docs_of([(i, prose(50 + i, words)) for i in range(2)])
        started = time.monotonic()
        rows = fingerprints.fingerprint_documents(docs, blocks=1, least=64).collect()
        assert all(r.sketch == sorted(r.sketch) and len(r.sketch) > words // 10 for r in rows)
        return time.monotonic() - started

    seconds(1_000)
    # 25 times the words; about 600 times the steps if every hash looks at the whole list again
    assert seconds(100_000) < 40 * max(seconds(4_000), 0.5)


# --- licences ----------------------------------------------------------------------------------

def test_licences(docs_of, odd, empty):
    texts = ["Released under the MIT License.", "the mit  license; under THE MIT-license, under the mit license!",
             "Apache License, Version 2.0", "under CC BY-NC 4.0", "licensed under the GNU General Public License, version 3.",
             "GNU general public stuff", "liKense under the mit license2", "version 2 gnu general public license"]
    rows = {r.doc_id: r for r in license_scan.scan(docs_of(texts)).collect()}
    assert [rows[i].base_labels for i in range(8)] == ["mit", "mit", "apache-2", "cc-by-nc", "", "", "", ""]
    assert (rows[1].n_base, rows[1].first_word, rows[1].last_word, rows[1].n_words) == (2, 3, 7, 11)
    assert rows[4].labels == "gpl-3" and rows[4].score == 1.0 and rows[5].labels == ""
    strange = license_scan.scan(odd)
    assert strange.count() == 9 and strange.where("n_base > 0 or score > 0 or n_words is null").count() == 0
    assert license_scan.scan(empty).count() == 0
