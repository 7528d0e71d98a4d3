"""Toxicity on held-out labels; the language model against its definition and its base."""

import math
import re
import zlib
from collections import Counter

import numpy as np

from __spark_entry__ import LLM_QUERIES
from starmart.llm import pitman_yor, queries, toxicity
from tests.llm.conftest import ODD

SF_DIR = "/root/testdata/sf0.1"


def test_toxicity_on_held_out_rows(spark):
    rows = LLM_QUERIES["op3_toxicity"](spark, SF_DIR).join(spark.read.parquet(f"{SF_DIR}/labels.parquet"), "doc_id").toPandas()
    held = rows[rows.held_out]
    assert rows.score.between(0, 1).all()
    assert (held.predicted[held.toxic == 1]).mean() > 0.8 and (held.predicted[held.toxic == 0]).mean() < 0.02


def test_toxicity_of_odd_documents(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (8, 0), (9, 0), (4, 0), (1, 0), (None, 1), (10, 3)], "doc_id long, toxic int")
    model = toxicity.fit(toxicity.labelled_texts(odd, labels, queries.held_out(4, 2)))
    scores = [r.score for r in toxicity.score(odd, model).collect()]
    assert len(scores) == len(ODD) and all(0 <= s <= 1 for s in scores)
    assert toxicity.score(none, model).count() == 0
    empty = toxicity.fit(toxicity.labelled_texts(none, labels, queries.held_out(4, 2)))
    assert toxicity.score(odd, empty).where("score = 0.5").count() == len(ODD)


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), ""]


def test_language_model_counts_and_beats_its_base(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = LLM_QUERIES["op5_pitman_yor"](spark, sf_dir).collect()
    texts = {r.doc_id: tokens(r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    counts = Counter(w for i, t in texts.items() if zlib.crc32(str(i).encode()) % 10 for w in t)
    n, v = sum(counts.values()), len(counts)
    assert len(rows) == len(texts)
    for r in rows:
        own = texts[r.doc_id]
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts[w] > 0 for w in own), n)
        assert abs(r.base_score - base) < 1e-6 * abs(base) and r.score < 0
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_predictive_probabilities_sum_to_one():
    draw = np.random.default_rng(3)
    pairs = np.unique(draw.integers(0, pitman_yor.CLASSES, (5000, 2)), axis=0)
    mean = pitman_yor.sampled(pairs[:, 0], pairs[:, 1], draw.integers(1, 3000, len(pairs)), 1)
    assert np.allclose(mean.sum(axis=1), 1) and (mean > 0).all()


def test_customers_keep_their_seats_through_sweeps():
    draw = np.random.default_rng(5)
    n = np.array([1, 2, 3, 40, 5000, 1, 7])
    at = np.array([0, 0, 0, 1, 1, 2, 2])
    held = pitman_yor.Restaurants(at, n, np.full(7, 0.1), 3, 1.0, 0.5, draw)
    for _ in range(20):
        held.sweep(np.full(7, 0.1))
        pair = np.repeat(np.arange(len(held.many)), held.held)
        assert (np.bincount(pair, held.size) == n[held.many]).all()
        assert (np.bincount(pair[held.size > 0]) == held.tables[held.many]).all()
        assert (held.opened == np.bincount(at, held.tables)).all() and (held.tables[n == 1] == 1).all()


def test_sweeps_reach_the_exact_distribution_of_tables():
    # Three customers of one dish, alone in their restaurant: every seating has its Pitman-Yor weight.
    p, theta, d = 0.3, 1.0, 0.5
    one = (1 - d) * (2 - d) * theta * p
    two = 3 * (1 - d) * theta * (theta + d) * p**2
    three = theta * (theta + d) * (theta + 2 * d) * p**3
    count = 4000
    held = pitman_yor.Restaurants(np.arange(count), np.full(count, 3), np.full(count, p), count, theta, d, np.random.default_rng(2))
    seen = np.zeros(4)
    for sweep in range(12):
        held.sweep(np.full(count, p))
        if sweep >= 4:
            seen += np.bincount(held.tables, minlength=4)
    expected = np.array([one, two, three]) / (one + two + three)
    assert np.allclose(seen[1:] / seen.sum(), expected, atol=0.015)


def test_language_model_scores_by_its_definition(spark):
    from pyspark.sql import functions as F

    texts = ["the cat sat on the mat", "the dog sat on the log", None, "a cat and a dog", "the cat sat", "zzz qqq sat"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in pitman_yor.score(docs, F.col("doc_id") >= 4).collect()}
    train = [tokens(t) for t in texts[:4]]
    counts = Counter(w for t in train for w in t)
    top = ["", *sorted((w for w in counts if w), key=lambda w: (-counts[w], w))]
    assert len(top) < pitman_yor.TOP
    # All training words are classes here, so the contexts are those of the class matrix, and a word's own share is one.
    pairs = Counter((top.index(a), top.index(b)) for t in train for a, b in zip(["", *t], t))
    before, after = (np.array(x) for x in zip(*sorted(pairs)))
    n = np.array([pairs[x] for x in sorted(pairs)])
    mean = np.mean([pitman_yor.sampled(before, after, n, k) for k in range(pitman_yor.CHAINS)], axis=0)
    for i in (0, 1, 2, 3, 4):
        own = [top.index(w) for w in tokens(texts[i])]
        assert abs(rows[i].score - sum(math.log10(mean[a, b]) for a, b in zip([0, *own], own))) < 1e-4


def test_word_contexts_give_probabilities(spark, monkeypatch):
    """With two classes of frequent words, all others have contexts of their own; brute force over the classes of a vocabulary."""
    monkeypatch.setattr(pitman_yor, "TOP", 2)
    draw = np.random.default_rng(4)
    words = [f"w{a}" for a in "abcdefghij"]
    texts = [" ".join(draw.choice(words, 30)) for _ in range(60)]
    docs = spark.createDataFrame([(i, t, False) for i, t in enumerate(texts)], "doc_id long, text string, held boolean")
    blocks = pitman_yor.blocks_of(docs).cache()
    top = pitman_yor.frequent(blocks)
    assert len(top) == 2
    held = pitman_yor.contexts(pitman_yor.postings(blocks, top, 3)).cache()
    classes = dict(zip(["", *words], pitman_yor.classes_of(["", *words], top).tolist()))
    got = {}
    for r in held.collect():
        names, sizes = pitman_yor.unpacked_words(r.words), pitman_yor.unpacked(r.sizes, 2)
        of = [w for w, m in zip(names, sizes) for _ in range(m)]
        got |= {(w, a): m for w, a, m in zip(of, pitman_yor.unpacked(r.after, 2).tolist(), pitman_yor.unpacked(r.n, 8).tolist())}
    expected = Counter((a, classes[b]) for t in texts for a, b in zip(["", *tokens(t)], tokens(t)) if classes[a] >= 2)
    assert got == expected
    parents = np.full((2, pitman_yor.CLASSES, pitman_yor.CLASSES), 1 / pitman_yor.CLASSES, "<f4")
    for r in pitman_yor.answers(held, parents, 0.5).collect():
        n, tables, sizes = pitman_yor.unpacked(r.n, 8), pitman_yor.unpacked(r.tables, 8), pitman_yor.unpacked(r.sizes, 2)
        opened = pitman_yor.unpacked(r.opened, 8).reshape(2, -1)
        assert ((tables >= 2 * np.minimum(n, 1)) & (tables <= 2 * n)).all()
        at = np.repeat(np.arange(len(sizes)), sizes)
        assert (opened.sum(axis=0) == np.bincount(at, tables, len(sizes))).all()


def test_frequent_words_are_counted_in_every_block(spark):
    """A word that is rare in each block, but not in all of them, is as frequent as its count says."""
    size = 20 * 8 * pitman_yor.TOP
    rows = [(k, ["", "common", f"own{k}", "spread"], [1, size, 30, 19]) for k in range(4)]
    blocks = spark.createDataFrame(rows, "block long, words array<string>, counts array<long>")
    assert pitman_yor.frequent(blocks) == ["", "common", "spread", "own0", "own1", "own2", "own3"]


def test_toxicity_fit_holds_rows_in_parts(monkeypatch):
    """The fit needs little beside the features, and the size of its parts does not matter."""
    import tracemalloc

    import pyarrow as pa

    draw = np.random.default_rng(6)
    rows = [np.sort(draw.choice(2000, 1000, replace=False)) for _ in range(600)]
    found = pa.chunked_array([pa.array([pitman_yor.packed(np.diff(r, prepend=0)) for r in rows], pa.binary())])
    labels, share, scale = (draw.random(600) < 0.5).astype(float), np.full(600, 1 / 600), draw.normal(size=2000)
    monkeypatch.setattr(toxicity, "ROUNDS", 20)
    monkeypatch.setattr(toxicity, "PART_ROWS", 50)
    parts = toxicity.parts_of(found)
    assert all((np.split(own, np.cumsum(n)[:-1])[0] == rows[50 * k]).all() for k, (n, own) in enumerate(parts))
    tracemalloc.start()
    weights, bias = toxicity.logistic(parts, scale, labels, share)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 600 * 1000 * 8  # one array of all entries
    whole = [(np.concatenate([n for n, _ in parts]), np.concatenate([own for _, own in parts]))]
    again, bias_again = toxicity.logistic(whole, scale, labels, share)
    assert np.allclose(weights, again) and abs(bias - bias_again) < 1e-9


def test_tables_lie_between_one_and_the_customers():
    c = np.array([0, 1, 2, 500, 10**6])
    tables = pitman_yor.seated(c, np.full(5, 0.01), np.full(5, 10.0), 0.5, np.random.default_rng(1))
    assert (tables <= c).all() and (tables >= np.minimum(c, 1)).all()


def test_language_model_of_odd_documents(odd, none):
    rows = pitman_yor.score(odd, queries.held_out(10, 0)).collect()
    assert len(rows) == len(ODD) and all(r.score < 0 and math.isfinite(r.score) for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (4, 5, 6)} == {1}
    assert pitman_yor.score(none, queries.held_out(10, 0)).count() == 0


def test_language_model_without_training_rows(odd):
    from pyspark.sql import functions as F

    rows = pitman_yor.score(odd, F.lit(True)).collect()
    assert len(rows) == len(ODD) and all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in rows)


def test_listed_customers_sit_at_the_tables_counted(monkeypatch):
    monkeypatch.setattr(pitman_yor, "SEATS", 8)
    draw = np.random.default_rng(6)
    n = np.array([2, 3, 8, 9, 1, 400, 5])
    held = pitman_yor.Restaurants(np.zeros(7, np.int64), n, np.full(7, 0.1), 1, 1.0, 0.5, draw)
    few = held.order_n[held.large :]
    assert held.large == 2 and few.tolist() == [8, 5, 3, 2]
    for _ in range(20):
        held.sweep(np.full(7, 0.1))
        size = held.size[int(held.held[: held.large].sum()) :]
        for first, m in zip(held.start, few):
            own = size[first : first + m]
            assert np.bincount(held.label[first : first + m], minlength=m).tolist() == own.tolist()
            empty = int((own == 0).sum())
            assert sorted(held.free[first : first + empty].tolist()) == np.flatnonzero(own == 0).tolist()


def test_few_and_many_customers_reach_the_same_tables(monkeypatch):
    n, seen = np.full(3000, 6), []
    for seats in (32, 4):
        monkeypatch.setattr(pitman_yor, "SEATS", seats)
        held = pitman_yor.Restaurants(np.arange(3000), n, np.full(3000, 0.2), 3000, 1.0, 0.5, np.random.default_rng(seats))
        tables = np.zeros(7)
        for sweep in range(10):
            held.sweep(np.full(3000, 0.2))
            tables += np.bincount(held.tables, minlength=7) if sweep >= 4 else 0
        seen.append(tables / tables.sum())
    assert np.allclose(*seen, atol=0.015)


def test_distinct_values_and_their_places():
    for values in ([], [3, 1, 3, 0], [2**62, 1, 2**62]):
        values = np.array(values, np.int64)
        expected, got = np.unique(values, return_inverse=True), pitman_yor.distinct(values)
        assert all((a == b).all() for a, b in zip(expected, got))


def test_tables_listed_for_a_sweep_are_those_searched_for(monkeypatch):
    monkeypatch.setattr(pitman_yor, "SEATS", 4)
    n = np.random.default_rng(7).integers(1, 60, 200)
    found = []
    for listed in (0, 500, 1 << 20):
        monkeypatch.setattr(pitman_yor, "LISTED", listed)
        held = pitman_yor.Restaurants(np.arange(200) % 5, n, np.full(200, 0.1), 5, 1.0, 0.5, np.random.default_rng(8))
        for _ in range(6):
            held.sweep(np.full(200, 0.1))
            assert len(held.listed) <= listed
        found.append((held.tables, held.opened, held.size))
    assert 0 < len(held.listed)
    assert all((a == b).all() for other in found[1:] for a, b in zip(found[0], other, strict=True))


def test_words_and_classes_stay_in_arrow():
    words = ["", "a", "the", "naïve", "Öl", "x😀", "zz😀y", "the2"]
    raws = [pitman_yor.packed_words(x) for x in (words[:1], words[1:5], words[5:])]
    split = pitman_yor.split_words(raws)
    assert split.to_pylist() == words and pitman_yor.split_words([]).to_pylist() == []
    top = ["", "the"]
    suffix = [zlib.crc32(w[-2:].encode()) % pitman_yor.SUFFIXES + pitman_yor.TOP for w in words]
    expected = [top.index(w) if w in top else k for w, k in zip(words, suffix, strict=True)]
    assert pitman_yor.classes_of(split, top).tolist() == pitman_yor.classes_of(words, top).tolist() == expected


def test_words_of_a_bucket_are_looked_up_at_once(monkeypatch):
    """However many blocks ask, the known words of a bucket make one table."""
    import pandas as pd

    class Frame:
        def __getattr__(self, name):
            return lambda *a: a[0] if name == "applyInPandas" else self

    calls = []
    look = pitman_yor.pc.index_in
    monkeypatch.setattr(pitman_yor.pc, "index_in", lambda *a, **k: calls.append(1) or look(*a, **k))
    run = pitman_yor.replies(Frame(), Frame(), 2)
    words = [f"w{k}" for k in range(20)]
    pack = pitman_yor.packed
    known = pd.DataFrame(
        [(pitman_yor.packed_words(words), pack(np.full(20, 900), 2), pack(np.arange(20), 8), pack(np.ones(20, int), 2),
          pack(np.arange(20), 2), pack(np.arange(20) + 5, 8), pack(np.ones(20, int), 8), pack(np.arange(40), 8))],
        columns=["words", "k", "c", "sizes", "after", "n", "tables", "opened"],
    )
    asked = [[3, 1], [7], [19, 0, 4]]
    rows = [(b, 0, pitman_yor.packed_words([words[i] for i in x]), pack(np.ones(len(x), int), 2), pack(np.array(x), 2)) for b, x in enumerate(asked)]
    got = run((0,), pd.DataFrame(rows, columns=["block", "start", "words", "sizes", "after"]), known)
    assert [pitman_yor.unpacked(c, 8).tolist() for c in got["c"]] == asked
    assert [pitman_yor.unpacked(c, 8).tolist() for c in got["n"]] == [[i + 5 for i in x] for x in asked]
    assert [pitman_yor.unpacked(c, 8).tolist() for c in got["opened"]] == [[*x, *(i + 20 for i in x)] for x in asked]
    assert len(calls) == 1
