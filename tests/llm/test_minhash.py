"""MinHash links and star components against brute force."""

import random

import numpy as np
import pytest

from starmart.llm import filters, minhash
from starmart.llm.queries import op11_minhash
from starmart.llm.stars import components
from tests.llm.conftest import ODD, prose
from tests.llm.test_near_duplicates import least_reachable, words


def shingles(text):
    w = words(text)
    return frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset([tuple(w)] if w else [])


def wanted(texts):
    """Per doc_id: set size, component, kept."""
    sets = {i: shingles(t) for i, t in texts.items()}
    ids = sorted(i for i in sets if sets[i])
    linked = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    low = least_reachable(sets, linked)
    return {i: (len(sets[i]), low[i], low[i] == i) for i in sets}


def found(frame):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in frame.collect()}


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_query_against_all_pairs(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text").collect()
    want = wanted({d.doc_id: d.text for d in docs})
    assert found(op11_minhash(spark, f"/root/testdata/{sf}")) == want
    assert any(not k for _, _, k in want.values())


@pytest.mark.parametrize("block", [9, 4096])
def test_groups_around_the_threshold(spark, block):
    """Near copies whose similarity lies around 0.8, so groups are chains, stars and strays; blocks far smaller than groups."""
    draw, texts = random.Random(block), {}
    for g in range(4):
        base = [f"g{g}w{k}" for k in range(120)]
        for _ in range(60):
            w = list(base)
            for k in draw.sample(range(120), draw.choice([1, 3, 5, 6, 7, 9, 12])):
                w[k] = f"x{draw.randrange(10**6)}"
            texts[len(texts)] = " ".join(w)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert found(minhash.near_duplicates(docs, block=block)) == wanted(texts)


def test_odd_documents(odd, none):
    rows = minhash.near_duplicates(odd).collect()
    assert len(rows) == len(ODD)
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by[1].component_id == by[2].component_id == by[3].component_id == 1 and not by[3].kept
    for i in (4, 5, 6):
        assert (by[i].n_shingles, by[i].component_id, by[i].kept) == (0, i, True)
    assert by[7].n_shingles == 1 and by[8].n_shingles == len(shingles(ODD[10][1]))
    assert [(r.component_id, r.kept) for r in rows if r.doc_id is None] == [(None, True)] * 2
    assert minhash.near_duplicates(none).count() == 0


def test_clashing_rows_of_one_doc_id(spark):
    rows = [(5, prose(90)), (5, prose(90, 3, 4)), (2, prose(90, 3, 4)), (9, prose(90))]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got) == [(2, 2, True), (5, 2, False), (5, 5, True), (9, 5, False)]


def test_signatures_estimate_similarity():
    values = np.random.default_rng(0).integers(0, 1 << 63, 3000, dtype=np.uint64)
    h = minhash.hashes()
    low = lambda v: (v[None, :] * h.factor[:, None] + h.offset[:, None]).min(axis=1)
    for shared in (1000, 2000, 2700):
        a, b = values[:2700], values[2700 - shared : 2700 - shared + 2700]
        union = len(np.union1d(a, b))
        same = (low(a) == low(b)).mean()
        assert abs(same - len(np.intersect1d(a, b)) / union) < 0.12


def test_filter_lets_all_wanted_ids_through(spark):
    ids = [0, 1, -5, 2**62, 12345]
    held = filters.id_filter(spark.createDataFrame([(i,) for i in ids], "rep long"))
    at = filters.positions(np.array(ids))
    assert (((held[(at >> np.uint64(6)).astype(int)] >> (at & np.uint64(63))) & np.uint64(1)) == 1).all()


def test_stars_of_random_graphs(spark):
    draw = random.Random(3)
    edges = [(draw.randrange(400), draw.randrange(400)) for _ in range(260)] + [(1000 + k, 1001 + k) for k in range(120)]
    edges += [(5000, 5000 + k) for k in range(300)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    want = least_reachable({x for e in real for x in e}, real)
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
