"""SimHash links and repeated passages against brute force."""

import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from starmart.llm import compact_windows, simhash
from starmart.llm.components import components
from tests.llm.conftest import ODD, prose


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def fingerprint(text):
    w = words(text)
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def least_reachable(ids, linked):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_fingerprints_and_components(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in simhash.near_duplicates(docs, shard_rows=16).collect()}
    want = {i: fingerprint(t) for i, t in texts.items()}
    assert {i: f for i, (f, _) in got.items()} == want
    near = [(a, b) for a in want for b in want if a < b and (want[a] ^ want[b]).bit_count() <= 3]
    assert {i: c for i, (_, c) in got.items()} == least_reachable(want, near)
    assert near


def test_links_of_dense_groups_are_whole(spark):
    """Fingerprints around a few centres, in shards that are far too small for them."""
    draw = np.random.default_rng(7)
    centres = draw.integers(0, 1 << 62, 12)
    fps = {int(c) for c in centres}
    for c in centres:
        for _ in range(60):
            fp = int(c)
            for bit in draw.integers(0, 62, draw.integers(1, 4)):
                fp ^= 1 << int(bit)
            fps.add(fp)
    rows = [(fp, k) for k, fp in enumerate(sorted(fps))]
    nodes = spark.createDataFrame(rows, "fp long, rep long")
    found = {r.node: r.component for r in components(simhash.links(nodes, shard_rows=32)).collect()}
    near = [(a, b) for x, a in rows for y, b in rows if a < b and (x ^ y).bit_count() <= 3]
    want = least_reachable([k for _, k in rows], near)
    assert {k: found.get(k, k) for _, k in rows} == want


def test_a_long_chain_is_one_component(spark):
    edges = spark.range(3000).selectExpr("id AS a", "id + 1 AS b")
    found = components(edges).collect()
    assert len(found) == 3001 and {r.component for r in found} == {0}
    assert components(edges.limit(0)).count() == 0


def test_odd_documents(odd, none):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == len(ODD)
    by = defaultdict(set)
    for r in got:
        by[r.doc_id].add((r.fingerprint, r.component_id))
    assert by[1] == by[2] == by[3] and {c for _, c in by[1]} == {1}
    assert by[4] == by[5] == by[6] == {("0" * 16, 4)}
    assert simhash.near_duplicates(none).count() == 0


def test_passages_of_fifty_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    runs = defaultdict(set)
    for r in docs.collect():
        w = words(r.text)
        for i in range(len(w) - 49):
            runs[tuple(w[i : i + 50])].add(r.doc_id)
    want = set().union(*(ids for ids in runs.values() if len(ids) > 1))
    passages = compact_windows.repeated_passages(docs)
    found = compact_windows.classes(passages).collect()
    assert want <= {r.doc_id for r in found}
    assert passages.where("similarity < 0.8 OR source_id >= doc_id").count() == 0


def test_every_document_has_a_class(odd, none):
    rows = compact_windows.classes(compact_windows.repeated_passages(odd), odd).collect()
    assert len(rows) == len(ODD)
    by = {r.doc_id: (r.component_id, r.n_links > 0, bool(r.spans)) for r in rows}
    assert by[1] == (1, True, False) and by[2] == by[3] == by[9] == (1, True, True)
    assert by[5] == (5, False, False) and by[8] == (8, False, False) and by[None] == (None, False, False)
    assert compact_windows.classes(compact_windows.repeated_passages(none), none).count() == 0


def test_one_changed_word_is_found_and_clean_text_is_not(spark):
    base = prose(200).split()
    changed = [*base[:100], "changed", *base[101:]]
    rows = [(1, " ".join(base)), (2, " ".join(changed)), (3, prose(200, 3, 11)), (4, " ".join(base[:40]))]
    found = compact_windows.classes(compact_windows.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")))
    assert {r.doc_id: r.component_id for r in found.collect()} == {1: 1, 2: 1}


def test_spans_are_cut_and_the_rest_stays(spark, odd, none):
    found = compact_windows.spans(compact_windows.repeated_passages(odd))
    left = compact_windows.without_spans(odd, found)
    assert left.columns == odd.columns
    rows = sorted(left.select("doc_id", "text").collect(), key=str)
    by = {r.doc_id: r.text for r in rows if r.doc_id is not None}
    assert by[1] == ODD[0][1] and 3 not in by and by[8] == ODD[10][1] and by[4] == "" and by[5] is None
    assert by[9] == prose(40, 3, 50) + " " + prose(40, 3, 90)
    assert sum(r.doc_id is None for r in rows) == 2
    assert compact_windows.repeated_passages(none).count() == 0


@pytest.mark.parametrize(("size", "inserted"), [(50, 20), (50, 45), (60, 40), (100, 40), (100, 300)])
def test_passages_with_words_inserted_on_the_smaller_id_are_each_found(spark, size, inserted):
    first, last = (" ".join(f"{side}{k}" for k in range(size)) for side in "pq")
    between = " ".join(f"x{k}" for k in range(inserted))
    rows = [(1, f"{first} {between} {last}"), (2, f"{first} {last}")]
    found = compact_windows.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"))
    assert found.where("similarity < 0.8").count() == 0
    (row,) = compact_windows.spans(found).collect()
    assert (row.doc_id, [(s.start, s.n_words) for s in row.spans]) == (2, [(0, 2 * size)])


def test_copies_are_found_behind_texts_that_quote_parts(spark):
    rows = []
    for t in range(12):
        whole = [f"t{t}w{k}" for k in range(60)]
        around = lambda i, w, t=t: " ".join([*(f"t{t}d{i}a{k}" for k in range(30)), *w, *(f"t{t}d{i}b{k}" for k in range(30))])
        edited = [*whole[:31], "changed", *whole[32:]]
        texts = [around(0, whole[:40]), around(1, whole[-40:]), *(around(i, whole) for i in range(2, 6)), around(6, edited)]
        rows += [(100 * t + i, text) for i, text in enumerate(texts)]
    found = compact_windows.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"))
    classes = {r.doc_id: r.component_id for r in compact_windows.classes(found).collect()}
    assert classes == {100 * t + i: 100 * t + 2 for t in range(12) for i in range(2, 7)}
    assert found.where("similarity < 0.8 OR source_id >= doc_id").count() == 0


def test_parts_that_are_similar_only_together_or_alone():
    p, q, x = np.arange(60, dtype=np.uint32), np.arange(100, 160, dtype=np.uint32), np.arange(1000, 1100, dtype=np.uint32)
    # One word inserted within the first passage, forty between the two: the first is one part.
    a, b = np.concatenate([p, q]), np.concatenate([p[:30], x[:1], p[30:], x[1:41], q])
    assert [r[:4] for r in compact_windows.similar_parts(a, b, 46, 0.8)] == [(0, 60, 0, 61), (60, 60, 101, 60)]
    # The second stands first in the other text.
    assert [r[:4] for r in compact_windows.similar_parts(a, np.concatenate([q, x, p]), 46, 0.8)] == [(0, 60, 160, 60), (60, 60, 0, 60)]
    assert compact_windows.similar_parts(p[:49], np.concatenate([p[:25], x, p[25:49]]), 46, 0.8) == []


def test_compact_windows_cover_every_subsequence_once():
    hashes = np.random.default_rng(1).integers(0, 50, 60).astype(np.uint64)
    windows = compact_windows.compact_windows(hashes, 5)
    for i in range(len(hashes)):
        for j in range(i + 4, len(hashes)):
            holding = [c for first, c, last in windows if first <= i <= c <= j <= last]
            assert len(holding) == 1 and hashes[holding[0]] == hashes[i : j + 1].min()
