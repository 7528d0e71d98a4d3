"""The Merkle manifest and periodic runs against brute force, and on documents with everything that may go wrong."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from __spark_entry__ import LLM_QUERIES
from starmart.llm import merkle, periodic_runs
from starmart.llm.queries import op12_merkle, op13_periodic_runs
from tests.llm.conftest import ODD, prose

SMALL = "/root/testdata/sf0.001"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes, fanout):
    """(root, siblings left and right per level and leaf)."""
    places, paths = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for i, at in enumerate(places):
            first = at - at % fanout
            paths[i].append(("".join(nodes[first:at]), "".join(nodes[at + 1 : first + fanout])))
        nodes = [digest("".join(nodes[k : k + fanout])) for k in range(0, len(nodes), fanout)]
        places = [at // fanout for at in places]
    return nodes[0], paths


def proved(rows, group, key, values, fanout):
    """Per row number: leaf, subroot, root, path."""
    leaves = [leaf(values(r)) for r in rows]
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[group(r)].append(i)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subroots, paths = [], {}
    for g in names:
        own = sorted(groups[g], key=lambda i: (key(rows[i]) is not None, key(rows[i]) or 0, leaves[i]))
        top, found = tree([leaves[i] for i in own], fanout)
        subroots.append(top)
        paths |= dict(zip(own, found, strict=True))
    root, over = tree(subroots, fanout)
    return [
        (leaves[i], subroots[names.index(group(r))], root, paths[i] + over[names.index(group(r))]) for i, r in enumerate(rows)
    ]


@pytest.mark.parametrize(("levels", "fanout"), [(1, 3), (2, 3), (1, 2), (7, 3)])
def test_manifest_of_odd_groups(spark, levels, fanout):
    """Groups of 0 to 3 partitions and more, ragged ends, ties, repeated rows, null keys and groups, clashing columns."""
    sizes = {None: 5, "": 1, "a": 40, "é": 9, "B": 10, "c": 3}
    rows = [(k if k % 11 else None, g, f"t{k}" if k % 4 else None, "x", 1) for g, n in sizes.items() for k in range(n)]
    rows += [(7, "a", "tie", "x", 1), (7, "a", "t7", "x", 1), (8, "a", None, "y", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, leaf string, place int")
    columns = ["doc_id", "source", "text", "leaf"]
    got = merkle.manifest(docs.repartition(5), columns, levels=levels, fanout=fanout).collect()
    want = proved(rows, lambda r: r[1], lambda r: r[0], lambda r: r[:4], fanout)
    wanted = sorted((str(r[0]), a, b, c, tuple(p)) for r, (a, b, c, p) in zip(rows, want, strict=True))
    assert sorted((str(r.doc_id), r.leaf, r.subroot, r.root, tuple(zip(r.left, r.right, strict=True))) for r in got) == wanted


def test_manifest_of_nothing_and_of_one_row(spark, none, odd):
    assert merkle.manifest(none, ["doc_id", "text"]).count() == 0
    (row,) = merkle.manifest(odd.where("doc_id = 7"), ["doc_id", "text"]).collect()
    assert row.leaf == row.subroot == row.root == leaf((7, "one")) and row.left == row.right == []


def test_merkle_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()
    rows = [tuple(d) for d in docs]
    want = {}
    for r, (a, b, c, path) in zip(rows, proved(rows, lambda r: r[1], lambda r: r[0], lambda r: r, 3), strict=True):
        tampered = zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
        h = leaf((*r[:4], r[4].replace("\n", ""))) if tampered else a
        for left, right in path:
            h = digest(left + h + right)
        want[r[0]] = (a, b, c, digest("".join(x + y for x, y in path)), h, h == c)
    got = {r.doc_id: tuple(r)[1:] for r in op12_merkle(spark, SMALL).collect()}
    assert got == want and {v[-1] for v in want.values()} == {True, False}


def brute_runs(w, least=12):
    found = {}
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            first = i
            while i + p < len(w) and w[i] == w[i + p]:
                i += 1
            if i + p - first >= max(least, 2 * p):
                found.setdefault((first, i + p), p)
            i += 1
    return sorted(((s, e - s, p) for (s, e), p in found.items()), key=lambda r: (r[0], r[2]))


def test_runs_of_random_texts():
    draw = random.Random(5)
    for _ in range(150):
        texts = []
        for _ in range(draw.randint(1, 6)):
            n, k = draw.choice([0, 1, 2, 12, 31, 90, 200]), draw.choice([1, 2, 3, 5, 50])
            w = [draw.randrange(k) for _ in range(n)]
            if n and draw.random() < 0.6:
                a = draw.randrange(n)
                p = 1 + draw.randrange((n - a) // 3 + 1)
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            texts.append(w)
        codes, counts = np.array(sum(texts, []), np.int64), np.array([len(w) for w in texts])
        for least in (2, 12):
            runs = periodic_runs.find_runs(codes, counts, least)
            got = [tuple(map(int, r)) for r in zip(*runs, strict=True)]
            assert got == [(t, *r) for t, w in enumerate(texts) for r in brute_runs(w, least)]


def test_transforms_are_exact():
    draw = np.random.default_rng(3)
    codes = draw.integers(1, 1 << 20, 4096)
    codes[2000:2600] = codes[100:700]
    at = np.array([100, 101, 300])
    # Numbers this large need more than one prime; one equal word more or less is told apart.
    block, distance = periodic_runs.occurrences(codes, at, np.full(3, 3000), 512)
    assert list(zip(block.tolist(), distance.tolist(), strict=True)) == [(0, 1900), (1, 1900)]


def test_runs_of_long_texts():
    n = 100_000
    for w, want in (([3] * n, (0, n, 1)), ([i % 777 for i in range(n)], (0, n, 777)), ([*range(n // 2)] * 2, (0, n, n // 2))):
        runs = periodic_runs.find_runs(np.array(w, np.int64), np.array([n]))
        assert [tuple(map(int, r))[1:] for r in zip(*runs, strict=True)] == [want]


def test_periodic_runs_of_odd_documents(odd, none):
    rows = periodic_runs.periodic_runs(odd).collect()
    assert len(rows) == len(ODD)
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert [tuple(r) for r in by[10].runs] == [(0, 180, 1)] and by[10].collapsed == "a"
    for i in (4, 5, 6):
        assert (by[i].n_words, by[i].runs, by[i].collapsed) == (0, [], "")
    assert by[8].collapsed == ODD[10][1] and by[3].collapsed == prose(120).upper()
    assert periodic_runs.periodic_runs(none).count() == 0


def test_periodic_runs_query(spark):
    want = {}
    for d in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", d.text or "")
        h = zlib.crc32(str(d.doc_id).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = brute_runs(w)
        gone = {i for s, m, p in runs for i in range(s + p, s + m)}
        top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        want[d.doc_id] = (
            len(runs),
            *top,
            1000 * top[1] // top[2] if runs else None,
            digest("".join(f"{s},{m},{p}\n" for s, m, p in runs)),
            digest(" ".join(x for i, x in enumerate(w) if i not in gone)),
        )
    got = {r.doc_id: tuple(r)[1:] for r in op13_periodic_runs(spark, SMALL).collect()}
    assert got == want and any(v[0] for v in want.values())


def test_new_queries_are_registered():
    assert {"op12_merkle", "op13_periodic_runs"} <= LLM_QUERIES.keys()
