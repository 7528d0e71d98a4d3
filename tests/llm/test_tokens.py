"""Packing and token files against the tokenizer itself."""

import time
import weakref
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from starmart.llm import packing, rans, tokens
from tests.llm.conftest import ODD


def ids_of(name, text, end):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize(
    ("name", "pieces", "lower"), [("byte_bpe_50k.json", tokens.BYTE_PIECES, False), ("word_bpe_49k.json", tokens.WORD_PIECES, True)]
)
def test_added_tokens_have_their_own_ids(name, pieces, lower):
    path = public_tokenizers.path(name)
    plain = Tokenizer.from_file(path)
    texts = ["a <|endoftext|> b", "a b", None, "<|startoftext|>it's 12\n<|endoftext|>", "<|ENDOFTEXT|> <|end oftext|>", "\u212a <|endoftext|>"]
    ids, counts = tokens.Encoder(tokens.definition_of(path), pieces, lower).encode(pa.array(texts))
    got = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    assert got == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert got[0] == ([64, 220, 50256, 275] if name.startswith("byte") else [320, 49407, 321])


def test_packing_holds_each_id_once_without_gaps(spark, odd, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = packing.pack(odd.where("doc_id <> 2 OR doc_id IS NULL"), path).collect()
    texts = {i: t for i, t, _ in ODD if i not in (2, None)}
    for i, text in texts.items():
        want, at = ids_of("word_bpe_49k.json", text, 1), 0
        for r in sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(want), crc(want[at : at + r.length]))
            at += r.length
        assert at == len(want)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    sizes = []
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        sizes.append(at)
    assert sorted(sequences) == list(range(len(sequences))) and sum(n < 2048 for n in sizes) <= 1 and max(sizes) <= 2048
    assert packing.pack(none, path).count() == 0


@pytest.mark.parametrize("histogram", [{1100: 5000}, {2048: 3, 1: 10_000}, {3: 1}, {n: n % 7 for n in range(1, 2049)}])
def test_plan_places_every_piece(histogram):
    plan, used = packing.Plan(histogram), {}
    for length, count in histogram.items():
        for rank in range(count):
            parts = list(plan.place(length, rank))
            assert sum(n for _, n, _, _ in parts) == length and parts[0][0] == 0
            for _, n, sequence, offset in parts:
                used.setdefault(sequence, []).append((offset, n))
    full = 0
    for held in used.values():
        ends = [0, *np.cumsum([n for _, n in sorted(held)]).tolist()]
        assert [o for o, _ in sorted(held)] == ends[:-1] and ends[-1] <= 2048
        full += ends[-1] == 2048
    assert full >= len(used) - 1


def test_least_squares_is_not_negative_and_close():
    columns = [{5: 1, 3: 1}, {4: 2}, {3: 2, 2: 1}]
    x = packing.non_negative_least_squares(columns, {5: 10, 3: 4, 4: 7, 2: 1}, 500)
    assert min(x) >= 0 and x[1] == pytest.approx(3.5) and x[0] == pytest.approx(7, abs=0.5)


def test_token_files_round_trip(spark, odd, none, folder):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rans.write_tokens(odd, f"{folder}/tokens", path)
    rows = rans.read_tokens(spark, f"{folder}/tokens", keep_ids=True).collect()
    assert len(rows) == len(ODD)
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at and crc(np.frombuffer(r.ids, "<u4")) == r.ids_crc32
        at += r.n_tokens
    by = {r.doc_id: r for r in rows}
    for i, text, _ in ODD:
        if i is not None:
            want = ids_of("byte_bpe_50k.json", text, 0)
            assert (by[i].n_tokens, by[i].ids_crc32) == (len(want), crc(want))
    order = [r.doc_id for r in sorted(rows, key=lambda r: r.start) if r.doc_id is not None]
    assert order == sorted(order)
    rans.write_tokens(none, f"{folder}/none", path)
    assert rans.read_tokens(spark, f"{folder}/none").count() == 0


@pytest.mark.parametrize("n", [1, 15, 16, 17, 70_000, 200_001])
def test_coder_round_trip(n):
    tokens = (np.random.default_rng(n).pareto(1.0, n) * 20).astype(np.int64) % 50_257
    segment = rans.encode(tokens)
    assert (rans.decode(segment) == tokens).all()
    segment["blocks"][0]["payload"] = segment["blocks"][0]["payload"][:-1] + b"\xff\x00"
    with pytest.raises(ValueError, match="checksum"):
        rans.decode(segment)


def test_frequencies_of_a_full_alphabet():
    counts = np.ones(50_257, np.int64)
    counts[0] = 10**9
    scaled = rans.frequencies(counts)
    assert scaled.sum() == 1 << 16 and scaled.min() == 1


def test_idle_workers_let_their_encoder_go(monkeypatch):
    monkeypatch.setattr(tokens, "IDLE_SECONDS", 0.1)
    definition = tokens.definition_of(public_tokenizers.path("byte_bpe_50k.json"))
    with tokens.encoder(definition, tokens.BYTE_PIECES, lower=False) as first:
        time.sleep(0.3)
        assert len(first.encode(pa.array(["a word"]))[0])
    with tokens.encoder(definition, tokens.BYTE_PIECES, lower=False) as again:
        assert again is first and len(again.known) == 2
    gone = weakref.ref(first)
    del first, again
    for _ in range(50):
        time.sleep(0.1)
        if gone() is None:
            break
    assert gone() is None


def test_blocks_of_a_full_segment_advance_together():
    ids = (np.random.default_rng(1).zipf(1.3, rans.SEGMENT_TOKENS) % 50_000).astype(np.uint32)
    segment = rans.encode(ids)
    assert segment["steps"] <= 1024 and (rans.decode(segment) == ids).all()
