"""Token ids of whole texts by a public tokenizer, encoding each distinct piece of text once per task."""

from __future__ import annotations

import ctypes
import os
import re
import sys
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import chain
from pathlib import Path
from threading import Timer
from types import ModuleType

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

#: Letters and numbers of the plain alphabet below, and how the two tokenizers cut a text before they merge; fixed
#: values of their files, over that alphabet.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
NUMBERS = "0-9²³¹¼½¾"
BYTE_PIECES = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^\s{LETTERS}{NUMBERS}]+|\s+(?!\S)|\s+"
WORD_PIECES = rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^\s{LETTERS}{NUMBERS}]+"
#: Outside these, library versions may class characters differently: such texts go through the tokenizer whole.
PLAIN = re.compile("[^\t\n\r -~¡-¬®-ÿ]")
HELD_PIECES = 1 << 20
IDLE_SECONDS = 1.0


class Codes(dict):
    """Numbers keys in the order in which they are first asked for, and lists those that are new."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        code = self[key] = len(self)
        self.new.append(key)
        return code


class Encoder:
    """Ids of texts, the same as the tokenizer's own for the whole text.

    A BPE merges within a piece only, so a text's ids are those of its pieces, end to end; a text that holds an added
    token, as <|endoftext|>, or is not plain goes through the tokenizer whole. Each distinct piece is
    encoded once; new ones go to the tokenizer together, as lines of one text. The table starts anew when it is
    full, which costs time only.
    """

    def __init__(self, definition: str, pieces: str, lower: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(definition)
        self.find, self.lower = re.compile(pieces).findall, lower
        # The tokenizer looks for its added tokens before it cuts a text into pieces.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # What stands between two lines: an id of its own, or nothing where the last id of a piece is marked as such.
        self.between = self._ids("\n")
        last = [i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]
        self.last = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        self.last[last or self.between] = True
        self._clear()

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _clear(self) -> None:
        self.known = Codes()
        self.ids = np.zeros(1 << 16, np.uint32)
        self.ends = np.zeros(1 << 16, np.int64)

    def _learn(self, pieces: list[str]) -> None:
        """Append the ids of new pieces; `ends[k]` is where those of piece k begin, `ends[k + 1]` where they end."""
        blank = [k for k, p in enumerate(pieces) if p.isspace()]
        alone = {k: self._ids(pieces[k]) for k in blank}
        lines = [p for k, p in enumerate(pieces) if k not in alone]
        ids = np.array(self._ids("\n".join([*lines, ""])), np.uint32)
        edges = np.flatnonzero(self.last[ids]) + 1
        sizes = np.diff(edges, prepend=0)
        if self.between:
            ids, sizes = ids[~self.last[ids]], sizes - len(self.between)
        if len(sizes) != len(lines):
            raise ValueError("pieces and their ids differ in number")
        if alone:
            at = np.cumsum(sizes) - sizes
            parts = {k: (a, n) for k, a, n in zip((k for k in range(len(pieces)) if k not in alone), at, sizes, strict=True)}
            own = [np.array(alone[k], np.uint32) if k in alone else ids[parts[k][0] : sum(parts[k])] for k in range(len(pieces))]
            ids, sizes = np.concatenate(own), np.fromiter(map(len, own), np.int64, len(own))
        n = len(self.known) - len(pieces)
        before = int(self.ends[n])
        if len(self.known) >= len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros(max(len(pieces), len(self.ends)), np.int64)])
        self.ends[n + 1 : n + 1 + len(pieces)] = before + np.cumsum(sizes)
        if before + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(ids), len(self.ids)), np.uint32)])
        self.ids[before : before + len(ids)] = ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids end to end, ids per text); null is an empty text."""
        if len(self.known) > HELD_PIECES:
            self._clear()
        whole = [t or "" for t in texts.to_pylist()]
        odd = {k for k, t in enumerate(whole) if PLAIN.search(t) or any(x in t for x in self.added)}
        found = [[] if k in odd else self.find(t.lower() if self.lower else t) for k, t in enumerate(whole)]
        pieces_of = np.fromiter(map(len, found), np.int64, len(found))
        codes = np.fromiter(map(self.known.__getitem__, chain.from_iterable(found)), np.int64, int(pieces_of.sum()))
        if self.known.new:
            new, self.known.new = self.known.new, []
            self._learn(new)
        starts = self.ends[codes]
        sizes = self.ends[codes + 1] - starts
        ends = np.cumsum(sizes)
        ids = self.ids[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
        running = np.concatenate([[0], ends])
        edges = np.concatenate([[0], np.cumsum(pieces_of)])
        counts = running[edges[1:]] - running[edges[:-1]]
        if not odd:
            return ids, counts
        parts = np.split(ids, np.cumsum(counts)[:-1])
        for k in sorted(odd):
            parts[k] = np.array(self._ids(whole[k]), np.uint32)
        return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))


@contextmanager
def encoder(definition: str, pieces: str, lower: bool) -> Iterator[Encoder]:
    """The worker process's own encoder, kept from task to task; its table is bounded.

    A worker that no task asks for IDLE_SECONDS lets it go, as idle workers live on beside the stages that follow.
    """
    held = sys.modules.setdefault("starmart_worker_encoders", ModuleType("starmart_worker_encoders")).__dict__
    key = f"{pieces} {lower} {hash(definition)}"
    own, timer = held.pop(key, (None, None))
    if timer:
        timer.cancel()
    own = own or Encoder(definition, pieces, lower)
    try:
        yield own
    finally:
        timer = Timer(IDLE_SECONDS, _let_go, (held, key, own))
        timer.daemon = True
        held[key] = own, timer
        del own
        timer.start()


def _let_go(held: dict, key: str, own: Encoder) -> None:
    """Drop an encoder that is still idle, and give what it took back to the system."""
    if held.get(key, (None,))[0] is own:
        held.pop(key, None)
    else:
        return
    own._clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def with_end(ids: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with an end id after each text's ids."""
    out = np.full(len(ids) + len(counts), end, np.uint32)
    keep = np.ones(len(out), bool)
    keep[np.cumsum(counts + 1) - 1] = False
    out[keep] = ids
    return out, counts + 1


def definition_of(path: str) -> str:
    """A tokenizer file's text, read where the job is defined: some 2 MB, whatever the data."""
    return Path(path).read_text(encoding="utf-8")
