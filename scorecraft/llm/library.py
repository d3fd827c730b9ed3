"""Token ids as the tokenizers library gives them, by pre-token.

A byte-level BPE tokenizer without normaliser encodes each pre-token by itself,
so the ids of a text are those of its pre-tokens in order, and each distinct
pre-token needs one call.  Texts with characters whose cut is not decided in ``pretokens``
are cut by the library's pre-tokenizer; only texts that hold one of the tokenizer's added
strings are given to the library whole."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from scorecraft.llm.pretokens import boundaries

# Characters that stand for bytes: printable ones of Latin-1 for themselves, the others from U+0100 on, in order.
_OWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_CHARS = np.arange(0x100, dtype="<u2")
_BYTE_CHARS[sorted({*range(0x100)} - {*_OWN})] = range(0x100, 0x200 - len(_OWN))
# Pre-tokens whose ids a task remembers (about 200 bytes each) before it starts anew, and
# pre-tokens given to the library at once.
REMEMBERED, AT_ONCE = 500_000, 5_000


def read_spec(path: str) -> str:
    """The tokenizer file's text, checked to be one that works by pre-token."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    spec = json.loads(text)
    pre = spec.get("pre_tokenizer") or {}
    if spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
        raise ValueError("a byte-level BPE tokenizer without normaliser and prefix blank is needed")
    return text


class Library:
    """One worker's tokenizer."""

    def __init__(self, spec: str):
        # Spark's tasks are the parallelism; the library's own threads would each keep memory
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.added = [t["content"].encode() for t in json.loads(spec).get("added_tokens", [])]
        self.known: dict[bytes, bytes] = {}

    def ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def of_pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids of each) for pre-tokens."""
        wanted = pieces.to_pylist()
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        new = [x for x in wanted if x not in known]
        for lo in range(0, len(new), AT_ONCE):
            part = new[lo:lo + AT_ONCE]
            known.update(zip(part, self._ids_of(part)))
        found = [known[x] for x in wanted]
        count = np.fromiter(map(len, found), np.int64, len(found)) // 4
        return np.frombuffer(b"".join(found), np.int32), count

    def _ids_of(self, pieces: list[bytes]) -> list[bytes]:
        """The ids (int32) of pre-tokens: the library's model is given each as it is after the
        byte-level step, without the rest of its pipeline, which a pre-token passes unchanged."""
        tokenize = self.tokenizer.model.tokenize
        text = _BYTE_CHARS[np.frombuffer(b"".join(pieces), np.uint8)].tobytes().decode("utf-16-le")
        flat, ends, at = [], [0], 0
        for x in pieces:
            flat += [t.id for t in tokenize(text[at:at + len(x)])]
            ends.append(4 * len(flat))
            at += len(x)
        raw = np.array(flat, np.int32).tobytes()
        return [raw[a:b] for a, b in zip(ends, ends[1:])]

    def count_pieces(self, pieces: list[bytes]) -> list[int]:
        out: list[int] = []
        for lo in range(0, len(pieces), AT_ONCE):
            out += [len(x) // 4 for x in self._ids_of(pieces[lo:lo + AT_ONCE])]
        return out

    def cut(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(starts of pre-tokens, mask of the texts the library must see whole: those that hold
        an added string).  Texts whose cuts ``boundaries`` does not decide are cut by the
        library's own pre-tokenizer."""
        start, other = boundaries(buf, offsets)
        whole = np.zeros(len(offsets) - 1, bool)
        raw = buf.tobytes()
        for mark in self.added:
            at = raw.find(mark)
            while at >= 0:
                k = int(np.searchsorted(offsets, at, side="right")) - 1
                whole[k] = True
                at = raw.find(mark, int(offsets[k + 1]))
        for k in np.flatnonzero(other & ~whole):
            lo, hi = int(offsets[k]), int(offsets[k + 1])
            cuts = [a for _, (a, _) in self.tokenizer.pre_tokenizer.pre_tokenize_str(raw[lo:hi].decode())]
            chars = np.flatnonzero((buf[lo:hi] & 0xC0) != 0x80)  # first byte of each character
            start[lo:hi] = False
            start[lo + chars[cuts]] = True
        return np.flatnonzero(start), whole


_LOADED: dict = {}  # of this worker


def library(shared) -> Library:
    """The worker's tokenizer for a broadcast specification."""
    spec = shared.value
    if _LOADED.get("spec") is not spec:
        _LOADED.update(spec=spec, library=Library(spec))
    return _LOADED["library"]


def texts_of(buf: np.ndarray, offsets: np.ndarray, which: np.ndarray) -> Iterator[tuple[int, str]]:
    for k in np.flatnonzero(which):
        yield int(k), buf[offsets[k]:offsets[k + 1]].tobytes().decode()
