"""Pre-tokens of byte-level BPE: where the split pattern cuts a text.

``boundaries`` cuts a whole batch of texts with numpy.  It handles ASCII, Latin
letters up to U+024F and common punctuation; a text with any other byte is
marked for the caller, which cuts it with the pattern itself or hands it to the
tokenizer library.  Both ways give the same cuts (``tests/llm`` compares them).

Rules of the pattern, for runs of one class (letter, digit, space, other): a run
takes one blank (0x20) before it along; of several spaces before a run the last
stands alone or goes along; an apostrophe that no blank precedes takes one of
the endings s t re ve m ll d along."""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa

from scorecraft.llm.batches import binary_array

LETTER, DIGIT, SPACE, OTHER = 0, 1, 2, 3
_TAIL, _LEAD2, _LEAD3, _UNKNOWN = 4, 5, 6, 7
_SPACES = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20)


def _code_point_class(cp: int) -> int:
    if cp in _SPACES:
        return SPACE
    if cp in (0x85, 0xA0) or 0x1C <= cp <= 0x1F:  # libraries differ on these
        return _UNKNOWN
    return {"L": LETTER, "N": DIGIT}.get(unicodedata.category(chr(cp))[0], OTHER)


_BY_CODE_POINT = np.array([_code_point_class(cp) for cp in range(0x250)], np.uint8)
_BY_BYTE = np.full(256, _UNKNOWN, np.uint8)
_BY_BYTE[:0x80] = _BY_CODE_POINT[:0x80]
_BY_BYTE[0x80:0xC0] = _TAIL
_BY_BYTE[0xC2:0xCA] = _LEAD2   # U+0080 .. U+024F (0xC9 0x8F)
_BY_BYTE[0xE2] = _LEAD3        # of these only dashes, quotes, bullets: U+2010-2027, U+2030-205E


def _classes(buf: np.ndarray) -> np.ndarray:
    cls = _BY_BYTE[buf]
    n = len(buf)
    two = np.flatnonzero(cls == _LEAD2)
    two = two[two + 1 < n]
    if len(two):
        cp = ((buf[two].astype(np.int32) & 0x1F) << 6) | (buf[two + 1] & 0x3F)
        kind = np.where(cp < 0x250, _BY_CODE_POINT[np.minimum(cp, 0x24F)], _UNKNOWN)
        cls[two] = kind
        cls[two + 1] = kind
    three = np.flatnonzero(cls == _LEAD3)
    three = three[three + 2 < n]
    if len(three):
        cp = ((buf[three].astype(np.int32) & 0x0F) << 12) | ((buf[three + 1].astype(np.int32) & 0x3F) << 6) | (buf[three + 2] & 0x3F)
        kind = np.where(((cp >= 0x2010) & (cp <= 0x2027)) | ((cp >= 0x2030) & (cp <= 0x205E)), OTHER, _UNKNOWN)
        for k in range(3):
            cls[three + k] = kind
    cls[(cls > OTHER)] = _UNKNOWN
    return cls


def boundaries(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, unknown): start marks the bytes at which a pre-token begins; unknown
    marks the texts whose cuts are not decided here."""
    n = len(buf)
    unknown = np.zeros(len(offsets) - 1, bool)
    if n == 0:
        return np.zeros(0, bool), unknown
    cls = _classes(buf)
    bad = np.flatnonzero(cls == _UNKNOWN)
    if len(bad):
        unknown[np.searchsorted(offsets, bad, side="right") - 1] = True
    first = np.zeros(n, bool)
    first[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    start = first.copy()
    start[1:] |= cls[1:] != cls[:-1]
    after_space = np.flatnonzero(start[1:] & ~first[1:] & (cls[:-1] == SPACE)) + 1
    start[after_space - 1] = True
    start[after_space[buf[after_space - 1] == 0x20]] = False
    mark = np.flatnonzero((buf == 0x27) & start)
    mark = mark[mark + 1 < n]
    mark = mark[~first[mark + 1]]
    if len(mark):
        one = np.isin(buf[mark + 1], np.frombuffer(b"stmd", np.uint8))
        nxt = np.minimum(mark + 2, n - 1)
        a, b = buf[mark + 1], np.where((mark + 2 < n) & ~first[nxt], buf[nxt], 0)
        two = ((a == 0x72) | (a == 0x76)) & (b == 0x65) | (a == 0x6C) & (b == 0x6C)
        for hit, size in ((mark[one], 1), (mark[two], 2)):
            start[hit + 1] = False
            after = hit + 1 + size
            start[after[after < n]] = True
    return start, unknown


def distinct(buf: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(code of each pre-token, distinct pre-tokens) of the pre-tokens that begin
    at ``starts`` and together cover ``buf``."""
    if len(starts) == 0:
        return np.zeros(0, np.int32), pa.array([], pa.large_binary())
    coded = binary_array(np.append(starts, len(buf)), buf).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
