"""Byte-level BPE over many texts at once: pre-tokens found with numpy, each distinct word encoded once.

The split follows public_tokenizers.PATTERN exactly. Its matches depend only on runs of letters, numbers,
white space and other characters, so the places where a match starts follow from array comparisons. Code points
that this Python's Unicode tables don't know could be letters to a newer library: texts with such a code point
are reported as odd and are left to the tokenizer library itself.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from itertools import chain

import numpy as np

LETTER, NUMBER, SPACE, OTHER, UNKNOWN = 1, 2, 3, 0, 9
#: The code points with Unicode's White_Space property.
WHITE_SPACE = (*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
#: Characters that are handled at a time; longer texts are cut where a match starts in any case.
CHUNK = 500_000
_SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")
_MULTIPLIER = 0x9E3779B97F4A7C15
_state: dict = {}


def _classes() -> np.ndarray:
    if "classes" not in _state:
        kind = {"L": LETTER, "N": NUMBER}
        table = np.fromiter(
            (UNKNOWN if (c := unicodedata.category(chr(i))) == "Cn" else kind.get(c[0], OTHER) for i in range(0x110000)), np.uint8, 0x110000
        )
        table[list(WHITE_SPACE)] = SPACE
        _state["classes"] = table
    return _state["classes"]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd multiplier and of its inverse modulo 2**64."""
    if len(_state.get("powers", ((),))[0]) < n:
        n = max(n, CHUNK + 1)
        both = []
        for base in (_MULTIPLIER, pow(_MULTIPLIER, -1, 1 << 64)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            both.append(np.cumprod(p, dtype=np.uint64))
        _state["powers"] = tuple(both)
    return _state["powers"]


def chunks(texts: list[str]):
    """Yield (document numbers, texts) of about CHUNK characters; a longer text comes in several parts."""
    numbers, parts, size = [], [], 0
    for i, text in enumerate(texts):
        at = 0
        while len(text) - at > CHUNK and (cut := _SAFE_CUT.search(text, at + CHUNK - 1)):
            yield [i], [text[at : cut.start()]]
            at = cut.start()
        text = text[at:] if at else text
        if parts and size + len(text) > CHUNK:
            yield numbers, parts
            numbers, parts, size = [], [], 0
        numbers.append(i)
        parts.append(text)
        size += len(text)
    if parts:
        yield numbers, parts


def split(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, set[int]]:
    """Distinct words, the word number of each pre-token, the first pre-token of each text (and the end), odd texts."""
    classes = _classes()
    odd: set[int] = set()
    joined = "".join(texts)
    code = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    kind = classes[code]
    if (kind == UNKNOWN).any():
        odd = {i for i, t in enumerate(texts) if (classes[np.frombuffer(t.encode("utf-32-le"), np.uint32)] == UNKNOWN).any()}
        return split(["" if i in odd else t for i, t in enumerate(texts)])[:3] + (odd,)
    n = len(code)
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=bounds[1:])
    if not n:
        return [], np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64), odd
    first = np.zeros(n + 1, bool)
    first[bounds] = True
    space = kind == SPACE
    start = np.empty(n, bool)
    start[0] = True
    start[1:] = kind[1:] != kind[:-1]
    start |= first[:n]
    blank_before = np.zeros(n, bool)
    blank_before[1:] = code[:-1] == 32
    blank_before &= ~first[:n]
    start &= space | ~blank_before  # a blank belongs to the word after it
    start[:-1] |= space[:-1] & ~space[1:] & ~first[1:n]  # the last of several white spaces stands alone or goes with the word
    quotes = np.flatnonzero((code == 39) & start)
    quotes = quotes[quotes + 1 < n]
    if len(quotes := quotes[~first[quotes + 1]]):
        a = code[quotes + 1]
        third = np.minimum(quotes + 2, n - 1)
        b = np.where((quotes + 2 < n) & ~first[third], code[third], 0)
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        hit = one | two
        start[quotes[hit] + 1] = False
        after = (quotes + np.where(one, 2, 3))[hit]
        after = after[after < n]
        after = after[~first[after]]
        start[after[kind[after] == LETTER]] = True
    starts = np.flatnonzero(start)
    ends = np.append(starts[1:], n)
    power, inverse = _powers(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((code.astype(np.uint64) + np.uint64(1)) * power[:n], out=total[1:])
    key = (total[ends] - total[starts]) * inverse[starts]
    _, at, number = np.unique(key, return_index=True, return_inverse=True)
    length = ends - starts
    shift = np.repeat(starts[at][number] - starts, length)
    if (length[at][number] == length).all() and (code[np.arange(n) + shift] == code).all():
        words = [joined[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
    else:  # two words share a hash: number them by their characters
        seen: dict[str, int] = {}
        number = np.array([seen.setdefault(joined[s:e], len(seen)) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)])
        words = list(seen)
    return words, number, np.searchsorted(starts, bounds), odd


def expand(flat: np.ndarray, lengths: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate the pieces of `flat` that `number` names; also how many values come before each."""
    offsets = np.cumsum(lengths) - lengths
    own = lengths[number]
    before = np.zeros(len(number) + 1, np.int64)
    np.cumsum(own, out=before[1:])
    return flat[np.repeat(offsets[number] - before[:-1], own) + np.arange(before[-1])], before


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def token_lengths(path: str) -> np.ndarray:
    """How many bytes the token of each rank has."""
    ranks = load_ranks(path)
    out = np.zeros(max(ranks.values()) + 1, np.int64)
    out[list(ranks.values())] = list(map(len, ranks))
    return out


def load_encoding(path: str):
    """The tiktoken encoding of a rank file, without special tokens; one for each process."""
    if ("encoding", path) not in _state:
        import public_tokenizers
        import tiktoken

        _state["encoding", path] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(path), special_tokens={})
    return _state["encoding", path]


class WordEncoder:
    """Token ids of whole texts. Words of up to 64 characters met before come from a cache of at most `cache` of them (None: all)."""

    def __init__(self, path: str, cache: int | None = 300_000):
        self.encoding, self.cache, self.known = load_encoding(path), cache, {}

    def words(self, words: list[str]) -> list[list[int]]:
        if self.cache is not None and len(self.known) > self.cache:
            self.known.clear()
        known, encode = self.known, self.encoding.encode_ordinary
        out = []
        for w in words:
            ids = known.get(w)
            if ids is None:
                ids = encode(w)
                if self.cache is None or len(w) <= 64:
                    known[w] = ids
            out.append(ids)
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[list[np.ndarray]] = [[] for _ in texts]
        for numbers, parts in chunks(texts):
            words, number, firsts, odd = split(parts)
            pieces = self.words(words)
            lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
            flat = np.fromiter(chain.from_iterable(pieces), np.uint32, int(lengths.sum()))
            ids, before = expand(flat, lengths, number)
            cuts = before[firsts].tolist()
            for k, i in enumerate(numbers):
                out[i].append(np.array(self.encoding.encode_ordinary(parts[k]), np.uint32) if k in odd else ids[cuts[k] : cuts[k + 1]])
        return [x[0] if len(x) == 1 else np.concatenate(x) if x else np.zeros(0, np.uint32) for x in out]
