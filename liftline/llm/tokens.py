"""Byte-level BPE ids of many texts at once, equal to what the tokenizers library returns text by text.

A byte-level vocabulary is applied to each word-like piece by itself. The pieces of a block of texts are found
with array operations, each distinct piece is encoded once by the library's model, and the ids are gathered back.
Parts that hold the literal of an added token, and vocabularies of another kind, are passed to the library as they are.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd

LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 4
#: The characters with the Unicode property White_Space.
WHITE_SPACE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: The endings that a byte-level vocabulary splits off after an apostrophe.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
#: Characters handled at once; bounds a task's memory whatever the length of a text.
BLOCK = 500_000
#: Pieces a worker remembers; others are encoded again in each block.
REMEMBERED = 800_000
LONGEST = 64
#: The character by which a byte-level vocabulary spells each byte; those that do not print are moved behind the others.
PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
SPELLING = np.arange(256, dtype=np.uint32)
SPELLING[np.setdiff1d(np.arange(256), PRINTED)] = 256 + np.arange(256 - len(PRINTED))
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: equal values stay equal, others look independent."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenated ranges [start, start + length)."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def cut_points(text: str, block: int = BLOCK) -> list[int]:
    """Where a very long text can be cut so that its parts have the ids of the whole: before a white space that
    follows something else. A part is longer than ``block`` only where it has no such place."""
    cuts, at = [], 0
    while len(text) - at > block:
        at += block
        while at < len(text) and not (ord(text[at]) in WHITE_SPACE and ord(text[at - 1]) not in WHITE_SPACE):
            at += 1
        if at < len(text):
            cuts.append(at)
    return cuts


class TokenEncoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        # a task has a processor of its own: the library's threads would only wait for each other
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.library = Tokenizer.from_file(path)
        # asked from the library: the file's vocabulary need not be parsed twice
        added = list(self.library.get_added_tokens_decoder().values())
        self.literals = [x.content for x in added]
        pre = self.library.pre_tokenizer
        self.by_piece = (
            isinstance(pre, ByteLevel)
            and pre.use_regex
            and not pre.add_prefix_space
            and self.library.normalizer is None
            # a long text is cut before white space: no literal may hold or take any
            and not any(x.lstrip or x.rstrip or x.single_word or re.search(r"\s", x.content) for x in added)
        )
        self.model = self.library.model
        self.known: dict[int, int] = {}
        self.ascii = np.array([self.char_class(c) if self.by_piece else 0 for c in range(128)], np.uint8)
        #: Hashes of the pieces remembered, ascending, and where each one's ids are: arrays, a tenth of a dictionary.
        self.keys, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)
        self.scatter = mixed(np.arange(1, 1 << 14, dtype=np.uint64))
        self.power = powers(BASE, BLOCK + 1)
        self.inverse = powers(np.uint64(pow(int(BASE), -1, 1 << 64)), BLOCK + 1)

    def char_class(self, c: int) -> int:
        """The class by which the library splits, asked from it: which of ``a``, ``1`` and ``!`` the character joins."""
        if c not in self.known:
            joins = lambda x: len(self.library.pre_tokenizer.pre_tokenize_str(x + chr(c))) == 1
            kinds = ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!"))
            self.known[c] = next((kind for kind, x in kinds if joins(x)), SPACE)
        return self.known[c]

    def classes(self, chars: np.ndarray) -> np.ndarray:
        out = self.ascii[np.minimum(chars, 127)]
        wide = np.flatnonzero(chars > 127)
        if len(wide):
            codes, kinds = pd.factorize(chars[wide])
            out[wide] = np.array([self.char_class(int(c)) for c in kinds], np.uint8)[codes]
        return out

    def scattered(self, chars: np.ndarray) -> np.ndarray:
        """``mixed`` of each character and one, looked up where there is a table for it."""
        out = self.scatter[np.minimum(chars, len(self.scatter) - 1)]
        wide = np.flatnonzero(chars >= len(self.scatter))
        out[wide] = mixed(chars[wide] + np.uint32(1))
        return out

    def piece_starts(self, chars: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Where pieces begin. ``first``: marks the first character of each text."""
        kind = self.classes(chars)
        n = len(chars)
        before = np.empty(n, np.uint8)
        before[0], before[1:] = 0, kind[:-1]
        before[first] = 0
        after = np.empty(n, np.uint8)
        after[-1], after[:-1] = 0, kind[1:]
        after[:-1][first[1:]] = 0
        last_char = np.empty(n, chars.dtype)
        last_char[0], last_char[1:] = 0, chars[:-1]
        space = kind == SPACE
        follows_blank = (before == SPACE) & (last_char == 32)
        start = np.where(
            space, (before != SPACE) | ((after != 0) & (after != SPACE)), (kind != before) & ~follows_blank
        )
        for i in np.flatnonzero((chars == 39) & start & (kind == OTHER)):
            if before[i] == OTHER:
                continue
            tail = chars[i + 1 : i + 3]
            stop = np.flatnonzero(first[i + 1 : i + 3])
            tail = "".join(map(chr, tail[: stop[0]] if len(stop) else tail))
            ending = next((e for e in ENDINGS if tail.startswith(e)), None)
            if ending:
                start[i + 1] = False
                end = i + 1 + len(ending)
                if end < n:
                    blank = chars[end] == 32 or kind[end] == SPACE
                    start[end] = True if not blank else start[end]
        start[first] = True
        return np.flatnonzero(start)

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the pieces, where those of each begin, and their counts. The model gets what the library's own split
        would hand it: the bytes of a piece, spelled as characters."""
        raw = np.frombuffer("".join(pieces).encode(), np.uint8)
        first_bytes = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
        edges = first_bytes[np.cumsum([0, *map(len, pieces)])].tolist()
        spelled = SPELLING[raw].tobytes().decode("utf-32-le")
        ids: list[int] = []
        ends = []
        for a, b in zip(edges, edges[1:]):
            ids += [token.id for token in self.model.tokenize(spelled[a:b])]
            ends.append(len(ids))
        counts = np.diff(np.array(ends, np.int64), prepend=0)
        return np.array(ids, np.uint32), np.array(ends, np.int64) - counts, counts

    def block(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the parts, concatenated, and their counts."""
        lengths = np.array([len(p) for p in parts], np.int64)
        whole = "".join(parts)
        if not whole:
            return np.zeros(0, np.uint32), np.zeros(len(parts), np.int64)
        chars = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        n = len(chars)
        if n + 1 > len(self.power):
            self.power, self.inverse = powers(BASE, n + 1), powers(np.uint64(pow(int(BASE), -1, 1 << 64)), n + 1)
        ends = np.cumsum(lengths)
        first = np.zeros(n + 1, bool)
        first[ends - lengths] = True
        starts = self.piece_starts(chars, first[:-1])
        sizes = np.diff(np.append(starts, n))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.scattered(chars) * self.power[:n], out=sums[1:])
        keys = (sums[starts + sizes] - sums[starts]) * self.inverse[starts]
        keys = mixed(keys ^ (sizes.astype(np.uint64) << np.uint64(40)))
        long = np.flatnonzero(sizes > LONGEST)  # by themselves: short strings alone are trusted to their hash
        keys[long] = np.arange(len(long), dtype=np.uint64)
        codes, kinds = pd.factorize(keys)
        kind_at = np.empty(len(kinds), np.int64)
        kind_at[codes[::-1]] = np.arange(len(codes))[::-1]
        slot = np.full(len(kinds), -1, np.int64)
        if len(self.keys):
            by_key = np.argsort(kinds)  # neighbours are found near each other
            at = np.minimum(np.searchsorted(self.keys, kinds[by_key]), len(self.keys) - 1)
            slot[by_key] = np.where(self.keys[at] == kinds[by_key], self.slots[at], -1)
        slot[codes[long]] = -1
        new = np.flatnonzero(slot < 0)
        used, room = len(self.starts), REMEMBERED - len(self.slots)
        if len(new):
            at = kind_at[new]
            pieces = [whole[a:b] for a, b in zip(starts[at].tolist(), (starts + sizes)[at].tolist())]
            ids, begins, counts = self.encode_pieces(pieces)
            slot[new] = used + np.arange(len(new))
            pool = np.concatenate([self.pool, ids])
            at_pool = np.concatenate([self.starts, len(self.pool) + begins])
            of_pool = np.concatenate([self.sizes, counts])
        else:
            pool, at_pool, of_pool = self.pool, self.starts, self.sizes
        piece_sizes = of_pool[slot][codes]
        out = pool[ranges(at_pool[slot][codes], piece_sizes)]
        if len(new) and len(new) <= room:
            short = sizes[kind_at[new]] <= LONGEST
            order = np.argsort(kinds[new][short])
            more = kinds[new][short][order]
            at = np.searchsorted(self.keys, more)
            self.keys, self.slots = np.insert(self.keys, at, more), np.insert(self.slots, at, slot[new][short][order])
            self.pool, self.starts, self.sizes = pool, at_pool, of_pool
        total = np.zeros(len(piece_sizes) + 1, np.int64)
        np.cumsum(piece_sizes, out=total[1:])
        edge = np.searchsorted(starts, np.append(ends - lengths, n))
        return out, np.diff(total[edge])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, concatenated, and their counts."""
        if not self.by_piece:
            ids = [np.array(e.ids, np.uint32) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
            return np.concatenate([np.zeros(0, np.uint32), *ids]), np.array([len(x) for x in ids], np.int64)
        out, counts = [np.zeros(0, np.uint32)], np.zeros(len(texts), np.int64)
        parts: list[str] = []
        owners: list[int] = []
        held = 0

        def flush() -> None:
            nonlocal held
            if parts:
                special = [k for k, p in enumerate(parts) if any(x in p for x in self.literals)]
                whole = self.library.encode_batch_fast([parts[k] for k in special], add_special_tokens=False)
                for k in special:
                    parts[k] = ""
                ids, sizes = self.block(parts)
                if special:
                    pieces = np.split(ids, np.cumsum(sizes)[:-1])
                    for k, x in zip(special, whole):
                        pieces[k] = np.array(x.ids, np.uint32)
                        sizes[k] = len(x.ids)
                    ids = np.concatenate(pieces)
                out.append(ids)
                np.add.at(counts, owners, sizes)
                parts.clear()
                owners.clear()
                held = 0

        for i, text in enumerate(texts):
            cuts = [0, *cut_points(text), len(text)] if len(text) > BLOCK else [0, len(text)]
            for a, b in zip(cuts, cuts[1:]):
                if held + b - a > BLOCK:
                    flush()
                parts.append(text[a:b])
                owners.append(i)
                held += b - a
        flush()
        return np.concatenate(out), counts


@lru_cache(maxsize=2)
def encoder(path: str) -> TokenEncoder:
    """One per worker process and vocabulary; what it has learnt serves later batches."""
    return TokenEncoder(path)


def batches(frames: Iterator[pd.DataFrame], path: str, end_id: int) -> Iterator[tuple[list, list[np.ndarray]]]:
    """(doc ids, id arrays with the end id) of rows (doc_id, text), some of them at a time."""
    encode = encoder(path).encode
    for frame in frames:
        ids, texts = frame["doc_id"].tolist(), frame["text"].tolist()
        k = 0
        while k < len(texts):
            j, held = k, 0
            while j < len(texts) and (j == k or held + len(texts[j]) <= BLOCK):
                held += len(texts[j])
                j += 1
            flat, counts = encode(texts[k:j])
            parts = np.split(flat, np.cumsum(counts)[:-1])
            yield ids[k:j], [np.append(p, np.uint32(end_id)) for p in parts]
            k = j
