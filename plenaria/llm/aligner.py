"""Alignment of two tokenizers' tokens within a worker: byte-level BPE (A) and sentence pieces with byte fallback (B).

A and B tokens that end at the same byte close a group.  Neither tokenizer has a token across a blank between two words
that neither start nor end with white space, so groups never cross such a blank: a text whose words are all of that kind
is the sum of its words.  A worker keeps what the first CACHE_WORDS words add; others are encoded and aligned once per slice.
Any other text is a word of its own.
"""

from __future__ import annotations

import itertools
import json
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from plenaria.llm.word_tokens import gather

CACHE_WORDS = 100_000
JOINED = 1 << 20         # bytes of words encoded in one string
WIDE = 1 << 14           # links of a group from which they are counted by distinct ids
B_BITS = 16              # a pair of ids is a << B_BITS | b
SPACE = "▁"
WHITE = r"[\t-\r \x{1C}-\x{1F}\x{85}\p{Z}]"


def default_paths() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Words(NamedTuple):
    """What each word adds to its text."""
    given: np.ndarray      # whether both tokenizers give its bytes back; else the other fields are zero or empty
    numbers: np.ndarray    # rows: A tokens, B tokens, groups, links
    groups: list[str]      # the groups' text
    size: np.ndarray       # number of distinct id pairs
    pairs: np.ndarray      # the pairs of all words in a row, ascending in a word
    times: np.ndarray      # how often each is linked

    @classmethod
    def joined(cls, parts: list[Words]) -> Words:
        return cls(*(list(itertools.chain.from_iterable(x)) if isinstance(x[0], list) else np.concatenate(x, axis=-1)
                     for x in zip(*parts)))

    def first(self, n: int) -> Words:
        """The first ``n`` words."""
        m = int(self.size[:n].sum())
        return Words(self.given[:n], self.numbers[:, :n], self.groups[:n], self.size[:n], self.pairs[:m], self.times[:m])


def nothing(n: int) -> Words:
    """``n`` words without tokens."""
    zero = np.zeros(0, dtype=np.int64)
    return Words(np.zeros(n, dtype=bool), np.zeros((4, n), dtype=np.int64), [""] * n, np.zeros(n, dtype=np.int64),
                 zero.astype(np.uint32), zero)


def byte_characters() -> dict[str, int]:
    """Byte-level BPE's characters: printable Latin-1 stands for itself, the other bytes follow from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary(NamedTuple):
    """Token bytes, joined, and each id's length."""
    data: np.ndarray
    size: np.ndarray

    @classmethod
    def of(cls, tokens: list[bytes]) -> Vocabulary:
        return cls(np.frombuffer(b"".join(tokens), dtype=np.uint8), np.array([len(t) for t in tokens], dtype=np.int64))


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        import tiktoken
        with open(a_path, encoding="utf-8") as f:
            model = json.load(f)
        special = {t["content"] for t in model["added_tokens"] if t["special"]}
        of = byte_characters()
        by_id = {i: t.encode() if t in special else bytes(of[c] for c in t) for t, i in model["model"]["vocab"].items()}
        by_id |= {t["id"]: t["content"].encode() for t in model["added_tokens"]}
        self.a = Vocabulary.of([by_id.get(i, b"") for i in range(max(by_id) + 1)])
        ranks = {t: i for i, t in by_id.items() if t.decode("utf-8", "replace") not in special}
        import public_tokenizers
        self.fast = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=b_path)
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())]
        if any(SPACE in n.lstrip(SPACE) for n in names):
            raise ValueError("a piece reaches over a blank")
        self.b = Vocabulary.of([bytes([int(n[3:5], 16)]) if self.pieces.is_byte(i) else n.replace(SPACE, " ").encode()
                                for i, n in enumerate(names)])
        self.text_of = [f"{i}{c}" for i in range(max(len(self.a.size), len(self.b.size))) for c in ",|;\n"]
        self.place = {"": 0}           # of a word in ``words``; the empty one stands for a text without words
        self.words = nothing(1)

    def _aligned(self, words: list[str]) -> Words:
        data = np.frombuffer("".join([" " + w for w in words]).encode(), dtype=np.uint8)
        a = np.array(self.fast.encode_ordinary(" " + " ".join(words)), dtype=np.int64)
        b = np.array(self.pieces.encode(" ".join(words)), dtype=np.int64)
        if not all(np.array_equal(gather(v.data, v.size, ids), data) for v, ids in ((self.a, a), (self.b, b))):
            if len(words) == 1:
                return nothing(1)
            half = len(words) // 2      # find the words that do it
            return Words.joined([self._aligned(words[:half]), self._aligned(words[half:])])
        a_end, b_end = np.cumsum(self.a.size[a]), np.cumsum(self.b.size[b])
        word_end = np.cumsum(np.fromiter((len(w.encode()) + 1 for w in words), dtype=np.int64, count=len(words)))
        ends = np.intersect1d(a_end, b_end, assume_unique=True)
        a_group, b_group = np.searchsorted(ends, a_end), np.searchsorted(ends, b_end)
        n_a, n_b = np.bincount(a_group, minlength=len(ends)), np.bincount(b_group, minlength=len(ends))
        group_word = np.searchsorted(word_end, ends)

        def per_word(x):
            return np.add.reduceat(x, np.searchsorted(group_word, np.arange(len(words))))

        # ids in the order of the groups' text, each with the character that follows it
        b_first, a_first = np.cumsum(n_b) - n_b, np.cumsum(n_a) - n_a
        a_at, b_at = np.arange(len(a)) + b_first[a_group], np.arange(len(b)) + a_first[b_group] + n_a[b_group]
        ids, mark = np.empty(len(a) + len(b), dtype=np.int64), np.zeros(len(a) + len(b), dtype=np.int64)
        ids[a_at], ids[b_at] = a, b
        mark[b_first + a_first + n_a - 1] = 1
        last = b_first + a_first + n_a + n_b - 1
        mark[last] = 2
        mark[last[np.append(group_word[1:] != group_word[:-1], True)]] = 3
        groups = "".join(map(self.text_of.__getitem__, (ids * 4 + mark).tolist())).split("\n")

        # links: every A token with every B token of its group; wide groups by their distinct ids
        wide = n_a * n_b > WIDE
        a_few = np.flatnonzero(~wide[a_group])
        with_b = n_b[a_group[a_few]]
        before = np.cumsum(with_b) - with_b
        b_of = np.repeat(b_first[a_group[a_few]] - before, with_b) + np.arange(int(with_b.sum()))
        pair = [(np.repeat(group_word[a_group[a_few]], with_b) << 32) | (np.repeat(a[a_few], with_b) << B_BITS) | b[b_of]]
        times = [np.ones(len(pair[0]), dtype=np.int64)]
        for g in np.flatnonzero(wide):
            xs, x_times = np.unique(a[a_first[g]:a_first[g] + n_a[g]], return_counts=True)
            ys, y_times = np.unique(b[b_first[g]:b_first[g] + n_b[g]], return_counts=True)
            pair.append(((group_word[g] << 32) | (xs[:, None] << B_BITS) | ys[None, :]).ravel())
            times.append((x_times[:, None] * y_times[None, :]).ravel())
        pair, times = summed(np.concatenate(pair), np.concatenate(times))
        numbers = np.stack([per_word(x) for x in (n_a, n_b, np.ones(len(ends), dtype=np.int64), n_a * n_b)])
        return Words(np.ones(len(words), dtype=bool), numbers, groups[:-1], np.bincount(pair >> 32, minlength=len(words)),
                     pair.astype(np.uint32), times)

    def aligned(self, words: list[str]) -> Words:
        out, size, low = [nothing(0)], 0, 0
        for i, w in enumerate(words):
            size += len(w)
            if size > JOINED or i == len(words) - 1:
                out.append(self._aligned(words[low:i + 1]))
                size, low = 0, i + 1
        return Words.joined(out)

    def align(self, texts: pa.Array) -> tuple[Words, np.ndarray, np.ndarray]:
        """Words, the places in them of the words of all texts in a row, and how many of these each text has (one at least).

        The first CACHE_WORDS words that the worker meets stay for later calls."""
        texts = pc.fill_null(texts, "")
        even = pc.invert(pc.match_substring_regex(texts, f"{WHITE}[ ]|[ ]{WHITE}|^{WHITE}|{WHITE}$|{SPACE}"))
        split = pc.split_pattern(pc.if_else(even, texts, ""), " ")
        coded = split.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        places = [self.place.get(w, -1) for w in distinct]
        new = [w for w, i in zip(distinct, places) if i < 0]
        at = split.offsets.to_numpy() - split.offsets[0].as_py()
        others = np.flatnonzero(pc.and_(pc.invert(even), pc.not_equal(texts, "")).to_numpy(zero_copy_only=False))
        words, kept = self.words, len(self.place)
        if new or len(others):
            # texts that are no sums of words are words of their own
            words = Words.joined([words, self.aligned(new), *(self._aligned([texts[i].as_py()]) for i in others.tolist())])
            room = max(0, min(CACHE_WORDS - kept, len(new)))
            self.place.update(zip(new[:room], range(kept, kept + room)))
            if room:
                self.words = words.first(kept + room)
        places = np.array(places, dtype=np.int64)
        places[places < 0] = kept + np.arange(len(new))
        index = places[coded.indices.to_numpy(zero_copy_only=False)]
        index[at[others]] = kept + len(new) + np.arange(len(others))
        return words, index, np.diff(at)


def summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their weights."""
    if not len(keys):
        return keys, weights
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(weights[order], first)


@lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    """One aligner and its cache per worker process."""
    return Aligner(a_path, b_path)
