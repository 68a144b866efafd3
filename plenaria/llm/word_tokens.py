"""Token ids of many texts by a word-level BPE vocabulary, through its distinct words.

The vocabulary's pre-tokenizer looks across no ASCII white space and ends a token between a letter and a run of marks, so
a text's ids are its words' ids in a row.  A batch is lower-cased (A-Z), split into words and dictionary-encoded by Arrow;
only words that the worker has not met are encoded.  Plain words (lower-case Latin-1 letters) go to the BPE model in one
string, all others through the whole tokenizer.  A worker keeps at most CACHE_WORDS words; beyond that it starts anew.
"""

from __future__ import annotations

import itertools
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE_WORDS = 800_000
SLICE_BYTES = 16 << 20    # of text encoded at once

_LETTER = r"[a-z\x{DF}-\x{F6}\x{F8}-\x{FF}]"
_MARKS = r"[!-/:-@\[-`{-~]+"


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _byte_characters() -> dict[int, str]:
    """Byte-level BPE's character for every byte that is not printable in Latin-1; the others stand for themselves."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    return {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in printable)}


class WordEncoder:
    """``encode`` gives flat ids and each text's number of ids."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers
        self.whole = Tokenizer.from_file(path)
        self.model = Tokenizer(self.whole.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.whole.get_vocab(True)
        self.last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)    # ids that end a word
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.characters = {b: c for b, c in _byte_characters().items() if b > 0x20}
        self.words: dict[str, bytes] = {}

    def _learn(self, words: pa.Array) -> None:
        """Encode words that are not yet known."""
        is_plain = pc.match_substring_regex(words, f"^{_LETTER}+$")
        plain, other = words.filter(is_plain).to_pylist(), words.filter(pc.invert(is_plain)).to_pylist()
        if plain:
            plain.sort(key=str.isascii)    # only the others need other characters
            cut = sum(1 for _ in itertools.takewhile(lambda w: not w.isascii(), plain))
            joined = " ".join(plain[:cut]).encode().decode("latin-1").translate(self.characters) + " " + " ".join(plain[cut:])
            ids = np.array(self.model.encode_batch_fast([joined], add_special_tokens=False)[0].ids, dtype="<u4")
            end = ((np.flatnonzero(self.last[ids]) + 1) * 4).tolist()
            if len(end) != len(plain):
                raise ValueError("a word without a last token")
            data, start = ids.tobytes(), 0
            for word, stop in zip(plain, end):
                self.words[word] = data[start:stop]
                start = stop
        for word, found in zip(other, self.whole.encode_batch_fast(other, add_special_tokens=False)):
            self.words[word] = np.array(found.ids, dtype="<u4").tobytes()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids (uint32) of all texts and the number of ids of each; null is empty."""
        texts = pc.fill_null(texts, "")
        # texts that may hold special tokens, which are told by case and by their marks, stay as they are
        eased = pc.replace_substring_regex(pc.ascii_lower(texts), f"({_LETTER})({_MARKS})(\\s|$)", r"\1 \2\3")
        texts = pc.if_else(pc.match_substring(texts, "<|"), texts, eased)
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        known = self.words
        ids_of = [known.get(w) if w else b"" for w in distinct]
        if None in ids_of:
            new = [i for i, x in enumerate(ids_of) if x is None]
            if len(known) + len(new) > CACHE_WORDS and known:
                self.words = known = {}
            self._learn(coded.dictionary.take(pa.array(new)))
            for i in new:
                ids_of[i] = known[distinct[i]]
        flat = np.frombuffer(b"".join(ids_of), dtype="<u4")
        size = np.fromiter(map(len, ids_of), dtype=np.int64, count=len(ids_of)) // 4
        index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        before = np.concatenate([[0], np.cumsum(size[index])])
        at = split.offsets.to_numpy() - split.offsets[0].as_py()
        return gather(flat, size, index), before[at[1:]] - before[at[:-1]]


def gather(flat: np.ndarray, size: np.ndarray, index: np.ndarray) -> np.ndarray:
    """The runs ``index`` of ``flat``, whose runs have ``size`` elements, in a row."""
    start = np.cumsum(size) - size
    count = size[index]
    end = np.cumsum(count)
    total = int(end[-1]) if len(end) else 0
    return flat[np.repeat(start[index] - (end - count), count) + np.arange(total)]


def slices(texts: pa.Array, upto: int = SLICE_BYTES):
    """(first row, one past the last) of runs of texts of about ``upto`` bytes, one text at least."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    end, low = np.cumsum(size), 0
    while low < len(size):
        high = max(low + 1, int(np.searchsorted(end, (end[low - 1] if low else 0) + upto, "right")))
        yield low, high
        low = high


@lru_cache(maxsize=4)
def encoder(path: str) -> WordEncoder:
    """One encoder and its cache per worker process."""
    return WordEncoder(path)
