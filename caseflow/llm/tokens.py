"""Token ids of whole texts, as a tokenizer file gives them.

For a tokenizer whose pieces never cross white space and that marks the end of
a word, a text's ids are those of its words one after the other. The words of
a slice are looked up in a bounded table; only unseen words go through the
tokenizer, many at a time. A word that holds the string of a special token goes
through it alone, so that it is split there as the tokenizer does. Any other
tokenizer encodes whole texts.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import unicodedata

import numpy as np
import pyarrow as pa

from . import flat

#: White-space words, A-Z as a-z (the normaliser lower-cases).
_LOWER = flat.plain_table()
_LOWER[0x41:0x5B] = np.arange(0x61, 0x7B)
_GROUP = 2000


class WordEncoder:
    def __init__(self, path: str, specials_as_text: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = specials_as_text
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kinds = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        suffix = spec["model"].get("end_of_word_suffix")
        self.by_word = bool(suffix) and kinds == ["NFC", "Replace", "Lowercase"] and bool(steps) \
            and steps[0].get("type") == "Split" and bool(steps[0].get("invert"))
        added = [] if specials_as_text else spec.get("added_tokens") or []
        self.by_word &= not any(re.search(r"\s", x["content"]) or x["normalized"] or x["single_word"] for x in added)
        self.special = re.compile(b"|".join(re.escape(x["content"].encode()) for x in added)) if added else None
        if self.by_word:
            self.pattern = regex.compile(steps[0]["pattern"]["Regex"])
            vocab = self.tokenizer.get_vocab()
            self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
            self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        self.clear()

    def clear(self) -> None:
        self.index = flat.HashIndex()
        self.ids, self.used = np.empty(1 << 16, dtype=np.uint32), 0
        self.start, self.length = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, and how many each has."""
        parts, sizes = [], []
        for k in range(0, len(words), _GROUP):
            group = words[k:k + _GROUP]
            ids = np.array(self.tokenizer.encode(" ".join(group), add_special_tokens=False).ids, dtype=np.uint32)
            pieces = np.array([len(self.pattern.findall(unicodedata.normalize("NFC", x).lower())) for x in group])
            ends = np.flatnonzero(self.ends[ids]) + 1
            if pieces.sum() == len(ends):
                size = np.diff(np.r_[0, np.r_[0, ends][np.cumsum(pieces)]])
            else:
                each = [x.ids for x in self.tokenizer.encode_batch(group, add_special_tokens=False)]
                ids = np.array([i for x in each for i in x], dtype=np.uint32)
                size = np.array([len(x) for x in each])
            parts.append(ids)
            sizes.append(size)
        return np.concatenate(parts), np.concatenate(sizes).astype(np.int64)

    def _learn(self, w: flat.Words, at: np.ndarray, alone: bool) -> None:
        keys, first = np.unique(w.hash[at], return_index=True)
        if not len(keys):
            return
        at = at[first]
        raw = w.raw.tobytes()
        words = [raw[s:e].decode() for s, e in zip(w.start[at].tolist(), w.end[at].tolist())]
        if alone:
            each = [self.tokenizer.encode(x, add_special_tokens=False).ids for x in words]
            ids, size = np.array([i for x in each for i in x], dtype=np.uint32), np.array([len(x) for x in each], dtype=np.int64)
        else:
            ids, size = self._encode_words(words)
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        self.ids[self.used:self.used + len(ids)] = ids
        self.index.add(keys, np.arange(len(self.start), len(self.start) + len(keys), dtype=np.int32))
        self.start = np.concatenate([self.start, self.used + np.cumsum(size) - size])
        self.length = np.concatenate([self.length, size])
        self.used += len(ids)

    def _with_specials(self, w: flat.Words) -> np.ndarray:
        """Which words hold a special token's string; these are told apart by
        their own bytes, not by the lower-cased ones."""
        odd = np.zeros(len(w.hash), dtype=bool)
        raw = w.raw.tobytes() if self.special else b""
        at = [m.start() for m in self.special.finditer(raw)] if self.special else []
        if at:
            odd[np.searchsorted(w.start, at, "right") - 1] = True
            for k in np.flatnonzero(odd).tolist():
                own = hashlib.blake2b(raw[w.start[k]:w.end[k]], digest_size=8, person=b"special").digest()
                w.hash[k] = int.from_bytes(own, "little")
        return odd

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts, and each text's offset (one more than texts)."""
        if not self.by_word:
            each = [x.ids for x in self.tokenizer.encode_batch([t or "" for t in texts.to_pylist()],
                                                               add_special_tokens=False)]
            return (np.array([i for x in each for i in x], dtype=np.uint32),
                    np.r_[0, np.cumsum([len(x) for x in each])].astype(np.int64))
        w = flat.words(texts, _LOWER)
        odd = self._with_specials(w)
        number = self.index.get(w.hash)
        new = number < 0
        if new.any():
            if self.index.full(int(new.sum())):
                self.clear()
                new[:] = True
            self._learn(w, np.flatnonzero(new & ~odd), False)
            self._learn(w, np.flatnonzero(new & odd), True)
            number = self.index.get(w.hash)
        size = self.length[number]
        return self.ids[flat.expand(size, self.start[number])], np.r_[0, np.cumsum(size)][w.first]


def default_path() -> str:
    """The tokenizer file that packing takes unless another one is named."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


_ENCODERS: dict[str | None, WordEncoder] = {}


def encoder(path: str | None = None) -> WordEncoder:
    """This worker's encoder of a tokenizer file; of the default one, wherever
    this machine has it."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path or default_path())
    return _ENCODERS[path]
