"""Token ids of whole texts by a vocabulary file of the tokenizers library.

The library's ids of a text are those of its parts between blanks, one after another: white
space is dropped and never part of a token. So each different part is encoded once and kept,
which is about five times as fast on prose. This holds for vocabularies that drop white space
and not for others, which ``Encoder`` encodes text by text.
"""

from __future__ import annotations

import json
import os
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words that a worker process keeps the ids of, twice: when they are as many, they become the
#: older ones, of which those that occur again are kept on.
KEPT_WORDS = 700_000

_TAIL = ".,!?;:"
_END_OF_WORD = "</w>"


def _cuts_cleanly(stem: str) -> bool:
    """Whether marks after the stem are pieces of their own. They are not after letters that
    composing or lower case takes apart into a letter and a mark, which joins them."""
    if not stem.isalpha():
        return False
    return stem.isascii() or max(stem) < "\u0100" or normalize("NFC", stem).lower().isalpha()


_SPECIAL = "<|"


def _keeps_case(texts: pa.Array) -> bool:
    """Whether some text may hold a special token, or a mark of U+0300 to U+036F (whose first byte is
    CC or CD), with which a small letter may be composed and its capital not."""
    if pc.any(pc.match_substring(texts, _SPECIAL)).as_py():
        return True
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    ends = np.frombuffer(texts.buffers()[1], wide)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or ends[0] == ends[-1]:
        return False
    data = np.frombuffer(texts.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    return bool((data == 0xCC).any() or (data == 0xCD).any())


class Encoder:
    """Ids of texts. One per process and file: see ``encoder``."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.drops_space = spec["model"].get("end_of_word_suffix") == _END_OF_WORD
        # A-Z can be lowered before words are told apart, as the file's own rules do it later: but for
        # special tokens, which all begin alike, and letters that a mark is composed with.
        steps = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        marks = [x["content"].startswith(_SPECIAL) for x in spec["added_tokens"]]
        self.lowers = "Lowercase" in steps and all(marks)
        vocabulary = self.tokenizer.get_vocab()
        self.size = max(vocabulary.values()) + 1
        self.ends = np.zeros(self.size, dtype=bool)
        self.ends[[i for word, i in vocabulary.items() if word.endswith(_END_OF_WORD)]] = True
        # For words of Latin-1 letters: composed as they are, and of one lower case.
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and where each text ends in it. Null is empty."""
        texts = pc.fill_null(texts, "")
        if not self.drops_space:
            found = self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)
            ids = [np.array(x.ids, dtype=np.uint32) for x in found]
            lengths = np.array([len(x) for x in ids], dtype=np.int64)
            return np.concatenate([np.empty(0, np.uint32), *ids]), np.cumsum(lengths)
        if self.lowers and not _keeps_case(texts):
            texts = pc.ascii_lower(texts)
        parts = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = parts.flatten().dictionary_encode()
        codes = coded.indices.to_numpy()
        words = self._words(coded.dictionary.to_pylist())
        lengths = np.fromiter(map(len, words), np.int64, len(words)) // 4
        flat = np.frombuffer(b"".join(words), np.uint32)
        starts = np.cumsum(lengths) - lengths
        each = lengths[codes]
        ends = np.cumsum(each)
        total = int(ends[-1]) if len(ends) else 0
        kind = np.int32 if total < 2**31 else np.int64
        place = np.repeat((starts[codes] - (ends - each)).astype(kind), each)
        place += np.arange(total, dtype=kind)
        ids = flat.take(place)
        part_ends = np.diff(parts.offsets.to_numpy()).cumsum()
        return ids, np.concatenate(([0], ends))[part_ends]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of each part. What is new is cut into a word and the marks after it."""
        if len(self.known) + len(words) > KEPT_WORDS:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        new = [word for word in words if word not in known]
        again = [word for word in new if word in older]
        known.update(zip(again, map(older.__getitem__, again), strict=True))
        if len(again) < len(new):
            new = [word for word in new if word not in known]
            stems = [word.rstrip(_TAIL) for word in new]
            for i, stem in enumerate(stems):
                if not (stem.isalpha() and stem.isascii() or _cuts_cleanly(stem)):
                    stems[i] = new[i]
            tails = [word[len(stem) :] for word, stem in zip(new, stems, strict=True)]
            self._learn(list((set(stems) | set(tails)).difference(known)))
            for word, stem, tail in zip(new, stems, tails, strict=True):
                if tail:
                    known[word] = known[stem] + known[tail]
        return list(map(known.__getitem__, words))

    def _learn(self, words: list[str]) -> None:
        """Letters alone are one piece, which ends in one end-of-word token: many go at once."""
        older = self.older
        self.known.update((word, older[word]) for word in words if word in older)
        words = [word for word in words if word not in self.known]
        plain, others, rest = [], [], []
        for word in words:
            if not word.isalpha():
                rest.append(word)
            elif word.isascii() or max(word) < "\u0100":
                plain.append(word)
            else:
                others.append(word)
        rest += self._learn_joined(self.plain, [word.lower() for word in plain], plain)
        rest += self._learn_joined(self.tokenizer, others, others)
        for start in range(0, len(rest), 1000):
            some = rest[start : start + 1000]
            found = self.tokenizer.encode_batch_fast(some, add_special_tokens=False)
            self.known.update(
                (w, np.array(x.ids, dtype=np.uint32).tobytes())
                for w, x in zip(some, found, strict=True)
            )

    def _learn_joined(self, tokenizer, words: list[str], names: list[str]) -> list[str]:
        """Learn words from texts of many; returns those that did not come out one by one."""
        failed = []
        for start in range(0, len(words), 1000):
            some, keys = words[start : start + 1000], names[start : start + 1000]
            joined = tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)
            ids = np.array(joined[0].ids, dtype=np.uint32)
            ends = (np.flatnonzero(self.ends[ids]) + 1) * 4
            if len(ends) == len(some):
                data, at = ids.tobytes(), 0
                for key, end in zip(keys, ends.tolist(), strict=True):
                    self.known[key] = data[at:end]
                    at = end
            else:
                failed += keys
        return failed


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The process's encoder of a vocabulary file, so that tasks share what it has kept."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def vocabulary_path(name: str) -> str:
    """The place of an installed public vocabulary file; any other path will do as well."""
    import public_tokenizers

    return public_tokenizers.path(name)
