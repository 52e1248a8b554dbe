"""Token ids of whole texts with a public tokenizer file, a word at a time.

The tokenizers library spends nearly all its time on merging, and words repeat. A text is cut where its pre-tokenizer
always cuts, each distinct word is encoded once by the library, and the ids of a text are joined from its words'. Where
a text has white space the cut rule does not cover, the library encodes that line whole. Words are numbered by Arrow and
their ids gathered by numpy, a round of texts at a time, so the memory of words is asked once per distinct word of a round.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa

ID_TYPE = np.dtype("<u4")
# White space to Python but not to the tokenizers' patterns.
ODD_SPACE = re.compile("[\x1c-\x1f]")
# Distinct words remembered per Python worker; beyond it the memory is emptied and fills again.
CACHE_WORDS = 800_000
# Words to one call of the library, marks that are one token each, and what is cut from a word's end.
WORDS_PER_CALL = 2000
TEXT_PER_ROUND = 4_000_000
MARKS = "~^`@|"
TAIL = ".,;:!?*#$%&"
# Words that a file with these rules takes as one piece, lower-cased; composing (NFC) leaves their letters as they are.
LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
LETTER_RULES = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
# The letter of each byte in byte-level files: printable bytes stand for themselves.
PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_LETTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in PRINTABLE)}


def public_path(name: str) -> str:
    """Place of an installed public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class WordTokenizer:
    """Ids as little-endian unsigned 32-bit integers (16 if ``narrow`` and the vocabulary allows), equal to the library's ``encode(text, add_special_tokens=False)``.

    ``spaced`` tells whether the pre-tokenizer keeps white space in its words (byte-level) or drops it (word ends).
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS, narrow: bool = False) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.type = np.dtype("<u2") if narrow and self.tokenizer.get_vocab_size() <= 1 << 16 else ID_TYPE
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.spaced = self.encode_whole("a b") != self.encode_whole("a") + self.encode_whole("b")
        self.cache_words = cache_words
        self.mark_ids = {m: np.frombuffer(self.encode_whole(m), self.type)[0] for m in f"{MARKS}\n" if self.encode_whole(m)}
        self.fixed = {"": b"", "\n": self.encode_whole("\n")}
        self.cache: dict[str, bytes] = dict(self.fixed)
        self.special = {
            token.content: np.array([i], self.type).tobytes()
            for i, token in self.tokenizer.get_added_tokens_decoder().items()
        }
        self.special_pattern = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        rules = json.loads(self.tokenizer.to_str())
        self.by_letters = {k: rules[k] for k in LETTER_RULES} == LETTER_RULES and rules["model"]["type"] == "BPE"

    def encode_whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.type).tobytes()

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of words that are new, many to a call: the words stand between marks whose id none of them has."""
        text, marks = ("\n".join(words), "\n") if self.spaced else (" ".join(words), MARKS)
        mark = next((m for m in marks if self.spaced or m not in text), None)
        if mark is None:
            return [self.encode_whole(w) for w in words]
        joined = text if self.spaced else f" {mark} ".join(words)
        ids = np.array(self.tokenizer.encode(joined, add_special_tokens=False).ids, self.type)
        cuts = np.flatnonzero(ids == self.mark_ids[mark]).tolist()
        blob, starts = ids.tobytes(), [0, *(c + 1 for c in cuts)]
        width = self.type.itemsize
        return [blob[width * i : width * j] for i, j in zip(starts, [*cuts, len(ids)])]

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text; None counts as empty. Texts are taken together so that new words are learned in bulk."""
        plans: list[list] = []
        out: list[bytes] = []
        held = 0
        for text in texts:
            plans.append(self._plan(text or ""))
            held += len(text or "")
            if held > TEXT_PER_ROUND:
                out += self._join(plans)
                plans, held = [], 0
        return out + self._join(plans)

    def _plan(self, text: str) -> list:
        """What a text is made of: lists of words to look up, and ids known already."""
        if self.special_pattern is None or not (found := self.special_pattern.search(text)):
            return [self._words(text)]
        parts, start = [], 0
        while found:
            parts += [self._words(text[start : found.start()]), self.special[found.group()]]
            start = found.end()
            found = self.special_pattern.search(text, start)
        return [*parts, self._words(text[start:])]

    def _words(self, text: str) -> list[str] | bytes:
        if not text:
            return b""
        if self.spaced:
            words = self._spaced_words(text)
            return self._odd_words(text) if words is None else words
        return self.encode_whole(text) if ODD_SPACE.search(text) else text.split()

    def _odd_words(self, text: str) -> list[str] | bytes:
        """What a text with white space of other kinds is cut into; here the library encodes it whole."""
        return self.encode_whole(text)

    def _join(self, plans: list[list]) -> list[bytes]:
        joined = iter(self._gathered([words for plan in plans for words in plan if isinstance(words, list)]))
        parts = ([next(joined) if isinstance(x, list) else x for x in plan] for plan in plans)
        return [x[0] if len(x) == 1 else b"".join(x) for x in parts]

    def _gathered(self, lists: list[list[str]]) -> list[bytes]:
        """The ids of each list's words, one after the other."""
        coded = pa.array(list(chain.from_iterable(lists)), pa.string()).dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # much faster than to_pylist()
        words = pa.array(self._known(distinct), pa.binary()).take(coded.indices)
        _, offsets, blob = words.buffers()
        ends = np.frombuffer(offsets, np.int32)[np.cumsum([0, *map(len, lists)])].tolist()
        blob = memoryview(blob or b"")
        return [blob[i:j].tobytes() for i, j in zip(ends, ends[1:])]

    def _known(self, words: list[str]) -> list[bytes]:
        """The ids of each of some distinct words; new words are learned in bulk."""
        if len(self.cache) > self.cache_words:
            self.cache.clear()
            self.cache.update(self.fixed)
        cache = self.cache
        known = list(map(cache.get, words))
        new = [w for w, ids in zip(words, known) if ids is None]
        if not new:
            return known
        # Between a letter and the marks after it every pattern cuts, so "word," is "word" and ",".
        split = {}
        for w in new:
            base = w.rstrip(TAIL)
            if base != w and base[-1:].isalpha():
                split[w] = (base, w[len(base) :])
        todo = list({p for w in new for p in split.get(w, (w,)) if p not in cache})
        if self.by_letters:
            plain = list(filter(LETTERS.fullmatch, todo))
            cache.update(zip(plain, self._letter_ids(plain)))
            todo = [p for p in todo if p not in cache] if len(plain) < len(todo) else []
        for i in range(0, len(todo), WORDS_PER_CALL):
            part = todo[i : i + WORDS_PER_CALL]
            cache.update(zip(part, self.encode_words(part)))
        cache.update((w, cache[a] + cache[b]) for w, (a, b) in split.items())
        return [cache[w] if ids is None else ids for w, ids in zip(words, known)]

    def _letter_ids(self, words: list[str]) -> list[bytes]:
        """Ids of words of ``LETTERS`` from the library's model; the rules before it only change case and letters."""
        tokenize, width = self.tokenizer.model.tokenize, self.type.itemsize
        lower = (w.lower() for w in words)
        letters = (w if w.isascii() else w.encode().decode("latin-1").translate(BYTE_LETTERS) for w in lower)
        ids: list[int] = []
        ends = [0]
        for w in letters:
            ids += [token.id for token in tokenize(w)]
            ends.append(len(ids) * width)
        blob = np.array(ids, self.type).tobytes()
        return [blob[i:j] for i, j in zip(ends, ends[1:])]

    @staticmethod
    def _spaced_words(text: str) -> list[str] | None:
        """Words with the one space before them, and line ends; None where white space stands otherwise."""
        words: list[str] = []
        for i, line in enumerate(text.split("\n")):
            parts = line.split(" ")
            if parts != line.split():
                return None
            if i:
                words.append("\n")
            words.append(parts[0])
            words += [f" {w}" for w in parts[1:]]
        return words


@lru_cache(maxsize=4)
def word_tokenizer(path: str) -> WordTokenizer:
    """One of narrow ids per file and Python worker, so words learned in one task serve the next."""
    return WordTokenizer(path, narrow=True)
