"""Texts cut into parts that the library encodes alike alone and in place, and a cache of these.

The library's merges never cross a pre-token. Pre-tokens end at white space, and
where letters, digits and other signs meet, but for an apostrophe before a
letter. Of ASCII and Latin characters these kinds are known by their bytes, so
parts are found without a Python object each; neighbours of which one is neither
stay together, whatever script they are in. Only distinct parts are looked up,
and those that are not held encoded: by the vocabulary's merges alone if they
are known to be single pre-tokens, else by the library.

Texts with a special token written out are encoded by the library as they are,
and so are, where white space is kept, those in which other white space follows
white space.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from storesales.llm.spans import byte_class, bytes_of, strings_of

LAST_PLAIN = 0x17F


def _plain(*kinds: str) -> str:
    """The plain characters of these general categories, as the inside of a character class."""
    chars = (chr(c) for c in range(0x21, LAST_PLAIN + 1))
    return "".join(re.escape(c) for c in chars if unicodedata.category(c)[0] in kinds and len(c.lower()) == 1)


LETTER = _plain("L")
_SIGN = re.escape("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")

#: Single pre-tokens, if they are parts: of plain letters, of digits, of ASCII signs.
WORD = re.compile(rf"[{LETTER}]+|[0-9]|[{_SIGN}]+").fullmatch
SPACED_WORD = re.compile(rf" ?(?:[{LETTER}]+|[0-9]+|[{_SIGN}]+)|[\t\n\r ]+").fullmatch

# Kinds of bytes.
SPACES, LETTERS, DIGITS, SIGNS, UNKNOWN = range(5)
KINDS = np.full(256, UNKNOWN, np.uint8)
KINDS[byte_class(0x20, range(0x09, 0x0E))] = SPACES
KINDS[byte_class(range(0x41, 0x5B), range(0x61, 0x7B))] = LETTERS
KINDS[byte_class(range(0x30, 0x3A))] = DIGITS
KINDS[byte_class(range(0x21, 0x30), range(0x3A, 0x41), range(0x5B, 0x61), range(0x7B, 0x7F))] = SIGNS

#: White space above 127.
OTHER_SPACE = "\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

_tokenizers: dict[str, object] = {}


def _kinds(data: np.ndarray) -> np.ndarray:
    """The kind of character that each byte is part of."""
    kinds = KINDS[data]
    # U+00C0 to U+017F are letters but for two signs; U+0130 is left out because its lower case has a mark of its own.
    at = np.flatnonzero((data >= 0xC3) & (data <= 0xC5))
    signs = (data[at] == 0xC3) & ((data[at + 1] == 0x97) | (data[at + 1] == 0xB7))
    letters = at[~signs & ~((data[at] == 0xC4) & (data[at + 1] == 0xB0))]
    kinds[letters] = kinds[letters + 1] = LETTERS
    return kinds


def parts_of(texts: pa.Array, keep_space: bool) -> tuple[pa.Array, np.ndarray]:
    """The parts of all texts (without NULL), and how many each text has.

    Without ``keep_space``, white space falls away and each digit is a part. With it, one blank goes with what is behind
    it. Of more white space before something else, all but the last one is a part, and the last one, too, if it is no
    blank; at the end of a text all of it is one part.
    """
    data, offsets = bytes_of(texts)
    if not len(data):
        return pa.array([], pa.large_string()), np.zeros(len(texts), np.int64)
    kinds = _kinds(data)
    space = kinds == SPACES
    first = np.zeros(len(data), bool)
    first[offsets[:-1][offsets[:-1] < len(data)]] = True
    cuts = first.copy()
    known = (kinds == LETTERS) | (kinds == DIGITS) | (kinds == SIGNS)
    meet = known[1:] & known[:-1] & (kinds[1:] != kinds[:-1])
    cuts[1:] |= meet & ~((data[:-1] == ord("'")) & (kinds[1:] == LETTERS))
    if keep_space:
        cuts[1:] |= space[1:] & ~space[:-1]  # white space begins
        last = space.copy()
        last[:-1] &= ~space[1:] & ~first[1:]
        last[-1] = False
        cuts |= last  # the last one before something else
        cuts[1:] |= ~space[1:] & space[:-1] & (data[:-1] != 0x20)  # something behind another one than a blank
        places = np.flatnonzero(cuts)
        return strings_of(data, np.append(places, len(data))), np.diff(np.searchsorted(places, offsets))
    digits = kinds == DIGITS
    cuts[1:] |= digits[1:] & digits[:-1]
    cuts[1:] |= space[:-1]
    cuts &= ~space
    kept = data[~space]
    strings = strings_of(kept, np.append(np.flatnonzero(cuts[~space]), len(kept)))
    return strings, np.diff(np.searchsorted(np.flatnonzero(cuts), offsets))


def unusual(texts: pa.Array, special: tuple[str, ...], mixed_space: bool) -> np.ndarray:
    """Which texts the library has to encode whole."""
    found = np.zeros(len(texts), bool)
    for word in special:
        found |= pc.match_substring(texts, word).to_numpy(zero_copy_only=False)
    if mixed_space:
        pattern = rf"[\t-\r {OTHER_SPACE}][{OTHER_SPACE}]"
        found |= pc.match_substring_regex(texts, pattern).to_numpy(zero_copy_only=False)
    return found




def tokenizer(path: str):
    """The library's tokenizer for a vocabulary file; one per worker, single-threaded."""
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _tokenizers[path] = Tokenizer.from_file(path)
    return _tokenizers[path]


# Printable bytes stand for themselves in a byte-level vocabulary, the others for the characters from 256 on.
_SHOWN = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 256 and b != 173]
_HIDDEN = [b for b in range(256) if b not in _SHOWN]
BYTE_OF = {**{chr(b): b for b in _SHOWN}, **{chr(256 + i): b for i, b in enumerate(_HIDDEN)}}
_SPELLED = {b: c for c, b in BYTE_OF.items()}

Encoder = Callable[[list[str]], list[list[int]]]


def encode_all(path: str) -> Encoder:
    """Ids of each part, by the library."""
    return lambda words: [e.ids for e in tokenizer(path).encode_batch_fast(words, add_special_tokens=False)]


def _by_kind(single: Callable, merge: Callable[[str], list[int]], others: Encoder) -> Encoder:
    def encode(words: list[str]) -> list[list[int]]:
        plain = list(map(single, words))
        rest = [w for w, p in zip(words, plain, strict=True) if not p]
        found = iter(others(rest) if rest else ())
        return [merge(w) if p else next(found) for w, p in zip(words, plain, strict=True)]

    return encode


def merge_words(path: str) -> Encoder:
    """The same for a vocabulary of words in lower case, at less cost for plain pre-tokens: without normaliser and rules."""
    model = tokenizer(path).model

    def merge(word: str) -> list[int]:
        spelled = word.lower().encode().decode("latin-1").translate(_SPELLED)
        return [token.id for token in model.tokenize(spelled)]

    return _by_kind(WORD, merge, encode_all(path))


def merge_bytes(path: str) -> Encoder:
    """The same for a byte-level vocabulary whose ids are in the order of its merges, at less cost for plain pre-tokens."""
    import tiktoken

    with open(path) as file:
        description = json.load(file)
    added = {token["content"] for token in description["added_tokens"]}
    ranks = {bytes(BYTE_OF[c] for c in w): i for w, i in description["model"]["vocab"].items() if w not in added}
    merges = tiktoken.Encoding("merges", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
    return _by_kind(SPACED_WORD, merges.encode_ordinary, encode_all(path))


class PretokenCache(dict):
    """Part -> what ``make`` makes of the ids that ``encode`` gives; at most ``limit`` beside those given at the start.

    A full cache starts anew from those, which bounds its memory and changes no result. Parts of more than ``LONGEST``
    characters are encoded each time and not kept.
    """

    LONGEST = 256

    def __init__(self, encode: Callable, make: Callable, first: dict | None = None, limit: int = 400_000):
        super().__init__(first or {})
        self.encode, self.make, self.first, self.limit = encode, make, dict(first or {}), limit

    def values_of(self, words: list[str]) -> list:
        """What is held of these distinct words, or found and kept."""
        missing = [w for w in words if w not in self]
        found = dict(zip(missing, map(self.make, self.encode(missing)), strict=True)) if missing else {}
        values = [found[w] if w in found else self[w] for w in words]
        kept = {w: v for w, v in found.items() if len(w) <= self.LONGEST}
        if len(self) + len(kept) > self.limit + len(self.first):
            self.clear()
            self.update(self.first)
        if len(kept) <= self.limit:
            self.update(kept)
        return values
