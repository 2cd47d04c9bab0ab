"""Token ids of many texts by a tokenizer file, each distinct word encoded once.

Neither of the two pre-tokenizers lets a token cross the place between a visible character and the
blank or line break after it, so a text may be cut there, the pieces encoded apart, and the ids joined.
Nor does a token reach from a letter or digit into the ASCII punctuation behind it, so a word is cut from that as well,
behind Latin letters, and capitals are lowered first if the tokenizer lowers them: fewer pieces differ.
The words of a pass are cut, told apart and put together again as stretches of one byte array; only distinct ones
reach Python.  Words repeat, so their ids are kept in a table of bounded size; when it is full it starts anew.
The tokenizer itself is read once a process.
"""

import os
import re

import numpy as np

from .portions import distinct, filled

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Words kept per process; about 200 bytes each.
KEPT_WORDS = 600_000
#: Texts whose missing words are encoded in one call, and bytes of one pass.
TEXTS_AT_ONCE, PASS_BYTES = 400, 1_500_000

_OTHER_SPACE = re.compile(r"[^\S \n]")
_BORDER = re.compile(rb"(?<=[^ \n])[ \n]")
_BLANK = np.zeros(256, bool)
_BLANK[[32, 10]] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_LOADED: dict = {}


def _ends_letter(data: np.ndarray) -> np.ndarray:
    """Whether each byte ends an ASCII letter or digit or a letter from U+00C0 to U+024F."""
    out = _ALNUM[data]
    before = np.concatenate([np.zeros(1, np.uint8), data[:-1]])
    two = (before >= 0xC3) & (before <= 0xC9) & (data >= 0x80) & (data < 0xC0)
    no_letter = (before == 0xC3) & ((data == 0x97) | (data == 0xB7)) | (before == 0xC9) & (data > 0x8F)
    return out | two & ~no_letter


class Encoder:
    """Ids of whole texts under the tokenizer at ``path``; strings of its special tokens are plain text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # a tokenizer that drops white space has no use for it; one that keeps it needs it in the pieces
        self.drops_space = not self.tokenizer.encode(" ", add_special_tokens=False).ids
        # to a tokenizer that lower-cases, a word and its capitalised form are one
        letters = bytes(range(65, 91)).decode()
        self.lowers = self.tokenizer.encode(letters, add_special_tokens=False).ids == self.tokenizer.encode(letters.lower(), add_special_tokens=False).ids
        self.words: dict[bytes, bytes] = {}

    def _encoded(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word; as words of one sequence they cost less than as a sequence each."""
        found = self.tokenizer.encode_batch([[w.decode("utf-8", "surrogatepass") for w in words]], is_pretokenized=True, add_special_tokens=False)[0]
        flat = np.asarray(found.ids, "<u4").tobytes()
        cuts = (4 * np.searchsorted(np.asarray(found.word_ids, np.int64), np.arange(len(words) + 1))).tolist()
        return [flat[lo:hi] for lo, hi in zip(cuts[:-1], cuts[1:])]

    def _cut(self, data: np.ndarray, starts: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(first byte, size)`` of the words of all parts; ``whole`` parts are one word each."""
        blank, after = _BLANK[data], np.concatenate([[False], _BLANK[data[:-1]]])
        new = blank != after if self.drops_space else blank & ~after
        new |= _PUNCT[data] & np.concatenate([[False], _ends_letter(data)[:-1]])
        for i in np.flatnonzero(whole):
            new[starts[i]:starts[i + 1]] = False
        new[starts[:-1][starts[:-1] < len(data)]] = True
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(data)))
        if self.drops_space:
            some = ~blank[first]
            first, size = first[some], size[some]
        return first, size

    def _pass(self, parts: list[bytes], whole: np.ndarray) -> list[np.ndarray]:
        """Ids of each part, none of them empty."""
        joined = b"".join(parts)
        joined = joined.lower() if self.lowers else joined  # of bytes, so A-Z only
        data = np.frombuffer(joined, np.uint8)
        starts = np.cumsum([0, *map(len, parts)])
        first, size = self._cut(data, starts, whole)
        if not len(first):
            return [np.empty(0, "<u4")] * len(parts)
        one, number = distinct(data, first, size)
        names = [joined[lo:hi] for lo, hi in zip(first[one].tolist(), (first[one] + size[one]).tolist())]
        if len(self.words) > KEPT_WORDS:
            self.words = {}
        words = self.words
        new = list({w for w in names if w not in words})
        if new:
            words.update(zip(new, self._encoded(new)))
        ids = [words[w] for w in names]
        for i in np.flatnonzero(whole):
            words.pop(parts[i], None)  # whole texts are not kept
        flat = np.frombuffer(b"".join(ids), "<u4")
        counts = np.array([len(x) // 4 for x in ids], np.int64)
        at = np.cumsum(counts) - counts
        out = flat[filled(at[number], counts[number])]
        ends = np.concatenate([[0], np.cumsum(counts[number])])
        return np.split(out, ends[np.searchsorted(first, starts[1:-1])])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        found: list[list[bytes]] = [[] for _ in texts]
        held, owners, whole, size = [], [], [], 0

        def settle():
            if held:
                for i, ids in zip(owners, self._pass(held, np.array(whole))):
                    found[i].append(ids.tobytes())
                for kept in (held, owners, whole):
                    kept.clear()

        for i, text in enumerate(texts):
            if not text:
                continue
            data = text.encode("utf-8", "surrogatepass")
            # other white space merges with blanks next to it; such texts are encoded whole
            is_whole = not self.drops_space and _OTHER_SPACE.search(text) is not None
            lo = 0
            while lo < len(data):
                end = None if is_whole or len(data) - lo <= PASS_BYTES else _BORDER.search(data, lo + PASS_BYTES)
                hi = end.start() if end else len(data)
                if size + hi - lo > PASS_BYTES:
                    settle()
                    size = 0
                held.append(data[lo:hi])
                owners.append(i)
                whole.append(is_whole)
                size += hi - lo
                lo = hi
        settle()
        return [b"".join(f) for f in found]


def encoder(path: str) -> Encoder:
    """The process's encoder of ``path``."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def encode_documents(path: str, texts: list[str], end_id: int) -> list[np.ndarray]:
    """Ids of each text with ``end_id`` behind them."""
    end = np.asarray([end_id], "<u4").tobytes()
    return [np.frombuffer(x + end, "<u4") for x in encoder(path).encode(texts)]
