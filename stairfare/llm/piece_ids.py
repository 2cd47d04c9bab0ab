"""Ids of whole texts under a SentencePiece BPE model, and the texts of ids, by merge rounds in numpy.

No merge crosses a place between two characters that no piece of the model has side by side, so texts
fall into words there (before a blank, between digits, at most punctuation).  The distinct words of many
texts lie in one flat array of symbols, and a round works on all of them at once: the rank of each pair of
neighbours, the least rank of each word (a segmented minimum), the merges at it from left to right, and
compaction.  Words without a pair left leave the array; the rounds end when it is empty.

One merge at a time is what the library does, best rank first and leftmost among equals.  In a round a word
makes all its merges of the least rank at once only where that is the same: where no pair with the merged
piece ranks before it.  For other ranks only merges further apart than two pieces can reach are made at once.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .portions import distinct, filled, slices
from .records import KEY, TEXT, keyed, restored

#: Characters of text in one pass, about; a text beyond it is cut where no piece can cross.
PASS_CHARS = 1_500_000
_BLANK = "▁"
_NONE = np.int32(2**31 - 1)
_LOADED: dict = {}


class Pieces:
    """A model's pieces as arrays.  Only BPE models with byte fallback whose normaliser leaves characters alone.

    A symbol is a piece's id, or ``n + code point`` for a character that is no piece.
    """

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.n = n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(n)]
        if any(sp.is_unused(i) for i in range(n)) or "".join(sp.encode("ﬁ  A ", out_type=str)) != "▁ﬁ▁▁A▁":
            raise ValueError("only models without unused pieces whose normaliser keeps every character")
        self.byte_ids = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        self.is_byte = np.array([sp.is_byte(i) for i in range(n)])
        self.decoded = [b"" if sp.is_control(i) else " ⁇ ".encode() if sp.is_unknown(i) else bytes([int(p[3:5], 16)]) if sp.is_byte(i)
                        else p.replace(_BLANK, " ").encode() for i, p in enumerate(names)]
        self.starts_blank = np.array([p.startswith(_BLANK) and not special[i] for i, p in enumerate(names)])
        self.silent = np.array([sp.is_control(i) for i in range(n)])
        self.known = {p: i for i, p in enumerate(names) if not special[i]}
        self.reach = max(map(len, self.known))
        self._merges(sp)
        self._characters()
        self._blank_runs()

    def _merges(self, sp):
        """Every pair of symbols that makes a piece, sorted by its key: ``rank`` and the piece it makes."""
        def symbol(s):
            return self.known.get(s, self.n + ord(s) if len(s) == 1 else None)

        scores = {i: sp.get_score(i) for i in self.known.values()}
        order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        found = {}
        for piece, i in self.known.items():
            for k in range(1, len(piece)):
                a, b = symbol(piece[:k]), symbol(piece[k:])
                if a is not None and b is not None:
                    found[self._key(a, b)] = (order[scores[i]], i, a, b)
        keys = sorted(found)
        self.pair_keys = np.array(keys or [-1], np.int64)
        self.pair_rank = np.array([found[k][0] for k in keys] or [_NONE], np.int32)
        self.pair_piece = np.array([found[k][1] for k in keys] or [-1], np.int32)
        rank_of = {i: order[s] for i, s in scores.items()}
        self.alone = np.zeros(len(order) + 1, bool)  # ranks whose merges must not all be made at once
        for rank, _, a, b in found.values():
            for x in (a, b):
                if x in rank_of and rank <= rank_of[x]:
                    self.alone[rank_of[x]] = True

    @staticmethod
    def _key(a, b):
        return (a << 32) | b

    def _characters(self):
        chars = sorted({c for p in self.known for c in p})
        self.symbol_of = np.arange(0x110000, dtype=np.int32) + np.int32(self.n)
        self.class_of = np.zeros(0x110000, np.int32)  # 0: in no piece
        for k, c in enumerate(chars):
            self.class_of[ord(c)] = k + 1
            self.symbol_of[ord(c)] = self.known.get(c, self.n + ord(c))
        self.joint = np.zeros((len(chars) + 1, len(chars) + 1), bool)  # characters side by side in a piece
        for p in self.known:
            for a, b in zip(p, p[1:]):
                self.joint[self.class_of[ord(a)], self.class_of[ord(b)]] = True

    def _blank_runs(self):
        """Pieces of a run of blanks by its length, if they all rank alike and repeat from some length on.

        Such a run is then laid down at once; it would take a round per blank otherwise.
        """
        self.run_rank, self.run_pieces, self.run_period = -1, [], 0
        one = self.known.get(_BLANK)
        runs = {len(p): i for p, i in self.known.items() if set(p) == {_BLANK}}
        ranks = {int(r) for r, piece in zip(self.pair_rank, self.pair_piece) if int(piece) in set(runs.values())}
        mixed = any(_BLANK * 2 in p and set(p) != {_BLANK} for p in self.known)
        if one is None or mixed or len(ranks) != 1 or max(runs) < 2:
            return
        most = max(runs)

        def laid(n):
            parts = [1] * n
            at = 0
            while at < len(parts) - 1:  # leftmost pair first; what it makes may reach back by one
                if parts[at] + parts[at + 1] in runs:
                    parts[at:at + 2] = [parts[at] + parts[at + 1]]
                    at = max(at - 1, 0)
                else:
                    at += 1
            return [runs[p] for p in parts]

        tried = [laid(n) for n in range(4 * most)]
        if all(tried[n] == [runs[most], *tried[n - most]] for n in range(most, 4 * most)):
            self.run_rank, self.run_pieces, self.run_period, self.run_one = ranks.pop(), tried[:most], most, one

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair and the piece it makes; ``_NONE`` if it makes none."""
        key = self._key(left.astype(np.int64), right)
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        hit = self.pair_keys[at] == key
        return np.where(hit, self.pair_rank[at], _NONE), self.pair_piece[at]

    def _laid_runs(self, symbols: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        """Words whose only pairs left are blanks in runs, each run replaced by its pieces."""
        out = []
        for word in np.split(symbols, ends[:-1]):
            blank = np.concatenate([[False], word == self.run_one, [False]])
            edge = np.flatnonzero(blank[1:] != blank[:-1])
            parts, at = [], 0
            for lo, hi in zip(edge[::2].tolist(), edge[1::2].tolist()):
                whole, rest = divmod(hi - lo, self.run_period)
                parts += [word[at:lo], np.full(whole, self.known[_BLANK * self.run_period], np.int32), np.array(self.run_pieces[rest], np.int32)]
                at = hi
            out.append(np.concatenate([*parts, word[at:]]))
        return out

    def _chosen(self, best: np.ndarray, symbols: np.ndarray, word: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Places of the merges to make now, from those of their word's least rank."""
        at = np.flatnonzero(best)
        if not len(at):
            return at
        # neighbours that overlap (a run of one symbol): every second one, from the left
        new = np.concatenate([[True], (at[1:] != at[:-1] + 1)])
        first = np.flatnonzero(new)
        at = at[(np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))) % 2 == 0]
        careful = self.alone[least[word[at]]]
        if careful.any():
            # of each cluster of near ones only the leftmost; places count symbols, which are a character at least
            far = np.concatenate([[True], (word[at[1:]] != word[at[:-1]]) | (at[1:] - at[:-1] > 2 * self.reach)])
            at = at[~careful | far]
        return at

    def merged(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(symbols, sizes)`` of words after all merges; ``sizes`` are symbols of each word, 1 at least."""
        n = len(sizes)
        done_words, done_sizes, done_symbols = [], [], []
        word = np.repeat(np.arange(n), sizes)
        number = np.arange(n)  # the word's own number, as words leave
        rank = np.full(len(symbols), _NONE, np.int32)
        piece = np.zeros(len(symbols), np.int32)
        inner = np.flatnonzero(word[1:] == word[:-1])
        rank[inner], piece[inner] = self._ranks(symbols[inner], symbols[inner + 1])
        while len(number):
            ends = np.cumsum(sizes)
            least = np.minimum.reduceat(rank, ends - sizes)
            over = least == _NONE
            runs = least == self.run_rank if self.run_rank >= 0 else np.zeros(len(least), bool)
            if runs.any():
                laid = self._laid_runs(symbols[runs[word]], np.cumsum(sizes[runs]))
                done_words.append(number[runs])
                done_sizes.append(np.array([len(x) for x in laid], np.int64))
                done_symbols += laid
                over = over | runs
            if over.any():
                plain = over & ~runs
                if plain.any():
                    done_words.append(number[plain])
                    done_sizes.append(sizes[plain])
                    done_symbols.append(symbols[plain[word]])
                stay = ~over
                on = stay[word]
                symbols, rank, piece, word = symbols[on], rank[on], piece[on], (np.cumsum(stay) - 1)[word[on]]
                number, sizes, least = number[stay], sizes[stay], least[stay]
                if not len(number):
                    break
            at = self._chosen(rank == least[word], symbols, word, least)
            symbols[at] = piece[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            sizes = sizes - np.bincount(word[at], minlength=len(sizes))
            moved = (np.cumsum(keep) - 1)[at]
            symbols, rank, piece, word = symbols[keep], rank[keep], piece[keep], word[keep]
            changed = np.zeros(len(symbols), bool)
            changed[moved] = True
            changed[moved[moved > 0] - 1] = True
            touched = np.flatnonzero(changed)
            last = touched == len(word) - 1
            same = ~last
            same[same] = word[touched[same]] == word[touched[same] + 1]
            rank[touched] = _NONE
            inside = touched[same]
            rank[inside], piece[inside] = self._ranks(symbols[inside], symbols[inside + 1])
        if not done_words:
            return symbols, sizes
        numbers, counts, flat = np.concatenate(done_words), np.concatenate(done_sizes), np.concatenate(done_symbols)
        order = np.empty(n, np.int64)
        order[numbers] = np.arange(n)
        starts = (np.cumsum(counts) - counts)[order]
        return flat[filled(starts, counts[order])], counts[order]

    def _byte_fallback(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters that are no piece as the ids of their UTF-8 bytes."""
        strange = np.flatnonzero(symbols >= self.n)
        if not len(strange):
            return symbols, sizes
        coded = [np.frombuffer(chr(c).encode("utf-8", "surrogatepass"), np.uint8) for c in (symbols[strange] - self.n).tolist()]
        wide = np.ones(len(symbols), np.int64)
        wide[strange] = [len(b) for b in coded]
        out = np.repeat(symbols, wide)
        out[filled((np.cumsum(wide) - wide)[strange], wide[strange])] = self.byte_ids[np.concatenate(coded)]
        return out, np.add.reduceat(wide, np.cumsum(sizes) - sizes)

    def cut(self, text: str, size: int = PASS_CHARS):
        """``text`` (blanks already marked) in stretches of about ``size`` characters that no piece crosses."""
        lo = 0
        while len(text) - lo > size:
            hi = lo + size
            while hi < len(text) and self.joint[self.class_of[ord(text[hi - 1])], self.class_of[ord(text[hi])]]:
                hi += 1
            yield text[lo:hi]
            lo = hi
        yield text[lo:]

    def _encode_pass(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, which are not empty and have their blanks marked."""
        chars = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = np.cumsum([0, *map(len, texts)])
        kind = self.class_of[chars]
        new = np.ones(len(chars), bool)
        new[1:] = ~self.joint[kind[:-1], kind[1:]]
        new[starts[:-1]] = True
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(chars)))
        symbols = self.symbol_of[chars]
        representative, number = distinct(symbols, first, size)
        own = first[representative]
        ids, counts = self._byte_fallback(*self.merged(symbols[filled(own, size[representative])], size[representative]))
        at = np.cumsum(counts) - counts
        flat = ids[filled(at[number], counts[number])]
        ends = np.cumsum(counts[number])
        return np.split(flat, ends[np.searchsorted(first, starts[1:-1]) - 1])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, without begin or end ids; an empty text has none."""
        found: list[list[np.ndarray]] = [[] for _ in texts]
        held, owners, size = [], [], 0

        def settle():
            if held:
                for i, ids in zip(owners, self._encode_pass(held)):
                    found[i].append(ids)
                held.clear()
                owners.clear()

        for i, text in enumerate(texts):
            if not text:
                continue
            for part in self.cut(_BLANK + text.replace(" ", _BLANK)):
                if size + len(part) > PASS_CHARS:
                    settle()
                    size = 0
                held.append(part)
                owners.append(i)
                size += len(part)
        settle()
        return [np.concatenate(f) if len(f) > 1 else f[0] if f else np.empty(0, np.int32) for f in found]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids.  Byte ids that are no UTF-8 give U+FFFD each; the blank put before a text is taken off."""
        table = self.decoded
        lead = np.flatnonzero(~self.silent[ids[:64]]) if len(ids) else ids
        if not len(lead) and len(ids) > 64:
            lead = np.flatnonzero(~self.silent[ids])
        strip = len(lead) and bool(self.starts_blank[ids[lead[0]]])
        raw = b"".join(map(table.__getitem__, ids.tolist()))[1 if strip else 0:]
        try:
            return raw.decode("utf-8")
        except UnicodeDecodeError:
            return self._decode_broken(ids)[1 if strip else 0:]

    def _decode_broken(self, ids: np.ndarray) -> str:
        """As ``decode`` where a run of byte ids is no UTF-8: each byte that starts no character is one U+FFFD."""
        out, at = [], 0
        edge = np.flatnonzero(np.diff(self.is_byte[ids].astype(np.int8))) + 1
        for lo, hi in zip([0, *edge.tolist()], [*edge.tolist(), len(ids)]):
            raw = b"".join(self.decoded[i] for i in ids[lo:hi].tolist())
            if not self.is_byte[ids[lo]]:
                out.append(raw.decode("utf-8"))
                continue
            at = 0
            while at < len(raw):
                wide = 1 if raw[at] < 0xC0 else 2 if raw[at] < 0xE0 else 3 if raw[at] < 0xF0 else 4
                try:
                    out.append(raw[at:at + wide].decode("utf-8"))
                    at += wide
                except UnicodeDecodeError:
                    out.append("�")
                    at += 1
        return "".join(out)


def pieces(path: str) -> Pieces:
    """The process's arrays of the model at ``path``."""
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def encode(packages: DataFrame, model: str, key: str = KEY, text: str = TEXT) -> DataFrame:
    """One row per package: ``package_key, ids, decoded``.

    ``ids`` are those that the SentencePiece library gives the whole description under the model file, without
    begin and end ids, ``decoded`` is its text of them.  Null or empty text: no ids and an empty text.  Null
    keys stay, repeated rows each keep their row, an empty table gives an empty one, other columns are not
    read.  A task holds about ``PASS_CHARS`` characters' arrays at once, however long a text.
    """
    def run(batches):
        known = pieces(model)
        for batch in batches:
            for lo, hi in slices(batch, "__text", PASS_CHARS):
                part = batch.slice(lo, hi - lo)
                ids = known.encode(part.column("__text").to_pylist())
                decoded = [known.decode(x) for x in ids]
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("__key"), pa.ListArray.from_arrays(ends, np.concatenate(ids).astype(np.int32)), pa.array(decoded, pa.string())],
                    names=[key, "ids", "decoded"])

    found = keyed(packages, key, text, for_python=True).mapInArrow(run, f"`{key}` string, ids array<int>, decoded string")
    return restored(found, key, packages)
