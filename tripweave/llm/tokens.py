"""Token ids of whole texts by a word-level BPE file, exact and without the same word twice."""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np
from tokenizers import Tokenizer

from .common import groups_of, word_hashes

#: Pieces of more bytes are left to the tokenizer library; the rounds below are one merge each.
LONG = 64
#: Bytes that are merged at once: a place among them fits into the low bits of a rank (``_PLACE``).
_PLACE = 22
_AT_ONCE = 1 << (_PLACE - 2)


#: Texts of letters beyond Latin-1 are cut into words first, and only their odd words are sent to
#: the library; the special tokens' strings are sent there too.
_CLASS = np.array(
    [{"L": 1, "N": 2}.get(unicodedata.category(chr(c))[0], 3) for c in range(256)], dtype=np.int8
)
_CLASS[[*range(0x09, 0x0E), 0x20, 0x85, 0xA0]] = 0
_SUFFIXES = ((b"s", 1), (b"t", 1), (b"m", 1), (b"d", 1), (b"re", 2), (b"ve", 2), (b"ll", 2))


def _latin(text: str) -> bytes | None:
    if "<|" in text:
        return None
    try:
        return text.lower().encode("latin-1")
    except UnicodeEncodeError:
        return None


def _pieces(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of letters, single digits, runs of signs, and English contractions."""
    kind = _CLASS[data]
    begin = np.ones(len(data) + 1, dtype=bool)
    begin[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    signs = np.flatnonzero((data[:-2] == ord("'")) & begin[:-3])
    for suffix, size in _SUFFIXES:
        ok = signs[signs + size < len(data)]
        for k in range(size):
            ok = ok[data[ok + 1 + k] == suffix[k]]
        begin[ok + 1] = False
        begin[ok + 1 + size] = True
    at = np.flatnonzero(begin)
    word = kind[at[:-1]] != 0
    return at[:-1][word], at[1:][word]


def _distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of an example of each different span, and for every span the number of its own.

    Spans are grouped by hash and then held to their example's bytes.
    """
    _, example, which = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
    size, model = ends - starts, example[which]
    same = np.array_equal(size, size[model])
    if same:
        end = np.cumsum(size)
        within = np.arange(end[-1] if len(end) else 0) - np.repeat(end - size, size)
        same = np.array_equal(
            data[np.repeat(starts, size) + within], data[np.repeat(starts[model], size) + within]
        )
    if not same:  # two spans of one hash
        spans = [data[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        number: dict[bytes, int] = {}
        which = np.array([number.setdefault(s, len(number)) for s in spans])
        example = np.unique(which, return_index=True)[1]
    return example, which


_NONE = np.int64(1) << 40


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones themselves."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in printable}
    rest = [b for b in range(256) if b not in letters]
    return letters | {b: chr(256 + k) for k, b in enumerate(rest)}


class WordTokens:
    """Ids of whole texts, equal to the library's.

    Texts are cut into pieces as the file's pre-tokenizer does.  Pieces are remembered, at most
    about ``remembered`` of them; the BPE merges of new ones are done for many pieces at once.
    """

    def __init__(self, path: str, remembered: int = 400_000):
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        letters = _byte_letters()
        self.inner = np.array([vocab[letters[b]] for b in range(256)], dtype=np.int64)
        self.last = np.array([vocab[letters[b] + end] for b in range(256)], dtype=np.int64)
        self.size = np.int64(max(vocab.values()) + 1)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        key = np.array([vocab[a] * int(self.size) + vocab[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks = key[order], order.astype(np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        self.remembered = remembered
        self.pieces: dict[bytes, bytes] = {}

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of non-empty pieces: in each round every piece makes its lowest, leftmost merge."""
        out: list[bytes] = [b""] * len(pieces)
        if not pieces:
            return out
        sizes = np.array([len(p) for p in pieces])
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        ids = self.inner[data]
        ends = starts + sizes - 1
        ids[ends] = self.last[data[ends]]
        rank = np.full(len(ids), _NONE)
        rank[:-1] = self._rank(ids[:-1], ids[1:])
        rank[ends] = _NONE
        if len(ids) >= 1 << _PLACE:
            raise ValueError("too many bytes at once")
        who = np.arange(len(pieces))
        while len(who):
            least = np.minimum.reduceat((rank << _PLACE) | np.arange(len(rank)), starts)
            at, found = least & ((1 << _PLACE) - 1), least >> _PLACE
            done = found >= _NONE
            if done.any():
                raw = ids.astype("<u4").tobytes()
                first = 4 * starts[done]
                for k, a, b in zip(who[done].tolist(), first.tolist(),
                                   (first + 4 * sizes[done]).tolist(), strict=True):
                    out[k] = raw[a:b]
                keep = np.repeat(~done, sizes)
                moved = np.cumsum(keep) - 1
                ids, rank, at = ids[keep], rank[keep], moved[at[~done]]
                who, sizes, found = who[~done], sizes[~done], found[~done]
                if not len(who):
                    break
            ids[at] = self.made[found]
            keep = np.ones(len(ids), dtype=bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))  # one symbol of each earlier piece has gone
            ids, rank = ids[keep], rank[keep]
            sizes = sizes - 1
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            ends = starts + sizes - 1
            rank[at] = _NONE
            inside = at < ends
            rank[at[inside]] = self._rank(ids[at[inside]], ids[at[inside] + 1])
            inside = at > starts
            rank[at[inside] - 1] = self._rank(ids[at[inside] - 1], ids[at[inside]])
        return out

    def _library(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def _learn(self, new: list[bytes]) -> None:
        short = [p for p in new if len(p) <= LONG]
        encoded = [p if p.isascii() else p.decode("latin-1").encode() for p in short]
        for first, last in groups_of(encoded, _AT_ONCE):
            merged = self.merge(encoded[first:last])
            self.pieces.update(zip(short[first:last], merged, strict=True))
        long = (p for p in new if len(p) > LONG)
        self.pieces.update({p: self._library(p.decode("latin-1")) for p in long})

    def _odd(self, text: str) -> bytes:
        words = re.findall(r"[^\x09-\x0d\x20]+", text)
        latin = [_latin(w) for w in words]
        known = iter(self._latin_ids([x for x in latin if x is not None]))
        return b"".join([
            self._library(w) if x is None else next(known)
            for w, x in zip(words, latin, strict=True)
        ])

    def _latin_ids(self, texts: list[bytes]) -> list[bytes]:
        out = []
        for first, last in groups_of(texts):
            group = texts[first:last]
            raw = b" ".join(group) + b"   "
            starts, ends = _pieces(np.frombuffer(raw, dtype=np.uint8))
            if len(self.pieces) > self.remembered:
                self.pieces.clear()
            example, which = _distinct(np.frombuffer(raw, dtype=np.uint8), starts, ends)
            spans = zip(starts[example].tolist(), ends[example].tolist(), strict=True)
            distinct = [raw[a:b] for a, b in spans]
            self._learn([p for p in distinct if p not in self.pieces])
            found = [self.pieces[p] for p in distinct]
            pool = np.frombuffer(b"".join(found), dtype="<u4")
            sizes = np.array([len(x) // 4 for x in found], dtype=np.int64)
            origin = (np.cumsum(sizes) - sizes)[which] if len(which) else sizes
            size = sizes[which] if len(which) else sizes
            end = np.cumsum(size)
            ids = pool[np.arange(end[-1] if len(end) else 0) + np.repeat(origin - end + size, size)]
            place = np.cumsum([0] + [len(t) + 1 for t in group])
            cuts = np.concatenate(([0], end))[np.searchsorted(starts, place)]
            out.extend(ids[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True))
        return out

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        latin = [_latin(t) for t in texts]
        known = iter(self._latin_ids([x for x in latin if x is not None]))
        return [
            self._odd(t) if x is None else next(known)
            for t, x in zip(texts, latin, strict=True)
        ]
