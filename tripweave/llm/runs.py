"""Periodic runs of words, found online by catchers over power-of-two blocks."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _ODD, groups_of, mix, text_bytes

#: What a run needs to be reported: words, and length as a multiple of its period.
LEAST_WORDS = 6
LEAST_EXPONENT = 4

_SEED = 0x6A09E667F3BCC909
_NONE = np.zeros(0, dtype=np.int64)


class SquareCatcher:
    """Squares of a growing sequence of word numbers, and the runs they merge into.

    The catchers of level k are the completed blocks of B = 2**k words.  A word that is appended
    closes, at each level, a suffix of B words; it is compared with the catchers 2B - 1 to
    4B - 2 words before it.  A square of a period in that range has a whole block in its first
    half, so this word, or one before it in the square, makes that block's catcher fire.  What a
    catcher finds is followed to both sides as far as words one period apart are equal; a stretch
    that still grows is kept open and followed further when words are appended.  Catches inside a
    known run whose period divides theirs say nothing new.

    Windows are compared by 64-bit hashes, built from those of their halves; ``runs_of`` holds what
    it reports to the words themselves.  Memory: 8 bytes a word and level.
    """

    def __init__(self, salt: int = 0) -> None:
        self.salt = salt
        self.words = _NONE
        self.levels: list[np.ndarray] = []
        self.open = (_NONE, _NONE, _NONE)  # start and end of the equal stretch, period
        self.closed = [(_NONE, _NONE, _NONE)]

    def _grow(self, new: np.ndarray) -> list[int]:
        """Append words and the hashes of the windows they complete; first new window per level."""
        self.words = np.concatenate((self.words, new))
        firsts, k = [], 0
        while k == 0 or 4 * (1 << k) - 2 <= len(self.words):
            if k == len(self.levels):
                self.levels.append(np.zeros(0, dtype=np.uint64))
            known = self.levels[k]
            firsts.append(len(known))
            salt = np.uint64(_SEED * (2 * (k + 64 * self.salt) + 1) % 2**64)
            if k == 0:
                fresh = mix(self.words[len(known):].astype(np.uint64) * _ODD + salt)
            else:
                half = self.levels[k - 1][len(known):]
                wide = 1 << (k - 1)
                fresh = mix(half[:len(half) - wide] * _ODD + (half[wide:] ^ salt))
            self.levels[k] = np.concatenate((known, fresh))
            k += 1
        return firsts

    def _follow(self, at: np.ndarray, period: np.ndarray, forward: bool) -> np.ndarray:
        """How far words from ``at`` on (or before it) equal those one period later."""
        at = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            level, wide = self.levels[k], 1 << k
            left = np.arange(len(at))
            while len(left):
                here = at[left] if forward else at[left] - wide
                there = here + period[left]
                inside = (here >= 0) & (there < len(level))
                left, here, there = left[inside], here[inside], there[inside]
                left = left[level[here] == level[there]]
                at[left] += wide if forward else -wide
        return at

    def _known(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """For each block of level k the period (0: none) and end of the run of short period it is in."""
        wide = 1 << k
        blocks = len(self.words) // wide
        period, last = np.zeros(blocks, dtype=np.int64), np.zeros(blocks, dtype=np.int64)
        start, end, q = self.open
        whole = end - start >= q
        parts = [*self.closed, (start[whole], end[whole] + q[whole], q[whole])]
        self.closed = [tuple(np.concatenate(x) for x in zip(*self.closed, strict=True))]
        start, end, q = (np.concatenate(x) for x in zip(*parts, strict=True))
        some = (2 * q <= wide) & (end - start >= wide)
        start, end, q = start[some], end[some], q[some]
        order = np.argsort(-q, kind="stable")  # of a run and its multiples the run counts
        start, end, q = start[order], end[order], q[order]
        first = -(-start // wide)
        number = np.maximum(end // wide - first, 0)
        place = np.repeat(first - np.cumsum(number) + number, number) + np.arange(number.sum())
        period[place], last[place] = np.repeat(q, number), np.repeat(end, number)
        return period, last

    def append(self, new: np.ndarray) -> None:
        """Words, numbered so that equal words have equal numbers."""
        firsts = self._grow(np.asarray(new, dtype=np.int64))
        start, end, period = self.open
        self._keep(start, self._follow(end, period, True), period)
        for k, first in enumerate(firsts):
            self._catch(k, first)

    def _catch(self, k: int, first: int) -> None:
        level, wide = self.levels[k], 1 << k
        suffix = np.arange(first, len(level))
        near = (suffix - (2 * wide - 1)) // wide
        found_block, found_period = [], []
        for block in (near, near - 1):
            some = block >= 0
            here, catcher = suffix[some], block[some] * wide
            hit = level[here] == level[catcher]
            found_block.append(catcher[hit])
            found_period.append(here[hit] - catcher[hit])
        at, period = np.concatenate(found_block), np.concatenate(found_period)
        if not len(at):
            return
        known, last = self._known(k)
        q = known[at // wide]
        told = (q > 0) & (period % np.maximum(q, 1) == 0) & (at + period + wide <= last[at // wide])
        at, period = at[~told], period[~told]
        order = np.lexsort((at, period))
        at, period = at[order], period[order]
        lead = np.ones(len(at), dtype=bool)  # of neighbouring blocks that fire at one period
        lead[1:] = (period[1:] != period[:-1]) | (at[1:] != at[:-1] + wide)
        tail = np.append(lead[1:], True)[:len(at)]
        period = period[lead]
        start = self._follow(at[lead], period, False)
        end = self._follow(at[tail] + wide, period, True)
        fresh = ~np.isin(_pairs(start, period), _pairs(self.open[0], self.open[2]))
        self._keep(start[fresh], end[fresh], period[fresh], self.open)

    def _keep(self, start, end, period, more=(_NONE, _NONE, _NONE)) -> None:
        """Sort stretches into open ones, and runs of those that ended and hold a square."""
        grows = end + period == len(self.words)
        done = ~grows & (end - start >= period)
        if done.any():
            self.closed.append((start[done], end[done] + period[done], period[done]))
        self.open = tuple(
            np.concatenate((a, b[grows])) for a, b in zip(more, (start, end, period), strict=True)
        )

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and least period of all runs so far that hold a square, by start and period."""
        start, end, period = self.open
        whole = end - start >= period
        parts = [*self.closed, (start[whole], end[whole] + period[whole], period[whole])]
        start, end, period = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((period, end, start))
        start, end, period = start[order], end[order], period[order]
        first = np.ones(len(start), dtype=bool)  # of a run and its multiples the run counts
        first[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
        return start[first], end[first], period[first]


def _pairs(start: np.ndarray, period: np.ndarray) -> np.ndarray:
    return start << 31 | period


def runs_of(
    words: np.ndarray, least_words: int = LEAST_WORDS, least_exponent: int = LEAST_EXPONENT
) -> list[tuple[int, int, int]]:
    """Start, length and period of all runs that are long enough, by start and period."""
    for salt in count():
        catcher = SquareCatcher(salt)
        catcher.append(words)
        start, end, period = catcher.runs()
        length = end - start
        some = length >= np.maximum(least_words, least_exponent * period)
        found = list(
            zip(start[some].tolist(), length[some].tolist(), period[some].tolist(), strict=True)
        )
        if all(np.array_equal(words[s:s + n - q], words[s + q:s + n]) for s, n, q in found):
            return found  # else two different windows had one hash: try others
    raise AssertionError


def _of_texts(texts: list[bytes], rule: tuple[int, int]):
    """Number of words, runs and what is left of each text."""
    split = [t.split() for t in texts]
    number: dict[bytes, int] = {}
    taken = count()
    every = []
    for words in split:
        every.extend([number[w] if w in number else number.setdefault(w, next(taken)) for w in words])
        every.append(-1)
    ids = np.array(every, dtype=np.int64)
    ends = np.flatnonzero(ids < 0)
    ids[ends] = len(number) + np.arange(len(ends))  # no run crosses the end of a text
    found = runs_of(ids, *rule)
    gone = np.zeros(len(ids) + 1, dtype=np.int64)
    for s, n, q in found:
        gone[s + q] += 1
        gone[s + n] -= 1
    gone = np.cumsum(gone) > 0
    runs: list[list[dict]] = [[] for _ in texts]
    starts = np.concatenate(([0], ends + 1))
    for (s, n, q), k in zip(
        found, np.searchsorted(ends, [s for s, _, _ in found]).tolist(), strict=True
    ):
        runs[k].append({"start": s - int(starts[k]), "length": n, "period": q})
    for k, words in enumerate(split):
        if runs[k]:
            cut = gone[starts[k]:ends[k]].tolist()
            words = [w for w, g in zip(words, cut, strict=True) if not g]
        yield len(split[k]), runs[k], b" ".join(words)


def _runs(rule: tuple[int, int], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column(1))
            for first, last in groups_of(texts):
                numbers, runs, left = zip(*_of_texts(texts[first:last], rule), strict=True)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, last - first),
                    pa.array(numbers, pa.int64()),
                    pa.array(runs, schema.types[2]),
                    pa.array(left, pa.binary()).cast(pa.string()),
                ], schema=schema)

    return run


def find_runs(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
    least_words: int = LEAST_WORDS, least_exponent: int = LEAST_EXPONENT,
) -> DataFrame:
    """One row per document: id, n_words, runs (start, length, period), collapsed.

    Words are runs of other bytes than ASCII white space, numbered from 0; null counts as empty.
    A run is a stretch of words with least period q (words q apart are equal) that no word next to
    it extends, of at least ``least_words`` words and ``least_exponent`` (2 or more) periods.  Runs
    come by start, then period.  ``collapsed`` is the text without the words that a run repeats (all of
    it but its first q words), joined by one space.  Rows that repeat an id, or have none, are
    documents of their own.  Other columns are not read.

    Each text is judged by itself, so there is no shuffle, and no group of texts can be hot.  Texts
    are taken in groups of about 2 MB, a longer one by itself: a task holds its words' hashes, 8 bytes
    a word and level (14 levels for 20,000 words, 24 for 16 million).
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    if least_exponent < 2:
        raise ValueError("a run needs an exponent of 2 at least")
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = docs.sparkSession.createDataFrame(
        [], f"id {kind}, n_words bigint, "
            f"runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    ).schema
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_runs((least_words, least_exponent), to_arrow_schema(schema)), schema)
