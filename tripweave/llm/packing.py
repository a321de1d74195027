"""Sum-of-squares packing of token sequences into windows of a fixed length."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tokens import WordTokens

WINDOW = 4096
END = 2
#: Sequences of a task are numbered from its partition number times this.
PER_TASK = 1 << 36

Piece = tuple[int, int, bytes]  # index of its document, first token there, ids


class Levels:
    """The open windows of one task, by fill level; ``count`` is the level array.

    A piece goes to the level (or to a new window) that makes the sum of the squared counts over
    all levels of partly filled windows smallest; the fullest such level wins a tie.
    """

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.count = np.zeros(window + 1, dtype=np.int64)
        self.open: dict[int, list[list[Piece]]] = defaultdict(list)

    def level_for(self, size: int) -> int:
        now = self.count[:self.window - size + 1]
        then = self.count[size:].copy()
        then[-1] = 0  # full windows are not counted
        growth = 2 * (then - now) + 2
        growth[[0, -1]] -= 1  # a new window, and a full one, change one level only
        growth[1:][now[1:] == 0] = np.iinfo(np.int64).max
        return len(growth) - 1 - int(np.argmin(growth[::-1]))

    def place(self, piece: Piece) -> list[Piece] | None:
        """Put a piece shorter than a window; the window if that fills it."""
        size = len(piece[2]) // 4
        level = self.level_for(size)
        if level:
            held = self.open[level].pop()
            self.count[level] -= 1
        else:
            held = []
        held.append(piece)
        level += size
        if level == self.window:
            return held
        self.open[level].append(held)
        self.count[level] += 1
        return None

    def close(self) -> Iterator[list[Piece]]:
        """The windows left open: they are poured together, cut where needed.

        What cannot fill a window is cut into sequences of a power of two, which need no padding.
        """
        left = [w for level in sorted(self.open, reverse=True) for w in self.open[level]]
        spare = [p for w in left for p in w]  # the fullest first: most pieces stay whole
        fill: list[list[Piece]] = [[]]
        total = sum(len(p[2]) // 4 for p in spare)
        sizes = [self.window] * (total // self.window)
        rest = total % self.window
        sizes += [1 << b for b in range(self.window.bit_length(), -1, -1) if rest >> b & 1]
        wanted = iter(sizes)
        room = next(wanted, 0)
        for doc, start, ids in spare:
            while ids:
                part, ids = ids[:4 * room], ids[4 * room:]
                fill[-1].append((doc, start, part))
                start += len(part) // 4
                room -= len(part) // 4
                if not room:
                    fill.append([])
                    room = next(wanted, 0)
        yield from (w for w in fill if w)


def _packed(path: str, window: int, end: int, schema: pa.Schema):
    tail = np.array([end], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, levels = WordTokens(path), Levels(window)
        sequence = TaskContext.get().partitionId() * PER_TASK
        names: dict[int, tuple] = {}  # id and tokens of documents with a piece in an open window
        seen = 0

        def rows(windows: list[list[Piece]]) -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            out = []
            for held in windows:
                offset = 0
                for doc, start, ids in held:
                    name, total = names[doc]
                    out.append((name, start, len(ids) // 4, ids, total, sequence, offset))
                    offset += len(ids) // 4
                sequence += 1
            for first in range(0, len(out), 2_000):
                columns = zip(*out[first:first + 2_000], strict=True)
                arrays = [pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                keys = part.column(0).to_pylist()
                texts = [x or "" for x in part.column(1).to_pylist()]
                full, whole = [], 4 * window
                for key, ids in zip(keys, tokens.ids(texts), strict=True):
                    ids += tail
                    names[seen] = key, len(ids) // 4
                    at = len(ids) - len(ids) % whole
                    full += [[(seen, k // 4, ids[k:k + whole])] for k in range(0, at, whole)]
                    if at < len(ids):
                        done = levels.place((seen, at // 4, ids[at:]))
                        if done:
                            full.append(done)
                    seen += 1
                yield from rows(full)
            held = {p[0] for at in levels.open.values() for w in at for p in w}
            names = {k: v for k, v in names.items() if k in held}
        yield from rows(list(levels.close()))

    return run


def pack(
    docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
    window: int = WINDOW, end: int = END,
) -> DataFrame:
    """Pack the token ids of all documents, each followed by ``end``, into windows.

    One row per piece: the id column, start (tokens of its document before it), length, ids
    (little-endian unsigned 32-bit numbers), doc_tokens, sequence_id, offset (in its sequence).
    ``tokenizer`` is the path of the tokenizer file, the same on all executors.

    A document longer than a window is cut into full windows and a rest.  Each task places the
    rests of its own documents by the sum-of-squares rule (``Levels``), so nothing is shuffled, and
    holds only its open windows.  At its end it pours them together; the last is cut into sequences
    of a power of two.  So each sequence has ``window`` tokens or a power of two.  Numbers depend
    on the partition number alone; a task that runs again gives the same rows.

    A null or empty text is the single id ``end``.  Rows of equal or null ids are packed each for
    itself.  Other columns are not read.
    """
    schema = T.StructType([
        T.StructField(doc_id, docs.schema[doc_id].dataType),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()), T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
    ])
    from pyspark.sql.pandas.types import to_arrow_schema

    run = _packed(tokenizer, window, end, to_arrow_schema(schema))
    return docs.select(F.col(doc_id), F.col(text).cast("string").alias(text)).mapInArrow(run, schema)
