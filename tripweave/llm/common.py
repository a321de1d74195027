"""What several operators of this package share: word hashing, folds, checkpoints."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its columns are declared, so no job looks into the files first."""
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def fold(key: Column, folds: int) -> Column:
    """Remainder of the CRC-32 of a key's text; null keys fall into fold 0."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(folds)), F.lit(0))


def free_name(df: DataFrame, name: str) -> str:
    """The name, or with underscores before it until no column of the table has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the session's ``spark.checkpoint.dir``; only a local session without one gets a new folder."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="checkpoints-")
    sc.setCheckpointDir(configured)


def cut(df: DataFrame) -> DataFrame:
    """End a table's lineage with a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column of an Arrow batch; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def _ranges(lengths: Iterator[int], most: int) -> Iterator[tuple[int, int]]:
    first = held = i = 0
    for i, length in enumerate(lengths, 1):
        held += length
        if held >= most:
            yield first, i
            first, held = i, 0
    if first < i:
        yield first, i


def groups_of(texts: list[bytes], most: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Index ranges of whole texts that hold about ``most`` bytes together."""
    return _ranges(map(len, texts), most)


def text_groups(column: pa.Array, most: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """As ``groups_of``, of a string column of an Arrow batch, so that its texts need not be Python's all at once."""
    return _ranges(pc.binary_length(column).fill_null(0).to_pylist(), most)


_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_BYTES = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that any of their bits may serve as a hash."""
    x = (x ^ (x >> np.uint64(31))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _ODD
    return x ^ (x >> np.uint64(32))


_BASE = 0x5851F42D4C957F2D
_POWERS: dict[int, np.ndarray] = {}


def _powers(n: int, base: int) -> np.ndarray:
    """The first n powers modulo 2**64, kept for the next call."""
    if len(_POWERS.get(base, ())) < n:
        out = np.full(n, base, dtype=np.uint64)
        out[0] = 1
        _POWERS[base] = np.multiply.accumulate(out)
    return _POWERS[base][:n]


_INVERSE = pow(_BASE, -1, 2**64)


def spans_of(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    return edge[::2], edge[1::2]


#: Longer spans are hashed by BLAKE2: regular strings of a thousand bytes collide in a polynomial
#: modulo 2**64.
_SHORT = 64


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; equal bytes get equal hashes wherever they stand."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[data] * _powers(len(data), _BASE), out=total[1:])
    value = (total[ends] - total[starts]) * _powers(len(data), _INVERSE)[starts]
    hashes = mix(value + (ends - starts).astype(np.uint64) * _ODD)
    for k in np.flatnonzero(ends - starts > _SHORT).tolist():
        digest = hashlib.blake2b(data[starts[k]:ends[k]].tobytes(), digest_size=8).digest()
        hashes[k] = int.from_bytes(digest, "little")
    return hashes


LOWER = bytes(range(256)).lower()  # A-Z only
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def shingle_hashes(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's shingles of ``size`` words.

    Words are runs of other bytes than ASCII white space, with A-Z lower-cased.  A text of fewer
    words has its whole sequence as its only shingle; one without words has none.
    """
    joined = b" ".join(texts).translate(LOWER)
    data = np.frombuffer(joined, dtype=np.uint8)
    starts, ends = spans_of(~_SPACE[data])
    words = word_hashes(data, starts, ends)
    first = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    bounds = np.searchsorted(starts, first)
    weights = mix(np.arange(1, size + 1, dtype=np.uint64) * _ODD) | np.uint64(1)
    n = max(len(words) - size + 1, 0)
    rolled = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        rolled += words[k:k + n] * weights[k]
    rolled = mix(rolled)
    out = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= size:
            out.append(np.unique(rolled[a:b - size + 1]))
        elif b > a:
            out.append(mix((words[a:b] * weights[:b - a]).sum(keepdims=True) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def cut_table(df: DataFrame) -> DataFrame:
    """As ``cut``, but as a compressed table: for rows that carry texts."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
