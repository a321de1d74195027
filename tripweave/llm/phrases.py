"""Phrases whose words stand together far more often than chance: counts by Rabin-Karp fingerprints."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import _ODD, cut, mix, text_bytes, text_groups, word_hashes

#: Language of documents without one.
NO_LANG = "und"

# Lower-case A-Z; one mark for all that ends a piece.
_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_MARK = b"."
_CLEAN = bytes(_MARK[0] if b in _ENDS else b for b in bytes(range(256)).lower())

_PRIME = np.uint64(2**61 - 1)
_BASE = 0x1B873593CC9E2D51 % (2**61 - 1)
_STEP = 1 << 18
#: Languages and phrases are dealt over so many parts where a language would make a hot group.
_PARTS = 64
#: Bits of a filter of frequent fingerprints: 16 for each, this many at most (16 MB).
_MOST_BITS = 1 << 27
_PROBES = 4


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x >> np.uint64(61)) + (x & _PRIME)
    return np.where(x >= _PRIME, x - _PRIME, x)


def _times(a: np.ndarray, b) -> np.ndarray:
    """Product modulo 2**61 - 1 of numbers below it."""
    b = np.asarray(b, dtype=np.uint64)
    low, mid = np.uint64(2**31 - 1), np.uint64(2**30 - 1)
    a1, a0, b1, b0 = a >> np.uint64(31), a & low, b >> np.uint64(31), b & low
    cross = a0 * b1 + a1 * b0
    return _reduced(
        (a1 * b1 << np.uint64(1)) + (cross >> np.uint64(30)) + ((cross & mid) << np.uint64(31)) + a0 * b0
    )


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(1, dtype=np.uint64)
    while len(out) < n:
        out = np.concatenate((out, _times(out, np.uint64(pow(base, len(out), 2**61 - 1)))))
    return out[:n]


class Fingerprints:
    """Fingerprints of stretches of up to ``longest`` words, from prefix polynomials."""

    def __init__(self, longest: int):
        self.longest = longest
        self.power = _powers(_BASE, _STEP + longest)
        self.inverse = _powers(pow(_BASE, -1, 2**61 - 1), _STEP + longest)

    def prefixes(self, words: np.ndarray) -> np.ndarray:
        """Sums of word fingerprints times powers of the base, of all words before each place."""
        terms = _times(words, self.power[:len(words)])
        low, high = terms & np.uint64(2**31 - 1), terms >> np.uint64(31)
        total = np.zeros(len(words) + 1, dtype=np.uint64)
        high = _times(_reduced(np.cumsum(high, dtype=np.uint64)), np.uint64(2**31))
        total[1:] = _reduced(high + _reduced(np.cumsum(low, dtype=np.uint64)))
        return total

    def of(self, prefixes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
        """The fingerprint of the ``size`` words from each place on; the same wherever they stand."""
        apart = _reduced(prefixes[at + size] + (_PRIME - prefixes[at]))
        return _times(apart, self.inverse[at])


class Filter:
    """Says of every fingerprint it was made from that it is in, and of few others."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits  # 64 in a word; their number is a power of two

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), dtype=bool)
        for k in range(_PROBES):
            place = _probe(keys, k) & np.uint64(64 * len(self.bits) - 1)
            found &= (self.bits[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)) == 1
        return found


def _probe(keys: np.ndarray, k: int) -> np.ndarray:
    return mix(keys + np.uint64(0x9E3779B97F4A7C15 * (k + 1) % 2**64))


def _bits(size: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            place = np.unique(np.concatenate([_probe(keys, k) & np.uint64(size - 1) for k in range(_PROBES)]))
            word = (place >> np.uint64(6)).astype(np.int64)
            bit = np.uint64(1) << (place & np.uint64(63))
            first = np.flatnonzero(np.diff(word, prepend=-1))
            held = np.bitwise_or.reduceat(bit, first) if len(first) else bit
            yield pa.RecordBatch.from_arrays([pa.array(word[first]), pa.array(held.view(np.int64))], schema=schema)

    return run


def filter_of(keys: DataFrame) -> Filter:
    """A filter of fingerprints (``key``); its size is bounded, whatever their number.

    Beyond the bound it lets more others pass, which costs time and shuffled rows but no result.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    size = 1 << 12
    while size < min(16 * keys.count(), _MOST_BITS):
        size *= 2
    schema = keys.sparkSession.createDataFrame([], "word bigint, held bigint").schema
    words = keys.mapInArrow(_bits(size, to_arrow_schema(schema)), schema)
    found = words.groupBy("word").agg(F.bit_or("held").alias("held")).toArrow()
    bits = np.zeros(size // 64, dtype=np.uint64)
    bits[found.column("word").to_numpy()] = found.column("held").to_numpy().view(np.uint64)
    return Filter(bits)


class Words:
    """The words of some texts one after the other, as numbers; each text and piece ends with a mark.

    Words of a language are numbered without gaps by ``codes`` (the mark too).
    """

    def __init__(self, texts: list[bytes], langs: np.ndarray, names: list[str]):
        cleaned = []
        for t in texts:
            words = b" ".join(t.translate(_CLEAN).replace(_MARK, b" . ").split())
            cleaned.append(words + b" . " if words else b". ")
        self.raw = b"".join(cleaned)
        ends = np.flatnonzero(np.frombuffer(self.raw, dtype=np.uint8) == 0x20)
        self.starts = np.concatenate(([0], ends + 1))  # each word ends with one space
        last = np.searchsorted(ends, np.cumsum([len(c) for c in cleaned]) - 1)
        self.text_ends = last + 1
        spans = pa.Array.from_buffers(
            pa.large_binary(), len(ends),
            [None, pa.py_buffer(self.starts.astype(np.int64)), pa.py_buffer(self.raw)],
        ).dictionary_encode()
        numbers = spans.indices.to_numpy().astype(np.int64)
        at = np.frombuffer(spans.dictionary.buffers()[1], dtype=np.int64)[:len(spans.dictionary) + 1]
        hashes = word_hashes(np.frombuffer(spans.dictionary.buffers()[2], dtype=np.uint8)[:at[-1]], at[:-1], at[1:])
        self.prints = hashes % (_PRIME - np.uint64(1)) + np.uint64(1)
        self.numbers, self.names = numbers, names
        self.is_word = numbers != numbers[-1]
        self.langs = np.repeat(langs, np.diff(self.text_ends, prepend=0))
        self.salts = _salts(names)
        self.codes = numbers * len(names) + self.langs

    def __len__(self) -> int:
        return len(self.numbers)

    def single(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes, keys and numbers of occurrences of all words."""
        total = np.bincount(self.codes[self.is_word], minlength=len(self.prints) * len(self.names))
        code = np.flatnonzero(total)
        number, lang = np.divmod(code, len(self.names))
        return code, mix(self.prints[number] + self.salts[lang] + _ODD), total[code]

    def phrase(self, at: int, size: int) -> bytes:
        return self.raw[self.starts[at]:self.starts[at + size] - 1]


def _stretches(prints: Fingerprints, words: Words, filters: list[Filter], sizes: range):
    """Size, places and keys of all stretches of two words and more whose parts pass their filters."""
    code, keys, _ = words.single()
    passes = np.zeros(len(words.prints) * len(words.names), dtype=bool)
    passes[code[filters[0](keys)]] = True
    often = passes[words.codes]
    for begin in range(0, len(words), _STEP):
        here = slice(begin, begin + _STEP + prints.longest - 1)
        fits = often[here]
        mine = min(_STEP, len(words) - begin)  # where stretches of this part begin
        prefixes = prints.prefixes(words.prints[words.numbers[here]])
        salt = words.salts[words.langs[here]]
        for size in range(2, sizes.stop):
            fits = fits[:-1] & fits[1:]
            at = np.flatnonzero(fits)
            if not len(at):
                break
            keys = mix(prints.of(prefixes, at, size) + salt[at] + np.uint64(size * int(_ODD) % 2**64))
            if size <= len(filters):
                passed = filters[size - 1](keys)
                fits[at[~passed]] = False
                at, keys = at[passed], keys[passed]
            if size in sizes:
                own = at < mine
                yield size, at[own] + begin, keys[own]


def _words(batch: pa.RecordBatch) -> Iterator[tuple[Words, pa.Array]]:
    """Words of the texts of a batch, by id, in groups of a megabyte, and the ids."""
    order = pc.sort_indices(batch.column(0))
    langs = batch.column(1).fill_null(NO_LANG).dictionary_encode()
    codes = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    names = langs.dictionary.to_pylist()
    for first, last in text_groups(batch.column(2).take(order), 1_000_000):
        some = order.slice(first, last - first)
        # One group's texts at a time: a batch has some dozen groups.
        texts = text_bytes(batch.column(2).take(some))
        yield Words(texts, codes[some.to_numpy()], names), batch.column(0).take(some)


def _salts(names: list[str]) -> np.ndarray:
    raw = b"".join(hashlib.blake2b(n.encode(), digest_size=8).digest() for n in names)
    return np.frombuffer(raw, dtype="<u8")


def _counted(size: int, held: list, schema: pa.Schema):
    """Numbers of occurrences by fingerprint, of stretches of one size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints, filters = Fingerprints(size), [f.value for f in held]
        for batch in batches:
            for words, _ in _words(batch):
                if size == 1:
                    _, keys, n = words.single()
                else:
                    found = [k for _, _, k in _stretches(prints, words, filters, range(size, size + 1))]
                    keys, n = np.unique(np.concatenate([*found, np.zeros(0, np.uint64)]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], schema=schema)

    return run


def _grouped(words: Words, at: np.ndarray, keys: np.ndarray, size: int):
    """First place and number of occurrences of each different stretch: by key, held to the words."""
    _, first, which, n = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    stretch = [words.codes[at + k] for k in range(size)]
    if not all(np.array_equal(w, w[first][which]) for w in stretch):  # two stretches of one key
        _, first, n = np.unique(np.stack(stretch, axis=1), axis=0, return_index=True, return_counts=True)
    return at[first], n


def _written(longest: int, held: list, schema: pa.Schema):
    """Texts and counts of stretches that pass the filters; and as the empty one, of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints, filters = Fingerprints(longest), [f.value for f in held]
        for batch in batches:
            for words, ids in _words(batch):
                found: dict[int, list] = {}
                for size, at, keys in _stretches(prints, words, filters, range(2, longest + 1)):
                    found.setdefault(size, []).append((at, keys))
                code, keys, n = words.single()
                total = np.bincount(code % len(words.names), weights=n, minlength=len(words.names))
                first = np.zeros(len(words.prints) * len(words.names), dtype=np.int64)
                first[words.codes[::-1]] = np.arange(len(words))[::-1]
                often = filters[0](keys)
                used = np.flatnonzero(total)
                # A size's phrases are written and sent before the next size's.
                for size in (0, 1, *found):
                    if size == 0:
                        at, count = None, total[used].astype(np.int64)
                    elif size == 1:
                        at, count = first[code[often]], n[often]
                    else:
                        at, count = _grouped(words, *(np.concatenate(x) for x in zip(*found.pop(size), strict=True)), size)
                    doc = np.zeros(len(used), np.int64) if at is None else np.searchsorted(words.text_ends, at, "right")
                    lang = used if at is None else words.langs[at]
                    phrases = [b""] * len(used) if at is None else [words.phrase(i, size) for i in at.tolist()]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(words.names, pa.string()).take(pa.array(lang)),
                        pa.array(np.full(len(lang), size, dtype=np.int32)),
                        pa.array(phrases, pa.binary()).cast(pa.string()),
                        pa.array(count), ids.take(pa.array(doc)),
                    ], schema=schema)

    return run


def phrase_counts(
    docs: DataFrame, least: int, longest: int, doc_id: str = "doc_id", text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """lang, size, phrase, count, first_doc of all phrases of 1 to ``longest`` words that occur often.

    Often: ``least`` times in the texts of a language, overlaps included.  The row of size 0 holds the
    number of all words of a language.  See ``collocations`` for texts and words.

    1. For each size, one after the other: a task hashes every stretch whose shorter parts can be
       frequent, by prefix polynomials, and counts hashes; a shuffle adds them up.  Those of
       ``least`` and more go into a filter of bounded size.
    2. A last scan groups the stretches that pass by hash, with the place of an occurrence, holds
       all occurrences to the words there, and writes the phrase out once a task.  These counts are
       added up by text, so a hash that two phrases share changes nothing.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(
        F.col(doc_id).alias("id"), F.col(lang).cast("string").alias("lang"),
        F.col(text).cast("string").alias("text"),
    )
    schema = spark.createDataFrame([], "key bigint, n bigint").schema
    held: list = []
    for size in range(1, longest + 1):
        counted = rows.mapInArrow(_counted(size, held, to_arrow_schema(schema)), schema)
        often = cut(counted.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("key"))
        held = [*held, spark.sparkContext.broadcast(filter_of(often))]
    schema = spark.createDataFrame(
        [], f"lang string, size int, phrase string, n bigint, id {kind}"
    ).schema
    written = rows.mapInArrow(_written(longest, held, to_arrow_schema(schema)), schema)
    return written.groupBy("lang", "size", "phrase").agg(
        F.sum("n").alias("count"), F.min("id").alias("first_doc")
    ).where((F.col("count") >= least) | (F.col("size") == 0))


def _part(first, last):
    return F.array_join(F.slice("words", first, last), " ")


def collocations(
    docs: DataFrame, least: int = 100, longest: int = 5, best: int = 2000, doc_id: str = "doc_id",
    text: str = "text", lang: str = "lang",
) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score, first_doc.

    Texts are lower-cased (A-Z) and end a piece at ``.,;:!?`` and line ends; words are what spaces and
    tabs separate; null counts as empty, a null language as ``und``.  Phrases of 2 to ``longest``
    words that occur a times, at least ``least``, are candidates.  The cut into two parts, which
    occur l and r times, with the lowest floor(1000 a n / (l r)) counts (the first of equal ones); n is
    the number of words of the language.  A candidate that lies in a longer one which occurs as
    often goes.  The first ``best`` of a language by score and a, then by phrase (bytes), are returned;
    first_doc is the least id of a document that holds the phrase.  Documents are read whatever their
    ids, repeated and null ones too; other columns are not read.
    """
    found = cut(phrase_counts(docs, least, longest, doc_id, text, lang))
    phrases = found.where("size > 0")
    often = phrases.where("size > 1").withColumn("words", F.split("phrase", " "))
    cuts = often.select(
        "lang", "phrase", F.col("count").alias("a"), "first_doc", "words",
        F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"),
    ).withColumn("left", _part(F.lit(1), F.col("k"))).withColumn(
        "right", _part(F.col("k") + 1, F.size("words"))
    ).drop("words")
    for side, name in (("left", "l"), ("right", "r")):
        counts = phrases.select("lang", F.col("phrase").alias(side), F.col("count").alias(name))
        cuts = cuts.join(counts.hint("merge"), ["lang", side])
    totals = found.where("size = 0").select(
        "lang", F.col("count").alias("n"), F.explode(F.sequence(F.lit(0), F.lit(_PARTS - 1))).alias("part")
    )
    part = F.pmod(F.xxhash64("phrase"), F.lit(_PARTS)).cast("int")
    exact = "cast(1000 as decimal(4,0)) * cast(a as decimal(17,0)) * cast(n as decimal(17,0))"
    scored = cuts.withColumn("part", part).join(totals.hint("merge"), ["lang", "part"]).withColumn(
        "score", F.expr(f"({exact}) div (cast(l as decimal(17,0)) * cast(r as decimal(17,0)))")
    )
    lowest = scored.groupBy("lang", "part", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r", "a", "n", "first_doc")).alias("x")
    ).select("lang", "part", "phrase", "x.*")
    inner = often.where("size > 2").select("lang", "size", "words", F.col("count").alias("f")).select(
        "lang", "f", "size", "words", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("m")
    ).select(
        "lang", "f", "words", "m", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)).alias("i")
    ).groupBy("lang", _part(F.col("i"), F.col("m")).alias("phrase")).agg(F.max("f").alias("f"))
    alone = lowest.join(inner.hint("merge"), ["lang", "phrase"], "left").where(
        F.col("f").isNull() | (F.col("f") < F.col("a"))
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    in_part = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    few = alone.withColumn("rank", in_part).where(F.col("rank") <= best)  # as many parts of a language
    return few.withColumn("rank", rank.cast("bigint")).where(F.col("rank") <= best).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score", "first_doc"
    )
