"""Secret scan: fixed patterns, and character models of random strings against identifiers."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import groups_of, spans_of, text_bytes

# The patterns that always count.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
LEAST = {"assign": 12, "access": 18, "hex": 16}
KINDS = ("assign", "access", "hex", "random")

#: Runs of so many characters are compared by the models; the log-likelihood ratio a character
#: (natural logarithm) from which on a run counts as random.
LEAST_RANDOM = 16
LEAST_RATIO = 0.5

# Words that identifiers and paths in files are often made of; labelled ordinary.
IDENTIFIER_WORDS = (
    "abstract access account action adapter add address admin api app array async audit auth base bean "
    "block body buffer build byte cache call cert char check class client cluster code collection column "
    "com command common config connection console constant container content context control copy core "
    "count create current data database date debug default delete device directory document domain "
    "download element email enable encoding end endpoint engine entity env error event example exception "
    "exec export factory field file filter final find format frame function gateway get group handler "
    "hash header home host html http id image impl implemented index info init input instance interface "
    "internal item java key kernel language last length level lib limit line link list listener load "
    "local lock log login main manager map max maximum memory message metadata method min mode model "
    "module name net network next node not null number object on operation option order org output "
    "package page parameter parent parse password path port prefix process project property provider "
    "proxy public query queue read record reference register remote remove report request reset resource "
    "response result return root route run schema script search secondary seconds security select send "
    "server service session set setting share singleton size socket source src start state static status "
    "stop storage stream string style system table target task template temp test text thread time "
    "timeout title token tool total transaction tree type unit update upload url user util utils value "
    "var version view web window write xml zone"
).split()

_TOKEN = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-"
_STATES = len(_TOKEN) + 1  # and one for all other bytes
_STATE = np.full(256, _STATES - 1, dtype=np.int64)
_STATE[[ord(c) for c in _TOKEN]] = np.arange(len(_TOKEN))
_HEX = np.isin(np.arange(256), [ord(c) for c in "0123456789abcdef"])

Span = tuple[int, int, int]  # start, place of its kind in KINDS, end


def fixed_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by start and kind; leftmost and non-overlapping per kind."""
    out: list[Span] = []
    if "=" in text or ":" in text:
        out += [
            (m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
            if m.end(2) - m.start(2) >= LEAST["assign"]
        ]
    if "AKIA" in text:
        out += [
            (m.start(), 1, m.end()) for m in ACCESS.finditer(text)
            if m.end() - m.start() >= LEAST["access"]
        ]
    return out


def _long_runs(inside: np.ndarray, least: int) -> list[tuple[int, int]]:
    starts, ends = spans_of(inside)
    long = ends - starts >= least
    return list(zip(starts[long].tolist(), ends[long].tolist(), strict=True))


def _found(texts: list[bytes]) -> Iterator[tuple[list[Span], list[tuple[int, int, bytes]]]]:
    """Of each text: the fixed spans, and other long runs of token characters with their bytes."""
    joined = b"\n".join(texts) + b"\n"
    data = np.frombuffer(joined, dtype=np.uint8)
    first = np.cumsum([0] + [len(t) + 1 for t in texts])
    runs: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    for kind, inside, least in (
        ("hex", _HEX[data], LEAST["hex"]), ("run", _STATE[data] < len(_TOKEN), LEAST_RANDOM)
    ):
        found = _long_runs(inside, least)
        owner = np.searchsorted(first, [a for a, _ in found], side="right") - 1
        for k, (a, b) in zip(owner.tolist(), found, strict=True):
            runs[k].append((kind, a - int(first[k]), b - int(first[k])))
    for raw, mine in zip(texts, runs, strict=True):
        text = raw.decode("utf-8", "replace")
        fixed = fixed_spans(text)
        if raw.isascii() or not mine:
            at = int
        else:  # code points before each byte
            before = np.cumsum((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80)
            at = lambda b, before=before: int(before[b - 1]) if b else 0
        fixed += [(at(a), 2, at(b)) for kind, a, b in mine if kind == "hex"]
        fixed.sort()
        other = [
            (at(a), at(b), raw[a:b]) for kind, a, b in mine
            if kind == "run" and not any(s < at(b) and at(a) < e for s, _, e in fixed)
        ]
        yield fixed, other


@dataclass
class RandomModel:
    """Log-likelihood ratios of character pairs: random strings against ordinary identifiers."""

    ratio: np.ndarray

    def of(self, token: bytes) -> float:
        """The ratio a character, so that neither long nor short runs are favoured."""
        states = _STATE[np.frombuffer(token, dtype=np.uint8)]
        return float(self.ratio[states[:-1], states[1:]].mean()) if len(states) > 1 else 0.0


def _word_counts(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letter pairs, first letters and last letters of words of a-z."""
    pairs, first, last = np.zeros((26, 26)), np.zeros(26), np.zeros(26)
    for word in words:
        letters = [ord(c) - ord("a") for c in word]
        np.add.at(pairs, (letters[:-1], letters[1:]), 1)
        first[letters[0]] += 1
        last[letters[-1]] += 1
    return pairs, first, last


def _identifier_pairs(pairs: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Pairs of characters of identifiers made of such words in the usual styles, as shares of their rows.

    The styles: words in lower case or capitals joined by a sign, camel case, a word and a number.
    """
    lower, upper, digit = slice(10, 36), slice(36, 62), slice(0, 10)
    signs = [_TOKEN.index(c) for c in "/_-"]
    words = max(first.sum(), 1e-9)
    out = np.zeros((len(_TOKEN), len(_TOKEN)))
    out[lower, lower] = 2 * pairs
    out[upper, upper] = pairs
    out[upper, lower] = first[:, None] * pairs / np.maximum(pairs.sum(axis=1, keepdims=True), 1e-9)
    out[lower, upper] = np.outer(last, first) / words
    for sign in signs:
        out[lower, sign] += last / 2
        out[sign, lower] += first / 2
        out[upper, sign] += last / 2
        out[sign, upper] += first / 2
    out[lower, digit] = last[:, None] / 40
    out[upper, digit] = last[:, None] / 40
    out[digit, lower] = first[None, :] / 40
    out[digit, upper] = first[None, :] / 40
    return out / np.maximum(out.sum(axis=1, keepdims=True), 1e-9)


def _ordinary(text_pairs: np.ndarray) -> np.ndarray:
    """Shares of the characters that follow each other in identifiers; in equal parts of two sources.

    One is the words of all texts, the other the words that identifiers are often made of.  Digits
    follow digits in any order, counting upwards most often; signs, and now and then letters, repeat themselves.
    """
    other = _STATES - 1
    low, cap = slice(10, 36), slice(36, 62)
    pairs = text_pairs[low, low] + text_pairs[cap, low] + text_pairs[cap, cap]
    ends = text_pairs[low, other] + text_pairs[cap, other]
    starts = text_pairs[other, low] + text_pairs[other, cap]
    shares = (
        _identifier_pairs(pairs + 0.01, starts + 0.01, ends + 0.01) + _identifier_pairs(*_word_counts(IDENTIFIER_WORDS))
    ) / 2
    n = len(_TOKEN)
    counting = np.zeros((n, n))
    for d in range(10):
        counting[d, :10] = 0.07
        counting[d, (d + 1) % 10] += 0.15
        counting[d, 62:] = 0.03
    for letter in range(10, 62):
        counting[letter, letter] = 0.05
    for sign in range(62, n):
        counting[sign, sign] = 0.6
        counting[sign, :10] = 0.04
    rest = np.maximum(1 - counting.sum(axis=1, keepdims=True), 0)
    return counting + rest * shares


def _counts(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, _STATES * _STATES), dtype=np.int64)
        for batch in batches:
            texts = text_bytes(batch.column(0))
            for a, b in groups_of(texts):
                data = _STATE[np.frombuffer(b"\n".join(texts[a:b]) + b"\n", dtype=np.uint8)]
                pairs = np.bincount(data[:-1] * _STATES + data[1:], minlength=_STATES * _STATES)
                secret = np.zeros_like(pairs)
                for text, (fixed, _) in zip(texts[a:b], _found(texts[a:b]), strict=True):
                    whole = text.decode("utf-8", "replace") if fixed else ""
                    for start, kind, end in fixed:
                        value = whole[start:end]
                        if kind == 0:
                            value = ASSIGN.match(value)[2]
                        s = _STATE[np.frombuffer(value.encode(), dtype=np.uint8)]
                        secret += np.bincount(s[:-1] * _STATES + s[1:], minlength=len(secret))
                total[0] += np.maximum(pairs - secret, 0)
                total[1] += secret
        kind, pair = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([
            pa.array(kind, pa.int64()), pa.array(pair, pa.int64()), pa.array(total[kind, pair])
        ], schema=schema)

    return run


def train(docs: DataFrame, text: str = "text") -> RandomModel:
    """Two chains of characters: of random strings, and of ordinary identifiers.

    Character pairs of all texts are counted, in the values of fixed spans and everywhere else; the
    fixed patterns label the samples.  The identifiers' chain is built from the pairs inside, before
    and after the words of the texts, and from ``IDENTIFIER_WORDS``, in the styles that identifiers
    and paths are written in.  Random strings get one count for each pair of characters besides
    those of the labelled values, so that without any they are uniform.  Both chains are over
    characters of tokens only.  The driver gets one number for each pair of states and class,
    whatever the size of the table.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = docs.sparkSession.createDataFrame([], "kind bigint, pair bigint, n bigint").schema
    rows = (
        docs.select(F.col(text).cast("string")).mapInArrow(_counts(to_arrow_schema(schema)), schema)
        .groupBy("kind", "pair").agg(F.sum("n").alias("n")).collect()
    )
    counts = np.zeros((2, _STATES * _STATES))
    for r in rows:
        counts[r["kind"], r["pair"]] = r["n"]
    counts = counts.reshape(2, _STATES, _STATES)
    n = len(_TOKEN)
    random = counts[1, :n, :n]
    # Labelled values tell which characters random strings have; their order is left to chance.
    share = (random.sum(axis=0) + 100.0) / (random.sum() + 100.0 * n)
    uniform = np.full(n, 1.0 / n)
    chance = np.tile((share + uniform) / 2, (n, 1))
    ordinary = 0.97 * _ordinary(counts[0]) + 0.03 / n
    return RandomModel(np.log(chance) - np.log(ordinary / ordinary.sum(axis=1, keepdims=True)))


def _scan(model: RandomModel, least_ratio: float, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column(1))
            for a, b in groups_of(texts):
                rows = []
                for fixed, other in _found(texts[a:b]):
                    spans = fixed + [
                        (s, 3, e) for s, e, token in other if model.of(token) >= least_ratio
                    ]
                    rows.append([
                        {"kind": KINDS[k], "start": s, "end": e} for s, k, e in sorted(spans)
                    ])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(rows, schema.types[1])], schema=schema
                )

    return run


def scan(
    docs: DataFrame, model: RandomModel, doc_id: str = "doc_id", text: str = "text",
    least_ratio: float = LEAST_RATIO,
) -> DataFrame:
    """One row per document: id and spans (kind, start, end in code points), by start and kind.

    Kinds assign, access and hex are the fixed patterns.  A run of ``LEAST_RANDOM`` or more token
    characters that overlaps none of them is random if its log-likelihood under the model of random
    strings exceeds that under the model of identifiers by ``least_ratio`` a character.  Null and empty texts
    have no spans; rows of equal or null ids are scanned each for itself; other columns are not read.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = docs.schema[doc_id].dataType.simpleString()
    schema = docs.sparkSession.createDataFrame(
        [], f"id {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>"
    ).schema
    return docs.select(F.col(doc_id), F.col(text).cast("string")).mapInArrow(
        _scan(model, least_ratio, to_arrow_schema(schema)), schema
    )
