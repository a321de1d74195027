"""Language identification: the family first, then linear support vector machines within it."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, groups_of

#: Documents of a language that are learned from, at most; picked by a hash of id and text.  A family's
#: machine gets twice as many documents of the family, and up to four times as many of all others.
PER_LANGUAGE = 600
#: Tables with a row a language are broadcast up to so many rows, else shuffled.
BROADCAST_ROWS = 100_000
BUCKETS = 1 << 12
UNKNOWN = "und"

# Families of some languages; any other is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk bg sr hr sl mk bs",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tk",
    "indic": "hi bn ur mr gu pa ne",
    "semitic": "ar he mt am",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

#: The margin of a decision without an alternative.
_SURE = 4.0
_BLANK = 32
_LETTER = np.full(256, _BLANK, dtype=np.uint8)
_LETTER[[*range(97, 123), *range(128, 256)]] = [*range(97, 123), *range(128, 256)]


def features(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each text: hashed three-byte strings of its lower-cased letters, as buckets and shares.

    Runs of anything but letters (bytes beyond ASCII count as such) are one blank.
    """
    return [
        (values, counts / max(counts.sum(), 1))
        for buckets in _buckets(texts)
        for values, counts in [np.unique(buckets, return_counts=True)]
    ]


def _buckets(texts: list[str]) -> list[np.ndarray]:
    raw = [b" " + t.lower().encode("utf-8", "replace") + b" " for t in texts]
    data = _LETTER[np.frombuffer(b"".join(raw), dtype=np.uint8)]
    keep = np.ones(len(data), dtype=bool)
    keep[1:] = (data[1:] != _BLANK) | (data[:-1] != _BLANK)
    ends = np.cumsum(keep)[np.cumsum([len(r) for r in raw]) - 1] if raw else []
    letters = data[keep].astype(np.uint32)
    if len(letters) < 3:
        return [np.zeros(0, dtype=np.int64) for _ in raw]
    code = (letters[:-2] << 16) | (letters[1:-1] << 8) | letters[2:]
    code = (code * np.uint32(2654435761)) >> np.uint32(32 - (BUCKETS.bit_length() - 1))
    starts = [0, *ends[:-1]]
    return [code[a:max(a, b - 2)].astype(np.int64) for a, b in zip(starts, ends, strict=True)]


def separate(x: np.ndarray, y: np.ndarray, rounds: int = 300, cost: float = 10.0) -> tuple[np.ndarray, float]:
    """A linear support vector machine (squared hinge loss) for y of -1 and 1, classes balanced.

    Accelerated gradient steps on scaled rows; deterministic.
    """
    norm = np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    a = np.hstack([x / norm, np.ones((len(x), 1))])
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1))
    w = z = np.zeros(a.shape[1])
    t, step = 1.0, 1.0 / (1.0 / cost + 2 * 2.0)
    for _ in range(rounds):
        slack = np.maximum(1 - y * (a @ z), 0)
        moved = z - step * (z / cost - 2 * a.T @ (weight * y * slack))
        faster = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z = moved + (t - 1) / faster * (moved - w)
        w, t = moved, faster
    return w[:-1], float(w[-1])


class LanguageModel:
    """A machine for each family against all others, and machines between the languages of a family.

    Made of rows (family, first, second, weights, bias): ``second`` is empty for the machine of the
    family ``first``; else the machine is positive for the language ``first`` of ``family``.
    """

    def __init__(self, machines: Iterable[tuple[str, str, str, Sequence[float], float]], languages: Mapping[str, str]):
        self.languages: dict[str, list[str]] = {}
        for language, family in sorted(languages.items()):
            self.languages.setdefault(family, []).append(language)
        self.families = sorted(self.languages)
        between, within = {}, {}
        for family, first, second, weights, bias in machines:
            machine = np.asarray(weights, dtype=np.float32), bias
            if second:
                within.setdefault(family, {})[first, second] = machine
            else:
                between[first] = machine
        self._between = self._stacked([between[f] for f in self.families if f in between])
        self._within = {
            f: (list(duels), self._stacked(list(duels.values()))) for f, duels in within.items()
        }

    @staticmethod
    def _stacked(machines: list) -> tuple[np.ndarray, np.ndarray]:
        weights = np.array([w for w, _ in machines], dtype=np.float32).reshape(-1, BUCKETS)
        return weights, np.array([b for _, b in machines])

    @staticmethod
    def _margins(machines: tuple[np.ndarray, np.ndarray], x: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        values, shares = x
        weights, bias = machines
        return weights[:, values] @ shares / max(float(np.linalg.norm(shares)), 1e-9) + bias

    def predict(self, x: tuple[np.ndarray, np.ndarray]) -> tuple[str, float]:
        """Language and a score from 0 to 1 of the narrower of the two decisions.

        The family of the widest margin; in it the language that wins most duels (then the widest),
        with its narrowest duel's margin.  Ties go to the name that comes first.
        """
        if not self.families:
            return UNKNOWN, 0.0
        family, wide = self.families[0], _SURE
        if len(self.families) > 1:
            margins = self._margins(self._between, x)
            family, wide = self.families[int(margins.argmax())], float(margins.max())
        names = self.languages[family]
        language, narrow = names[0], _SURE
        if len(names) > 1:
            duels, machines = self._within[family]
            won = {n: [0, 0.0, _SURE] for n in names}
            for (first, second), margin in zip(duels, self._margins(machines, x).tolist(), strict=True):
                for name, by in ((first, margin), (second, -margin)):
                    won[name][0] += by > 0
                    won[name][1] += by
                    won[name][2] = min(won[name][2], by)
            language = max(names, key=lambda n: (won[n][0], won[n][1]))
            narrow = won[language][2]
        return language, float(1 / (1 + np.exp(-4 * min(wide, narrow))))


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _sampled(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(3).to_pylist()]
            for a, b in groups_of(texts):
                found = features(texts[a:b])
                yield pa.RecordBatch.from_arrays([
                    *[batch.column(k).slice(a, b - a) for k in range(3)],
                    pa.array([v for v, _ in found], schema.types[3]),
                    pa.array([x for _, x in found], schema.types[4]),
                ], schema=schema)

    return run


def _fitted(schema: pa.Schema):
    def run(group: pa.Table) -> pa.Table:
        buckets, shares = group.column("buckets").to_pylist(), group.column("shares").to_pylist()
        y = np.array(group.column("side"), dtype=np.float64)
        order = sorted(range(len(y)), key=lambda k: (y[k], buckets[k], shares[k]))
        x = np.zeros((len(y), BUCKETS), dtype=np.float32)
        for row, k in enumerate(order):
            x[row, buckets[k]] = shares[k]
        weights, bias = separate(x, y[order])
        return pa.Table.from_arrays([
            *[group.column(name).slice(0, 1) for name in ("family", "first", "second")],
            pa.array([weights.tolist()], schema.types[3]), pa.array([bias]),
        ], schema=schema)

    return run


def sample(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
    per_language: int = PER_LANGUAGE,
) -> DataFrame:
    """lang, rank (from 1), spot, buckets, shares: up to ``per_language`` documents of each language.

    They are those of the least hash of id and text (``spot``).  Languages are counted first, and
    only rows whose hash is low for that count are ranked, twice as many as are wanted (and always
    the least of all), so a language that holds most rows does not fill one task.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spot = F.pmod(F.xxhash64(doc_id, text), F.lit(1 << 40)) / float(1 << 40)
    read = docs.where(
        F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(doc_id).isNotNull()
    ).select(F.col(lang).alias("lang"), spot.alias("spot"), F.col(text).cast("string").alias("text"))
    counts = cut(read.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("spot").alias("least")))
    few = counts.count() <= BROADCAST_ROWS
    low = (F.col("spot") * F.col("n") < 2 * per_language) | (F.col("spot") == F.col("least"))
    order = Window.partitionBy("lang").orderBy("spot")
    ranked = (
        read.join(F.broadcast(counts) if few else counts.hint("merge"), "lang").where(low)
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_language)
        .select("lang", "rank", "spot", "text")
    )
    schema = docs.sparkSession.createDataFrame(
        [], "lang string, rank int, spot double, buckets array<int>, shares array<double>"
    ).schema
    found = ranked.mapInArrow(_sampled(to_arrow_schema(schema)), schema)
    return cut(found.where(F.size("buckets") > 0))


def machines(
    picked: DataFrame, family_of: Mapping[str, str] = FAMILY_OF, per_language: int = PER_LANGUAGE,
) -> tuple[DataFrame, dict[str, str]]:
    """The machines as a table (family, first, second, weights, bias), and each language's family.

    A machine is fitted in the task that has its group: a family against up to ``4 * per_language``
    documents of all others (their first ranks), or two languages of a family.  The number of
    machines grows with the number of families, and by the square of the languages of one family.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    languages = {
        row["lang"]: family_of.get(row["lang"], row["lang"])
        for row in picked.select("lang").distinct().toLocalIterator()
    }
    members: dict[str, list[str]] = {}
    for language, family in sorted(languages.items()):
        members.setdefault(family, []).append(language)
    kin = picked.sparkSession.createDataFrame(
        [
            (x, f, -(-2 * per_language // len(members[f])),
             [{"first": min(x, y), "second": max(x, y), "side": 1 if x < y else -1} for y in members[f] if y != x])
            for x, f in languages.items()
        ],
        "lang string, family string, most int, duels array<struct<first:string,second:string,side:int>>",
    )
    rows = picked.join(F.broadcast(kin) if len(languages) <= BROADCAST_ROWS else kin.hint("merge"), "lang")
    key = ["family", "first", "second", "side"]
    own = rows.where(F.col("rank") <= F.col("most")).select(
        F.lit("").alias("family"), F.col("family").alias("first"), F.lit("").alias("second"),
        F.lit(1).alias("side"), "buckets", "shares",
    )
    pool = rows.orderBy("rank", "spot").limit(4 * per_language).withColumn(
        "other", F.explode(F.lit(sorted(members)).cast("array<string>"))
    ).where(F.col("other") != F.col("family"))
    rest = pool.select(
        F.lit("").alias("family"), F.col("other").alias("first"), F.lit("").alias("second"),
        F.lit(-1).alias("side"), "buckets", "shares",
    )
    duels = rows.select("family", F.inline("duels"), "buckets", "shares").select(*key, "buckets", "shares")
    groups = own.unionByName(rest) if len(members) > 1 else own.limit(0)
    schema = picked.sparkSession.createDataFrame(
        [], "family string, first string, second string, weights array<float>, bias double"
    ).schema
    return groups.unionByName(duels).groupBy("family", "first", "second").applyInArrow(
        _fitted(to_arrow_schema(schema)), schema
    ), languages


def train(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
    per_language: int = PER_LANGUAGE, family_of: Mapping[str, str] = FAMILY_OF,
) -> LanguageModel:
    """Learn every language that occurs, from up to ``per_language`` documents of each.

    Only rows of non-null language, text and id are learned from; rows that share an id are picked
    by their texts.  Machines are fitted in tasks; the driver gets their weights, 16 kB a machine,
    and the names of the languages.
    """
    fitted, languages = machines(sample(docs, doc_id, text, lang, per_language), family_of, per_language)
    if not languages:
        return LanguageModel([], {})
    # Fitted all at once first: the iterator would run one partition after the other.
    rows = cut(fitted).toLocalIterator()
    return LanguageModel(
        [(m["family"], m["first"], m["second"], m["weights"], m["bias"]) for m in rows], languages
    )


def _predicted(model: LanguageModel, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in groups_of(texts):
                found = [
                    model.predict(x) if _has_letter(t) else (UNKNOWN, 0.0)
                    for t, x in zip(texts[a:b], features(texts[a:b]), strict=True)
                ]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), pa.array([x for x, _ in found], pa.string()),
                    pa.array([s for _, s in found], pa.float64()),
                ], schema=schema)

    return run


def predict(docs: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, lang_pred, score (0 to 1).

    Whole texts are read.  A null text, or one without a letter, is ``und`` with score 0, and so is
    every text if nothing was learned.  Rows of equal or null ids are judged each for itself; other
    columns are not read.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = docs.schema[doc_id].dataType.simpleString()
    schema = docs.sparkSession.createDataFrame(
        [], f"id {kind}, lang_pred string, score double"
    ).schema
    return docs.select(F.col(doc_id), F.col(text).cast("string")).mapInArrow(
        _predicted(model, to_arrow_schema(schema)), schema
    )
