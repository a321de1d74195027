"""The whole pipeline over a small table, held to its stages one by one in plain Python."""

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tripweave.llm import quality
from tripweave.llm.decontaminate import leaks
from tripweave.llm.queries import TOKENIZER

from .test_dedup import brute_components

SF_DIR = "/root/testdata/sf0.001"


def test_run_against_the_stages_in_plain_python(spark, tmp_path):
    given = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    good = quality.score(given, quality.train(given, labels)).where("predicted = 1").collect()
    long = max((r.text for r in good if r.lang == "en"), key=len)
    item = max((r.text for r in items.collect()), key=len)
    edited = " ".join(w if i else "edited" for i, w in enumerate(long.split()))
    planted = [  # a copy, a near copy and a text with a whole benchmark item
        (10**6, long, "en", "planted", 0), (10**6 + 1, edited, "en", "planted", 0),
        (10**6 + 2, f"{long[:len(long) // 2]} {item} {long[len(long) // 2:]}", "en", "planted", 0),
    ]
    docs = given.unionByName(spark.createDataFrame(planted, given.schema))
    for name, df in (("documents", docs), ("benchmark", items), ("labels", labels)):
        df.write.parquet(f"{tmp_path}/{name}.parquet")

    model = quality.train(docs, labels)
    kept = {r.doc_id: r.text for r in quality.score(docs, model).where("predicted = 1").collect()}
    last = {}
    for i, text in kept.items():
        last[text or ""] = max(i, last.get(text or "", i))
    kept = {i: kept[i] for i in last.values()}
    kept = {i: kept[i] for i, (_, root) in brute_components(kept, 5, 80).items() if root == i}
    left = spark.createDataFrame(list(kept.items()), "doc_id bigint, text string")
    leaking = {r.doc_id for r in leaks(left, items).collect()}
    kept = {i: t for i, t in kept.items() if i not in leaking}
    assert 10**6 + 2 not in kept and len({10**6, 10**6 + 1} & set(kept)) <= 1
    assert len(kept) > 20

    library = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    used, fill = dict.fromkeys(kept, 0), {}
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {p.doc_id for p in pieces} == set(kept)
    ids = {i: np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
           for i, t in kept.items()}
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        assert p.start == used[p.doc_id] and p.doc_tokens == len(ids[p.doc_id])
        used[p.doc_id] += p.length
        assert p.ids_crc32 == zlib.crc32(ids[p.doc_id][p.start:p.start + p.length].tobytes())
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == fill.get(p.sequence_id, 0)
        fill[p.sequence_id] = p.offset + p.length
    assert used == {i: len(x) for i, x in ids.items()}
    assert max(fill.values()) <= 4096
