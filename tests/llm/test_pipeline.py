"""The whole pipeline against its stages done by hand."""

import re
import zlib

import numpy as np
import public_tokenizers
from test_near_dedup import brute_force
from test_spans import kinds_of_secrets
from tokenizers import Tokenizer

import corpus_pipeline
from parcelle.llm.packing import TOKENIZER
from parcelle.llm.quality import quality_rules


def masked(text):
    out, at = "", 0
    for _, start, end in kinds_of_secrets(text):
        if start >= at:
            out += text[at:start] + "[SECRET]"
        at = max(at, end)
    return out + text[at:]


def runs(text):
    words = [w for w in (x.lower().strip("\"'`.,;:!?()[]{}<>|*#$%&=~^+-/\\_") for x in text.split()) if w]
    return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))}


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [r[0] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text").collect()]
    good = {r["doc_id"] for r in quality_rules(docs).where("kept").collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] in good}
    texts = {i: texts[i] for i, (_, _, kept) in brute_force(list(texts.items())).items() if kept}
    texts = {i: t for i, t in texts.items() if not any(len(runs(t) & runs(u)) >= 0.6 * len(runs(u)) for u in items)}
    assert 0 < len(texts) < len(good)

    tokenizer = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    want = set()
    for i, text in texts.items():
        ids = np.array(tokenizer.encode(masked(text), add_special_tokens=False).ids + [1], "<u4")
        want |= {(i, n, k, len(ids[k:k + 4096]), zlib.crc32(ids[k:k + 4096].tobytes())) for n, k in enumerate(range(0, len(ids), 4096))}
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows} == want and len(rows) == len(want)
    ends = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 4096 and len(ends) <= 1.1 * sum(ends.values()) / 4096 + 2
    assert [bool(re.search(k, name)) for k, (name, _) in zip(("quality", "dedup", "decontam", "secret", "packing"), corpus_pipeline.STAGES)] == [True] * 5
