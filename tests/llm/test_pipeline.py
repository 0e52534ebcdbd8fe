"""The pipeline against a plain one: same models, everything else by brute force."""

from collections import Counter

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from snapmart.llm import quality_pu, secret_scan, shared, toxicity

from . import data
from .test_packing_ann import check_sequences
from .test_simhash import plain_components, plain_fingerprint


def test_stages_keep_what_a_plain_pipeline_keeps(spark, tmp_path):
    docs = spark.read.parquet(f"{data.SMALL}/documents.parquet")
    again = docs.limit(5)  # repeated rows
    hard = data.hard_docs(spark).withColumn("doc_id", F.col("doc_id") + 10_000_000)
    every = docs.unionByName(again).unionByName(hard)
    every.coalesce(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{data.SMALL}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    labels = shared.read_table(spark, str(tmp_path), "labels")
    kinds = now.dtypes
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [r.asDict() for r in now.collect()]
        out = stage(spark, now, str(tmp_path))
        if name == "packing":
            rows = [r.asDict() for r in out.collect()]
            break
        assert out.dtypes == kinds
        out.write.parquet(str(tmp_path / f"{k}"))
        out = spark.read.parquet(str(tmp_path / f"{k}"))
        after = [r.asDict() for r in out.collect()]
        if name == "quality":
            model = quality_pu.train(now, labels)
            verdict = {(r["doc_id"], r["score"] >= 0.7) for r in quality_pu.classify(now, model).collect()}
            want = [r for r in before if (r["doc_id"], True) in verdict]
        elif name == "toxicity":
            model = toxicity.train(now, labels)
            verdict = {(r["doc_id"], r["score"] >= 0.3) for r in toxicity.classify(now, model).collect()}
            want = [r for r in before if (r["doc_id"], False) in verdict]
        elif name == "dedup":
            fps = [plain_fingerprint(r["text"] or "") for r in before]
            group = plain_components(fps, list(range(len(before))))
            best = {}
            for g, r in zip(group, before):
                key = (r["doc_id"] is None, r["doc_id"] or 0)
                if g not in best or key < best[g]:
                    best[g] = key
            assert Counter((r["doc_id"] is None, r["doc_id"] or 0) for r in after) == Counter(best.values())
            texts = Counter((r["doc_id"], r["text"]) for r in before)
            want = after if all((r["doc_id"], r["text"]) in texts for r in after) else None
        else:
            want = [r | ({} if r["text"] is None else {"text": secret_scan.redacted(r["text"]),
                                                        "n_chars": len(secret_scan.redacted(r["text"]))}) for r in before]
        key = lambda r: str(sorted(r.items()))
        assert sorted(after, key=key) == sorted(want, key=key), name
        assert after, name
        now = out
    library = Tokenizer.from_file(shared.vocabulary("word_bpe_49k.json"))
    tokens = Counter()
    for r in before:
        tokens[r["doc_id"]] += 1 + len(library.encode(r["text"] or "", add_special_tokens=False).ids)
    packed = Counter()
    for r in rows:
        packed[r["doc_id"]] += r["length"]
    assert packed == tokens
    assert check_sequences(rows, 2048) <= np.ceil(1.02 * sum(tokens.values()) / 2048) + 1


def test_run_and_empty_input(spark, tmp_path):
    docs = spark.read.parquet(f"{data.SMALL}/documents.parquet")
    rows = corpus_pipeline.run(spark, data.SMALL).collect()
    assert rows and {r["doc_id"] for r in rows} <= {r["doc_id"] for r in docs.select("doc_id").collect()}
    docs.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{data.SMALL}/labels.parquet").limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 5 and corpus_pipeline.ORACLE_SQL is None
