import corpus_pipeline
import brute
import public_tokenizers
import pyarrow.parquet as pq
import sentencepiece

from tidewatch.llm import quality
from tidewatch.llm.registry import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def test_each_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    bench = pq.read_table(f"{SF}/benchmark.parquet").to_pylist()
    items = [(x["item_id"], x["text"]) for x in bench]
    before = {r["doc_id"]: r for r in docs.collect()}
    model = quality.trained(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = {r["id"]: r["score"] for r in quality.quality(docs, model).collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, SF).toArrow())
        rows = docs.collect()
        after = {r["doc_id"]: r for r in rows}
        assert len(after) == len(rows)
        if name != "tokens":
            assert docs.columns == columns
        if name == "quality":
            assert set(after) == {i for i in before if scores[i] >= quality.KEEP}
        elif name == "exact_dedup":
            last = {}
            for i, r in before.items():
                last[brute.fold(r["text"])] = max(i, last.get(brute.fold(r["text"]), i))
            assert set(after) == set(last.values())
        elif name == "near_dedup":
            near = brute.near_components([(i, r["text"]) for i, r in before.items()], 5, 80, 100)
            assert set(after) == {i for i, (_, c) in near.items() if i == c}
        elif name == "decontamination":
            for i, r in before.items():
                n, hit, _ = brute.contamination(r["text"], items, 10)
                if hit <= 0.5 * n:
                    assert len(brute.words(after[i]["text"])) == n - hit
                    assert (after[i]["text"] == r["text"]) == (hit == 0)
                    assert after[i]["n_chars"] == len(after[i]["text"]) or not hit
                else:
                    assert i not in after
        else:
            library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(corpus_pipeline.TOKENIZER))
            assert set(after) == set(before)
            assert all(r["token_ids"] == library.encode(r["text"]) and r["n_tokens"] == len(r["token_ids"]) for r in rows)
        before = after


def test_registered():
    assert len([n for n in QUERIES if n.startswith("op")]) == 10 and "pipeline" in QUERIES
    assert set(ORACLE_SQL) <= set(QUERIES)
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
