import base64
import hashlib

import public_tokenizers
import tiktoken

import corpus_pipeline
from holdrift.llm import importance, jaccard_join
from holdrift.llm.tables import stored
from build_llm import EDGES, documents
from test_decontaminate import brute_force as hits
from test_jaccard_join import brute_force as groups

FOLDER = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(stored(stage(spark, kept[-1], FOLDER)))
        assert kept[-1].columns == docs.columns
    rows = [[(r["doc_id"], r["text"]) for r in d.collect()] for d in kept]
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    sampled = {r["doc_id"] for r in importance.judged(docs, labels).where("kept").collect()}
    assert {r[0] for r in rows[1]} == sampled
    assert {r[0] for r in rows[2]} <= {r[0] for r in rows[1]} and len(rows[2]) >= 0.99 * len(rows[1])
    wanted = {c for _, _, c in groups(rows[2], jaccard_join.Similarity(5, 80))}
    assert {r[0] for r in rows[3]} == wanted
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert {r[0] for r in rows[4]} == {h[0] for h in hits(rows[3], items) if not h[4]}

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    final = {r["doc_id"]: r for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert set(final) == {r[0] for r in rows[4]}
    for doc_id, text in rows[4]:
        assert final[doc_id]["token_ids"] == library.encode_ordinary(text)
        assert final[doc_id]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_edges(spark, tmp_path):
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    documents(spark, EDGES).write.parquet(f"{tmp_path}/documents.parquet")
    ids = [r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert not {1, 2, 3, 9} & set(ids) and 6 in ids and ids.count(4) <= 1


def test_empty_documents(spark, tmp_path):
    for name in ("labels", "benchmark", "documents"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
