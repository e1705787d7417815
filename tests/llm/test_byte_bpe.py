import base64
import hashlib

import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken

from holdrift.llm import byte_bpe, op2_query
from build_llm import EDGES, documents

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def one_by_one(text, vocab):
    """Merges the leftmost pair of the lowest rank, again and again, in each pre-token."""
    found = []
    for word in byte_bpe.pre_tokens(text, regex.compile(public_tokenizers.PATTERN)):
        tokens = [bytes([b]) for b in word.encode()]
        ranks = {t: r for r, t in enumerate(vocab.tokens) if t}
        while len(tokens) > 1:
            rank, k = min((ranks.get(tokens[k] + tokens[k + 1], 10 ** 9), k) for k in range(len(tokens) - 1))
            if rank == 10 ** 9:
                break
            tokens[k:k + 2] = [tokens[k] + tokens[k + 1]]
        found += [ranks[t] for t in tokens]
    return found


TEXTS = ["aaaaaaaaaaaa aaa aa a", "It's they'll WE'VE", "  two  spaces \n\n\t end ", "日本語のテキスト", "\U0001f600\U0001f600x",
         "<|endoftext|>", "a\U00010ee7b \U00010ee7\U00010ee7a", "x" * 5000, "0123456789" * 30, "\x00\x1c\x85\xa0 é"]


def test_same_ids_as_library_and_as_single_merges(spark, library):
    with open(RANKS, "rb") as file:
        vocab = byte_bpe.vocabulary(file.read())
    found = byte_bpe.encoded(documents(spark, list(enumerate(TEXTS))), RANKS, public_tokenizers.PATTERN).collect()
    for row in found:
        assert row["token_ids"] == library.encode_ordinary(TEXTS[row["doc_id"]])
        if len(TEXTS[row["doc_id"]]) < 200:
            assert row["token_ids"] == one_by_one(TEXTS[row["doc_id"]], vocab)


def test_documents_and_round_trip(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    digest = lambda data: hashlib.sha256(data).hexdigest()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for row in op2_query.op2_byte_bpe(spark, "/root/testdata/sf0.001").collect():
        ids = library.encode_ordinary(texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == digest(",".join(map(str, ids)).encode())
        assert row["decoded_sha256"] == digest(texts[row["doc_id"]].encode())


def test_edges(spark):
    rows = op2_query.digests(documents(spark, EDGES)).collect()
    assert len(rows) == len(EDGES)
    by_id = {}
    for row in rows:
        by_id.setdefault(row["doc_id"], []).append(row)
    assert by_id[1][0]["n_tokens"] == by_id[2][0]["n_tokens"] == 0
    assert by_id[4][0] == by_id[4][1] and len(by_id[None]) == 2
    assert by_id[6][0]["decoded_sha256"] == hashlib.sha256(("word " * 60000).encode()).hexdigest()
    assert op2_query.digests(documents(spark, EDGES).limit(0)).count() == 0


def test_blocks_do_not_change_ids(spark, monkeypatch):
    block = byte_bpe._Block()
    with open(RANKS, "rb") as file:
        vocab = byte_bpe.vocabulary(file.read())
    cut = regex.compile(public_tokenizers.PATTERN)
    for k, text in enumerate(TEXTS):
        block.add(k, text, cut)
    together = [r for b in block.batches(vocab, pa.int64()) for r in b.column(1).to_pylist()]
    for k, text in enumerate(TEXTS):
        alone = byte_bpe._Block()
        alone.add(k, text, cut)
        assert together[k] == [r for b in alone.batches(vocab, pa.int64()) for r in b.column(1).to_pylist()][0]


def test_decoded_rows_in_small_batches(spark, monkeypatch):
    """Batches are cut by bytes; a text above the bound is a batch of its own, and empty ones get lost nowhere."""
    monkeypatch.setattr(byte_bpe, "BYTES_OUT", 50)
    texts = ["", "a b", "long " * 30, "", None, "x" * 50, "é" * 40, "end", ""] * 3
    tokens = byte_bpe.encoded(documents(spark, list(enumerate(texts))).coalesce(1), RANKS, public_tokenizers.PATTERN)
    found = {r["doc_id"]: bytes(r["bytes"]).decode() for r in byte_bpe.decoded(tokens, RANKS).collect()}
    assert found == {k: text or "" for k, text in enumerate(texts)}
