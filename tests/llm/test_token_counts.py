"""Token counts against the tokenizers library."""

import itertools
import random

import public_tokenizers
import pytest
import regex
from tokenizers import Tokenizer

from holdrift.llm import op11_query, token_counts
from holdrift.llm.byte_bpe import pre_tokens
from tests.llm.build_llm import EDGES, documents

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(op11_query.FILE)


@pytest.fixture(scope="module")
def merges():
    with open(op11_query.FILE, "rb") as file:
        return token_counts.Merges(file.read())


def counted(spark, rows):
    found = token_counts.counted(documents(spark, rows), op11_query.FILE, public_tokenizers.PATTERN, 512)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    return found.collect()


def test_all_code_points(library, merges):
    """Cuts at every code point, and counts at every sixteenth."""
    cut = regex.compile(public_tokenizers.PATTERN)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for texts in (points[k:k + 4096] for k in range(0, len(points), 4096)):
        text = "".join(f"a{c}1{c}! {c} " for c in texts)
        ends = [end for _, (_, end) in library.pre_tokenizer.pre_tokenize_str(text)]
        words = pre_tokens(text, cut)
        assert ends == list(itertools.accumulate(map(len, words)))
        text = "".join(f"{c}1{c}" for c in texts[::16])
        assert sum(merges.count(w.encode()) for w in pre_tokens(text, cut)) == len(
            library.encode(text, add_special_tokens=False).ids)


def test_whole_table(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    found = op11_query.op11_token_counts(spark, FOLDER).collect()
    assert len(found) == len(texts)
    for row in found:
        n = len(library.encode(texts[row.doc_id] or "", add_special_tokens=False).ids)
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len((texts[row.doc_id] or "").encode()), n, n > 512)


def test_random_and_long_words(spark, library):
    rng = random.Random(3)
    letters = ["a", "b", "th", "e", " ", "  ", "\n", "é", "ß", "漢", "😀", "'s", "1", "!", "<|endoftext|>", "ing"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(400)]
    texts += ["ab" * 20000, "x" * 30001, " " * 5000, "the " * 40000, "<|endoftext|>" * 3, "a <|endoftext|> b<|endoftext|",
              "  <|endoftext|>  ", "<|endoftext|><|endoftext|> x"]
    found = {r.doc_id: r.n_tokens for r in counted(spark, list(enumerate(texts)))}
    assert found == {k: len(library.encode(t, add_special_tokens=False).ids) for k, t in enumerate(texts)}


def test_edges(spark, library):
    found = counted(spark, EDGES)
    assert len(found) == len(EDGES)
    expected = [(k, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for k, t in EDGES]
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in found), key=str) == sorted(expected, key=str)
    assert counted(spark, []) == []


def test_limit_and_cache(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "CACHED_WORDS", 1)
    monkeypatch.setattr(token_counts, "CACHED_BYTES", 2)
    found = token_counts.counted(documents(spark, [(1, "a b c"), (2, "a b")]), op11_query.FILE,
                                 public_tokenizers.PATTERN, 2)
    assert {r.doc_id: r.over_limit for r in found.collect()} == {1: True, 2: False}


def test_other_kinds_are_refused():
    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as file, pytest.raises(ValueError):
        token_counts.Merges(file.read())
