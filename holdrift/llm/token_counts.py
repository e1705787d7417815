"""Token counts by heap-and-linked-list byte-pair merging.

A text is cut into pre-tokens; the bytes of each are the first symbols, held in a linked list. A
heap holds the adjacent pairs that merge, lowest rank first and leftmost among equals. The
lowest is popped and merged, and the pairs with the merged symbol's neighbours are pushed. The
count is the number of first symbols less the number of merges; no identifier is ever given out.

The file is one of the ``tokenizers`` library: a byte-level BPE without normaliser. Strings of
its added tokens count as one token wherever they stand in a text, as the library's default is.

Documents need no shuffle. Each task keeps the counts of the words it has seen, up to
``CACHED_WORDS``; then it starts anew. Words longer than ``CACHED_BYTES`` are not kept.

Defined results: a null or empty text has no bytes and no tokens. Rows come back one for one,
repeated ones too, under their doc_id (null stays null); an empty table gives an empty result.
Other columns are not returned. Texts are counted whole, whatever their length.
"""

import heapq
import json

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from holdrift.llm.byte_bpe import pre_tokens

CACHED_WORDS = 200_000
CACHED_BYTES = 64


def byte_characters() -> list:
    """The character that stands for each byte in the vocabulary.

    Printable bytes stand for themselves; the others take the characters from 256 on, in order.
    """
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class Merges:
    """Which adjacent symbols merge, at which rank and into what; and the added tokens."""

    def __init__(self, file: bytes):
        described = json.loads(file)
        model, cut = described["model"], described["pre_tokenizer"] or {}
        if (model.get("type", "BPE") != "BPE" or described["normalizer"] is not None or model.get("dropout")
                or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True)
                or model.get("ignore_merges") or model.get("continuing_subword_prefix")
                or model.get("end_of_word_suffix")):
            raise ValueError("only byte-level BPE without normaliser, prefix space and affixes is counted")
        numbers = model["vocab"]
        self.of_byte = [numbers[c] for c in byte_characters()]
        self.pairs = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.pairs[numbers[left], numbers[right]] = rank, numbers[left + right]
        added = [t for t in described["added_tokens"] if t["content"]]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise ValueError("added tokens that take their surroundings in are not counted")
        contents = sorted((t["content"] for t in added), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, contents))) if contents else None

    def count(self, word: bytes) -> int:
        """The number of tokens of one pre-token."""
        symbols = [self.of_byte[b] for b in word]
        n = count = len(symbols)
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        into = [-1] * n  # what the pair that starts at a place merges into
        heap, pairs = [], self.pairs

        def look_up(place):
            right = following[place]
            found = pairs.get((symbols[place], symbols[right])) if right < n else None
            if found is None:
                into[place] = -1
            else:
                into[place] = found[1]
                heapq.heappush(heap, (found[0], place, found[1]))

        for place in range(n - 1):
            look_up(place)
        while heap:
            _, place, merged = heapq.heappop(heap)
            if into[place] != merged:
                continue  # one of the two is gone
            gone = following[place]
            symbols[place], into[gone] = merged, -1
            following[place] = following[gone]
            if following[gone] < n:
                before[following[gone]] = place
            count -= 1
            look_up(place)
            if before[place] >= 0:
                look_up(before[place])
        return count


class _Counts(dict):
    """Counts of the words seen."""

    def __init__(self, merges):
        super().__init__()
        self.merges = merges

    def __missing__(self, word):
        data = word.encode()
        count = self.merges.count(data)
        if len(data) <= CACHED_BYTES:
            self[word] = count
        return count


def counted(documents: DataFrame, file: str, pattern: str, limit: int) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every document.

    ``file``: a local JSON file of the tokenizers library. ``pattern`` cuts a text into pre-tokens.
    """
    with open(file, "rb") as opened:
        shared = documents.sparkSession.sparkContext.broadcast(opened.read())

    def count(batches):
        merges, cut = Merges(shared.value), regex.compile(pattern)
        known = _Counts(merges)
        for batch in batches:
            counts = []
            for text in batch.column(1):
                text = text.as_py() or ""
                pieces = merges.added.split(text) if merges.added else [text]
                counts.append(len(pieces) - 1 + sum(
                    sum(map(known.__getitem__, pre_tokens(piece, cut))) for piece in pieces))
                if len(known) > CACHED_WORDS:
                    known.clear()
            n_tokens = pa.array(counts, pa.int64())
            n_bytes = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
            yield pa.record_batch([batch.column(0), n_bytes, n_tokens, pc.greater(n_tokens, limit)],
                                  names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    id_type = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", documents["text"].cast("string")).mapInArrow(
        count, f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean")
