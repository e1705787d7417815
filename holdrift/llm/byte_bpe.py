"""Byte-level BPE: encoding by merge replay, and decoding.

Encoding takes the distinct pre-tokens of a block of documents as one corpus. An inverted
index holds, for each mergeable pair of tokens, the places where the pair stands. The merges
are replayed in rank order: all places of the lowest pending rank are merged at once, and only
the pairs with the merged token's neighbours are looked up again and put into the index. So
a merge costs what it touches, and each distinct pre-token is merged once per block.

A block is what one task reads, up to ``BLOCK_CHARS`` characters: the documents need no
shuffle, memory is bounded by the block, and a lost task is repeated on its own.

Defined results: a null or empty text has no tokens, and no tokens decode to no bytes. Rows come
back one for one, repeated ones too, under their doc_id (null stays null); an empty table gives an empty
result. Other columns are not returned. Texts are encoded whole, whatever their length.
"""

import base64
import collections
import functools
import heapq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from holdrift.llm.memory import frugal

BLOCK_CHARS = 10_000_000
ROWS_OUT = 1000
BYTES_OUT = 64 << 20  # of decoded texts in one batch
# Letters and numbers that were assigned after Unicode 16. The tiktoken library takes
# them for neither; the regex library knows them already.
LATER_LETTERS = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F),
    (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD),
    (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959),
    (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9),
    (0x11DF1, 0x11DF1), (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8),
    (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20),
    (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168),
    (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF),
    (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4),
    (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479),
    (0x3D000, 0x3FC3F))
_LATER = regex.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in LATER_LETTERS) + "]")
NONE = np.int32(2 ** 31 - 1)  # the rank of a pair that does not merge


class Vocabulary:
    """Token bytes by rank, and which pairs of tokens merge into which."""

    def __init__(self, file: bytes):
        ranks = {}
        for line in file.splitlines():
            if line.strip():
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
        size = max(ranks.values()) + 1
        self.tokens = [b""] * size
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                left, right = ranks.get(token[:k]), ranks.get(token[k:])
                if left is not None and right is not None:
                    pairs[left * size + right] = rank
        self.size = size
        self.keys = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[k] for k in sorted(pairs)] + [NONE], np.int32)
        self.bytes = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank each pair of tokens merges into, or NONE."""
        wanted = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.keys, wanted)
        found = self.merged[np.minimum(at, len(self.keys))]
        found[self.keys[np.minimum(at, len(self.keys) - 1)] != wanted] = NONE
        return found


@functools.lru_cache(maxsize=4)
def vocabulary(file: bytes) -> Vocabulary:
    return Vocabulary(file)


def pre_tokens(text: str, pattern) -> list:
    """The matches of the pattern, with letters assigned later taken for private characters."""
    if text.isascii() or not _LATER.search(text):
        return pattern.findall(text)
    spans = (match.span() for match in pattern.finditer(_LATER.sub("\ue000", text)))
    return [text[a:b] for a, b in spans]


def _leftmost(places: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Of places that overlap in a chain (as in aaa), every other one from the left."""
    if len(places) < 2:
        return places
    chained = np.concatenate([[False], following[places[:-1]] == places[1:]])
    if not chained.any():
        return places
    index = np.arange(len(places))
    run_start = np.maximum.accumulate(np.where(chained, 0, index))
    return places[(index - run_start) % 2 == 0]


def merge_replay(words: list, vocab: Vocabulary):
    """Token ids of all words, concatenated, and how many each word has."""
    lengths = np.array([len(w) for w in words], np.int64)
    tokens = vocab.of_byte[np.frombuffer(b"".join(words), np.uint8)]
    n = len(tokens)
    if n == 0:
        return tokens, np.zeros(len(words), np.int64)
    # Linked lists: the neighbours of each place, -1 at the ends of a word.
    ends = np.cumsum(lengths)
    following = np.arange(1, n + 1)
    following[ends[lengths > 0] - 1] = -1
    before = np.arange(-1, n - 1)
    before[(ends - lengths)[lengths > 0]] = -1
    alive = np.ones(n, bool)
    pending = np.full(n, NONE, np.int32)
    index = collections.defaultdict(list)
    heap = []

    def look_up(places):
        """Ranks of the pairs that start at the places; mergeable ones go into the index."""
        linked = places[following[places] >= 0]
        pending[places] = NONE
        ranks = vocab.rank(tokens[linked], tokens[following[linked]])
        pending[linked] = ranks
        mergeable = ranks != NONE
        linked, ranks = linked[mergeable], ranks[mergeable]
        order = np.argsort(ranks, kind="stable")
        linked, ranks = linked[order], ranks[order]
        cuts = np.flatnonzero(np.diff(ranks)) + 1
        for part in np.split(linked, cuts) if len(linked) else ():
            rank = int(pending[part[0]])
            if rank not in index:
                heapq.heappush(heap, rank)
            index[rank].append(part)

    look_up(np.arange(n))
    while heap:
        rank = heapq.heappop(heap)
        places = np.unique(np.concatenate(index.pop(rank)))
        places = places[alive[places] & (pending[places] == rank)]
        left = _leftmost(places, following)
        if not len(left):
            continue
        right = following[left]
        after = following[right]
        tokens[left] = rank
        following[left] = after
        before[after[after >= 0]] = left[after >= 0]
        alive[right] = False
        pending[right] = NONE
        neighbours = before[left]
        look_up(np.unique(np.concatenate([left, neighbours[neighbours >= 0]])))
    word_of = np.repeat(np.arange(len(words)), lengths)
    return tokens[alive], np.bincount(word_of[alive], minlength=len(words))


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of the ranges [start, start + length), one after the other."""
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - before, lengths)


class _Block:
    """Documents whose pre-tokens are encoded together."""

    def __init__(self):
        self.ids, self.parts, self.chars = [], [], 0
        self.words = collections.defaultdict()
        self.words.default_factory = self.words.__len__

    def add(self, doc_id, text, pattern):
        found = pre_tokens(text, pattern) if text else []
        self.ids.append(doc_id)
        self.parts.append(np.fromiter(map(self.words.__getitem__, found), np.int32, len(found)))
        self.chars += len(text or "")

    def batches(self, vocab, id_type):
        tokens, counts = merge_replay([w.encode() for w in self.words], vocab)
        starts = np.cumsum(counts) - counts
        for k in range(0, len(self.ids), ROWS_OUT):
            parts = self.parts[k:k + ROWS_OUT]
            words = np.concatenate(parts) if parts else np.zeros(0, np.int32)
            values = tokens[_spread(starts[words], counts[words])]
            ends = np.concatenate([[0], np.cumsum(counts[words])])
            rows = ends[np.concatenate([[0], np.cumsum([len(p) for p in parts])])]
            lists = pa.ListArray.from_arrays(pa.array(rows, pa.int32()), pa.array(values, pa.int32()))
            yield pa.record_batch(
                [pa.array(self.ids[k:k + ROWS_OUT], id_type), lists], names=["doc_id", "token_ids"])


def encoded(documents: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """doc_id and token_ids of every document, without special tokens.

    ``rank_file``: a local file of base64 tokens and ranks. ``pattern`` cuts a text into pre-tokens.
    """
    context = documents.sparkSession.sparkContext
    with open(rank_file, "rb") as file:
        shared = context.broadcast(file.read())

    def encode(batches):
        vocab, cut, block = vocabulary(shared.value), regex.compile(pattern), _Block()
        for batch in batches:
            id_type = batch.column(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                block.add(doc_id, text.as_py(), cut)
                if block.chars >= BLOCK_CHARS:
                    yield from block.batches(vocab, id_type)
                    block = _Block()
        if block.ids:
            yield from block.batches(vocab, id_type)

    id_type = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(frugal(encode), f"doc_id {id_type}, token_ids array<int>")


def decoded_bytes(values: np.ndarray, vocab: Vocabulary) -> tuple:
    """All bytes of the tokens, and how many each token has."""
    lengths = vocab.lengths[values]
    return vocab.bytes[_spread(vocab.starts[values], lengths)], lengths


def decoded(tokens: DataFrame, rank_file: str) -> DataFrame:
    """doc_id, token_ids and the bytes the ids stand for."""
    context = tokens.sparkSession.sparkContext
    with open(rank_file, "rb") as file:
        shared = context.broadcast(file.read())

    def decode(batches):
        vocab = vocabulary(shared.value)
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(k, ROWS_OUT)
                lists = part.column(1).fill_null([])
                values = lists.flatten().to_numpy(zero_copy_only=False)
                counts = lists.value_lengths().to_numpy(zero_copy_only=False)
                ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
                sizes = np.concatenate([[0], np.cumsum(vocab.lengths[values], dtype=np.int64)])[ends]
                start = 0
                while start < len(lists):  # rows of about BYTES_OUT, so that 32-bit offsets hold
                    stop = max(start + 1, int(np.searchsorted(sizes, sizes[start] + BYTES_OUT, "right")) - 1)
                    all_bytes, _ = decoded_bytes(values[ends[start]:ends[stop]], vocab)
                    if len(all_bytes) > np.iinfo(np.int32).max:
                        raise OverflowError("a decoded text of more than 2 GB does not fit into a row")
                    offsets = (sizes[start:stop + 1] - sizes[start]).astype(np.int32)
                    binary = pa.Array.from_buffers(
                        pa.binary(), stop - start, [None, pa.py_buffer(offsets), pa.py_buffer(all_bytes)])
                    rows = part.slice(start, stop - start)
                    yield pa.record_batch([rows.column(0), rows.column(1), binary],
                                          names=["doc_id", "token_ids", "bytes"])
                    start = stop

    id_type = tokens.schema["doc_id"].dataType.simpleString()
    return tokens.select("doc_id", "token_ids").mapInArrow(
        frugal(decode), f"doc_id {id_type}, token_ids array<int>, bytes binary")
