import collections

import numpy as np
import pytest

from holdrift.llm import jaccard_join
from holdrift.llm.components import components
from build_llm import EDGES, documents, near_copies


def shingles_of(text, length):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    width = min(length, len(words))
    return frozenset(tuple(words[k:k + width]) for k in range(len(words) - width + 1))


def brute_force(rows, like):
    """(n_shingles, component) of each row, from all pairs."""
    sets = [shingles_of(text, like.length) for _, text in rows]
    label = list(range(len(rows)))

    def top(k):
        while label[k] != k:
            k = label[k]
        return k

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= like.percent * len(a | b):
                label[max(top(i), top(j))] = min(top(i), top(j))
    ids = collections.defaultdict(list)
    for k, (doc_id, _) in enumerate(rows):
        ids[top(k)].append(doc_id)
    found = []
    for k, (doc_id, _) in enumerate(rows):
        known = [i for i in ids[top(k)] if i is not None]
        found.append((doc_id, len(sets[k]), min(known) if known and sets[k] else doc_id if not sets[k] else None))
    return found


def shown(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, x) for x in r))


@pytest.mark.parametrize("length,percent,size", [(3, 90, 256), (5, 80, 4), (3, 90, 3), (1, 60, 5)])
def test_components_of_all_pairs(spark, monkeypatch, length, percent, size):
    """Also with tiny groups, so that groups are dealt out and opened from outside."""
    monkeypatch.setattr(jaccard_join, "GROUP_SIZE", size)
    like = jaccard_join.Similarity(length, percent)
    rows = list(enumerate(near_copies(seed=length)))
    assert shown(jaccard_join.joined(documents(spark, rows), like).collect()) == shown(brute_force(rows, like))


def test_hot_tokens_do_not_change_the_result(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "HOT_FROM", 1)
    like = jaccard_join.Similarity(3, 80)
    passage = " ".join(f"p{k}" for k in range(40))
    rows = [(k, f"{passage} {text}") for k, text in enumerate(near_copies(seed=9, families=5))]
    assert shown(jaccard_join.joined(documents(spark, rows), like).collect()) == shown(brute_force(rows, like))


def test_edges(spark):
    like = jaccard_join.Similarity(3, 90)
    assert shown(jaccard_join.joined(documents(spark, EDGES), like).collect()) == shown(brute_force(EDGES, like))
    assert jaccard_join.joined(documents(spark, EDGES).limit(0), like).count() == 0


def test_one_of_each(spark):
    found = jaccard_join.one_of_each(documents(spark, EDGES), jaccard_join.Similarity(3, 90))
    ids = [r["doc_id"] for r in found.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 3, 4, 5, 6, 7, 8] and ids.count(None) == 2
    assert found.columns == documents(spark, EDGES).columns


def test_one_of_each_by_row(spark):
    """A text stays though its repeated id has a copy elsewhere; rows without id lose copies only."""
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (2, "another text that has no copy"), (2, "a b c d e f"),
            (None, "a b c d e f"), (None, "g h i j k l"), (None, "g h i j k l"), (None, ""), (None, "")]
    found = jaccard_join.one_of_each(documents(spark, rows), jaccard_join.Similarity(3, 90))
    assert sorted((r["doc_id"] or 0, r["text"]) for r in found.collect()) == [
        (0, ""), (0, ""), (0, "g h i j k l"), (1, "a b c d e f"), (2, "another text that has no copy")]


def test_components_of_paths_and_stars(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(200, 201), (7, 7)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {found[k] for k in range(41)} == {0} and {found[100 + k] for k in range(30)} == {100}
    assert found[201] == 200
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_intersections_in_slices(monkeypatch):
    monkeypatch.setattr(jaccard_join, "_MATRIX_CELLS", 40)
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64)) for _ in range(12)]
    found = jaccard_join.intersections(sets[:5], sets[5:])
    assert found.tolist() == [[len(np.intersect1d(a, b)) for b in sets[5:]] for a in sets[:5]]
