import random
import re

import pytest

from holdrift.llm import decontaminate
from build_llm import EDGES, documents, sentence

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_force(rows, items, length=10):
    runs = {}
    for item, text in items:
        words = words_of(text)
        for k in range(max(1, len(words) - length + 1) if words else 0):
            runs.setdefault(tuple(words[k:k + length]), set()).add(item)
    found = []
    for doc_id, text in rows:
        words, hit, hit_items = words_of(text), set(), set()
        for n in {len(r) for r in runs}:
            for k in range(len(words) - n + 1):
                if tuple(words[k:k + n]) in runs:
                    hit |= set(range(k, k + n))
                    hit_items |= runs[tuple(words[k:k + n])]
        found.append((doc_id, len(words), len(hit), sorted(map(str, hit_items)), bool(hit)))
    return found


def texts(seed=2):
    rng = random.Random(seed)
    items = [(k, sentence(rng, rng.randrange(1, 40), 60)) for k in range(20)] + [
        (50, "the the the the the the the the the the the"), (51, ""), (52, None), (53, "Öl, ÉTÉ 9")]
    rows = []
    for k in range(60):
        parts = [sentence(rng, rng.randrange(5, 60), 60)]
        for _ in range(rng.randrange(3)):
            parts.insert(rng.randrange(2), items[rng.randrange(20)][1].upper() + ".")
        rows.append((k, " ; ".join(parts)))
    return rows + [(70, "The " * 25), (71, "öl, Été; 9"), (72, "Öl  ÉTÉ-9 Öl  ÉTÉ-9")], items


def item_table(spark, items):
    return spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id", "2 AS phrase")


def shown(found):
    return sorted((r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"], r["contaminated"]) for r in found.collect())


def test_same_as_brute_force(spark):
    rows, items = texts()
    found = decontaminate.decontaminated(documents(spark, rows), item_table(spark, items))
    assert shown(found) == sorted(brute_force(rows, items))


@pytest.mark.parametrize("length", [2, 4])
def test_other_lengths(spark, length):
    rows, items = texts(4)
    found = decontaminate.decontaminated(documents(spark, rows), item_table(spark, items), length)
    assert shown(found) == sorted(brute_force(rows, items, length))


def test_proximity(spark):
    """Every other term of the phrase stands within the distance of its rarest term."""
    rows = [(1, "alpha beta x x x gamma"), (2, "gamma alpha beta"), (3, "alpha x x x x x x x beta gamma"), (4, "alpha beta")]
    phrases = decontaminate.phrases_of(item_table(spark, [(1, "alpha beta gamma")]))
    index = decontaminate.build_index(documents(spark, rows), phrases.vocabulary)
    near = {d: {r["doc_id"] for r in decontaminate.proximity_matches(index, phrases, d).collect()} for d in (2, 5, 9)}
    assert near == {2: {2}, 5: {1, 2}, 9: {1, 2, 3}}


def test_edges(spark):
    items = [(1, "one"), (2, "the same text of nine words stands here twice"), (2, "two words"), (None, "two words")]
    found = decontaminate.decontaminated(documents(spark, EDGES), item_table(spark, items)).collect()
    assert len(found) == len(EDGES)
    by_id = {r["doc_id"]: r for r in found if r["doc_id"] is not None}
    assert by_id[4]["n_hit"] == 1 and by_id[8]["item_ids"] == ["2"] and not by_id[1]["contaminated"]
    assert by_id[6]["n_words"] == 60000
    none = [r for r in found if r["doc_id"] is None]
    assert sorted((r["n_words"], r["contaminated"], r["item_ids"]) for r in none) == [
        (0, False, []), (2, True, ["", "2"])]
    kept = decontaminate.rows_of_clean_texts(documents(spark, EDGES), item_table(spark, items))
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 3, 5, 6, 7]
    assert kept.columns == documents(spark, EDGES).columns


def test_rows_with_null_or_repeated_ids(spark):
    """No phrase is put together from the words of different rows, and no row goes for another's hit."""
    half, rest = "x x x x x six seven eight nine ten", "one two three four five y y y y y"
    item = "one two three four five six seven eight nine ten"
    rows = [(None, half), (None, rest), (1, half), (1, rest), (2, item), (2, "clean"), (None, "zzz " + item)]
    items = item_table(spark, [(7, item)])
    found = decontaminate.decontaminated(documents(spark, rows[:4]), items).collect()
    assert [r["n_hit"] for r in found] == [0, 0, 0, 0] and not any(r["contaminated"] for r in found)
    table = documents(spark, rows)
    assert shown(decontaminate.decontaminated(table.where("doc_id IS NOT NULL"), items)) == sorted(
        brute_force([r for r in rows if r[0] is not None], [(7, item)]))
    found = decontaminate.decontaminated(table, items).collect()
    assert sorted((r["n_words"], r["n_hit"]) for r in found if r["doc_id"] is None) == [(10, 0), (10, 0), (11, 10)]
    kept = decontaminate.rows_of_clean_texts(table, items)
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect()) == sorted(
        (k or 0, t) for k, t in rows if item not in t)
    assert kept.columns == table.columns


def test_empty_tables(spark):
    docs, items = documents(spark, EDGES), item_table(spark, [(1, "one")])
    assert decontaminate.decontaminated(docs.limit(0), items).count() == 0
    assert not any(r["contaminated"] for r in decontaminate.decontaminated(docs, items.limit(0)).collect())
