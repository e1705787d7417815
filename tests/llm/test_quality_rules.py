import random
import re

from holdrift.llm import quality_rules
from build_llm import EDGES, documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text or "")
    places, windows = set(), {}
    for k in range(len(words) - 7):
        windows.setdefault(tuple(words[k:k + 8]), []).append(k)
    for found in windows.values():
        if len(found) > 1:
            places |= {p for k in found for p in range(k, k + 8)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    failed = len(words) < 20 or 100 * len(places) > 30 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(places), failed)


def test_base_counts(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abc") * rng.randrange(1, 3) for _ in range(n)) for n in (0, 7, 8, 9, 30, 200, 900)]
    texts += ["a b c\na b c\n \n \nx # $ <b>\x0b\x0c\r\n" * 3, "é ü x " * 30, " lead and trail \n"]
    rows = list(enumerate(texts)) + [(100 + k, t) for k, (_, t) in enumerate(EDGES)]
    found = quality_rules.judged(documents(spark, rows)).collect()
    assert len(found) == len(rows)
    wanted = {doc_id: base(text) for doc_id, text in rows}
    for r in found:
        assert wanted[r["doc_id"]] == (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"],
                                       r["n_repeat_words"], r["base_failed"])
        assert not (r["base_failed"] and r["kept"])


def test_divergence_and_its_guard(spark):
    rng = random.Random(2)
    words = quality_rules.COMMON_WORDS["en"] + ["tree", "house", "river", "stone"] * 4

    def text(n, tail=""):
        return " ".join(rng.choice(words) + tail for _ in range(n))

    rows = [(k, text(200)) for k in range(60)] + [(100, text(200, "%%%")), (101, text(200).upper()), (102, text(30, "%%%"))]
    found = {r["doc_id"]: r for r in quality_rules.judged(documents(spark, rows)).collect()}
    assert all(found[k]["kept"] for k in range(60))
    assert not found[100]["kept"] and not found[101]["kept"]
    assert found[102]["kept"] and found[102]["class_distance"] > 0.3  # too short to be judged


def test_null_and_unknown_languages(spark):
    rows = [(1, "word text " * 40, None, "s"), (2, "word text " * 40, "xx", "s"), (3, None, None, None)]
    found = {r["doc_id"]: r for r in quality_rules.judged(documents(spark, rows)).collect()}
    assert found[1]["word_distance"] is None and found[2]["word_distance"] is None
    assert found[3]["n_words"] == 0 and not found[3]["kept"]
    assert quality_rules.judged(documents(spark, rows).limit(0)).count() == 0


def test_characters_beyond_ascii_count_once(spark):
    found = quality_rules.counts(documents(spark, [(1, "é漢😀 Ab1! # x")])).first()
    assert found["class_counts"] == [1, 2, 1, 3, 3, 2] and sum(found["class_counts"]) == len("é漢😀 Ab1! # x")


def test_no_words_and_no_distance(spark):
    rows = [(1, " \n "), (2, "the tree of words " * 30)]
    found = {r["doc_id"]: r for r in quality_rules.judged(documents(spark, rows)).collect()}
    assert found[1]["class_distance"] is not None and found[1]["word_distance"] is None
    found = {r["doc_id"]: r for r in quality_rules.judged(documents(spark, [(1, ""), (2, None)])).collect()}
    assert all(r["class_distance"] is None and r["word_distance"] is None for r in found.values())


def test_texts_without_common_words_are_rejected(spark):
    """Real proportions: a fifth of the words are common ones; menus and lists of names hold none."""
    rng = random.Random(5)
    common = quality_rules.COMMON_WORDS["en"]
    rare = [f"{a}{b}{c}" for a in "bdfgl" for b in "aeiou" for c in "nrstk"]

    def text(n, share):
        return " ".join(rng.choice(common) if rng.random() < share else rng.choice(rare) for _ in range(n))

    rows = [(k, text(150, 0.2)) for k in range(60)]
    rows += [(100 + k, text(150, 0.0)) for k in range(5)] + [(200, text(60, 0.0))]
    found = {r["doc_id"]: r for r in quality_rules.judged(documents(spark, rows)).collect()}
    assert all(found[k]["kept"] for k in range(60)) and not any(found[100 + k]["kept"] for k in range(5))
    assert found[200]["kept"]  # too short for the word rule
    assert all(found[100 + k]["class_distance"] < 0.3 for k in range(5))


def test_no_python_in_the_plan(spark):
    plan = quality_rules.counts(documents(spark, EDGES))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
