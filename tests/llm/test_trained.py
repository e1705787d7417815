"""Language identification, LM scoring and importance resampling."""

import collections
import math
import random

import numpy as np
from pyspark.sql import functions as F

from holdrift.llm import importance, language_id, lm_scoring
from build_llm import EDGES, documents

FOLDER = "/root/testdata/sf0.01"


def evidence(docs):
    return docs.select("doc_id", "text", F.col("lang").alias("declared"), F.col("source").alias("host"))


def test_language_of_held_out_texts(spark):
    """Without their declarations, held-out documents are told by text and host alone."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    hidden = F.col("doc_id") % 3 == 0
    found = language_id.judged(evidence(docs).withColumn("declared", F.when(~hidden, F.col("declared"))))
    found = found.where("doc_id % 3 = 0").join(docs.select("doc_id", "lang"), "doc_id")
    assert found.where("language = lang").count() >= 0.99 * found.count()


def trigram_likelihoods(rows, text, languages):
    """log p(text | language) from counted trigrams, without the code under test."""
    def grams(text):
        data = text.lower().encode()
        return [(int.from_bytes(data[k:k + 3], "big") * 2654435761 % 2 ** 32) >> 17 for k in range(len(data) - 2)]

    found = []
    for language in languages:
        counted = collections.Counter(g for r in rows if r[2] == language for g in grams(r[1]))
        total = sum(counted.values()) + 0.5 * 2 ** 15
        found.append(sum(math.log((counted[g] + 0.5) / total) for g in grams(text)))
    return np.array(found)


def test_all_languages_are_kept(spark, monkeypatch):
    """A hundred languages, one of them of two documents, in several passes; a blank declaration is none."""
    rng = random.Random(8)
    texts, k = [], 0
    for language in range(100):
        words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(8)]
        for _ in range(2 if language == 7 else 4):
            texts.append((k, " ".join(rng.choice(words) for _ in range(60)), f"l{language:02}", f"host{language}.org"))
            k += 1
    texts += [(900, texts[0][1], "", " "), (901, texts[0][1], " ", None)]
    table = evidence(documents(spark, texts)).repartition(3)
    found = {r["doc_id"]: r for r in language_id.judged(table).collect()}
    assert all(found[k]["language"] == declared and found[k]["kept"] for k, _, declared, _ in texts[:-2])
    assert found[900]["language"] == "l00" and found[900]["declared"] is None and found[901]["language"] == "l00"
    monkeypatch.setattr(language_id, "LANGUAGES_AT_ONCE", 30)
    again = {r["doc_id"]: r for r in language_id.judged(table).collect()}
    assert all(again[k]["language"] == r["language"] and math.isclose(again[k]["confidence"], r["confidence"])
               for k, r in found.items())


def test_evidence_is_fused(spark):
    """The product of likelihood, trust and smoothed priors, computed by hand for every row."""
    rng = random.Random(3)
    words = {"aa": ["kala", "maro", "tipu"], "bb": ["szcz", "wrth", "blyn"]}
    rows = []
    for k in range(60):
        lang = "aa" if k % 3 else "bb"
        rows.append((k, " ".join(rng.choice(words[lang]) for _ in range(12)), lang if k % 7 else "aa",
                     ["www.one.org", "two.one.org", "plain"][k % 3]))
    rows += [(100, "kala wrth", None, "www.one.org"), (101, "kala wrth", "bb", "new.one.org"), (102, "maro", "bb", None)]
    fusion = language_id.Fusion()
    table = evidence(documents(spark, rows))
    model = language_id.fitted(table, fusion)
    found = {r["doc_id"]: r for r in language_id.judged(table, fusion).collect()}
    like = {r[0]: trigram_likelihoods(rows, r[1], model.languages) for r in rows}
    best = {k: int(np.argmax(v)) for k, v in like.items()}
    n = len(model.languages)

    def counts(match, own):
        return np.bincount([best[r[0]] for r in rows if match(r) and r[0] != own], minlength=n).astype(float)

    kinds = len({r[2] for r in rows if r[2]})
    for k, text, declared, host in rows:
        every = counts(lambda r: r[3] is not None or True, k)
        prior = (every + 1) / (every.sum() + n)
        levels = []
        if host:
            if "." in host:
                levels = [lambda r: r[3] and r[3].endswith(".org"), lambda r: r[3] and r[3].endswith("one.org")]
            else:
                levels = [lambda r: r[3] == host]
            levels.append(lambda r: r[3] == host)
        for level in levels:
            c = counts(level, k)
            prior = (c + fusion.host_weight * prior) / (c.sum() + fusion.host_weight)
        trust = np.ones(n)
        if declared:
            trust = (counts(lambda r: r[2] == declared, k) + 1) / (every + kinds)
        score = like[k] * fusion.tempering + np.log(prior) + np.log(trust)
        post = np.exp(score - score.max()) / np.exp(score - score.max()).sum()
        assert found[k]["language"] == model.languages[int(np.argmax(score))]
        assert math.isclose(found[k]["confidence"], post.max(), rel_tol=1e-9)


def test_language_edges(spark):
    docs = documents(spark, EDGES + [(20, "text", None, None), (21, None, None, None)])
    found = language_id.judged(evidence(docs)).collect()
    assert len(found) == len(EDGES) + 2
    assert all(r["language"] == "und" and not r["kept"] for r in found if r["doc_id"] in (1, 2, 21))
    kept = language_id.identified(docs)
    assert kept.columns == docs.columns and 1 not in [r["doc_id"] for r in kept.collect()]
    assert language_id.identified(docs.limit(0)).count() == 0
    none = language_id.judged(evidence(docs).withColumn("declared", F.lit(None).cast("string"))).collect()
    assert {r["language"] for r in none} == {"und"}


def by_hand(texts, chosen, smoothing):
    """Losses from the definitions, with plain dictionaries; the scored text itself is left out of the counts."""
    split = [(k, (t or "").encode().lower().split()) for k, t in texts]
    distinct = len({w for _, ws in split for w in ws})
    found = {}
    for k, ws in split:
        for name in ("target", "background"):
            words, after, pairs = collections.Counter(), collections.Counter(), collections.Counter()
            left_out = False
            for other, theirs in split:
                if name == "target" and other not in chosen:
                    continue
                if other == k and not left_out:
                    left_out = True
                    continue
                words.update(theirs)
                after.update([None, *theirs][:len(theirs)])
                pairs.update(zip([None, *theirs], theirs))
            total, loss = sum(words.values()) + distinct + 1, 0.0
            for before, w in zip([None, *ws], ws):
                loss -= math.log((pairs[before, w] + smoothing * (words[w] + 1) / total) / (after[before] + smoothing))
            found.setdefault(k, []).append(loss / len(ws) if ws else None)
    return found


def test_losses_by_hand(spark, monkeypatch):
    """All words and pairs are modelled, in any blocks, and a copy of a text counts when the text is scored."""
    monkeypatch.setattr(lm_scoring, "_SCORED_WORDS", 300)
    monkeypatch.setattr(lm_scoring, "_RANGE_KEYS", 500)
    rng = random.Random(6)
    texts = [(k, " ".join(f"w{int(rng.expovariate(0.01))}" for _ in range(rng.randrange(0, 90)))) for k in range(40)]
    texts += [(90, None), (91, ""), (92, "Only new WORDS"), (93, texts[3][1]), (94, "again again again again")]
    chosen = {*range(0, 40, 3), 94}
    ids = spark.createDataFrame([(k,) for k in [*chosen, 3, 3]], "doc_id long")
    found = lm_scoring.cross_entropy_difference(documents(spark, texts).repartition(3), ids, 5.0).collect()
    wanted = by_hand(texts, chosen, 5.0)
    assert sorted(r["doc_id"] for r in found) == sorted(k for k, _ in texts)
    for r in found:
        target, background = wanted[r["doc_id"]]
        if target is None:
            assert r["n_words"] == 0 and r["loss_target"] is None and r["difference"] is None
        else:
            assert math.isclose(r["loss_target"], target, rel_tol=1e-9)
            assert math.isclose(r["loss_background"], background, rel_tol=1e-9)
            assert math.isclose(r["difference"], target - background, rel_tol=1e-6, abs_tol=1e-9)


def test_held_out_documents_score_like_those_of_the_target(spark):
    """The score tells the kind of a text, not whether the target holds it: halves of the good labels agree."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    good = sorted(r["doc_id"] for r in labels.where("quality = 1 AND toxic = 0").collect())
    chosen = set(random.Random(2).sample(good, len(good) // 2))
    ids = spark.createDataFrame([(k,) for k in chosen], "doc_id long")
    score = {r["doc_id"]: r["difference"] for r in lm_scoring.cross_entropy_difference(docs, ids).collect()}
    inside, outside = (np.array([score[k] for k in part if score.get(k) is not None]) for part in (
        chosen, set(good) - chosen))
    assert abs(np.median(inside) - np.median(outside)) < 0.25 * np.concatenate([inside, outside]).std()


def test_texts_of_the_kind_of_the_target_score_lower(spark):
    """Of two kinds of text in the background, held-out ones of the target's kind are nearer to it, without exception."""
    rng = random.Random(12)
    texts = [(k, " ".join(f"{'ab'[k % 2]}{int(rng.expovariate(0.05))}" if rng.random() < 0.7 else
                          f"c{int(rng.expovariate(0.1))}" for _ in range(80))) for k in range(120)]
    ids = spark.createDataFrame([(k,) for k in range(0, 120, 4)], "doc_id long")
    score = {r["doc_id"]: r["difference"]
             for r in lm_scoring.cross_entropy_difference(documents(spark, texts), ids, 20.0).collect()}
    assert max(score[k] for k in range(0, 120, 2)) < min(score[k] for k in range(1, 120, 2))
    inside, outside = (np.mean([score[k] for k in range(start, 120, 4)]) for start in (0, 2))
    assert abs(inside - outside) < 0.1 * (np.mean([score[k] for k in range(1, 120, 2)]) - outside)


def test_lm_edges(spark):
    ids = spark.createDataFrame([(4,), (None,)], "doc_id long")
    assert lm_scoring.cross_entropy_difference(documents(spark, EDGES), ids).count() == len(EDGES)
    assert lm_scoring.cross_entropy_difference(documents(spark, EDGES), ids.limit(0)).count() == len(EDGES)
    assert lm_scoring.cross_entropy_difference(documents(spark, EDGES).limit(0), ids).count() == 0


def test_kth_largest(spark):
    rng = random.Random(5)
    values = [rng.gauss(0, 1) for _ in range(500)] + [0.25] * 40 + [1e9, -1e9]
    keys = spark.createDataFrame([(v,) for v in values], "key double")
    ordered = sorted(values, reverse=True)
    for k in (1, 2, 100, 260, 542):
        assert importance.kth_largest(keys, k) == ordered[k - 1]
    assert importance.kth_largest(keys, 543) is None


def test_ratios_by_hand_and_sample(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    good = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    bad = {r["doc_id"] for r in labels.where("quality = 0").collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    raw, target = collections.Counter(), collections.Counter()
    for k, text in texts.items():
        found = importance.buckets_of(text).tolist()
        raw.update(found)
        if k in good:
            target.update(found)
    s, size = 0.1, importance.BUCKETS
    ratio = {b: math.log((target[b] + s) / (sum(target.values()) + s * size))
             - math.log((raw[b] + s) / (sum(raw.values()) + s * size)) for b in raw}
    judged = importance.judged(docs, labels).collect()
    for r in judged[::50]:
        found = importance.buckets_of(texts[r["doc_id"]]).tolist()
        assert math.isclose(r["ratio"], sum(ratio[b] for b in found) / len(found), abs_tol=1e-9)
    kept = {r["doc_id"] for r in judged if r["kept"]}
    ordered = sorted((r["key"] for r in judged), reverse=True)
    assert min(r["key"] for r in judged if r["kept"]) == ordered[len(kept) - 1]  # the top k of the keys
    assert good <= kept and len(bad & kept) <= 0.02 * len(bad)


def test_quality_of_held_out_documents(spark):
    """Labels of every third document are hidden; those documents are told nevertheless."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    found = importance.judged(docs, labels.where("doc_id % 3 != 0")).join(labels.where("doc_id % 3 = 0"), "doc_id")
    right = found.where("kept = (quality = 1)").count()
    assert right >= 0.97 * found.count()


def test_importance_edges(spark):
    docs = documents(spark, EDGES)
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 0), (5, 0, 0), (None, 1, 1), (8, None, 0), (4, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    assert importance.judged(docs, labels).count() == len(EDGES)
    assert importance.sampled(docs, labels).columns == docs.columns
    assert importance.sampled(docs, labels.limit(0)).count() == len(EDGES)
    assert importance.judged(docs.limit(0), labels).count() == 0
