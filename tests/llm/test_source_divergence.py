"""Source divergence against brute force."""

import collections
import random
import re

import pytest

from holdrift.llm import source_divergence
from holdrift.llm.source_divergence import Audit
from tests.llm.build_llm import documents

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_force(rows, audit):
    texts = [(r[2] or "", r[3] or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (r[1] or "").translate(LOWER)))
             for r in rows]
    out = []
    for lang in {t[0] for t in texts}:
        mine = [t for t in texts if t[0] == lang]
        containing = collections.Counter(w for t in mine for w in set(t[2]))
        kept = [w for w, n in containing.items() if n >= audit.least_documents]

        def shares(groups):
            counts = collections.Counter(w for t in groups for w in t[2])
            total = sum(counts[w] for w in kept)
            return counts, {w: 1 + audit.unit * (counts[w] + audit.smoothing) // (total + audit.smoothing * len(kept))
                            for w in kept}

        sources = {s: shares([t for t in mine if t[1] == s]) for s in {t[1] for t in mine}}
        whole = shares(mine)[1]
        for source, (counts, p) in sources.items():
            pairs = [(-sum(abs(p[w] - q[w]) for w in kept), other.encode(), other)
                     for other, (_, q) in sources.items() if other != source]
            terms = [(whole[w] - p[w], w.encode(), w) for w in kept if counts[w] and p[w] > whole[w]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:audit.top])):
                out += [(lang, source, part, item, -value, k) for k, (value, _, item) in enumerate(found, 1)]
    return sorted(out)


def audited(spark, rows, audit):
    found = source_divergence.audited(documents(spark, rows), audit)
    assert dict(found.dtypes) == {"lang": "string", "source": "string", "part": "string", "item": "string",
                                  "value": "bigint", "rank": "int"}
    return sorted(map(tuple, found.collect()))


def some_rows(n=400, sources=9):
    rng = random.Random(2)
    words = [f"{a}{b}" for a in ("w", "É", "X", "漢", "z") for b in ("a", "B", "ß", "zz", "y", "é😀", "q", "h")]
    rows = []
    for k in range(n):
        source = rng.choice(["hot", f"s{rng.randrange(sources)}", f"é{rng.randrange(3)}"])
        lang = rng.choice(["en", "en", "de", None, ""])
        length = rng.randrange(0, 40)
        rows.append((k % 300, " ".join(rng.choice(words[len(source) % 7:]) for _ in range(length)), lang, source))
    return rows


@pytest.mark.parametrize("audit", [Audit(), Audit(groups=2, terms=5, least_documents=10, top=3), Audit(groups=1, terms=1, least_documents=25)])
def test_brute_force(spark, audit):
    rows = some_rows()
    rows += [(1000, None, "en", "null text"), (1001, "", "en", None), (1001, "", "en", None), (1002, "1 2 !", "fr", "a"),
             (1003, None, "fr", "b"), (1004, "only", "it", "single"), (None, "wa WA wa", "en", "hot"),
             (5, "wa-wa.wa\nwa " * 3000, "en", "long")]
    found = audited(spark, rows, audit)
    assert found == brute_force(rows, audit) and {r[2] for r in found} == {"pair", "term"}
    assert ("fr", "a", "pair", "b", 0, 1) in found


def test_blocks_of_documents(spark, monkeypatch):
    monkeypatch.setattr(source_divergence, "BLOCK_ENTRIES", 5)
    rows, audit = some_rows(120), Audit(least_documents=3)
    assert audited(spark, rows, audit) == brute_force(rows, audit)


def test_empty_table(spark):
    assert audited(spark, [], Audit()) == []


def test_large_counts_are_exact(spark):
    rows = spark.createDataFrame([(9_000_000_000_000, 9_000_000_000_007, 3)], "n long, total long, kept long")
    found = rows.select(source_divergence.share("n", "total", "kept", Audit()).alias("p")).first()[0]
    assert found == 1 + 10 ** 9 * (9_000_000_000_000 + 5) // (9_000_000_000_007 + 15)
