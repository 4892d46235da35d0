"""TF-IDF in long form against plain counts."""

import math
import random
from collections import Counter

import pytest

from reportlens.operators import corpus


def plain(rows, ngrams, min_df, max_df, top):
    """{(key, term): weight}; rows of one key count as one document, but as several in n."""
    docs = {}
    for key, text in rows:
        words = text.split()
        docs.setdefault(key, Counter()).update(" ".join(words[i:i + n]) for n in ngrams for i in range(len(words) - n + 1))
    n, df, total = len(rows), Counter(t for d in docs.values() for t in d), Counter()
    for d in docs.values():
        total.update(d)
    allowed = [t for t in total if min_df <= df[t] <= max_df * n]
    kept = set(sorted(allowed, key=lambda t: (-total[t], t))[:top])
    out = {}
    for key, d in docs.items():
        w = {t: c * (math.log((1 + n) / (1 + df[t])) + 1) for t, c in d.items() if t in kept}
        out.update({(key, t): x / math.sqrt(sum(y * y for y in w.values())) for t, x in w.items()})
    return out


@pytest.mark.parametrize("seed,ngrams,min_df,max_df,top", [(1, (1,), 1, 1.0, 20), (2, (1, 2), 2, 0.6, 25), (3, (1, 2), 1, 0.95, 8), (4, (1, 2), 3, 0.5, 500), (5, (2,), 1, 1.0, 30)])
def test_tfidf(spark, seed, ngrams, min_df, max_df, top):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    rows = [(i % 55, " ".join(rnd.choices(words, [1 / (k + 1) for k in range(40)], k=rnd.randrange(1, 40)))) for i in range(60)]
    got = corpus.tfidf(spark.createDataFrame(rows, "key int, t string"), "key", "t", ngrams, min_df, max_df, top).collect()
    want = plain(rows, ngrams, min_df, max_df, top)
    assert len(got) == len(want) and all(abs(want[r["key"], r["term"]] - r["weight"]) < 1e-9 for r in got)


def test_rare_words_are_counted_once_only(spark):
    """Two-grams of words that could not be among the terms are not shuffled."""
    rows = [(i, f"often always a{i} b{i} c{i}") for i in range(30)]
    tf = spark.createDataFrame([(i, w, 1) for i, t in rows for w in t.split()], "key int, term string, tf long")
    n = spark.range(1).selectExpr("30 AS n").scalar()
    assert {r["term"] for r in corpus._frequent_words(tf, n, 1, 1.0, 2).collect()} == {"often", "always"}
    assert corpus._frequent_words(tf, n, 2, 1.0, 3) is None
