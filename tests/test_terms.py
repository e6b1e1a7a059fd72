"""Term statistics against a plain in-memory count over the same texts."""

import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from townhall.operators import terms

TEXTS = [
    "Dogs dog DOG dogs Dog class classes glass glasses bus bu",
    "it's 12 12's 12'ab a's 's x's's ''s he''s O'Brien's 3rd ² 2² Ünïcode ñ_x _y",
    "New York is big. New York is far; new york IS old. New Yorks?",
    "machine learning machine learning Machine Learning machine learning models model",
    "", None, "the and of", "single",
    "ss s as was has gas ga", "data science data science data science data sets data set",
] + ["machine learning is fun and data science too"] * 9


def tokens(text):
    found = re.findall(r"\w[\w']*", text or "")
    found = [w[:-2] if w.lower().endswith("'s") else w for w in found]
    return [w for w in found if not w.isdigit()]


def folded(forms):
    cases = defaultdict(Counter)
    for f in forms:
        cases[f.lower()][f] += 1
    home = {k: k for k in cases}
    for key in list(cases):
        if key.endswith("s") and not key.endswith("ss") and key[:-1] in cases and len(key) > 1:
            home[key] = key[:-1]
    merged = defaultdict(Counter)
    for key, counter in cases.items():
        for f, n in counter.items():
            merged[home[key]][f if home[key] == key else f[:-1]] += n
    shown = {k: min(c, key=lambda f: (-c[f], f)) for k, c in merged.items()}
    total = {shown[k]: sum(c.values()) for k, c in merged.items()}
    return total, {k: shown[h] for k, h in home.items()}


def score(c12, c1, c2, n):
    if n <= c1 or n <= c2:
        return 0.0

    def part(k, m, x):
        return math.log(max(x, 1e-10)) * k + math.log(max(1 - x, 1e-10)) * (m - k)

    p, p1, p2 = c2 / n, c12 / c1, (c2 - c12) / (n - c1)
    return -2 * (part(c12, c1, p) + part(c2 - c12, n - c1, p) - part(c12, c1, p1) - part(c2 - c12, n - c1, p2))


def cloud(texts, stop, threshold):
    rows = [tokens(t) for t in texts]
    singles = [w for r in rows for w in r if w.lower() not in stop]
    pairs = [f"{a} {b}" for r in rows for a, b in zip(r, r[1:]) if a.lower() not in stop and b.lower() not in stop]
    words, names = folded(singles)
    both, _ = folded(pairs)
    out, scores = Counter(words), {}
    for pair, n in both.items():
        a, b = (names[w.lower()] for w in pair.split(" "))
        scores[pair] = score(n, words[a], words[b], len(singles))
        if scores[pair] > threshold:
            out[a] -= n
            out[b] -= n
            out[pair] = n
    return {t: n for t, n in out.items() if n > 0}, scores, words, both


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(t,) for t in TEXTS], "text string").repartition(4)


def test_words(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS if t is not None], "text string")
    for r in df.select("text", terms.words(F.col("text")).alias("w")).collect():
        assert r.w == tokens(r.text)


@pytest.mark.parametrize("stop", [(), terms.REPORT_STOPWORDS, terms.ENGLISH_STOPWORDS])
def test_counts_and_scores(texts, stop):
    want, scores, words, both = cloud(TEXTS, set(stop), 10)
    assert {r.term: r.n for r in terms.term_counts(texts, "text", stop).collect()} == words
    assert {r.term: r.n for r in terms.bigram_counts(texts, "text", stop).collect()} == both
    got = {r.bigram: r.score for r in terms.scored_bigrams(texts, "text", stop).collect()}
    assert got == pytest.approx(scores, abs=1e-6)
    assert {r.term: r.n for r in terms.cloud_counts(texts, "text", stop, 10).collect()} == want


def test_frequent_words_are_split(spark):
    """One word is in most pairs; the join may split its rows, the scores stay."""
    rows = ["hub a%d hub" % (i % 40) for i in range(400)] + ["x y z"] * 5
    _, scores, _, _ = cloud(rows, set(), 10)
    keep = {k: spark.conf.get(k) for k in (
        "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1")
    try:
        df = spark.createDataFrame([(t,) for t in rows], "text string").repartition(4)
        got = {r.bigram: r.score for r in terms.scored_bigrams(df, "text").collect()}
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    assert got == pytest.approx(scores, abs=1e-6)


def test_top_terms(texts):
    counts = terms.cloud_counts(texts, "text", terms.REPORT_STOPWORDS, 10)
    rows = terms.most_frequent(counts, 3).orderBy(F.desc("n"), "term").collect()
    assert len(rows) == 3 and rows[0].frequency == 1.0
    assert all(r.frequency == r.n / rows[0].n for r in rows)


def test_no_texts(spark):
    empty = spark.createDataFrame([], "text string")
    assert terms.most_frequent(terms.cloud_counts(empty, "text"), 10).count() == 0


def test_report_stopwords():
    assert len(set(terms.REPORT_STOPWORDS)) == len(terms.REPORT_STOPWORDS)
