"""Byte network, Merkle manifest and ball-tree search against brute force and held-out labels."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from townhall.llm import ball_search, byte_network, merkle
from townhall.llm.queries import QUERIES

MANY = "doc_id long, text string, lang string, source string, n_chars long, node string, rank int"


# -- Merkle manifest ---------------------------------------------------------


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def value(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(row, text):
    return H("".join(value(v) for v in (row.doc_id, row.source, row.lang, row.n_chars, text)))


def tree(nodes):
    """Root, and for each node its siblings (left, right) from below."""
    sides, held = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, groups = [], []
        for i in range(0, len(nodes), 3):
            run = nodes[i : i + 3]
            for j in range(len(run)):
                for m in held[i + j]:
                    sides[m].append(("".join(run[:j]), "".join(run[j + 1 :])))
            up.append(H("".join(run)))
            groups.append([m for g in held[i : i + 3] for m in g])
        nodes, held = up, groups
    return nodes[0], sides


def manifest(rows):
    by = collections.defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    trees = []
    for source in sorted(by, key=lambda s: (s is not None, (s or "").encode())):
        own = sorted(by[source], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)))
        leaves = [leaf(r, r.text) for r in own]
        trees.append((own, leaves, *tree(leaves)))
    if not trees:
        return []
    root, tops = tree([t[2] for t in trees])
    out = []
    for (own, leaves, subroot, sides), top in zip(trees, tops):
        for r, x, side in zip(own, leaves, sides):
            side, held = side + top, x
            if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and r.text is not None:
                held = leaf(r, r.text.replace("\n", ""))
            for a, b in side:
                held = H(a + held + b)
            out.append((r.doc_id, x, subroot, root, H("".join(a + b for a, b in side)), held, held == root))
    return sorted(out, key=repr)


def proven(docs):
    return sorted(map(tuple, merkle.proofs(docs).collect()), key=repr)


def test_manifest_of_odd_rows(odd_docs):
    assert proven(odd_docs) == manifest(odd_docs.collect())


def test_manifest_without_rows(no_docs):
    assert proven(no_docs) == []


@pytest.mark.parametrize("n", [1, 2, 3, 4, 27, 28, 729, 730, 2300])
def test_manifest_of_one_source(spark, n):
    """Trees of one leaf, of whole and broken levels, and of several blocks; one source holds all but two rows."""
    rows = [(i * 7, f"a\nb{i}", "en", "hot", 3, "x", 1) for i in range(n)] + [(1, "x", None, None, 1, "", 0), (2, "x", "e", "é", 1, "", 0)]
    docs = spark.createDataFrame(rows, MANY)
    assert proven(docs) == manifest(docs.collect())


def test_manifest_of_one_row_many_times(spark):
    docs = spark.createDataFrame([(5, "a\nb", "en", "s", 3, "x", 1)] * 1000, MANY).repartition(7)
    assert proven(docs) == manifest(docs.collect())


def test_blocks_are_built_without_a_join(spark):
    rows = spark.range(50).selectExpr("string(id % 2) as tree", "id as rank", "int(id % 3) as depth", "struct(sha2(string(id), 256) as hash) as node")
    plan = merkle._rolled(rows, 0)._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"(\w*Join)\b", plan) == [] and plan.count("Exchange hashpartitioning") == 1


# -- ball-tree search --------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


def answers(docs, queries):
    held = [(d, words(t)) for d, t in docs]
    n_docs, n_terms = sum(bool(w) for _, w in held), sum(len(w) for _, w in held)
    holders = collections.Counter(t for _, w in held for t in set(w))
    out = []
    for q, text in queries:
        scored = []
        for d, w in held:
            tf = collections.Counter(w)
            m = 10 + (90 * len(w) * n_docs) // max(n_terms, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m))
                        for t in set(words(text)) if tf[t])
            if score > 0:
                scored.append((-score, d is not None, d or 0, d))
        out += [(q, k + 1, x[3], -x[0]) for k, x in enumerate(sorted(scored)[:10])]
    return sorted(out, key=repr)


def searched(docs, queries):
    return sorted(map(tuple, ball_search.ranked_search(docs, queries).collect()), key=repr)


def test_search_of_odd_rows(spark, odd_docs):
    queries = [(1, "the QUICK brown"), (2, None), (3, "..."), (4, "漢字かな word3"), (None, "one two"), (4, "漢字かな word3"), (5, "nowhere")]
    asked = spark.createDataFrame(queries, "item_id long, text string").withColumn("doc_id", odd_docs.sparkSession.range(1).agg({"id": "max"}).scalar())
    pairs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert searched(odd_docs, asked) == answers(pairs, queries)


def test_search_without_rows(spark, odd_docs, no_docs):
    asked = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert searched(no_docs, asked) == [] and searched(odd_docs, asked.where("false")) == []


def test_search_in_many_blocks_and_shards(spark, monkeypatch):
    rng = np.random.default_rng(3)
    draw = lambda k: " ".join(f"w{int(x)}" for x in rng.zipf(1.3, k) if x < 400)
    pairs = [(int(i // 2), draw(int(rng.integers(1, 60)))) for i in rng.permutation(900)]
    pairs += [(2000 + i, pairs[7][1]) for i in range(60)]  # copies tie
    queries = [(i, draw(12)) for i in range(25)]
    monkeypatch.setattr(ball_search, "BLOCK_TERMS", 60)
    monkeypatch.setattr(ball_search, "MOST_ROWS", 100)
    docs = spark.createDataFrame(pairs, "doc_id long, text string").repartition(4)
    assert searched(docs, spark.createDataFrame(queries, "item_id long, text string")) == answers(pairs, queries)


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(4)
    values = (rng.integers(0, 10**6, (500, 300)) * (rng.random((500, 300)) < 0.05)).astype(np.int64)
    weight = rng.integers(0, 9000, 300)
    tree = ball_search.ball_tree(values.astype(np.float32) * weight.astype(np.float32))
    seen = 0
    for _ in range(20):
        own = np.unique(rng.integers(0, 300, 12))
        scores, bound = values[:, own] @ weight[own], ball_search.bounds(tree, own)
        for i in range(len(bound)):
            rows = tree.order[tree.first[i] : tree.last[i]]
            assert not len(rows) or bound[i] >= scores[rows].max()
        best = sorted(scores.tolist())[-10:]
        seen += sum(1 for _ in ball_search.search(tree, bound, best))
    assert seen < 20 * (len(tree.first) + 1) // 2


# -- byte network ------------------------------------------------------------


def slow_score(net, text):
    """One text, chunk by chunk and place by place."""
    rows = byte_network._chunks(text)
    values = []
    for row in rows:
        e = net.embed[row].reshape(-1, byte_network.STRIDE * byte_network.EMBED)
        out = np.array([e[i] @ net.near + e[i + 1] @ net.far for i in range(len(e) - 1)])
        if byte_network.n_blocks(len(text)) == 1:
            out = out[: byte_network._PLACES]
        values.append(np.maximum(np.maximum(out.max(axis=0) + net.bias, 0) @ net.hidden + net.hidden_bias, 0))
    logit = np.mean(values, axis=0) @ net.out + net.share[0]
    return 1 / (1 + math.exp(-logit))


def test_scores_cover_whole_texts(monkeypatch):
    net = byte_network.fresh(9)
    net.bias += 0.1
    rng = np.random.default_rng(1)
    texts = [b"", b"a", "é漢".encode() * 90] + [bytes(rng.integers(32, 127, int(n)).astype(np.uint8)) for n in (251, 252, 253, 256, 508, 509, 3000)]
    expected = [slow_score(net, t) for t in texts]
    starts = np.cumsum([0] + [len(t) for t in texts])
    together = byte_network.text_scores(net, np.frombuffer(b"".join(texts), np.uint8), starts)
    monkeypatch.setattr(byte_network, "RUN", 3 * byte_network.BLOCK)
    alone = [byte_network.text_score(net, np.frombuffer(t, np.uint8)) for t in texts]
    assert np.allclose(together, expected, atol=1e-5) and np.allclose(alone, expected, atol=1e-5)


def test_gradients_are_those_of_the_loss():
    net = byte_network.fresh(2)
    texts = [b"abc def " * 100, b"### zzz" * 60, b"hello world"]
    data = [byte_network._chunks(t) for t in texts]
    counts = np.array([len(d) for d in data], np.float32)
    truth, weight = np.array([1.0, 0.0, 1.0]), np.array([0.5, 1.0, 0.25])
    owner = np.repeat(np.arange(3), counts.astype(int))

    def loss():
        values = []
        for rows in data:
            e = net.embed[rows].reshape(len(rows), -1, byte_network.STRIDE * byte_network.EMBED)
            out = (e[:, :-1] @ net.near + e[:, 1:] @ net.far).max(axis=1)
            values.append(byte_network.chunk_values(net, out).mean(axis=0))
        p = byte_network._probability(net, np.array(values))
        return float(-(weight * (truth * np.log(p) + (1 - truth) * np.log(1 - p))).sum())

    grads = byte_network._gradients(net, np.concatenate(data), owner, counts, truth, weight)
    rng = np.random.default_rng(0)
    for w, g in zip(net.weights(), grads):
        at = np.unravel_index(np.abs(g).argmax(), g.shape) if g.any() else tuple(rng.integers(0, n) for n in g.shape)
        kept = w[at]
        w[at] = kept + 1e-3
        up = loss()
        w[at] = kept - 1e-3
        slope = (up - loss()) / 2e-3
        w[at] = kept
        assert slope == pytest.approx(float(g[at]), abs=2e-3, rel=0.1)


def test_held_out_quality(spark):
    folder = "/root/testdata/sf0.1"
    found = {r.doc_id: r for r in QUERIES["op11_byte_network"](spark, folder).collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    held = [(r.quality, found[r.doc_id].predicted) for r in labels if r.doc_id in found and found[r.doc_id].held_out]
    assert all(x.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) and 0 <= x.score <= 1 for d, x in found.items())
    for kind in (0, 1):
        own = [p == kind for q, p in held if q == kind]
        assert sum(own) >= 0.92 * len(own)


def test_odd_texts_have_scores(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(4, 1), (5, 0), (6, 1), (7, 0), (99, 1), (None, 1), (4, None), (8, 7)], "doc_id long, quality int")
    rows = byte_network.quality_scores(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert {r.held_out for r in rows if r.doc_id is None} == {False}
    assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1 and len({r.score for r in rows if r.doc_id == 4}) == 1
    assert byte_network.quality_scores(no_docs, labels).collect() == []
    assert {r.score for r in byte_network.quality_scores(odd_docs, labels.where("false")).collect()} == {0.5}


def test_labels_do_not_leak(spark, odd_docs):
    """Scores do not change with the labels of held-out rows."""
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 12)], "doc_id long, quality int")
    wrong = labels.withColumn("quality", merkle.F.expr("if(crc32(string(doc_id)) % 3 = 1, 1 - quality, quality)"))
    one, two = (sorted(map(tuple, byte_network.quality_scores(odd_docs, x).collect()), key=repr) for x in (labels, wrong))
    assert one == two
