"""Near-duplicate groups, repeats, suffix arrays and components against brute force."""

import collections
import random
import tracemalloc

import brute
import numpy as np
import pytest

from townhall.llm import components, repeats, suffix_sort, superminhash as sm
from townhall.llm.frames import beside_text


def by_repr(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("induce", ["_induce_by_bucket", "_induce_by_entry"])
def test_suffix_arrays_and_common_prefixes(induce, monkeypatch):
    one = getattr(suffix_sort, induce)
    monkeypatch.setattr(suffix_sort, "_induce_by_bucket", one)
    monkeypatch.setattr(suffix_sort, "_induce_by_entry", one)
    rng = np.random.default_rng(4)
    for _ in range(120):
        kinds = int(rng.integers(1, 5))
        text = np.append(rng.integers(1, kinds + 1, rng.integers(0, 200)), 0)
        raw = bytes(text.astype(np.uint8))
        order = suffix_sort.suffix_array(text, kinds + 1)
        assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
        shared = suffix_sort.common_prefixes(text, order)
        for a, b in zip(order[:-1], order[1:]):
            n = 0
            while max(a, b) + n < len(raw) and raw[a + n] == raw[b + n]:
                n += 1
            assert shared[b] == n


def test_repeated_windows_of_byte_strings():
    rng = random.Random(1)
    for _ in range(40):
        parts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(30))) for _ in range(4)]
        seen = {}
        for p in parts:
            for i in range(len(p) - 4):
                seen[p[i : i + 5]] = seen.get(p[i : i + 5], 0) + 1
        want = [[i for i in range(len(p) - 4) if seen[p[i : i + 5]] > 1] for p in parts]
        assert [w.tolist() for w in repeats.repeated_windows(parts, 5)] == want


def test_sorting_holds_few_bytes_for_each_byte():
    """A worker keeps what its largest shard took, so that bounds the workers of all later stages too."""
    rng = random.Random(1)
    words = [made_up(rng, 1) for _ in range(500)]
    parts = [" ".join(rng.choice(words) for _ in range(80)).encode() for _ in range(500)]
    tracemalloc.start()
    try:
        repeats.repeated_windows(parts, 256)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 50 * sum(map(len, parts))


def made_up(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def planted(spark):
    """Copies, edited copies, shared passages, runs of one character and texts cut at awkward places."""
    rng = random.Random(9)
    base, passage = made_up(rng, 400), made_up(rng, 120)
    rows = [(i, made_up(rng, rng.randrange(1, 200))) for i in range(30)]
    rows += [(100, base), (101, base), (102, base + " more"), (103, "é" + base[3:1500]), (104, base.upper())]
    for k in range(20):
        w = base.split(" ")
        for _ in range(rng.randrange(1, 30)):
            w[rng.randrange(len(w))] = "edit%d" % rng.randrange(10**6)
        rows.append((200 + k, " ".join(w)))
    rows += [(300 + k, made_up(rng, 40) + " " + passage[: 380 + 10 * k] + " " + made_up(rng, 30)) for k in range(8)]
    rows += [(400, "z" * 1000), (401, "yz" * 300), (402, None), (403, ""), (404, "z" * 399), (405, "a " * 700)]
    rows += [(500, rows[0][1]), (500, rows[0][1])]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


@pytest.mark.parametrize("place, size", [(0, 400), (336, 736), (10, 410), (100, 437), (50, 450), (47, 449)])
@pytest.mark.parametrize("step", [1, 48])
def test_parts_hold_every_window_and_share_its_core(place, size, step):
    seen = []
    for low, high, a, b in repeats.parts(place, size, step):
        assert b - a == 401 - step
        seen += range(low, high + 1)
        for w in (low, high):
            assert w <= a and b <= w + 400
    assert sorted(seen) == list(range(size - 399))


@pytest.mark.parametrize("most", [4096, 1])
def test_repeats(planted, most, monkeypatch):
    """With at most one part of a core to be sorted, every window is settled by counting."""
    monkeypatch.setattr(repeats, "MOST_PARTS", most)
    rows, docs = planted
    assert by_repr(repeats.repeat_digest(docs).collect()) == by_repr(brute.repeats(rows, 400))


def test_short_passages_of_many_words(spark):
    """Passages of 51 words and under 400 bytes go at a shorter length, as by brute force."""
    rng = random.Random(8)
    passages = [" ".join("abcdefgh"[rng.randrange(8)] * rng.randrange(3, 8) for _ in range(51)) for _ in range(6)]
    assert all(256 <= len(p) < 400 for p in passages)
    rows = [(k, made_up(rng, 60) + " " + passages[k % 6] + " " + made_up(rng, 50)) for k in range(30)]
    rows += [(100 + k, made_up(rng, 120)) for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_bytes, sum(x.stop - x.start for x in r.spans)) for r in repeats.without_repeats(docs, length=256).collect()}
    assert got == {d: (n, gone) for d, n, gone, _, _ in brute.repeats(rows, 256)}
    left = {r.doc_id: r.text for r in repeats.drop_repeats(docs, length=256).collect()}
    assert all(passages[k % 6] not in left[k] for k in range(30)) and all(left[d] == t for d, t in rows[30:])


def test_a_text_moves_once_and_other_columns_stay(spark):
    """Columns are kept whatever their names; no copy of the text goes along beside it."""
    text = "a passage that comes again " * 20
    rows = [(k, text, f"r{k}", None, k % 2 == 0) for k in range(3)] + [(7, None, "x", "y", None), (8, "short", None, "z", True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, rest string, there boolean")
    left = repeats.drop_repeats(docs)
    want = [(d, t if t != text else "", *more) for d, t, *more in rows]
    assert left.schema == docs.schema and by_repr(map(tuple, left.collect())) == by_repr(want)
    row = beside_text(docs, "doc_id", "text").schema["row"].dataType
    assert row["rest"].dataType.names == ["doc_id", "row", "rest", "there"]


def test_one_row_a_thousand_times(spark):
    rng = random.Random(9)
    text = made_up(rng, 400)
    rows = [(7, text)] * 1000 + [(8, text[: len(text) // 2] + made_up(rng, 100)), (9, made_up(rng, 300))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = collections.Counter(map(tuple, repeats.repeat_digest(docs).collect()))
    few = rows[:2] + rows[1000:]
    assert got == collections.Counter({r: 1000 if r[0] == 7 else 1 for r in brute.repeats(few, 400)})
    longest = repeats._settled(
        repeats.id_and_text(docs).withColumn("doc", repeats.row_key("doc_id", "text")), repeats.Windows()).selectExpr("max(size(found))").first()[0]
    assert longest < 100


def test_every_window_is_filed_once():
    data = np.frombuffer(("abcdefgh" * 200 + "Q" + "abcdefgh" * 100).encode(), np.uint8)
    _, _, first, last, _ = repeats.stretches(data, np.array([0, len(data)]))
    covered = np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last)])
    assert covered.tolist() == list(range(len(data) - 399))


def test_pieces_of_a_long_text_overlap_by_a_window():
    import pyarrow as pa

    keep, repeats._PIECE = repeats._PIECE, 700
    try:
        text = "".join(chr(97 + i * i % 23) for i in range(3000))
        batch = pa.RecordBatch.from_arrays([pa.array([text])], names=["text"])
        starts = []
        for _, at, data, rows in repeats._pieces(400, batch):
            _, _, first, last, _ = repeats.stretches(data, rows)
            starts += [at + x for a, b in zip(first, last) for x in range(a, b + 1)]
        assert sorted(starts) == list(range(len(text) - 399))
    finally:
        repeats._PIECE = keep


def test_near_groups(planted):
    rows, docs = planted
    got = by_repr(r[:3] for r in sm.near_duplicates(docs).collect())
    assert got == by_repr(brute.near_groups(rows))


def test_one_row_of_each_group_stays(planted):
    rows, docs = planted
    kept = [r.doc_id for r in sm.drop_near_duplicates(docs).collect()]
    want = brute.near_groups(rows)
    alone = [d for d, n, _ in want if n == 0]
    assert sorted(kept) == sorted({c for _, n, c in want if n} | set(alone))


def test_a_family_whose_members_are_linked_to_the_source_only(spark):
    """Independent edits: every copy is near the source, few copies are near each other, some near nothing."""
    rng = random.Random(3)
    source = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    rows = [(0, " ".join(source))]
    for k in range(1, 120):
        w = list(source)
        for at in rng.sample(range(len(w)), rng.choice([1, 2, 3, 4, 5, 6, 8])):
            w[at] = f"e{rng.randrange(10**9)}"
        rows.append((k, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert by_repr(r[:3] for r in sm.near_duplicates(docs).collect()) == by_repr(brute.near_groups(rows))


def test_signatures_estimate_the_likeness():
    rng = np.random.default_rng(5)
    for share in (0.3, 0.75, 0.95):
        total, near = 0, []
        for _ in range(30):
            pool = rng.integers(0, 2**63, 1000).astype(np.uint64)
            both = int(2 * share / (1 + share) * 500)
            a, b = np.unique(pool[:500]), np.unique(np.concatenate([pool[:both], pool[500 : 1000 - both]]))
            n = len(np.intersect1d(a, b))
            total += n / (len(a) + len(b) - n)
            near.append(np.mean(sm.signature(a, 128) == sm.signature(b, 128)))
        assert abs(np.mean(near) - total / 30) < 0.03
    one = sm.signature(np.array([7], np.uint64), 16)  # a permutation: each round fills one place
    assert sorted((one >> np.uint64(56)).tolist()) == list(range(16))


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(60) if i % 20 != 19] + [(rng.randrange(100, 140), rng.randrange(100, 140)) for _ in range(30)]
    df = spark.createDataFrame([(bytes([a]), bytes([b])) for a, b in links if a != b], "a binary, b binary").repartition(7)
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            parent[max(top(a), top(b))] = min(top(a), top(b))
    got = {r.node[0]: r.component[0] for r in components.connected(df).collect()}
    assert got == {x: top(x) for x in parent}
    assert components.connected(df.where("false")).count() == 0


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert by_repr(repeats.repeat_digest(odd_docs).collect()) == by_repr(brute.repeats(rows, 400))
    assert by_repr(r[:3] for r in sm.near_duplicates(odd_docs).collect()) == by_repr(brute.near_groups(rows))
    for stage in (repeats.drop_repeats, sm.drop_near_duplicates):
        out = stage(odd_docs)
        assert out.schema.names == odd_docs.schema.names and stage(no_docs).count() == 0
    cut = {r.doc_id: r.text for r in repeats.drop_repeats(odd_docs).collect()}
    assert cut[1] is None and cut[2] == "" and cut[4] == "one two"
    assert repeats.repeat_digest(no_docs).count() == 0 and sm.near_duplicates(no_docs).count() == 0
