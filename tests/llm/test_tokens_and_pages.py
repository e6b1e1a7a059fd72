"""Tokens, packing, archives and page text against the libraries, brute force and round trips."""

import collections
import glob
import gzip
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as public
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from townhall.llm import packing, tree_bpe, warc, wrappers
from townhall.llm.page_tokens import TEXT, tokens

BYTES, WORDS = public.path("byte_bpe_50k.json"), public.path("word_bpe_49k.json")
RNG = random.Random(6)
TEXTS = [
    None, "", " ", "\n \n", "a\t  b", "  x  \n\n y ", "\x1c a \x1d b", "foo<|endoftext|> bar  <|endoftext|>", "x<|startoftext|>y",
    "it's  we'LL don't", "é ́a ß Σας ΌΔΟΣ", "一二三" * 3000,
    "a" * 20000, "ab1!" * 4000, " " * 9000 + "x", "  z   q", "\U0001f600\U0001f469‍\U0001f469" * 900, "İSTANBUL Å",
    "\x00\x01 \x7f", "　中 文 x y\u0085z", "".join(RNG.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(30000)),
    "".join(RNG.choice("aab") for _ in range(25000)), "x" * 5000 + "<|endoftext|>" + "y" * 5000,
]


@pytest.fixture(scope="module")
def texts(spark, small):
    odd = spark.createDataFrame([(9000 + i, t) for i, t in enumerate(TEXTS)] + [(9000, None), (None, "no id")], "doc_id long, text string")
    return spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").union(odd)


def test_ids_and_decoded_text(texts):
    model = Tokenizer.from_file(BYTES)
    want = collections.Counter()
    for r in texts.collect():
        ids = model.encode(r.text or "", add_special_tokens=False).ids
        back = model.decode(ids, skip_special_tokens=False)
        want[r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256(back.encode()).hexdigest()] += 1
    assert collections.Counter(tuple(r) for r in tree_bpe.encode_digest(texts, BYTES).collect()) == want


@pytest.mark.parametrize("leaf", [1, 2, 3, 7, 50])
def test_joined_halves_are_the_whole(leaf):
    model = tree_bpe.tokenizer(BYTES)
    for text in ["a" * 300, "abab" * 60, "thequickbrownfoxjumpsoverthelazydog" * 9, "".join(RNG.choice("aeinorst") for _ in range(700))]:
        leaves = [tree_bpe._tokens(model, text[i : i + leaf]) for i in range(0, len(text), leaf)]
        joined = tree_bpe.tree(lambda s: tree_bpe._tokens(model, s), leaves)
        assert joined == tree_bpe._tokens(model, text)


@pytest.mark.parametrize("unsplit, fan", [(40, 2), (64, 3), (4, 16)])
def test_leaves_are_joined_over_levels(spark, unsplit, fan):
    """Many levels, runs that end in a single node, stretches of unequal length and short ones between them."""
    texts = ["x" * 1000, "ab" * 777 + " and " + "the" * 400 + "<|endoftext|>" + "q" * 41, "short words only",
             "".join(RNG.choice("aeinorst") for _ in range(1500)) + "\n" + "=" * 130]
    rows = spark.createDataFrame([(bytes([k]), t) for k, t in enumerate(texts)], "node binary, text string")
    model = Tokenizer.from_file(BYTES)
    want = {bytes([k]): model.encode(t, add_special_tokens=False).ids for k, t in enumerate(texts)}
    got = {bytes(r.node): list(r.ids) for r in tree_bpe.encode_long(rows, BYTES, unsplit, fan).collect()}
    assert got == want
    assert tree_bpe.encode_long(rows.where("false"), BYTES, unsplit, fan).count() == 0


def test_a_full_cache_starts_anew(monkeypatch):
    made = []
    cache = tree_bpe.ChunkCache(lambda chunks: [made.append(c) or c.upper() for c in chunks], entries=3)
    for chunks in (["a", "b"], ["c", "d", "a"], ["a", "c", "d"], ["e", "f", "g", "h"]):
        assert cache.of(chunks) == [c.upper() for c in chunks]


def check_packing(rows, docs, model):
    by, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        sequences[r.sequence_id].append((r.offset, r.length))
    want, total = collections.defaultdict(list), 0
    for r in docs:
        ids = model.encode(r.text or "", add_special_tokens=False).ids + [0]
        total += len(ids)
        for k, a in enumerate(range(0, len(ids), 2048)):
            part = ids[a : a + 2048]
            want[r.doc_id].append((k, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert {d: sorted(v) for d, v in by.items()} == {d: sorted(v) for d, v in want.items()}
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    return len(sequences), -(-total // 2048)


class OnlyWords:
    """A tokenizer whose normalizer and patterns must not be asked; counts what its model is given."""

    def __init__(self, whole):
        self.model, self.pre_tokenizer, self._bpe, self.asked = self, whole.pre_tokenizer, whole.model, []

    def tokenize(self, word):
        self.asked.append(word)
        return self._bpe.tokenize(word)

    def encode(self, *_, **__):
        raise AssertionError("a plain text was given to the whole tokenizer")


def test_the_model_is_given_each_word_of_plain_texts_once(monkeypatch):
    whole = Tokenizer.from_file(WORDS)
    words = OnlyWords(whole)
    monkeypatch.setattr(packing, "tokenizer", lambda path: words)
    coder = packing._Coder(WORDS)
    plain = ["The word, the (word); it's sharp and 2026 %%%", "WORD!\tthe\r\nword's éÀÿ ß,ß it's12x", "", "'", " ''s ", "a1b22'd3"]
    plain += ["".join(RNG.choice("aAzÀéÿßø'tsSre09.,!<|>- \n\t\r") for _ in range(60)).replace("<|", "<") for _ in range(300)]
    for text in plain:
        assert coder.ids(text) == np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text
    for word in ("the", "word", "and", "sharp", "%%%", "2"):
        assert words.asked.count(word) == 1


def test_remembered_words_are_bounded():
    made = []
    known = packing._Lately(lambda w: made.append(w) or w.encode(), 3)
    for words in ("ab", "cda", "acd", "efgh", "abcdefgh"):
        assert [known[w] for w in words] == [w.encode() for w in words]
        known = known.turned()
        assert len(known) <= 3
    assert made[:4] == [*"abcd"]


def test_packed_documents(texts):
    used, bound = check_packing(packing.packed_documents(texts, WORDS).collect(), texts.collect(), Tokenizer.from_file(WORDS))
    assert used <= bound + 2


@pytest.mark.parametrize("kind", ["small", "long tail", "just over a third", "uniform", "all full", "none"])
def test_ways_place_all_pieces(kind):
    rng = np.random.default_rng(1)
    lengths = {
        "small": rng.integers(1, 30, 5000), "long tail": np.clip(rng.lognormal(5.3, 1.1, 20000).astype(int), 1, 2048),
        "just over a third": rng.integers(690, 760, 3000), "uniform": rng.integers(1, 2049, 5000),
        "all full": np.full(70, 2048), "none": np.zeros(0, int),
    }[kind]
    counts = np.bincount(lengths, minlength=2049)
    ways = packing.packed(counts)
    placed = np.zeros(2049, np.int64)
    for column, times in ways:
        assert times > 0 and sum(x * n for x, n in column.items()) <= 2048
        for x, n in column.items():
            placed[x] += n * times
    assert (placed == counts).all()
    used = sum(t for _, t in ways)
    assert used <= sum(t for _, t in packing._rounded(counts, [], 0.0, 2048))  # never more than best fit alone
    if kind in ("small", "long tail"):
        assert used <= -(-int(lengths.sum()) // 2048) + 1
    ranks = collections.defaultdict(list)
    for length, low, high, _, _, _ in packing.places(ways):
        ranks[length].append((low, high))
    for length, spans in ranks.items():
        at = 0
        for low, high in sorted(spans):
            assert low == at
            at = high
        assert at == counts[length]


def test_program_is_solved_and_bounded():
    """Nearly everything is covered; the bound holds; where best fit wastes room the program's columns win."""
    rng = np.random.default_rng(5)
    lengths = np.concatenate([rng.integers(640, 720, 3000), rng.integers(500, 530, 2000), rng.integers(900, 1100, 1500)])
    counts = np.bincount(lengths, minlength=2049)
    solved = packing.program(counts)
    assert solved.covered.sum() > 0.95 * counts.sum()
    used = sum(t for _, t in packing.packed(counts))
    assert -(-int(lengths.sum()) // 2048) <= solved.bound + 1 and solved.bound <= used
    assert used < sum(t for _, t in packing._rounded(counts, [], 0.0, 2048))


def test_solution_covers_no_length_twice():
    counts = np.bincount(np.random.default_rng(3).integers(100, 1900, 4000), minlength=2049)
    covered = np.zeros(2049)
    for column, share in packing.solve(counts):
        assert share > 0 and sum(x * n for x, n in column.items()) <= 2048
        for x, n in column.items():
            covered[x] += n * share
    assert (covered <= counts + 1e-6).all() and covered.sum() > 0.5 * counts.sum()


def test_no_documents(no_docs):
    assert packing.packed_documents(no_docs, WORDS).count() == 0 and tree_bpe.encode_digest(no_docs, BYTES).count() == 0


# -- archives ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def pages(spark, small):
    big = "x" * 1500
    odd = [(9001, "http://a/\r\nb", big), (9002, None, big), (None, "u", big), (9003, "u", None), (9004, "u", ""),
           (9005, "u", "é" * 100), (9006, "u", "é" * 100), (9007, "u", big), (9007, "u", big)]
    extra = spark.createDataFrame(odd, "page_id long, url string, html string")
    return spark.read.parquet(f"{small}/pages.parquet").select("page_id", "url", "html").union(extra)


def test_archive_round_trip(pages):
    rows, groups = pages.collect(), collections.defaultdict(list)
    for r in rows:
        body = (r.html or "").encode()
        if len(body) >= 1000 and r.page_id is not None:
            groups[body].append(r.page_id)
    want = []
    for r in rows:
        body = (r.html or "").encode()
        holder = max(groups.get(body, []), default=None)
        again = holder is not None and r.page_id != holder
        want.append((r.page_id, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", holder if again else None))
    assert sorted(map(tuple, warc.archive_round_trip(pages).collect()), key=repr) == sorted(want, key=repr)
    assert warc.archive_round_trip(pages.where("false")).count() == 0


def test_headers_decide_what_is_read(spark, pages, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/w"
    warc.write_warc(pages, path)
    plain = warc.read_warc(spark, path)
    assert plain.schema.names[0] == "record_id" and plain.count() == pages.count()
    some = warc.read_warc(spark, path, "page_id", "record_type").where("page_id > 40 and record_type = 'response'")
    text = some._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in text and "Filter [" not in text  # taken over by the source
    assert {r.page_id for r in some.collect()} == {r.page_id for r in plain.where("page_id > 40 and record_type = 'response'").collect()}
    monkeypatch.setattr(warc, "_payload", lambda block: 1 / 0)
    for file in glob.glob(f"{tmp_path}/w/*.warc"):
        with open(file, "rb") as f:
            assert all(r["payload"] is None for r in warc.records(warc._Plain(f), lambda row: True, False))
    with pytest.raises(AnalysisException, match="no such columns"):
        spark.read.format("warc").schema("nothing string").load(path).collect()


def test_compressed_archives_and_lost_files(spark, pages, tmp_path):
    path = f"{tmp_path}/w"
    warc.write_warc(pages, f"file://{path}")
    n = warc.read_warc(spark, path).count()
    (tmp_path / "w" / "part-of-a-lost-task.warc").write_bytes(b"WARC/1.1\r\nWARC-Type: response\r\n")
    assert warc.read_warc(spark, path, "page_id").count() == n  # not in the list of the finished write
    (tmp_path / "g").mkdir()
    for k, file in enumerate(glob.glob(f"{path}/part-*.warc")):
        records = open(file, "rb").read().split(b"WARC/1.1\r\n")[1:]
        if "lost" not in file:
            (tmp_path / "g" / f"{k}.warc.gz").write_bytes(b"".join(gzip.compress(b"WARC/1.1\r\n" + r) for r in records))
    sums = [warc.read_warc(spark, p).where("record_type = 'response'").agg(F.count("*"), F.sum(F.length("payload"))).first()
            for p in (path, f"{tmp_path}/g")]
    assert sums[0] == sums[1]


# -- page text -------------------------------------------------------------------------


def test_articles_of_the_pages(spark, small):
    import html
    import re

    pages = spark.read.parquet(f"{small}/pages.parquet")
    found = {r.page_id: r for r in wrappers.main_text(pages).collect()}
    for r in pages.collect():
        inside = re.search(r"<article>(.*?)</article>", r.html, re.S).group(1)
        lines = [" ".join(html.unescape(re.sub(r"</?[a-zA-Z][^>]*>", "", part.replace("<br>", " "))).split())
                 for part in re.split(r"</?(?:p|h1)>", inside)]
        want = "\n".join(x for x in lines if x)
        assert found[r.page_id].text == want and found[r.page_id].n_chars == len(want)


PAGE = """<!doctype html><html><head><title>T%d</title><script>if (1 < 2) document.write("<p>no</p>")</script></head><body>
<!-- <p>no</p> --><div id="wrap%d"><div class="top-menu"><a href=/>Home</a> <a href=/x>News</a></div>
<div class="c%d"><h2>Title &#8470; %d</h2><div class=story><p>Body text number %d is here &amp; long
 enough to count<p>second <b>%d</b>rd para<ul><li>item %d one<li>item two %d</ul></div></div>
<div class="box">About us always the same words here and there</div><div class="cookie-notice">We use cookies %d</div>
<div class="comment-list"><p>I disagree %d strongly with everything said here</p></div>
<form><p>Name %d</p></form><aside>Also %d</aside></div></body></html>"""


def test_pages_without_a_marked_article(spark):
    rows = [(i, f"http://q.example/{i}", PAGE % tuple(i * k for k in range(1, 13))) for i in range(1, 9)]
    rows += [(90, None, None), (91, "http://z/", ""), (92, "http://z/", "plain <b>words</b> only < 3")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    out = {r.page_id: r.text for r in wrappers.main_text(df).collect()}
    assert out[3] == "Title № 12\nBody text number 15 is here & long enough to count\nsecond 18rd para\nitem 21 one\nitem two 24"
    assert out[90] == "" and out[91] == "" and out[92] == "plain words only < 3"
    assert wrappers.main_text(df.where("false")).count() == 0


def texts_of(spark, pages):
    """Main text by number, of pages given as (host, html)."""
    rows = [(i, f"http://{host}/{i}", page) for i, (host, page) in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    out = {r.page_id: r.text for r in wrappers.main_text(df).collect()}
    return [out[i] for i in range(len(rows))]


def test_names_that_say_nothing_of_a_part(spark):
    frames = ["<body class=no-sidebar><article>%s</article>", "<body class=search-results><div class=x>%s</div>",
              "<html class=cookie-consent><body><article>%s</article>", "<div id=page class=has-sidebar><article>%s</article></div>",
              "<article class=has-comments>%s</article>", "<div class='widget wrap'><div class=x>%s</div></div>",
              "<div class=overlay><article>%s</article></div>"]
    pages = [(f"h{k}.example", frame % f"<p>Text {k} of {i} and more") for k, frame in enumerate(frames) for i in range(4)]
    assert texts_of(spark, pages) == [f"Text {k} of {i} and more" for k in range(len(frames)) for i in range(4)]
    listed = "<article><p>Own %d text</article><div class=comment-list><article class=comment><p>Long %d reply of many words</article></div>"
    assert texts_of(spark, [("c.example", listed % (i, i)) for i in range(4)]) == [f"Own {i} text" for i in range(4)]


def test_a_host_with_two_templates(spark):
    pages = [("two.example", ("<article><p>Marked %d text</article><div>Other words %d</div>" if i % 2 else
                              "<div class=content><p>Plain %d text of some words</div><div class=menu>Menu %d</div>") % (i, i))
             for i in range(12)]
    assert texts_of(spark, pages) == [f"Marked {i} text" if i % 2 else f"Plain {i} text of some words" for i in range(12)]


def test_copies_of_a_page_are_no_constant_text(spark):
    page = "<div class=x><h2>Only title</h2><p>One paragraph</div><div class=menu>Menu %d</div>"
    other = "<div class=x><h2>Title %d</h2><p>Paragraph %d</div><div class=box>Same box</div>"
    pages = [("copies.example", page % (i // 2)) for i in range(6)] + [("other.example", other % (i, i)) for i in range(4)]
    want = ["Only title\nOne paragraph"] * 6 + [f"Title {i}\nParagraph {i}" for i in range(4)]
    assert texts_of(spark, pages) == want


def test_text_beside_the_container_with_most_text_stays(spark):
    page = "<div class=lead>Lead %d</div><div class=x>" + "<p>Body %d words" * 30 + "</div><section>Last part %d</section>"
    want = ["\n".join([f"Lead {i}", *[f"Body {i} words"] * 30, f"Last part {i}"]) for i in range(4)]
    assert texts_of(spark, [("b.example", page % ((i,) * 32)) for i in range(4)]) == want


def test_constant_text_at_a_position_of_the_wrapper(spark):
    def page(i):
        body = "".join(f"<p>Paragraph {k} of text {i}</p>" for k in range(1 + i % 3))
        extra = "<div><p>Optional notice</p></div>" if i % 2 else ""
        return f"<article><h1>Same head</h1><p>An advert</p>{body}<p>Read more of us</p>{extra}<section><p>End {i}</p></section></article>"

    def text(i):
        return "\n".join(["Same head", *[f"Paragraph {k} of text {i}" for k in range(1 + i % 3)], f"End {i}"])

    versions = "<article>" + "<p>As in all versions</p><p>The same again</p>" * 3 + "<p>Version %d</p></article>"
    pages = [("a.example", page(i)) for i in range(12)] + [("v.example", versions % i) for i in range(4)]
    pages += [("p.example", page(i).replace("article", "div")) for i in range(12)]
    lines = "As in all versions\nThe same again\n" * 3
    want = [text(i) for i in range(12)] + [f"{lines}Version {i}" for i in range(4)]
    want += [text(i).replace("Same head\n", "") for i in range(12)]
    assert texts_of(spark, pages) == want


def test_repeats_fold_and_missing_parts_become_optional():
    def page(body):
        return wrappers.fold([wrappers._item(t) for t in tokens(f"<div>{body}</div>")])

    three, one, none = (page("".join(f"<p>x{i}" for i in range(n)) + "<ul><li>a</ul>") for n in (3, 1, 0))
    merged = wrappers.merge(wrappers.merge(three, one), none)
    assert [i.key.startswith("(") for i in merged].count(True) == 1
    group = next(i for i in merged if i.group)
    assert group.optional and not merged[0].optional
    assert next(s for s in group.slots()).pages >= 2
    back = wrappers.from_json(wrappers.to_json(merged))
    assert wrappers.to_json(back) == wrappers.to_json(merged)


def test_token_stream_survives_broken_markup():
    for text in ("<", "<p", "</", "<!--", "<a href='x", "<div><p>a</section></div>b", "<script>x", "</div></div>", "&#0;&#x110000;&bogus;"):
        tokens(text)
    assert [t.text for t in tokens("<p>a<b>b</b>c &lt;d&gt;</p>e") if t.key == TEXT] == ["abc <d>", "e"]
