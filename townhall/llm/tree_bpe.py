"""Byte-pair encoding and decoding with the tokenizers library, exact for texts of any length.

White space followed by other characters is a chunk; the pre-tokenizer never joins characters
across the end of a chunk, so a text's ids are those of its chunks in turn. Chunks recur, so a task
encodes (and decodes) a chunk it has met lately once. That memory is bounded by entries.

A stretch that the pre-tokenizer leaves unsplit can be as long as a text. Such stretches are cut
into leaves that are encoded as rows of their own, in parallel. Neighbours are then joined in a
tree: a window of tokens around the join is encoded anew and grows until its first token is the
left side's and its last token the right side's. Every pair of neighbouring tokens is then one
that the encoder itself has produced, which makes the whole the encoding of the whole.

Defined results: a null or empty text has no ids and decodes to the empty text; repeated rows
are encoded alike; an empty table gives an empty result.

The leaves of one text are joined by many tasks: a level joins each run of ``FAN`` neighbours in a group of its own,
and there are as many levels as the longest stretch needs, one for each power of ``FAN``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from townhall.llm.frames import id_and_text
from townhall.session import settle

UNSPLIT = 4096  # characters; longer stretches are cut into leaves of half this or less
CACHE_ENTRIES = 120_000
FAN = 16  # neighbours joined in one task; 4 levels are enough for stretches of 100 million characters

# fixed values: the characters that Unicode calls white space
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACES = frozenset(re.sub("(.)-(.)", lambda m: "".join(map(chr, range(ord(m[1]), ord(m[2]) + 1))), SPACE))
CHUNK = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")

LOADED: dict = {}


def tokenizer(path: str):
    """One per worker process and file; without threads of its own, as Spark has the cores."""
    if path not in LOADED:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(path)
        made.no_truncation()
        made.no_padding()
        LOADED[path] = made
    return LOADED[path]


class ChunkCache:
    """What a function makes of distinct chunks, for many texts.

    Two generations: when the young one is full it becomes the old one, and what is used again
    comes back, so frequent chunks stay and memory holds at most twice ``entries``.
    """

    def __init__(self, make: Callable[[list[str]], list], entries: int = CACHE_ENTRIES):
        self._make, self._entries, self._young, self._old = make, entries, {}, {}

    def of(self, chunks: list[str]) -> list:
        young, old = self._young, self._old
        missing = sorted(set(chunks).difference(young))
        if missing:
            new = [c for c in missing if c not in old]
            young.update((c, old[c]) for c in missing if c in old)
            young.update(zip(new, self._make(new)))
        found = [*map(young.__getitem__, chunks)]
        if len(young) > self._entries:
            self._old, self._young = young, {}
        return found


def _joined(ids: list[int]) -> str:
    return ",".join(map(str, ids))


def _token_bytes(model) -> np.ndarray:
    """Bytes that each token stands for. A byte is one letter in this vocabulary; special tokens are text."""
    special = {k: t.content for k, t in model.get_added_tokens_decoder().items()}
    widths = np.zeros(model.get_vocab_size(), np.int64)
    for letters, k in model.get_vocab().items():
        widths[k] = len(special[k].encode()) if k in special else len(letters)
    return widths


class _Coder:
    """Ids of chunks as written text, and whether any chunk does not come back as it was."""

    def __init__(self, path: str):
        self.model = tokenizer(path)
        self.changed: set[str] = set()
        self._widths = _token_bytes(self.model)
        self.cache = ChunkCache(self._make)

    def _make(self, chunks: list[str]) -> list[str]:
        # chunks that begin with a gap and do not end with one are encoded as one text and cut
        # apart by the bytes of the tokens; the others one by one
        run = [c for c in chunks if c[0] in _SPACES and c[-1] not in _SPACES]
        text = "".join(run)
        ids = self.model.encode(text, add_special_tokens=False).ids
        known: dict[str, str] = {}
        if self.model.decode(ids, skip_special_tokens=False) == text:
            ends = np.cumsum([len(c.encode()) for c in run])
            cuts = (np.searchsorted(np.cumsum(self._widths[ids]), ends) + 1).tolist() if run else []
            names = [*map(str, ids)]
            known = {c: ",".join(names[i:j]) for c, i, j in zip(run, [0, *cuts], cuts)}
        alone = [c for c in chunks if c not in known]
        found = [e.ids for e in self.model.encode_batch(alone, add_special_tokens=False)]
        for chunk, own, out in zip(alone, found, self.model.decode_batch(found, skip_special_tokens=False)):
            known[chunk] = _joined(own)
            if out != chunk:
                self.changed.add(chunk)
        return [known[c] for c in chunks]


# fixed values: the pre-tokenizer's own pattern, for text of ASCII and the letters of Latin-1
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN_PIECE = re.compile(
    rf" ?[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)| ?[0-9]+| ?[^ \n\r\t{_LETTERS}0-9]+|[ \n\r\t]+(?![^ \n\r\t])|[ \n\r\t]+"
)
_PLAIN = bytes([9, 10, 13, *range(32, 127), *(c for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7))])


def is_plain(text: str) -> bool:
    """Whether a text has only ASCII and letters of Latin-1, and nothing like a special token."""
    try:
        return "<|" not in text and not text.encode("latin-1").translate(None, _PLAIN)
    except UnicodeEncodeError:
        return False


def _encode_rows(path: str, unsplit: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of each text; a text with a chunk that may hold a long stretch is handed on as it is.

    Plain texts are cut by the pre-tokenizer's own pattern, others into chunks.
    """
    if ("coder", path) not in LOADED:  # kept between the tasks of a worker
        LOADED["coder", path] = _Coder(path)
    coder = LOADED["coder", path]
    for batch in batches:
        counts, digests, decoded, handed = [], [], [], []
        for text in batch.column("text"):
            text = text.as_py()
            chunks = _PLAIN_PIECE.findall(text) if is_plain(text) else CHUNK.findall(text)
            if len(text) > unsplit and max(map(len, chunks)) > unsplit:
                for out, value in ((counts, None), (digests, None), (decoded, None), (handed, text)):
                    out.append(value)
                continue
            written = ",".join(coder.cache.of(chunks))
            back = text
            if coder.changed and not coder.changed.isdisjoint(chunks):
                ids = [*map(int, written.split(","))] if written else []
                back = coder.model.decode(ids, skip_special_tokens=False)
            counts.append(written.count(",") + 1 if written else 0)
            digests.append(hashlib.sha256(written.encode()).hexdigest())
            decoded.append(hashlib.sha256(back.encode()).hexdigest())
            handed.append(None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(digests, pa.string()),
             pa.array(decoded, pa.string()), pa.array(handed, pa.string())],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "long_text"],
        )


def stretches(model, text: str) -> list[tuple[bool, str]]:
    """A text as special tokens (True) and the stretches that the pre-tokenizer leaves unsplit.

    Stretches are in the alphabet of the model, one letter for each byte.
    """
    special = [t.content for t in model.get_added_tokens_decoder().values()]
    split = re.split("(" + "|".join(map(re.escape, special)) + ")", text) if special else [text]
    out: list[tuple[bool, str]] = []
    for part in split:
        if part in special:
            out.append((True, part))
        elif part:
            out += [(False, piece) for piece, _ in model.pre_tokenizer.pre_tokenize_str(part)]
    return out


def join(encode: Callable[[str], list[tuple[int, str]]], left: list, right: list) -> list:
    """Tokens (id, letters) of two neighbouring stretches as those of the two in one."""
    width = 1
    while True:
        a, b = left[-width:], right[:width]
        window = encode("".join(t for _, t in a) + "".join(t for _, t in b))
        if (width >= len(left) or window[0] == a[0]) and (width >= len(right) or window[-1] == b[-1]):
            return left[: len(left) - len(a)] + window + right[len(b) :]
        width *= 2


def tree(encode: Callable[[str], list[tuple[int, str]]], leaves: list[list]) -> list:
    """Joins leaves pairwise until one is left."""
    while len(leaves) > 1:
        joined = [join(encode, a, b) for a, b in zip(leaves[::2], leaves[1::2])]
        leaves = joined + ([leaves[-1]] if len(leaves) % 2 else [])
    return leaves[0] if leaves else []


def _tokens(model, letters: str) -> list[tuple[int, str]]:
    return [(t.id, t.value) for t in model.model.tokenize(letters)]


def _to_leaves(path: str, unsplit: int, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row for each leaf, special token and short stretch of a long text, with how many leaves its part has."""
    model, leaf = tokenizer(path), max(unsplit // 2, 1)
    for batch in batches:
        for node, text in zip(batch["node"], batch["text"]):
            rows = []
            for part, (special, letters) in enumerate(stretches(model, text)):
                if special or len(letters) <= unsplit:
                    rows.append((node, part, 0, 1, special, letters))
                else:
                    starts = range(0, len(letters), leaf)
                    rows += [(node, part, k, len(starts), False, letters[i : i + leaf]) for k, i in enumerate(starts)]
            yield pd.DataFrame(rows, columns=["node", "part", "leaf", "leaves", "special", "letters"])


def _encode_leaves(path: str, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    model = tokenizer(path)
    for batch in batches:
        found = [
            [(model.token_to_id(letters), letters)] if special else _tokens(model, letters)
            for special, letters in zip(batch["special"], batch["letters"])
        ]
        yield pd.DataFrame({
            "node": batch["node"], "part": batch["part"], "leaf": batch["leaf"], "leaves": batch["leaves"],
            "ids": [[i for i, _ in f] for f in found], "values": [[v for _, v in f] for f in found],
        })


def _join_run(path: str, group: pd.DataFrame) -> pd.DataFrame:
    """Neighbouring nodes of one stretch as one node of the next level."""
    model, run = tokenizer(path), group.sort_values("leaf")
    whole = tree(partial(_tokens, model), [list(zip(map(int, i), v)) for i, v in zip(run["ids"], run["values"])])
    return pd.DataFrame({
        "node": [run["node"].iloc[0]], "part": [run["part"].iloc[0]], "leaf": [run["run"].iloc[0]],
        "ids": [[i for i, _ in whole]], "values": [[v for _, v in whole]],
    })


def encode_long(texts: DataFrame, path: str, unsplit: int = UNSPLIT, fan: int = FAN) -> DataFrame:
    """From distinct long texts (node, text): (node, ids). Leaves are rows of their own, joined level by level."""
    leaves = texts.mapInPandas(
        partial(_to_leaves, path, unsplit), "node binary, part int, leaf int, leaves int, special boolean, letters string"
    )
    found = "node binary, part int, leaf int, ids array<int>, values array<string>"
    encoded = settle(leaves.repartition("node", "part", "leaf").mapInPandas(
        partial(_encode_leaves, path), found.replace("leaf int", "leaf int, leaves int")), "leaves")
    nodes, left = encoded.where("leaves > 1").drop("leaves"), encoded.agg(F.max("leaves")).first()[0] or 1
    while left > 1:
        runs = nodes.withColumn("run", F.floor(F.col("leaf") / fan).cast("int"))
        nodes, left = runs.groupBy("node", "part", "run").applyInPandas(partial(_join_run, path), found), -(-left // fan)
    parts = encoded.where("leaves = 1").select("node", "part", "ids").unionByName(nodes.select("node", "part", "ids"))
    # put side by side without Python; what a group holds is one text's ids, as the row of its text did
    in_order = F.array_sort(F.collect_list(F.struct("part", "ids")))
    return parts.groupBy("node").agg(F.flatten(F.transform(in_order, lambda p: p["ids"])).alias("ids"))


def _digest_long(path: str, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    model = tokenizer(path)
    for batch in batches:
        ids = [[*map(int, x)] for x in batch["ids"]]
        back = [model.decode(x, skip_special_tokens=False) for x in ids]
        yield pd.DataFrame({
            "node": batch["node"], "n_tokens": [len(x) for x in ids],
            "ids_sha256": [hashlib.sha256(_joined(x).encode()).hexdigest() for x in ids],
            "decoded_sha256": [hashlib.sha256(x.encode()).hexdigest() for x in back],
        })


def encode_digest(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", unsplit: int = UNSPLIT
) -> DataFrame:
    """Per row: doc_id, n_tokens, and digests of the ids and of what they decode to."""
    plain = id_and_text(docs, id_col, text_col)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    first = settle(plain.mapInArrow(partial(_encode_rows, path, unsplit), schema + ", long_text string"), "encoded")
    short = first.where("long_text is null").drop("long_text")
    long = first.where("long_text is not null").select("doc_id", F.col("long_text").alias("text")).withColumn(
        "node", F.unhex(F.md5("text")))
    ids = encode_long(long.dropDuplicates(["node"]).select("node", "text"), path, unsplit)
    digests = ids.mapInPandas(
        partial(_digest_long, path), "node binary, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
    joined = long.select("doc_id", "node").join(digests, "node").drop("node")
    return short.unionByName(joined)
