"""Best-fit packing of token pieces into sequences by a configuration linear program.

Pieces are known by their lengths alone, so the histogram, at most as long as a sequence, is all
that one machine sees. The program asks for the fewest sequences such that every length is
covered; a column is a way to fill one sequence. Multiplicative weights solve it: lengths that
lag behind gain weight, a knapsack over the weights prices every column that starts with a given
length, and each length still uncovered buys its best column. Rounds go on until all but ``GAP`` of the
volume is covered. Prices over the dearest filling they allow are a solution of the dual program: a lower
bound of the sequences that any packing needs. Whole multiples of the columns are taken; what rounding
leaves over is packed best fit, longest first.

Every piece then finds its place from its rank among the pieces of its length, by binary search in a
table of at most (columns x 63) rows, as 63 different lengths fill a sequence of 2048.

Defined results: a null or empty text is the single end token; rows with one id are packed each;
an empty table gives an empty result.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from townhall.llm.frames import id_and_text
from townhall.llm.tree_bpe import CACHE_ENTRIES, LOADED, is_plain, tokenizer
from townhall.session import settle

SEQUENCE = 2048
END = 0
ROUNDS = 48  # of multiplicative weights in which the pace rises to the whole histogram
GAP = 0.002  # share of the volume that may stay uncovered when the rounds end
RATE = 0.03  # how fast prices follow the distance from the pace
SLACK = 0.05  # how far below the best column's worth one may be bought
WORD_ENTRIES = 250_000  # words of plain texts whose ids a worker remembers at least
PARTS = (1.0, 0.9, 0.75, 0.5, 0.25, 0.0)  # of the solution that are rounded

_WORD = re.compile(r"[^ \n\r\t]+")
# fixed values: the tokenizer's own pattern, for lowered text of ASCII and the letters of Latin-1
_PLAIN_WORD = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^ \n\r\ta-zß-öø-ÿ0-9]+")


def _packed_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Lately(dict):
    """What ``make`` makes of a key, made when it is first asked for.

    Two generations: ``turned`` makes a full one the old one, and what is asked for again comes back, so
    frequent keys stay and memory holds twice ``entries`` and one text's at most.
    """

    def __init__(self, make: Callable[[str], bytes], entries: int, old: dict[str, bytes] | None = None):
        super().__init__()
        self._make, self._entries, self._old = make, entries, old or {}

    def __missing__(self, key: str) -> bytes:
        found = self._old.get(key)
        if found is None:
            found = self._make(key)
        self[key] = found
        return found

    def turned(self) -> _Lately:
        if len(self) <= self._entries:
            return self
        self._old = {}
        return _Lately(self._make, self._entries, self)


# of the characters of Latin-1: 0 for white space and the apostrophe, 1 letters, 2 digits, 3 signs
_KINDS = bytes(0 if chr(c) in " \n\r\t'" else 1 if chr(c).isalpha() else 2 if 48 <= c < 58 else 3 for c in range(256))
_MEET = bytes(k < 16 and k // 4 > 0 and k % 4 > 0 and (k // 4 != k % 4 or k % 4 == 2) for k in range(256))


def _apart(text: str) -> str:
    """Lowered plain text with a space wherever letters, single digits and signs meet, but beside an apostrophe.

    The tokenizer's pattern begins anew at all these places.
    """
    raw = text.encode("latin-1")
    kinds = np.frombuffer(raw.translate(_KINDS), np.uint8)
    meet = np.frombuffer((4 * kinds[:-1] + kinds[1:]).tobytes().translate(_MEET), bool)
    return np.insert(np.frombuffer(raw, np.uint8), np.flatnonzero(meet) + 1, 32).tobytes().decode("latin-1")


class _Coder:
    """Ids of texts: those of the words of plain texts, of others those of what stands between white space."""

    def __init__(self, path: str):
        self._model = tokenizer(path)
        self._bpe = self._model.model
        letters = map(chr, [*range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)])  # of Latin-1
        self._alphabet = str.maketrans({c: self._model.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in letters})
        self._words, self._chunks = _Lately(self._word, WORD_ENTRIES), _Lately(self._chunk, CACHE_ENTRIES)

    def _word(self, word: str) -> bytes:
        """What ``_apart`` leaves is a word, given to the tokenizer's model whole, or holds an apostrophe."""
        if "'" in word and len(parts := _PLAIN_WORD.findall(word)) > 1:
            return b"".join(map(self._words.__getitem__, parts))
        letters = word if word.isascii() else word.translate(self._alphabet)
        return _packed_ids([t.id for t in self._bpe.tokenize(letters)])

    def _chunk(self, chunk: str) -> bytes:
        if is_plain(chunk):
            return b"".join(map(self._words.__getitem__, _PLAIN_WORD.findall(chunk.lower())))
        return _packed_ids(self._model.encode(chunk, add_special_tokens=False).ids)

    def ids(self, text: str) -> bytes:
        if is_plain(text):  # ``split`` knows more white space than the tokenizer, but plain texts have none of it
            found = b"".join(map(self._words.__getitem__, _apart(text.lower()).split()))
        else:
            found = b"".join(map(self._chunks.__getitem__, _WORD.findall(text)))
        self._words, self._chunks = self._words.turned(), self._chunks.turned()
        return found


def _pieces(path: str, size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Token ids of each text, cut.

    White space only separates for this tokenizer, so a text's ids are those of its words, and a
    word met lately is not encoded again. Plain texts are cut into words by the tokenizer's own
    pattern, others at white space.
    """
    if ("packing", path) not in LOADED:  # kept between the tasks of a worker
        LOADED["packing", path] = _Coder(path)
    coder, end = LOADED["packing", path], np.array([END], "<u4").tobytes()
    for batch in batches:
        rows, piece, start, length, check = [], [], [], [], []
        for row, text in enumerate(batch.column("text")):
            ids = coder.ids(text.as_py()) + end
            for k, at in enumerate(range(0, len(ids), 4 * size)):
                part = ids[at : at + 4 * size]
                rows.append(row)
                piece.append(k)
                start.append(at // 4)
                length.append(len(part) // 4)
                check.append(zlib.crc32(part))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()),
             pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(check, pa.int64())],
            names=["doc_id", "piece", "start", "length", "ids_crc32"],
        )


def token_pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 size: int = SEQUENCE) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""
    return id_and_text(docs, id_col, text_col).mapInArrow(
        partial(_pieces, path, size), "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def _knapsack(value: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Best value of each room, and the length to take first there (0: leave it empty)."""
    best, take = np.zeros(size + 1), np.zeros(size + 1, np.int64)
    for room in range(1, size + 1):
        gain = value[1 : room + 1] + best[room - 1 :: -1]
        at = int(np.argmax(gain))
        best[room], take[room] = max((best[room - 1], take[room - 1]), (gain[at], at + 1))
        if best[room] == best[room - 1]:
            take[room] = take[room - 1]
    return best, take


def _column(first: int, take: np.ndarray, size: int) -> dict[int, int]:
    found, room = {first: 1}, size - first
    while room > 0 and take[room]:
        length = int(take[room])
        found[length] = found.get(length, 0) + 1
        room -= length
    return found


@dataclass
class Program:
    """Columns with how often to use them, a lower bound of the sequences needed, pieces of each length covered."""

    columns: list[tuple[dict[int, int], float]]
    bound: float
    covered: np.ndarray


def program(counts: np.ndarray, size: int = SEQUENCE, rounds: int = ROUNDS) -> Program:
    """The configuration program of a histogram: ``counts[l]`` pieces of length ``l`` are to be covered.

    Prices start as shares of a sequence. In each round the knapsack prices every column that
    begins with a given length; lengths behind the pace of the rounds buy theirs if it is worth
    nearly as much as the best one. Prices of lengths behind the pace then rise and those of
    lengths ahead fall, by a factor of their distance. No column covers a length beyond its
    count, so nothing is bought twice. The pace rises for ``rounds`` rounds; those that follow at the full pace each
    cover at least one more length to its end, the first of the best column, so there are at most ``size`` of them.
    """
    lengths = np.flatnonzero(counts)
    covered, price = np.zeros(size + 1), np.arange(size + 1) / size
    volume = float((counts * np.arange(size + 1)).sum())
    if not len(lengths):
        return Program([], 0.0, covered)
    held = counts.astype(float)
    columns: dict[tuple, float] = {}
    bound, step = volume / size, 0
    while True:
        step += 1
        pace = min(step / rounds, 1.0)
        value = np.full(size + 1, -np.inf)
        open_ = lengths[covered[lengths] < held[lengths] * (1 - 1e-9)]
        if not len(open_) or step > rounds and ((held - covered) * np.arange(size + 1)).sum() <= GAP * volume:
            return Program([(dict(k), v) for k, v in columns.items()], bound, covered)
        value[open_] = price[open_]
        best, take = _knapsack(value, size)
        if step % 8 == 0:  # prices over the dearest filling of a sequence are a solution of the dual
            value[lengths] = price[lengths]
            bound = max(bound, float((held * price).sum() / _knapsack(value, size)[0][size]))
        behind = open_[covered[open_] < pace * held[open_]]
        worth = price[behind] + best[size - behind]
        for length in behind[worth >= (1 - SLACK) * best[size]][::-1].tolist():
            column = _column(length, take, size)
            share = min([(pace * held[length] - covered[length]) / column[length]]
                        + [(held[x] - covered[x]) / n for x, n in column.items()])
            if share <= 0:
                continue
            key = tuple(sorted(column.items()))
            columns[key] = columns.get(key, 0.0) + share
            for x, n in column.items():
                covered[x] += share * n
        price[lengths] *= np.exp(RATE * (pace - covered[lengths] / held[lengths]))
        price /= max(best[size], 1e-12)


def solve(counts: np.ndarray, size: int = SEQUENCE, rounds: int = ROUNDS) -> list[tuple[dict[int, int], float]]:
    """Columns and how often to use them; what they leave uncovered is left to the rounding."""
    return program(counts, size, rounds).columns


def _rounded(counts: np.ndarray, columns: list[tuple[dict[int, int], float]], part: float,
             size: int) -> list[tuple[dict[int, int], int]]:
    """Whole multiples of a part of the solution; the rest goes best fit, longest first."""
    left = counts.astype(np.int64).copy()
    out: list[tuple[dict[int, int], int]] = []
    for column, share in columns:
        times = min([int(part * share)] + [int(left[x]) // n for x, n in column.items()])
        if times > 0:
            out.append((column, times))
            for x, n in column.items():
                left[x] -= times * n
    while True:
        there = np.flatnonzero(left)
        if not len(there):
            return out
        column, room = {}, size
        while room > 0:
            there = there[(there <= room) & (left[there] > [column.get(int(x), 0) for x in there])]
            if not len(there):
                break
            length = int(there[-1])
            n = min(room // length, int(left[length]) - column.get(length, 0))
            column[length] = column.get(length, 0) + n
            room -= n * length
        times = min(int(left[x]) // n for x, n in column.items())
        out.append((column, times))
        for x, n in column.items():
            left[x] -= times * n


def packed(counts: np.ndarray, size: int = SEQUENCE) -> list[tuple[dict[int, int], int]]:
    """Ways to fill a sequence, each with how many sequences use it; all pieces are placed once.

    The solution is rounded at several parts of its size, as a larger rest leaves more short
    pieces to fill gaps with; the rounding with the fewest sequences is taken. Part 0 is best fit
    alone, so the result never needs more sequences than that.
    """
    columns = solve(counts, size)
    tried = [_rounded(counts, columns, part, size) for part in PARTS]
    return min(tried, key=lambda ways: sum(times for _, times in ways))


def places(ways: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Rows length, low, high (ranks), first sequence, pieces of the length in each, first offset."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for column, times in ways:
        offset = 0
        for length, n in sorted(column.items(), reverse=True):
            low = used.get(length, 0)
            used[length] = low + n * times
            rows.append((length, low, low + n * times, sequence, n, offset))
            offset += n * length
        sequence += times
    return rows


def _seat(table: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sequence and offset of pieces; ``table`` as ``places`` gives it, sorted by length and low."""
    most = int(table[:, 2].max(initial=0)) + 1
    key = table[:, 0] * most + table[:, 1]  # ranks of a length stay below ``most``
    for batch in batches:
        length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
        row = table[np.searchsorted(key, length * most + rank, "right") - 1] if len(batch) else table[:0]
        nth = rank - row[:, 1]
        columns = [batch.column(c) for c in batch.schema.names if c != "rank"]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(row[:, 3] + nth // row[:, 4]), pa.array(row[:, 5] + nth % row[:, 4] * row[:, 0])],
            names=[*(c for c in batch.schema.names if c != "rank"), "sequence_id", "offset"])


def pack(pieces: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """Adds sequence_id and offset to pieces (a column ``length`` of 1 to ``size``)."""
    spark = pieces.sparkSession
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = [c for c in pieces.columns]
    salted = settle(pieces.withColumn("salt", F.pmod(F.xxhash64(*names), F.lit(salts))), "pieces")
    counts = settle(salted.groupBy("length", "salt").agg(F.count("*").alias("n")), "piece-counts")
    histogram = np.zeros(size + 1, np.int64)
    for length, n in counts.groupBy("length").agg(F.sum("n")).collect():  # at most ``size`` rows
        histogram[length] = n
    table = np.array(places(packed(histogram, size)), np.int64).reshape(-1, 6)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    order = Window.partitionBy("length", "salt").orderBy(*names)
    ranked = salted.withColumn("nth", F.row_number().over(order) - 1).join(bases, ["length", "salt"])
    ranked = ranked.withColumn("rank", F.col("base") + F.col("nth"))
    kinds = {f.name: f.dataType.simpleString() for f in pieces.schema.fields}
    out = ", ".join([*(f"`{c}` {kinds[c]}" for c in names), "sequence_id long", "offset long"])
    return ranked.select(*names, "rank").mapInArrow(partial(_seat, table), out)


def packed_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                     size: int = SEQUENCE) -> DataFrame:
    return pack(token_pieces(docs, path, id_col, text_col, size), size)
