"""Best-fit packing of tokenized documents into sequences of one length.

Large items are matched: pieces above a third of the capacity go at most two to a sequence, each with the largest
partner that still fits. Smaller pieces then go to the smallest gap that holds them, longest first. The decision
needs only how many pieces have each length, at most `capacity` numbers however large the corpus is, so the driver
plans on that histogram; Spark numbers the pieces of each length and looks up each number's place.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import Scratch, kept, map_columns, numbered

CAPACITY = 1024
END_ID = 2
#: Distinct words whose ids a worker remembers; beyond it, it keeps those met most often.
REMEMBERED = 200_000

#: New words are encoded as lines of one text, so many at once.
LINES = 2_000

_ADJACENT_SPACE = re.compile(r"\s\s")
_WORD_BORDER = re.compile(r"(?<=\S) (?=\S)")
#: White space in lines of words that doesn't lead a word: odd kinds, inner and trailing spaces, empty lines.
_INNER_SPACE = re.compile(r"(?<!\n)[^\S\n]|[^\S \n]| \n|\n\n")
_LINE_END = ("\n",)
#: Fixed value: how the tokenizer cuts a text before it merges bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def merge_ranks(tokenizer) -> dict[bytes, int]:
    """The bytes of each token of a byte-level vocabulary and its id; ids grow as merges do, which `checked` proves on words."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {chr(c): c for c in plain} | {chr(256 + k): c for k, c in enumerate(c for c in range(256) if c not in plain)}
    return {bytes(shown[c] for c in token): k for token, k in tokenizer.get_vocab(with_added_tokens=False).items() if all(c in shown for c in token)}


class WordEncoder(dict):
    """Encodes texts with a byte-level BPE tokenizer, each distinct word once.

    The tokenizer never merges across a single space or line end between two other characters, so a text's ids are
    those of its space-led words and line ends one after the other. Keys: a word that a space leads, or a 1-tuple with
    a line's first word or its end. Texts that hold an added token, such as <|endoftext|>, go to the tokenizer whole.
    New words are merged by a second library over the tokenizer's own vocabulary, several times as fast; a worker's
    first words go through both, and if they ever differ the tokenizer does all.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=merge_ranks(self.tokenizer), special_tokens={}).encode_ordinary
        self.line_end = self.slow("\n")
        self.unchecked = 3_000
        self.forget()

    def slow(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def forget(self) -> None:
        self.clear()
        self.waiting: list[str] = []
        self.flat, self.used, self.ends, self.met = np.empty(1 << 16, np.uint32), 0, np.zeros(1, np.int64), np.zeros(0, np.int64)

    def thin(self) -> None:
        """Keeps the words met most often, half of REMEMBERED at most."""
        least = max(2, int(np.partition(self.met, -REMEMBERED // 2)[-REMEMBERED // 2]) + 1)
        kept = np.flatnonzero(self.met >= least)
        words, size, first = list(self), np.diff(self.ends)[kept], self.ends[kept]
        ends, met = np.cumsum(size), self.met[kept]
        flat = self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - size), size)]
        self.forget()
        self.update((words[at], k) for k, at in enumerate(kept))
        self.flat, self.used, self.ends, self.met = flat, len(flat), np.concatenate([[0], ends]), met

    def __missing__(self, key) -> int:
        self[key] = at = len(self)
        self.waiting.append(key[0] if type(key) is tuple else " " + key)
        return at

    def ids_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All words' ids and how many each has."""
        if self.unchecked > 0 and self.fast != self.slow:
            self.unchecked -= len(words)
            if any(self.fast(w) != self.slow(w) for w in words):
                self.fast = self.slow
        sizes = np.zeros(len(words), np.int64)
        parts: list[np.ndarray] = []
        plain: list[int] = []
        for low in range(0, len(words) if len(self.line_end) == 1 else 0, LINES):
            some = range(low, min(low + LINES, len(words)))
            text = "\n".join(words[low : low + LINES])
            if _INNER_SPACE.search(f"\n{text}\n"):
                some = [k for k in some if not _INNER_SPACE.search(f"\n{words[k]}\n") and "\n" not in words[k]]
                text = "\n".join(words[k] for k in some)
            if len(some):
                plain += some
                ids = np.array(self.fast(text + "\n"), np.uint32)  # a line end's id follows each word's
                end = ids == self.line_end[0]
                sizes[some] = np.diff(np.flatnonzero(end), prepend=-1) - 1
                parts.append(ids[~end])
        others = sorted(set(range(len(words))).difference(plain)) if len(plain) < len(words) else []
        order = np.array([*plain, *others], np.int64)
        for k in others:
            ids = np.array(self.fast(words[k]), np.uint32)
            sizes[k] = len(ids)
            parts.append(ids)
        flat = np.concatenate(parts) if parts else np.empty(0, np.uint32)
        if others:  # back to the words' own order
            held = np.cumsum(sizes[order]) - sizes[order]
            begins = np.empty(len(words), np.int64)
            begins[order] = held
            ends = np.cumsum(sizes)
            flat = flat[np.arange(len(flat)) + np.repeat(begins - (ends - sizes), sizes)]
        return flat, sizes

    def learn(self) -> None:
        if not self.waiting:
            return
        ids, sizes = self.ids_of(self.waiting)
        ends = self.used + np.cumsum(sizes)
        if ends[-1] > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.empty(int(ends[-1]) * 2 - self.used, np.uint32)])
        self.flat[self.used : ends[-1]] = ids
        self.used, self.ends, self.waiting = int(ends[-1]), np.concatenate([self.ends, ends]), []

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids one after the other, and where each text's end."""
        if len(self) > REMEMBERED:
            self.thin()
        words: list = []
        counts = np.zeros(len(texts), np.int64)
        whole: dict[int, list[int]] = {}
        for k, text in enumerate(texts):
            before = len(words)
            if any(x in text for x in self.added):
                whole[k] = self.slow(text)
            elif _ADJACENT_SPACE.search(text):
                first, *rest = _WORD_BORDER.split(text)
                words.append((first,))
                words += rest
            else:
                for line in text.split("\n"):
                    first, *rest = line.split(" ")
                    words += ((first,), *rest, _LINE_END)
                words.pop()
            counts[k] = len(words) - before
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        self.learn()
        self.met = np.bincount(at, minlength=len(self)) + np.pad(self.met, (0, len(self) - len(self.met)))
        first, size = self.ends[at], self.ends[at + 1] - self.ends[at]
        ends = np.cumsum(size)
        ids = self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - size), size)]
        text_ends = np.append(0, ends)[np.cumsum(counts)]
        if whole:
            parts = np.split(ids, text_ends[:-1])
            parts = [np.array(whole[k], np.uint32) if k in whole else x for k, x in enumerate(parts)]
            ids, text_ends = np.concatenate(parts), np.cumsum([len(x) for x in parts])
        return ids, text_ends


def encoder(path: str) -> WordEncoder:
    """A worker's encoder, kept between tasks."""
    return kept(("encoder", path), lambda: WordEncoder(path))


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if asked, ids.

    A null text counts as empty and yields the end id alone. Repeated rows yield repeated pieces. Other columns are
    ignored. No rows in, no rows out.
    """

    def pieces(ids_of: list, texts: list) -> list:
        ids, ends = encoder(tokenizer_path).encode([t or "" for t in texts])
        sizes = np.diff(ends, prepend=0) + 1
        ids, ends = np.insert(ids, ends, end_id).astype("<u4"), np.cumsum(sizes)
        n = -(-sizes // capacity)
        doc = np.repeat(np.arange(len(sizes)), n)
        piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
        # only a document's first piece may be shorter
        spare = np.repeat(n * capacity - sizes, n)
        start = np.maximum(piece * capacity - spare, 0)
        length = (piece + 1) * capacity - spare - start
        begin = np.repeat(ends - sizes, n) + start
        data = memoryview(ids.view(np.uint8))
        crc = [zlib.crc32(data[4 * a : 4 * (a + m)]) for a, m in zip(begin.tolist(), length.tolist(), strict=True)]
        rows = [pa.array(ids_of, pa.int64()).take(pa.array(doc)), piece.astype(np.int32), start, length, crc]
        return [*rows, [ids[a : a + m].astype(np.int32) for a, m in zip(begin, length, strict=True)]] if with_ids else rows

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return map_columns(docs.select(F.col("doc_id").cast("long"), "text"), pieces, schema, keeps=True)


def plan_layout(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Places for pieces by length: (length, first, count, sequence, each, offset).

    Pieces number first .. first + count - 1 of that length go, `each` to a sequence, to the sequences from
    `sequence` on, from `offset` on. A row uses up a length or a gap, so rows are a few for each length.
    """
    left = {n: c for n, c in histogram.items() if c > 0}
    placed = dict.fromkeys(left, 0)
    rows: list[tuple[int, int, int, int, int, int]] = []
    gaps: list[int] = []  # sorted
    open_at: dict[int, list[tuple[int, int]]] = {}  # gap: (first sequence, how many)
    used = 0

    def put(length: int, count: int, sequence: int, each: int, offset: int) -> None:
        rows.append((length, placed[length], count, sequence, each, offset))
        placed[length] += count
        left[length] -= count

    def leave(gap: int, sequence: int, count: int) -> None:
        if gap and count:
            if gap not in open_at:
                insort(gaps, gap)
            open_at.setdefault(gap, []).append((sequence, count))

    large = sorted(n for n in left if 3 * n > capacity)
    for n in reversed(large):
        while left[n]:
            fits = [p for p in large if p <= min(n, capacity - n) and left[p] > (p == n)]
            mate = max(fits, default=0)
            count = left[n] // 2 if mate == n else min(left[n], left[mate]) if mate else left[n]
            put(n, count, used, 1, 0)
            if mate:
                put(mate, count, used, 1, n)
            leave(capacity - n - mate, used, count)
            used += count
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            k = bisect_left(gaps, n)
            if k == len(gaps):
                fresh = -(-left[n] // (capacity // n))
                leave(capacity, used, fresh)
                used += fresh
                continue
            gap = gaps[k]
            sequence, count = open_at[gap].pop()
            if not open_at[gap]:
                del open_at[gap], gaps[k]
            each = min(gap // n, left[n])
            count_used = min(count, left[n] // each)
            leave(gap, sequence + count_used, count - count_used)
            put(n, count_used * each, sequence, each, capacity - gap)
            leave(gap - each * n, sequence, count_used)
    return rows


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Every piece with its sequence_id and offset; the columns of token_pieces stay.

    Sequences hold at most `capacity` ids, and offsets leave no gap. Equal lengths are numbered by a hash of their
    ids, so ties have no other meaning. Doc_ids must tell documents apart.
    """
    spark: SparkSession = docs.sparkSession
    with Scratch(spark, "packing") as scratch:
        pieces = scratch.save(token_pieces(docs, tokenizer_path, capacity, end_id, with_ids), "pieces", keep=True)
        histogram = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
        plan = spark.createDataFrame(plan_layout(histogram, capacity), "length long, first long, count long, sequence long, each long, at long")
        ranked = numbered(pieces, "length", ["doc_id", "piece"], "rank", sum(histogram.values()))
        own = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("count"))
        # the plan has a few rows for each of at most `capacity` lengths
        placed = ranked.alias("p").join(F.broadcast(plan).alias("q"), (F.col("p.length") == F.col("q.length")) & own)
        nth = F.col("rank") - F.col("first")
        return placed.select("p.doc_id", "p.piece", "p.start", "p.length", "p.ids_crc32", F.expr("sequence + (rank - first) div each").alias("sequence_id"), (F.col("at") + nth % F.col("each") * F.col("p.length")).alias("offset"), *(["p.ids"] if with_ids else []))


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id and its ids; `packed` must hold ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most `capacity` ids
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))
