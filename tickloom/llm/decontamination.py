"""Benchmark decontamination by the q-gram lemma.

Texts are compared in small letters with every run of other characters than letters and digits as one space. Two
strings within e edits share at least m + 1 - q - q e of the m + 1 - q q-grams of the shorter, and all shared ones lie on
diagonals at most e apart. So shared q-grams are counted in bands of diagonals that overlap by half; bands that reach
the bound are regions, and an alignment banded to the region's diagonals decides. Before that, items of which a segment
holds too few q-grams anywhere, of this or a shorter length, are left out: the same lemma without diagonals. Long texts
are searched in segments that overlap by more than the longest item. An item's alignment costs its length times some four
times the edits that it needs, rounded up to a sixteenth, a quarter or all of its budget.

Items come in chunks of bounded size. A chunk is sent to all tasks for one pass over the documents and taken back before
the next, so what driver and tasks hold doesn't grow with the number of items or documents; the passes do, one for each
CHUNK bytes of items.
"""

from __future__ import annotations

import re
import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import Scratch, kept, map_columns, released

Q = 8
#: Edits that a passage may differ by, as a share of the item's length.
BUDGET = 0.1
#: Bytes of items in a chunk.
CHUNK = 8 << 20
#: Bytes of a text that are searched at once; more where items are longer than a quarter.
SEGMENT = 16 << 10
#: Items above which a q-gram counts as common.
COMMON = 64
#: Shorter q-grams, whose bound is closer to an item's length, by which candidates are tested once more; and for regions.
SHORTER = (5, 4, 3)
SMALL = 3
#: Cells of alignments that are computed at once.
CELLS = 1 << 16

_OTHER = re.compile(r"[\W_]+")
_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)


def plain(text: str | None) -> str:
    return _OTHER.sub(" ", (text or "").lower()).strip()


def edits_allowed(length: int) -> int:
    """The budget, less where the lemma would ask for no shared q-gram; at least 0."""
    return max(0, min(int(length * BUDGET), (length - Q) // Q))


def grams(data: np.ndarray, q: int = Q) -> np.ndarray:
    """Each place's q bytes as one number."""
    n = len(data) - q + 1
    if n <= 0:
        return np.empty(0, _U)
    if q == 8:
        return np.lib.stride_tricks.sliding_window_view(data, q).copy().view(_U).ravel()
    return reduce(lambda code, k: (code << _U(8)) | data[q - 1 - k : q - 1 - k + n], range(q), np.zeros(n, _U))


class Items:
    """A chunk of items and the index of their q-grams.

    Items of equal plain text are searched once. Places of a q-gram in an item that follow each other within a band's
    width are one posting, since they touch the same bands: a run of one letter costs no more than a word. Where q-grams
    that more than COMMON items hold make up at most half of an item's bound, they are left out of its count and the bound
    is lowered by as many, which keeps it exact.
    """

    def __init__(self, ids: list[int], texts: list[str]):
        same: dict[str, list[int]] = {}
        for i, t in zip(ids, map(plain, texts), strict=True):
            if t:
                same.setdefault(t, []).append(i)
        self.ids, self.texts = list(same.values()), [t.encode() for t in same]
        self.short = [k for k, t in enumerate(self.texts) if len(t) < Q]
        lengths = np.array([len(t) for t in self.texts], np.int64)
        self.lengths, self.edits = lengths, np.array([edits_allowed(n) for n in lengths.tolist()], np.int64)
        self.longest = int((lengths + self.edits).max(initial=0))
        self.flat = np.frombuffer(b"".join(self.texts), np.uint8)
        self.starts = np.append(0, np.cumsum(lengths))
        self._index()
        self.fewest = int(self.least(self.edits)[self.lengths >= Q].min(initial=1 << 30))
        self.bits = max(16, int(np.ceil(np.log2(max(len(self.codes), 1)))) + 6)
        self.there = np.zeros(1 << self.bits, bool)
        self.there[_slot(self.codes, self.bits)] = True

    def _index(self) -> None:
        """Postings by q-gram: item, first and last place, and how many places."""
        codes = [grams(np.frombuffer(t, np.uint8)) for t in self.texts]
        flat = np.concatenate(codes) if codes else np.empty(0, _U)
        sizes = [len(c) for c in codes]
        order = np.argsort(flat, kind="stable")
        flat = flat[order]
        item = np.repeat(np.arange(len(codes), dtype=np.int32), sizes)[order]
        place = np.concatenate([np.arange(n, dtype=np.int32) for n in sizes] or [np.empty(0, np.int32)])[order]
        fresh = np.append(True, (flat[1:] != flat[:-1]) | (item[1:] != item[:-1]) | (place[1:] - place[:-1] > self.edits[item[1:]] + 1))[: len(flat)]
        at = np.flatnonzero(fresh)
        count = np.diff(np.append(at, len(flat)))
        flat, item, first, last = flat[at], item[at], place[at], place[at + count - 1]
        least = self.lengths + 1 - Q - Q * self.edits
        codes, gram, held = np.unique(flat, return_inverse=True, return_counts=True)
        common = held[gram] > COMMON
        left = np.bincount(item[common], weights=count[common], minlength=len(self.texts)).astype(np.int64)
        left[2 * left > least] = 0
        keep = ~(common & (left[item] > 0))
        self.left = left
        self.codes, self.begins = np.unique(flat[keep], return_index=True)
        self.begins = np.append(self.begins, int(keep.sum()))
        self.item, self.first, self.last, self.count = item[keep], first[keep], last[keep], count[keep].astype(np.int32)

    def least(self, edits: np.ndarray) -> np.ndarray:
        """The shared q-grams among the indexed ones that so many edits leave at least."""
        return self.lengths + 1 - Q - Q * edits - self.left

    def _postings(self, shared: np.ndarray, block: int = 1 << 18):
        """The postings of q-grams as (index into `shared`, posting), at most a block at once, or those of one q-gram."""
        n = self.begins[shared + 1] - self.begins[shared]
        ends, low = np.cumsum(n), 0
        while low < len(shared):
            high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + block, "right")))
            yield _ranges(self.begins[shared[low:high]], n[low:high], low)
            low = high

    def candidates(self, part: bytes, shared: np.ndarray) -> np.ndarray:
        """Items of which a part of a text holds enough q-grams of each length anywhere."""
        n = np.zeros(len(self.texts))
        for _, posting in self._postings(shared):
            n += np.bincount(self.item[posting], weights=self.count[posting], minlength=len(n))
        items = np.flatnonzero((n >= self.least(self.edits)) & (n > 0))
        if not len(items):
            return items
        for q in SHORTER:
            if len(items):
                items = items[self._holds(part, items, q)]
        return items

    def _holds(self, part: bytes, items: np.ndarray, q: int) -> np.ndarray:
        """Whether enough of each item's q-grams of a shorter length lie anywhere in a part of a text."""
        there = np.zeros(1 << 18, bool)
        there[_slot(grams(np.frombuffer(part, np.uint8), q), 18)] = True
        own = self.lengths[items] + 1 - q
        stay, ends, low = np.zeros(len(items), bool), np.cumsum(own), 0
        while low < len(items):
            high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + (1 << 18), "right")))
            _, at = _ranges(self.starts[items[low:high]], own[low:high], 0)
            begins = np.append(0, np.cumsum(own[low:high]))[:-1]
            stay[low:high] = np.add.reduceat(there[_slot(self._codes(at, q), 18)].astype(np.int64), begins) >= own[low:high] - q * self.edits[items[low:high]]
            low = high
        return stay

    def _codes(self, at: np.ndarray, q: int) -> np.ndarray:
        """The q bytes from each place on of all items in a row, as numbers like those of `grams`."""
        return reduce(lambda code, k: (code << _U(8)) | self.flat[at + q - 1 - k], range(q), np.zeros(len(at), _U))

    def near(self, part: bytes, regions: list[tuple[int, int, int]], edits: np.ndarray) -> list[tuple[int, int, int]]:
        """Regions in whose part of the text enough of the item's shorter q-grams lie."""
        codes, scale = grams(np.frombuffer(part, np.uint8), SMALL), np.int64(len(part) + 1)
        keys = np.sort(codes.astype(np.int64) * scale + np.arange(len(codes)))
        keys = np.append(keys, np.int64(1) << 62)
        item, begin, end = (np.array(x, np.int64) for x in zip(*regions, strict=True))
        begin, end = np.maximum(0, begin - edits[item]), end + edits[item] + self.lengths[item]
        own = self.lengths[item] + 1 - SMALL
        ends, low, stay = np.cumsum(own), 0, np.zeros(len(item), bool)
        while low < len(item):
            high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + (1 << 18), "right")))
            nth, at = _ranges(self.starts[item[low:high]], own[low:high], low)
            code = self._codes(at, SMALL).astype(np.int64) * scale
            after = keys[np.searchsorted(keys, code + np.minimum(begin[nth], len(part)))]
            starts = np.append(0, np.cumsum(own[low:high]))[:-1]
            stay[low:high] = np.add.reduceat((after < code + np.minimum(end[nth], len(part))).astype(np.int64), starts) >= own[low:high] - SMALL * edits[item[low:high]]
            low = high
        return [r for r, good in zip(regions, stay.tolist(), strict=True) if good]

    def regions(self, items: np.ndarray, edits: np.ndarray, shared: np.ndarray, places: tuple[np.ndarray, np.ndarray, np.ndarray]) -> list[tuple[int, int, int]]:
        """(item, first and last diagonal) of runs of bands in which enough places of the text share a q-gram with the item.

        shared: the q-grams of the text that items hold; places: where, and each one's first of these and number. A posting adds one to an interval of
        bands for each place, so counts are running sums over the interval's ends.
        """
        wanted = np.zeros(len(self.texts), bool)
        wanted[items] = True
        width, least = edits + 1, self.least(edits)
        flat, starts, sizes = places
        base, span = -(int(self.longest) + 2), int(flat.max(initial=0)) + int(self.longest) + 8
        keys, weights = [], []

        def folded() -> None:
            key, inverse = np.unique(np.concatenate(keys), return_inverse=True)
            weight = np.bincount(inverse, weights=np.concatenate(weights)).astype(np.int64)
            keys[:], weights[:] = [key], [weight]

        held = 0
        for which, posting in self._postings(shared):
            own = wanted[self.item[posting]]
            which, posting = which[own], posting[own]
            low, n = 0, np.cumsum(sizes[which])
            while low < len(which):
                high = max(low + 1, int(np.searchsorted(n, (n[low - 1] if low else 0) + (1 << 18), "right")))
                nth, at = _ranges(starts[which[low:high]], sizes[which[low:high]], low)
                t, p = flat[at], posting[nth]
                i = self.item[p].astype(np.int64)
                begin, end = np.floor_divide(t - self.last[p], width[i]) - 1, np.floor_divide(t - self.first[p], width[i]) + 1
                keys += [i * span + begin - base, i * span + end - base]
                weights += [np.ones(len(i), np.int64), np.full(len(i), -1)]
                held += 2 * len(i)
                if held > 1 << 20:
                    folded()
                    held = len(keys[0])
                low = high
        if not keys:
            return []
        folded()
        key, count = keys[0], np.cumsum(weights[0])
        item = key // span
        full = np.flatnonzero(count >= np.maximum(least[item], 1))
        out: list[tuple[int, int, int]] = []
        for j in full.tolist():  # the count holds up to the next key, which is the same item's: intervals end
            i, w = int(item[j]), int(width[item[j]])
            begin, end = (int(key[j] % span) + base) * w, (int(key[j + 1] % span) + base + 1) * w - 1
            if out and out[-1][0] == i and begin <= out[-1][2] + 1:
                out[-1] = (i, out[-1][1], end)
            else:
                out.append((i, begin, end))
        return out

    def found(self, text: bytes, first: bool = False) -> list[tuple[int, int, int, int]]:
        """(item id, start, end, edits) of the best match of each item in a plain text, in bytes; first: of one at least."""
        best: dict[int, tuple[int, int, int]] = {}
        for i in self.short:
            at = (b" " + text + b" ").find(b" " + self.texts[i] + b" ")
            if at >= 0:
                best[i] = (0, at, at + len(self.texts[i]))
        size = max(SEGMENT, 4 * self.longest)
        for offset in range(0, max(1, len(text) - self.longest), size - self.longest):
            if first and best:
                break
            for i, (edits, start, end) in self._part(text[offset : offset + size], {i: x[0] for i, x in best.items()}).items():
                if i not in best or (edits, start + offset) < best[i][:2]:
                    best[i] = (edits, start + offset, end + offset)
        return sorted((k, start, end, edits) for i, (edits, start, end) in best.items() for k in self.ids[i])

    def _part(self, part: bytes, before: dict[int, int]) -> dict[int, tuple[int, int, int]]:
        """The best matches in a part of a text, of items found before only those with fewer edits."""
        limit = self.edits.copy()
        limit[list(before)] = np.array(list(before.values()), np.int64) - 1
        codes = grams(np.frombuffer(part, np.uint8))
        if not len(self.codes) or not len(codes):
            return {}
        at = np.flatnonzero(self.there[_slot(codes, self.bits)])
        gram = np.minimum(np.searchsorted(self.codes, codes[at]), len(self.codes) - 1)
        same = self.codes[gram] == codes[at]
        at, gram = at[same], gram[same]
        if len(at) < self.fewest:  # each shared q-gram has a place of its own in the text
            return {}
        order = np.argsort(gram, kind="stable")
        shared, begins = np.unique(gram[order], return_index=True)
        items = self.candidates(part, shared) if len(shared) else shared
        out: dict[int, tuple[int, int, int]] = {}
        for i in items.tolist():
            where = part.find(self.texts[i]) if limit[i] >= 0 else -1
            if where >= 0:
                out[i] = (0, where, where + len(self.texts[i]))
        if not len(items):
            return out
        places = at[order], begins, np.diff(np.append(begins, len(order)))
        for share in (16, 4, 1):  # few edits first: they need a narrow band only
            left = np.array([i for i in items.tolist() if i not in out and limit[i] > 0 and (share == 1 or self.edits[i] >= 64)], np.int64)
            if len(left):
                edits = np.clip(limit, 0, self.edits // share)
                regions = self.regions(left, edits, shared, places)
                regions = self.near(part, regions, edits) if regions else regions
                out.update(aligned(part, [(self.texts[i], i, low, high, int(edits[i])) for i, low, high in regions]))
        return out


def _slot(codes: np.ndarray, bits: int) -> np.ndarray:
    return ((codes * _ODD) >> _U(64 - bits)).astype(np.int64)


def _ranges(begins: np.ndarray, sizes: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges one after the other, each with its range's index, which counts from `first`."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(np.arange(first, first + len(sizes)), sizes), np.arange(total) + np.repeat(begins - (ends - sizes), sizes)


def aligned(text: bytes, regions: list[tuple[bytes, int, int, int, int]]) -> dict[int, tuple[int, int, int]]:
    """name: (edits, start, end) of the part of a text nearest to an item, if within `most` edits.

    Regions are (item, name, first and last diagonal, most). Shared q-grams lie on these diagonals, so an alignment stays
    within `most` of them: only that band of cells is computed, a row for each byte of the item. A cell holds the edits and,
    for ties, the earliest start. Regions of like length share a table of at most CELLS cells a row, or have one of their
    own; one whose cells all exceed its edits leaves it.
    """
    best: dict[int, tuple[int, int, int]] = {}
    order = sorted(regions, key=lambda r: (len(r[0]), r[3] - r[2] + 2 * r[4]))
    low = 0
    while low < len(order):
        high, width = low, 0
        while high < len(order):
            wider = max(width, order[high][3] - order[high][2] + 1 + 2 * order[high][4])
            if high > low and wider * (high + 1 - low) > CELLS:
                break
            high, width = high + 1, wider
        for name, made in _table(text, order[low:high], width):
            if name not in best or made[:2] < best[name][:2]:
                best[name] = made
        low = high
    return best


def _table(text: bytes, regions: list, width: int):
    scale, none = len(text) + 1, np.int64(1) << 60
    lows = np.array([r[2] - r[4] for r in regions], np.int64)
    before = max(0, -int(lows.min()))
    longest = len(regions[-1][0])
    padded = np.full(before + max(len(text), int(lows.max())) + width + longest + 1, -1, np.int16)  # -1: outside of the text
    padded[before : before + len(text)] = np.frombuffer(text, np.uint8)
    windows = np.lib.stride_tricks.sliding_window_view(padded, width)
    items = np.zeros((len(regions), longest), np.uint8)
    for j, r in enumerate(regions):
        items[j, : len(r[0])] = np.frombuffer(r[0], np.uint8)
    sizes, most = np.array([len(r[0]) for r in regions]), np.array([r[4] for r in regions], np.int64)
    steps = np.arange(width) * scale
    place = lows[:, None] + np.arange(width)
    row = np.where((place >= 0) & (place <= len(text)), place, none)  # edits * scale + start
    alive = np.arange(len(regions))
    for k in range(longest):
        own = windows[lows[alive] + before + k]
        fresh = row + scale * (own != items[alive, k][:, None])
        fresh[own < 0] = none  # no such byte
        fresh[:, :-1] = np.minimum(fresh[:, :-1], row[:, 1:] + scale)  # the item's byte is left out
        # an inserted byte of the text costs one edit: a running minimum along the row
        row = np.minimum(np.minimum.accumulate(fresh - steps, axis=1) + steps, none)
        stay = np.ones(len(alive), bool)
        if k % 8 == 7:
            stay = row.min(axis=1) < (most[alive] + 1) * scale
        ended = sizes[alive] == k + 1
        for j in np.flatnonzero(ended & stay).tolist():
            r, end = regions[alive[j]], int(np.argmin(row[j]))
            edits, start = divmod(int(row[j, end]), scale)
            if edits <= r[4]:
                yield r[1], (edits, start, min(r[2] - r[4] + k + 1 + end, len(text)))
        stay &= ~ended
        if not stay.all():
            alive, row = alive[stay], row[stay]
            if not len(alive):
                return


def chunks(benchmark: DataFrame, size: int = CHUNK):
    """Items as (ids, texts), in chunks of about `size` bytes."""
    wanted = benchmark.where(F.col("text").isNotNull() & F.col("item_id").isNotNull()).select(F.col("item_id").cast("long"), "text")
    ids, texts, held = [], [], 0
    for r in wanted.toLocalIterator():
        ids.append(r[0])
        texts.append(r[1])
        held += len(r[1])
        if held >= size:
            yield ids, texts
            ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, start, end, edits: the best match of each item in each document that holds one.

    start and end count bytes of the plain text. Items shorter than a q-gram match whole words only; null and blank
    texts, on either side, match nothing. Rows that repeat, of documents or items, match each time. Ties go to the
    earliest start. Other columns are ignored; no items or no documents give no rows. With several chunks of items the
    rows of each are written to the shared folder before the next.
    """
    wanted = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("long"), "text")
    schema = "doc_id long, item_id long, start int, end int, edits int"
    scratch, out, before = Scratch(docs.sparkSession, "contaminations"), [], None
    for k, (ids, texts) in enumerate(chunks(benchmark)):
        if before:
            out[-1] = scratch.save(out[-1], str(k), keep=True)
            before.destroy()
        before = docs.sparkSession.sparkContext.broadcast((ids, texts))
        out.append(map_columns(wanted, _search(before), schema, keeps=True))
    if len(out) > 1:
        out[-1] = scratch.save(out[-1], "last", keep=True)
        before.destroy()
    return reduce(DataFrame.unionByName, out) if out else docs.sparkSession.createDataFrame([], schema)


def _items(shared):
    """A function for tasks that gives the chunk's index, made once in each worker."""
    name = ("items", uuid.uuid4().hex)
    return lambda: kept(name, lambda: Items(*shared.value))


def _search(shared):
    items = _items(shared)

    def of(ids: list, texts: list) -> tuple:
        rows = [(i, *x) for i, t in zip(ids, texts, strict=True) for x in items().found(plain(t).encode())]
        return tuple(zip(*rows, strict=True)) if rows else ((), (), (), (), ())

    return of


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no item is found; all columns stay.

    Each row is decided by its own text, so ids may be null or repeat. Only with several chunks of items are the rows
    left by one chunk written to the shared folder before the next.
    """
    scratch, before = Scratch(docs.sparkSession, "decontamination"), None
    for k, (ids, texts) in enumerate(chunks(benchmark)):
        if before:
            docs = scratch.save(docs, str(k), keep=True)
            before.destroy()
        before = docs.sparkSession.sparkContext.broadcast((ids, texts))
        docs = docs.where(_clean(before)("text"))
    return docs


def _clean(shared):
    items = _items(shared)

    @F.arrow_udf("boolean")
    def clean(texts: pa.Array) -> pa.Array:
        out = pa.array([not items().found(plain(t.as_py()).encode(), first=True) for t in texts], pa.bool_())
        released()
        return out

    return clean
