"""Document quality by co-training of two views.

One classifier sees what the text holds: hashed words, hashed runs of three bytes, and its shape. The other sees the
page's metadata: language, source and length. In each round a
view marks the unlabelled texts of which it is most sure and the other learns from the marks. Both are then calibrated
on labelled texts held back, and a last fit on the two calibrated scores combines them.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import map_columns, released
from tickloom.llm.logistic import Logistic
from tickloom.llm.shingles import mix, word_hashes

#: Labelled rows of each class and unlabelled rows that training reads at most, in expectation.
LABELLED, UNLABELLED = 4_000, 6_000
ROUNDS = 4
#: Share of the unlabelled rows that a view marks in a round at most, and how sure it must be.
MARKED, SURE = 0.1, 0.95
THRESHOLD = 0.5
#: Penalty of both views' fits.
RIDGE = 20.0
SOURCES, LANGS = 32, 8
#: Places that words, and runs of bytes, are hashed to.
PLACES = 192

_LETTER, _UPPER, _DIGIT, _SYMBOL = (np.zeros(256, bool) for _ in range(4))
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_UPPER[65:91] = True
_DIGIT[48:58] = True
_SYMBOL[list(b"#$%&*@^~<>=+\\/|_{}[]")] = True


def hashed(codes: np.ndarray, seed: int) -> np.ndarray:
    """Counts of codes in PLACES places, as logs of their shares: common ones weigh little more than rare ones."""
    code = mix(codes.astype(np.uint64) + np.uint64(seed))
    counts = np.bincount((code % np.uint64(PLACES)).astype(np.int64), minlength=PLACES)
    return np.log1p(1000 * counts / max(1, len(codes)))


def text_view(text: str | None) -> np.ndarray:
    """Hashed words and runs of three bytes of the whole text, in small letters, and its shape."""
    data = (text or "").encode()
    low = np.frombuffer(data.lower(), np.uint8).astype(np.uint32)
    words, _ = word_hashes([data])
    threes = (low[:-2] << 16 | low[1:-1] << 8 | low[2:]) if len(low) > 2 else low[:0]
    return np.concatenate([hashed(words, 1), hashed(threes, 2), shape_of(text or "", data)])


def shape_of(text: str, data: bytes) -> list[float]:
    """Shares that tell prose from shouting, symbol noise, lists and repetition, over the whole text."""
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    size, letters = max(1, len(data)), max(1, int(counts[_LETTER].sum()))
    words = text.split()
    n = max(1, len(words))
    lines = [x for x in text.split("\n") if x.strip()]
    again = sum(a == b for a, b in zip(words, words[1:], strict=False))
    logs = np.log10(1e-3 + np.array([counts[_UPPER].sum() / letters, counts[_DIGIT].sum() / size, counts[_SYMBOL].sum() / size, counts[33] / n, counts[124] / n, again / n, 1 - len(set(lines)) / max(1, len(lines)), (counts[44] + counts[46]) / n, counts[10] / n]))
    packed = len(zlib.compress(data, 1)) / size if data else 1.0
    return [*logs, packed, np.log(len(set(words)) + 1) - 0.8 * np.log(n + 1), letters / n / 10, np.log(n), float(not words)]


def meta_view(lang: str | None, source: str | None, n_chars: float | None) -> list[float]:
    """Language and source as hashed marks, and the length on a log scale; nulls are values of their own."""
    row = np.zeros(SOURCES + LANGS + 2)
    row[zlib.crc32(str(source).encode()) % SOURCES] = 1
    row[SOURCES + zlib.crc32(str(lang).encode()) % LANGS] = 1
    size = np.log1p(max(0.0, float(n_chars))) if n_chars is not None and n_chars == n_chars else 0.0
    row[-2:] = size, size * size / 10
    return list(row)


class CoTraining:
    """Two views' classifiers and their calibrated combination."""

    def __init__(self, text: np.ndarray, meta: np.ndarray, label: np.ndarray, rounds: int = ROUNDS):
        """Rows with a label of -1 are unlabelled; every third labelled row is held back for calibration."""
        known = np.flatnonzero(label >= 0)
        held, base = known[2::3], np.setdiff1d(known, known[2::3])
        pool = np.flatnonzero(label < 0)
        views = (text, meta)
        marks: list[dict[int, float]] = [{}, {}]  # what each view learns from the other
        self.models = [Logistic(v[base], label[base], ridge=RIDGE) for v in views]
        for _ in range(rounds):
            for k, model in enumerate(self.models):
                p = model.probability(views[k][pool])
                most = max(1, int(MARKED * len(pool)))
                for sure, mark in ((p, 1.0), (1 - p, 0.0)):
                    best = np.argsort(-sure, kind="stable")[: max(1, int(most * (label[base] == mark).mean()))] if len(pool) and len(base) else []
                    marks[1 - k].update((int(pool[j]), mark) for j in best if sure[j] >= SURE)
            for k, v in enumerate(views):
                rows = np.array([*base, *marks[k]], int)
                y = np.array([*label[base], *marks[k].values()], float)
                weight = np.array([1.0] * len(base) + [0.3] * len(marks[k]))
                self.models[k] = Logistic(v[rows], y, weight, RIDGE)
        self.calibrated = [Logistic(m.logit(v[held])[:, None], label[held]) for m, v in zip(self.models, views, strict=True)]
        self.last = Logistic(self._both(text[held], meta[held]), label[held])

    def _both(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        return np.column_stack([c.logit(m.logit(v)[:, None]) for c, m, v in zip(self.calibrated, self.models, (text, meta), strict=True)])

    def score(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        return self.last.probability(self._both(text, meta))


def _views(texts, langs, sources, sizes) -> tuple[np.ndarray, np.ndarray]:
    return np.array([text_view(t) for t in texts]), np.array([meta_view(*x) for x in zip(langs, sources, sizes, strict=True)])


def _parts(*columns: pa.Array, rows: int = 256):
    """The views of a batch, some rows at a time."""
    for low in range(0, len(columns[0]), rows):
        yield _views(*(c.slice(low, rows).to_pylist() for c in columns))


def train(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, unlabelled: int = UNLABELLED) -> CoTraining | None:
    """Fits on a hash sample of labelled and unlabelled rows; only their features reach the driver. None: no labels."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), F.col("quality").cast("int"))
    sizes = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    place = lambda seed: F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.lit(seed)), F.lit(1 << 20)) / float(1 << 20)
    # one share for both classes keeps their proportion
    drawn = known.where(place(7) < min(1.0, labelled / max(sizes.values()))).dropDuplicates(["doc_id"])
    share = min(1.0, unlabelled / max(1, docs.count()))
    own = docs.select(F.col("doc_id").cast("long"), "text", "lang", "source", F.col("n_chars").cast("double")).join(F.broadcast(drawn), "doc_id", "left")  # of the sample's bound
    own = own.where(F.col("quality").isNotNull() | (place(8) < share))

    def views(ids: list, marks: list, *rest: list) -> tuple:
        text, meta = _views(*rest)
        return ids, marks, [x.astype(np.float32).tobytes() for x in text], [x.astype(np.float32).tobytes() for x in meta]

    rows = map_columns(own.select("doc_id", "quality", "text", "lang", "source", "n_chars"), views, "doc_id long, quality int, x binary, y binary").orderBy("doc_id").collect()
    if not any(r["quality"] is not None for r in rows):
        return None
    label = np.array([-1 if r["quality"] is None else r["quality"] for r in rows])
    return CoTraining(*(np.frombuffer(b"".join(r[c] for r in rows), np.float32).reshape(len(rows), -1) for c in ("x", "y")), label)


def scored(docs: DataFrame, model: CoTraining | None) -> Column:
    """A column with the quality, from 0 to 1, of the row's whole text, lang, source and n_chars; 1 without a model.

    Nulls in any of them are values that the views know: a null text counts as empty.
    """
    if model is None:
        return F.lit(1.0)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(text: pa.Array, lang: pa.Array, source: pa.Array, n_chars: pa.Array) -> pa.Array:
        found = [shared.value.score(*views) for views in _parts(text, lang, source, n_chars)]
        released()
        return pa.array(np.concatenate(found) if found else [], pa.float64())

    return score("text", "lang", "source", F.col("n_chars").cast("double"))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, score and kept (score >= THRESHOLD) of every row.

    Rows that repeat repeat; equal rows score the same, and a score at the threshold is kept. Nulls are values that the
    views know. Without usable labels all rows are kept. Other columns are ignored. No rows in, no rows out.
    """
    model = train(docs, labels)
    return docs.select(F.col("doc_id").cast("long"), scored(docs, model).alias("score")).withColumn("kept", F.col("score") >= THRESHOLD)


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents of sufficient quality, with all their columns."""
    return docs.where(scored(docs, train(docs, labels)) >= THRESHOLD)
