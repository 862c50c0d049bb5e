"""Toxicity by compression distance.

zstandard trains one dictionary on pieces of ordinary texts and one on toxic texts. Both classes share nearly all of
their words, which would fill either dictionary; so of toxic texts training reads only segments: runs of characters in which
every GRAM characters in a row are over-represented in the toxic sample. A window is
compressed with the ordinary dictionary alone and with the toxic one before it; a window that gets smaller by the toxic
one is nearer to toxic text. A logistic fit on held-back training texts turns the differences of a text's windows into
a calibrated score.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import kept, map_columns
from tickloom.llm.logistic import Logistic
from tickloom.llm.shingles import mix

#: Labelled texts of each class that training reads at most, in expectation: for dictionaries, and for calibration.
SAMPLE = {1: (2_000, 1_500), 0: (4_000, 3_000)}
#: Share of the training rows that dictionaries may use; the others calibrate.
FITTED = 0.7
#: Bytes of segments of each class that zstandard trains on at most, in expectation.
TRAINED = 8 << 20
#: Bytes in a window, and between the starts of two.
WINDOW, STRIDE = 96, 64
#: Characters in a row that tell toxic segments, bits of the map that holds them, and a segment's least length.
GRAM, MAP_BITS, LEAST = 5, 24, 8
#: Toxic texts that such characters must be in, and standard errors of their over-representation.
LEAST_TEXTS, LEAST_Z = 3, 4.0
#: Sizes of both dictionaries, and of the pieces that training chooses and counts.
ORDINARY_SIZE, ORDINARY_PIECE, TOXIC_SIZE, TOXIC_PIECE = 16_384, (24, 6), 2_048, (24, 8)
#: Bytes of an ordinary text in one training sample.
CUT = 4_096
#: Penalty of the calibration fit.
RIDGE = 1.0
THRESHOLD = 0.7
#: Largest window differences that count as features, and features in all.
TOP, FEATURES = 4, 12

LETTERS = re.compile(r"[^\W\d_]+")


class Distance:
    """Window compression lengths under both dictionaries."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        import zstandard as z

        # short matches count, and frames carry nothing but the data
        given = z.ZstdCompressionParameters(window_log=17, chain_log=14, hash_log=14, search_log=4, min_match=4, target_length=32, strategy=z.STRATEGY_GREEDY, write_content_size=False, write_checksum=False, write_dict_id=False)
        self.ordinary, self.toxic = (z.ZstdCompressor(dict_data=z.ZstdCompressionDict(x, dict_type=z.DICT_TYPE_RAWCONTENT), compression_params=given).compress for x in (ordinary, toxic))

    def features(self, text: str | None) -> list[float]:
        """The TOP largest differences, the mean one, the number of windows, and how many differ by several bytes."""
        data = (text or "").lower().encode()
        nearer = [len(self.ordinary(w)) - len(self.toxic(w)) for w in (data[k : k + WINDOW] for k in range(0, max(1, len(data) - WINDOW + STRIDE), STRIDE))]
        top = sorted(nearer, reverse=True)[:TOP]
        top += [0] * (TOP - len(top))
        over = lambda least: sum(x >= least for x in nearer)
        n = len(nearer)
        return [*top, sum(nearer) / n, np.log(n), over(3) / n, over(5) / n, np.log1p(over(4)), np.log1p(over(7)), top[0] - top[-1], max(top[0], 0) ** 0.5]


def spaced(text: str) -> str:
    """The words of a text in small letters, with one space on either side of each."""
    return f" {' '.join(LETTERS.findall(text.lower()))} "


def slots(text: str) -> np.ndarray:
    """A place in the map for every GRAM characters in a row."""
    data = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    if len(data) < GRAM:
        return np.empty(0, np.int64)
    code = np.zeros(len(data) - GRAM + 1, np.uint64)
    for k in range(GRAM):
        code = mix(code ^ data[k : k + len(code)])
    return (code >> np.uint64(64 - MAP_BITS)).astype(np.int64)


def segments(text: str, told: np.ndarray) -> list[str]:
    """Runs of characters whose grams the map holds, of LEAST characters at least."""
    text = spaced(text)
    rare = np.flatnonzero(told[slots(text)])
    cover = np.zeros(len(text) + 2, np.int8)
    np.add.at(cover, rare + 1, 1)
    np.add.at(cover, rare + 1 + GRAM, -1)
    edge = np.flatnonzero(np.diff(np.cumsum(cover) > 0))
    return [text[a:b] for a, b in zip(edge[::2], edge[1::2], strict=True) if b - a >= LEAST]


def trained(samples: DataFrame, size: int, piece: tuple[int, int]) -> bytes:
    """A dictionary that zstandard trains on a bounded hash sample of the column `s`; the samples' end if they are too few."""
    import zstandard as z

    held = samples.agg(F.coalesce(F.sum(F.octet_length("s")), F.lit(0))).first()[0]
    place = F.pmod(F.xxhash64("s", F.lit(6)), F.lit(1 << 20))
    drawn = samples.where(place < min(1.0, TRAINED / max(1, held)) * (1 << 20)).orderBy(F.xxhash64("s"), "s")
    texts = [r["s"].encode() for r in drawn.collect()]
    try:
        return z.train_dictionary(size, texts, k=piece[0], d=piece[1]).as_bytes()
    except z.ZstdError:
        return b" ".join(texts)[-size:]


def telling(texts: DataFrame) -> np.ndarray:
    """A map of 2^MAP_BITS bits: the places of GRAM characters in a row that toxic texts hold more often than ordinary ones."""
    n = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    out = np.zeros((1 << MAP_BITS) // 8, np.uint8)
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if not n1 or not n0:
        return out

    def places(own: list, marks: list) -> tuple:
        found = [np.unique(slots(spaced(t))) for t in own]
        return np.concatenate(found), np.repeat(np.array(marks, np.int32), [len(x) for x in found])

    sums = [F.sum((F.col("toxic") == k).cast("long")).alias(f"in{k}") for k in (0, 1)]
    counts = map_columns(texts.select("text", "toxic"), places, "p long, toxic int").groupBy("p").agg(*sums)
    share = (F.col("in0") + F.col("in1")) / (n0 + n1)
    z = (F.col("in1") / n1 - F.col("in0") / n0) / F.sqrt(share * (1 - share) * (1 / n1 + 1 / n0))
    counts = counts.where((F.col("in1") >= LEAST_TEXTS) & (share < 1)).where(z >= LEAST_Z)
    bits = 32_768  # of one row that Spark makes
    for r in counts.groupBy(F.expr(f"p div {bits}").alias("part")).agg(F.bitmap_construct_agg(F.expr(f"p % {bits}")).alias("map")).collect():
        out[r["part"] * bits // 8 : (r["part"] + 1) * bits // 8] = np.frombuffer(r["map"], np.uint8)
    return out


def dictionaries(drawn: DataFrame) -> tuple[bytes, bytes]:
    """Of texts with `toxic` 0 or 1: the ordinary dictionary, and the toxic one with the ordinary one behind. Equal texts count once."""
    texts = drawn.select("text", "toxic").distinct()
    ordinary, toxic = (texts.where(F.col("toxic") == k).select("text") for k in (0, 1))
    shared = drawn.sparkSession.sparkContext.broadcast(telling(texts))  # of fixed size

    def rare(own: list) -> tuple:
        told = np.unpackbits(shared.value, bitorder="little").view(bool)
        return ([s for t in own for s in segments(t, told)],)

    def cut(own: list) -> tuple:
        return ([low[k : k + CUT] for t in own for low in [t.lower()] for k in range(0, len(low), CUT)],)

    common = trained(map_columns(ordinary, cut, "s string"), ORDINARY_SIZE, ORDINARY_PIECE) or b" "
    return common, trained(map_columns(toxic, rare, "s string"), TOXIC_SIZE, TOXIC_PIECE) + b" " + common


def train(docs: DataFrame, labels: DataFrame, learns: Column, sample: dict = SAMPLE) -> tuple[bytes, bytes, Logistic]:
    """Dictionaries and calibration from a hash sample of the labelled rows for which `learns` holds, by doc_id.

    Labels that are null or neither 0 nor 1 teach nothing; without both labels every text scores as the labels do.
    Without rows every text scores 0.5.
    """
    known = labels.where(learns & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
    n = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    part, place = F.lit(None).cast("int"), F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 20)) / float(1 << 20)
    for mark, size in n.items():
        first, second = (min(share, want / size) for share, want in zip((FITTED, 1 - FITTED), sample[mark], strict=True))
        part = F.when((F.col("toxic") == mark) & (place < first), 0).when((F.col("toxic") == mark) & (place >= FITTED) & (place < FITTED + second), 1).otherwise(part)
    drawn = known.withColumn("part", part).where(F.col("part").isNotNull())
    # the sample's bound is the size of what is sent
    texts = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("long"), "text").join(F.broadcast(drawn), "doc_id").persist()
    ordinary, toxic = dictionaries(texts.where("part = 0"))
    rows = map_columns(texts.where("part = 1").select("text", "toxic"), lambda t, m: (m, _features(t, ordinary, toxic)), "toxic int, x array<double>", keeps=True).collect()
    texts.unpersist()
    share = {mark: n.get(mark, 0) / max(1, sum(r["toxic"] == mark for r in rows)) for mark in (0, 1)}
    y = np.array([r["toxic"] for r in rows], float)
    weight = np.array([share[r["toxic"]] for r in rows])
    return ordinary, toxic, Logistic(np.array([r["x"] for r in rows]).reshape(len(rows), FEATURES), y, weight / max(weight.mean(), 1e-9) if len(rows) else weight, RIDGE)


def _features(texts: list, ordinary: bytes, toxic: bytes) -> list[list[float]]:
    distance = kept(("distance", ordinary, toxic), lambda: Distance(ordinary, toxic))
    return [distance.features(t) for t in texts]


def toxicity(docs: DataFrame, model: tuple[bytes, bytes, Logistic], threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score from 0 to 1 and predicted of every row, from its whole text alone.

    A null text counts as empty, which has no difference. Long texts are compressed window by window. Repeated rows
    repeat; other columns are ignored. No rows in, no rows out.
    """

    def of(ids: list, texts: list) -> tuple:
        score = model[2].probability(np.array(_features(texts, *model[:2]), float).reshape(len(ids), FEATURES))
        return ids, score, (score >= threshold).astype(np.int32)

    return map_columns(docs.select(F.col("doc_id").cast("long"), "text"), of, "doc_id long, score double, predicted int", keeps=True)
