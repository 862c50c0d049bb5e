"""Language identification, words first and then ever shorter character n-grams.

A word that training has seen in enough documents is scored by its log frequency in each language. An unseen word
falls back to its n-grams of the greatest length of which any is known, from 4 down to 1, at a penalty for each step
down. A text's score in a language is the sum over its words.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import map_columns

#: Texts of each language that training reads at most, in expectation.
SAMPLE = 3_000
#: Words, and n-grams of each length, of each language that the model keeps at most; the most frequent ones stay.
WORDS, GRAMS = 20_000, 20_000
#: Training texts that a word must be in.
SEEN = 3
LONGEST = 4
#: Factor of the log likelihood for each step down from words to shorter n-grams.
STEP_DOWN = 0.8
#: Words whose evidence counts as independent in the score from 0 to 1.
INDEPENDENT = 20
#: Words that a worker remembers at most.
REMEMBERED = 400_000

UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters of a text in small letters; signs such as ½ or ², which are neither letters nor digits, part them."""
    found = LETTERS.findall((text or "").lower())
    if all(map(str.isalpha, found)):
        return found
    return [w for x in found for w in ([x] if x.isalpha() else "".join(c if c.isalpha() else " " for c in x).split())]


def grams(word: str, n: int) -> list[str]:
    marked = f"<{word}>"
    return [marked[k : k + n] for k in range(len(marked) - n + 1)] if n > 1 else list(word)


def counted(texts: list[str | None]) -> Counter:
    """(kind, piece): number of texts; kind 0 for words, else the n-gram's length."""
    out: Counter = Counter()
    for text in texts:
        words = set(words_of(text))
        pieces = {(0, w) for w in words}
        for n in range(1, LONGEST + 1):
            pieces.update((n, g) for w in words for g in grams(w, n))
        out.update(pieces)
    return out


def train(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """Learns from text and lang of a hash sample of about `sample` rows of each language; null langs teach nothing.

    Languages are counted over all rows. The model holds at most WORDS + LONGEST * GRAMS pieces for each language.
    """
    known = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model({}, [], {})
    share = F.create_map(*(F.lit(x) for lang, n in sorted(sizes.items()) for x in (lang, min(1.0, sample / n))))
    drawn = known.where(F.pmod(F.xxhash64("text", F.lit(3)), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))

    def of(texts: list, langs: list) -> tuple:
        rows = [(lang, kind, piece, n) for lang in set(langs) for (kind, piece), n in counted([t for t, x in zip(texts, langs, strict=True) if x == lang]).items()]
        return tuple(zip(*rows, strict=True)) if rows else ((), (), (), ())

    pieces = map_columns(drawn, of, "lang string, kind int, piece string, n long", 1024).groupBy("lang", "kind", "piece").agg(F.sum("n").alias("n")).where((F.col("kind") > 0) | (F.col("n") >= SEEN))
    order = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "piece")
    most = F.when(F.col("kind") == 0, WORDS).otherwise(GRAMS)
    kept = pieces.withColumn("at", F.row_number().over(order)).where(F.col("at") <= most).select("lang", "kind", "piece", "n").collect()
    totals: Counter = Counter()
    for r in kept:
        totals[r["lang"], r["kind"]] += r["n"]
    langs = sorted(sizes)
    place = {lang: k for k, lang in enumerate(langs)}
    table: dict[tuple[int, str], np.ndarray] = {}
    for r in kept:
        row = table.setdefault((r["kind"], r["piece"]), np.zeros(len(langs)))
        row[place[r["lang"]]] = r["n"]
    base = {kind: np.array([totals[lang, kind] for lang in langs], float) for kind in range(LONGEST + 1)}
    size = Counter(kind for kind, _ in table)
    return Model({k: np.log((v + 0.1) / (base[k[0]] + 0.1 * size[k[0]])) for k, v in table.items()}, langs, {})


class Model:
    """Log frequencies of pieces by language, and the scores of words met so far."""

    def __init__(self, table: dict[tuple[int, str], np.ndarray], langs: list[str], met: dict[str, int]):
        self.table, self.langs = table, langs
        self.met, self.rows = met, []

    def score(self, word: str) -> np.ndarray:
        """Log likelihoods of a word, less their mean over the languages."""
        found = self.table.get((0, word))
        weight = 1.0
        for n in range(LONGEST, 0, -1):
            if found is None:
                weight *= STEP_DOWN
                hits = [self.table[n, g] for g in grams(word, n) if (n, g) in self.table]
                found = np.mean(hits, axis=0) if hits else None
        return weight * (found - found.mean()) if found is not None else np.zeros(len(self.langs))

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        if len(self.met) > REMEMBERED:
            self.met, self.rows = {}, []
        words = [words_of(t) for t in texts]
        for word in {w for own in words for w in own if w not in self.met} if self.langs else ():
            self.met[word] = len(self.rows)
            self.rows.append(self.score(word))
        best, sure = [], []
        table = np.array(self.rows)
        for own in words:
            if not own or not self.langs:
                best.append(UNKNOWN)
                sure.append(0.0)
                continue
            mean = table[np.fromiter(map(self.met.__getitem__, own), np.int64, len(own))].mean(0)
            odds = np.exp(min(len(own), INDEPENDENT) * (mean - mean.max()))
            best.append(self.langs[int(mean.argmax())])
            sure.append(float(odds.max() / odds.sum()))
        return best, sure


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of every row, from its whole text alone.

    A null text or one without letters is `und`, with a score of 0; so is every text if nothing could be learned. Ties
    go to the language first by name. Repeated rows repeat; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.table, model.langs))
    own: list[Model] = []

    def of(ids: list, texts: list) -> tuple:
        if not own:
            own.append(Model(*shared.value, {}))
        return ids, *own[0].predict(texts)

    return map_columns(docs.select(F.col("doc_id").cast("long"), "text"), of, "doc_id long, lang_pred string, score double", 512)
