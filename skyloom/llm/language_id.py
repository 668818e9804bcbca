"""Language identification by rank-order profiles (out-of-place distance).

A profile is the ranked list of the most frequent letter n-grams (orders 1 to 3, words padded by one
blank) of a language. A document gets the language whose profile its own ranks are nearest to: each
n-gram of the document counts by how many places it is off, or ``size`` places if the profile lacks it.

Training reads only text and language of the training rows; its counts cover all of them, and tasks
send one row per language and distinct n-gram. A profile has at most ``size`` entries, and languages are
handled in blocks of ``LANGUAGES_AT_ONCE``, so what a task is sent is bounded whatever the data holds.

Defined results: a null text, or one without a letter, is ``und`` with score 0, as is any text if no
profile could be learned; ties go to the language that sorts first; rows with a null text or language
teach nothing; repeated rows count each time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.llm.common import category_table, code_points, each, fields, fold_of, kept_rows, query, table

UNKNOWN = "und"
SIZE = 300
LANGUAGES_AT_ONCE = 500
FLUSH_KEYS = 2_000_000
MERGE_KEYS = 500_000
BLANK = 32
RESULT = fields(lang_pred=T.StringType(), score=T.DoubleType())


def gram_keys(text: str | None) -> np.ndarray:
    """Keys of all n-grams of a text: up to three code points of 21 bits each, so no two share a key."""
    if not text:
        return np.empty(0, dtype=np.int64)
    points = code_points(text.lower())
    letter = category_table("L")[points]
    if not letter.any():
        return np.empty(0, dtype=np.int64)
    points = np.where(letter, points, BLANK).astype(np.int64)
    keep = letter.copy()
    keep[:-1] |= letter[1:]
    keep[1:] |= letter[:-1]
    keep[1:] &= letter[1:] | letter[:-1]  # of a run of blanks the first stays
    points = np.concatenate(([BLANK], points[keep], [BLANK]))
    points = points[np.concatenate(([True], (points[1:] != BLANK) | (points[:-1] != BLANK)))]
    word = points != BLANK
    pairs = (points[:-1] << 21) | points[1:]
    middle = word[1:-1]
    triples = ((points[:-2] << 42) | (points[1:-1] << 21) | points[2:])[middle]
    return np.concatenate((points[word], pairs, triples))


def top_keys(keys: np.ndarray, size: int = SIZE) -> np.ndarray:
    """The most frequent keys in rank order; equally frequent ones by key."""
    found, times = np.unique(keys, return_counts=True)
    if len(found) > 4 * size:  # only those at or above the count of the last rank can be among the first
        least = np.partition(times, len(times) - size)[len(times) - size]
        found, times = found[times >= least], times[times >= least]
    return found[np.lexsort((found, -times))[:size]]


class _Counts:
    """Running counts of keys, merged whenever enough of them wait."""

    def __init__(self):
        self.keys, self.times, self.waiting, self.size = [], [], [], 0

    def add(self, keys: np.ndarray) -> None:
        self.waiting.append(keys)
        self.size += len(keys)
        if self.size >= MERGE_KEYS:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        new = np.concatenate([*self.waiting, np.empty(0, dtype=np.int64)])
        self.waiting, self.size = [], 0
        keys, times = np.unique(new, return_counts=True)
        if len(self.keys):
            found, where = np.unique(np.concatenate((self.keys, keys)), return_inverse=True)
            times = np.bincount(where, np.concatenate((self.times, times))).astype(np.int64)
            keys = found
        self.keys, self.times = keys, times
        return keys, times


def _count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: dict[str, _Counts] = {}

    def flush() -> Iterator[pd.DataFrame]:
        for lang, counts in held.items():
            keys, times = counts.merge()
            yield pd.DataFrame({"lang": lang, "gram": keys, "n": times})
        held.clear()

    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            if lang not in held:
                held[lang] = _Counts()
            held[lang].add(gram_keys(text))
        if sum(len(c.keys) + c.size for c in held.values()) > FLUSH_KEYS:
            yield from flush()
    yield from flush()


def learn_profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = SIZE) -> DataFrame:
    """``lang, gram, place``: the ``size`` most frequent n-grams of each language, from place 0."""
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    counts = rows.mapInPandas(_count_grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    # the filter is on the bare rank, so each task hands on no more than ``size`` rows of a language
    ranked = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
    return ranked.select("lang", "gram", (F.col("rank") - 1).alias("place"))


def _predictor(names: list[str], places: list[tuple[np.ndarray, np.ndarray]], size: int):
    """Function text -> (language, score) over one block of profiles."""
    all_keys = np.unique(np.concatenate([k for k, _ in places])) if places else np.empty(0, dtype=np.int64)
    table_ = np.full((len(names), len(all_keys) + 1), -1, dtype=np.int32)
    for row, (keys, place) in enumerate(places):
        table_[row, np.searchsorted(all_keys, keys)] = place

    def predict(text: str | None) -> tuple[str, float]:
        keys = top_keys(gram_keys(text), size)
        if not len(keys) or not names:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(all_keys, keys), len(all_keys) - 1)
        at = np.where(all_keys[at] == keys, at, len(all_keys))
        theirs = table_[:, at]
        off = np.where(theirs < 0, size, np.abs(theirs - np.arange(len(keys), dtype=np.int32)))
        total = off.sum(axis=1)
        best = int(total.argmin())
        return names[best], 1.0 - float(total[best]) / (size * len(keys))

    return predict


def predictor(profiles: DataFrame, size: int = SIZE):
    """A column function text -> struct(lang_pred, score). Profiles are few and short; they go by blocks."""
    names = [r[0] for r in profiles.select("lang").distinct().orderBy("lang").collect()]
    blocks = []
    for start in range(0, max(1, len(names)), LANGUAGES_AT_ONCE):
        some = names[start:start + LANGUAGES_AT_ONCE]
        rows = profiles.where(F.col("lang").isin(some)).toPandas() if some else None
        places = []
        for name in some:
            own = rows[rows["lang"] == name].sort_values("gram")
            places.append((own["gram"].to_numpy(), own["place"].to_numpy()))
        blocks.append(each(_Block(some, places, size), RESULT))

    def column(text: Column) -> Column:
        found = [block(text) for block in blocks]
        if len(found) == 1:
            return found[0]
        best = F.array_sort(
            F.array(*[F.struct((-f["score"]).alias("s"), f["lang_pred"].alias("l"), f.alias("f")) for f in found])
        )
        return best[0]["f"]

    return column


class _Block:
    """One block of profiles; builds its lookup table on first use in a worker."""

    def __init__(self, names, places, size):
        self.args, self.predict = (names, places, size), None

    def __getstate__(self):
        return {"args": self.args, "predict": None}

    def __call__(self, text):
        if self.predict is None:
            self.predict = _predictor(*self.args)
        return self.predict(text)


def identify(docs: DataFrame, profiles: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, lang_pred, score`` per row of ``docs``."""
    return docs.select(F.col(id_col), predictor(profiles)(F.col(text_col)).alias("m")).select(id_col, "m.*")


def keep_identified(docs: DataFrame, profiles: DataFrame, min_score: float = 0.05, text_col: str = "text") -> DataFrame:
    """Rows whose language is known with at least ``min_score``; columns stay as they are."""
    test = (F.col("m.lang_pred") != UNKNOWN) & (F.col("m.score") >= min_score)
    return kept_rows(docs, text_col, predictor(profiles), test)


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.where(fold_of(F.col("doc_id"), 5) != 0)


@query("op10_language_id")
def op10_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    profiles = learn_profiles(training_rows(docs)).persist()
    found = docs.select(
        "doc_id", (fold_of(F.col("doc_id"), 5) == 0).alias("held_out"),
        predictor(profiles)(F.col("text")).alias("m"),
    )
    profiles.unpersist()
    return found.select("doc_id", "held_out", "m.*")
