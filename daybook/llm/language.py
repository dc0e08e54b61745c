"""Language identification by a string kernel.

Two texts are compared by the blended-spectrum presence kernel: how many n-grams of one
to three letters occur in both, however often, divided by the root of the product of how
many occur in each. Landmarks, some texts of the training sample, stand for the kernel's
feature space (Nyström): a text is mapped to its kernel values with the landmarks, times
the inverse root of the landmarks' own kernel matrix, in which a one-versus-rest ridge
regression is fitted. Scoring a batch of texts is two matrix products.

N-grams are told apart by a hash of ``FEATURE_BITS`` bits. Training reads all labelled
rows but fits on a sample of at most ``PER_LANGUAGE`` rows of each language, expected, taken
by a hash of the key; that bound is the fit's only limit. Every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import given, saved, unit

UNDETERMINED = "und"
FEATURE_BITS = 13
PER_LANGUAGE = 400
LANDMARKS = 160
RIDGE = 0.1
TEXTS_AT_ONCE = 256
LETTERS_AT_ONCE = 1 << 20


# --- features -----------------------------------------------------------------


def letter_table() -> np.ndarray:
    """For each code point its lower-case form if it is a letter, else a blank, 0."""
    table = np.zeros(0x110000, np.uint32)
    for at in range(len(table)):
        char = chr(at)
        if char.isalpha():
            table[at] = ord(char.lower()[0])
    return table


_letters: list[np.ndarray] = []


def letters_of(text: str) -> np.ndarray:
    if not _letters:
        _letters.append(letter_table())
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _letters[0][points]


def mark_grams(row: np.ndarray, text: str) -> bool:
    """Sets the entries of ``row`` for the n-grams present in ``text``; whether it has letters.

    Runs of other characters are one blank, and a blank stands before and after the text,
    so n-grams also tell where words begin and end. Long texts are hashed piece by piece, the
    pieces overlapping by all but one letter of an n-gram.
    """
    x = np.zeros(len(text) + 2, np.uint32)
    x[1:-1] = letters_of(text)
    x = x[np.r_[True, (x[1:] != 0) | (x[:-1] != 0)]]
    shift = np.uint32(32 - FEATURE_BITS)
    for at in range(0, len(x), LETTERS_AT_ONCE):
        part = x[at : at + LETTERS_AT_ONCE + 2]
        one = part[part != 0]
        row[(one * np.uint32(2654435761)) >> shift] = 1
        two = part[:-1] * np.uint32(2246822519) + part[1:] * np.uint32(3266489917)
        row[(two * np.uint32(668265263)) >> shift] = 1
        three = two[:-1] * np.uint32(374761393) + part[2:] * np.uint32(2654435761)
        three ^= three >> np.uint32(15)
        row[(three * np.uint32(2246822519)) >> shift] = 1
    return bool(x.any())


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Presence of n-grams, divided by its length, and which texts have a letter."""
    marks = np.zeros((len(texts), 1 << FEATURE_BITS), np.float32)
    lettered = np.array([mark_grams(row, t) if t else False for row, t in zip(marks, texts, strict=True)])
    return marks / np.sqrt(np.maximum(marks.sum(axis=1, keepdims=True), 1)), lettered


# --- model --------------------------------------------------------------------


@dataclass
class Model:
    """What scoring needs; its size depends on the parameters only."""

    languages: list[str]
    landmarks: np.ndarray
    weights: np.ndarray
    offsets: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score from 0 to 1 of each text: the regression's highest value, as a
        share of all of them above 0."""
        x, lettered = features(texts)
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        values = np.clip((x @ self.landmarks.T) @ self.weights + self.offsets, 0, None)
        values = values.astype(np.float64) + 1e-9
        best = values.argmax(axis=1)
        score = values[np.arange(len(texts)), best] / values.sum(axis=1)
        names = [self.languages[b] if ok else UNDETERMINED for b, ok in zip(best, lettered, strict=True)]
        return names, np.where(lettered, score, 0.0)


def fit(x: np.ndarray, labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """The kernel ridge regression of labelled texts' features ``x``; the first of each
    language in turn are landmarks."""
    languages = sorted(set(labels))
    if not languages:
        none = np.zeros((0, 1 << FEATURE_BITS), np.float32)
        return Model([], none, np.zeros((0, 0), np.float32), np.zeros(0, np.float32))
    order = pd.Series(labels).groupby(labels).cumcount().argsort(kind="stable").to_numpy()
    chosen = x[order[:landmarks]]
    values, vectors = np.linalg.eigh((chosen @ chosen.T).astype(np.float64))
    keep = values > 1e-6 * values.max(initial=1.0)
    root = vectors[:, keep] / np.sqrt(values[keep])
    mapped = (x @ chosen.T).astype(np.float64) @ root
    wanted = np.array([[float(a == b) for b in languages] for a in labels])
    # every language weighs the same, however many rows it has
    share = 1.0 / np.maximum(wanted.sum(axis=0), 1)
    weight = (wanted * share).sum(axis=1, keepdims=True)
    weight /= weight.sum()
    center, mean = (weight * mapped).sum(axis=0), (weight * wanted).sum(axis=0)
    a, b = mapped - center, wanted - mean
    gram = a.T @ (weight * a) + ridge * 1e-2 * np.eye(a.shape[1])
    beta = np.linalg.solve(gram, a.T @ (weight * b))
    return Model(
        languages, chosen, (root @ beta).astype(np.float32), (mean - center @ beta).astype(np.float32)
    )


# --- jobs ---------------------------------------------------------------------


def train(
    labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
    per_language: int = PER_LANGUAGE,
) -> Model:
    """Fits on a sample of ``labelled``: of a language with n rows, each is taken with
    probability ``per_language`` / n, by its key, up to twice that many. Rows without text or
    language teach nothing."""
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(key).alias("_key"), F.col(text).alias("_text"), F.col(lang).alias("_lang")
    )
    counts = saved(rows.groupBy(F.col("_lang").alias("_of")).agg(F.count("*").alias("_n")), "languages")
    draw = unit(F.xxhash64(F.lit(4), "_key"))
    taken = (
        rows.withColumn("_draw", draw)
        .join(counts, F.col("_lang") == F.col("_of"))
        .where(F.col("_draw") * F.col("_n") < per_language)
    )

    @F.pandas_udf("binary")
    def packed(texts: pd.Series) -> pd.Series:
        rows = (features([t])[0][0] for t in texts)
        return pd.Series([np.packbits(row > 0).tobytes() for row in rows], dtype=object)

    sample = taken.select("_key", "_draw", "_lang", packed("_text").alias("_bits")).toPandas()
    sample = sample.sort_values(["_draw", "_key"], kind="stable")
    sample = sample.groupby("_lang", sort=True).head(2 * per_language)
    bits = np.frombuffer(b"".join(sample["_bits"]), np.uint8).reshape(len(sample), (1 << FEATURE_BITS) // 8)
    x = np.unpackbits(bits, axis=1).astype(np.float32)
    return fit(x / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1)), sample["_lang"].tolist())


def with_language(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``documents`` with ``lang_pred`` and ``score`` added, or in place of such columns.

    Only the text counts. A text that is null, empty or without a letter is ``und``, with
    score 0; so is every text if nothing was learned.
    """
    shared = documents.sparkSession.sparkContext.broadcast(vars(model))

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        fitted = Model(**shared.value)
        for texts in batches:
            names, scores = [], []
            for at in range(0, len(texts), TEXTS_AT_ONCE):
                named, scored = fitted.predict(texts.iloc[at : at + TEXTS_AT_ONCE].tolist())
                names += named
                scores.append(scored)
            yield pd.DataFrame({"lang_pred": names, "score": np.concatenate([np.zeros(0), *scores])})

    rows = given(documents, ["lang_pred", "score"], words=F.col(text))
    rows = rows.select("given", predict("words").alias("predicted"))
    return rows.select("given.*", "predicted.lang_pred", "predicted.score")


def with_letters(documents: DataFrame, text: str = "text") -> DataFrame:
    """The ``documents`` whose text has a letter, in the sense of the features; nothing needs
    to have been learned."""

    @F.pandas_udf("boolean")
    def lettered(texts: pd.Series) -> pd.Series:
        return pd.Series([bool(t) and bool(letters_of(t).any()) for t in texts], dtype=bool)

    rows = given(documents, words=F.col(text))
    return rows.where(lettered("words")).select("given.*")


def held_out(key: str = "doc_id") -> Column:
    """Rows that are never trained on: a quarter, by a checksum of the key."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))
