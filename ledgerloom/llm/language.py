"""Operator 6: language ID in two levels.

The first level tells language families apart, the second the languages within a family: one linear
support vector machine for each pair of them, whose votes are added up. Features are hashed letter
n-grams of the whole text. The machines are fitted on a bounded sample of labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import batch, binary_rows, landed, longs, over_batches, splitmix, table, texts_of

#: Labelled rows of each language that a model is fitted on, at most about, and of all languages together:
#: what reaches the driver, however many languages there are.
ROWS_PER_LANGUAGE, ALL_ROWS = 1000, 8000
#: Hashed features; a vector travels to the driver only for the sample's rows.
FEATURES = 1 << 12

# Families of close languages. A language that isn't listed is a family of its own.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "is", "lb", "nb", "nl", "nn", "no", "sv"],
    "romance": ["ca", "es", "fr", "gl", "it", "oc", "pt", "ro"],
    "slavic": ["be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "indic": ["bn", "gu", "hi", "mr", "ne", "pa"],
    "turkic": ["az", "kk", "ky", "tr", "tt", "uz"],
    "semitic": ["am", "ar", "he", "mt"],
    "uralic": ["et", "fi", "hu"],
}
FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs}

LETTER = regex.compile(r"\p{L}")


def family_of(lang: str) -> str:
    return FAMILY_OF.get(lang, lang)


#: Characters of a text that are hashed at once: n-grams over a cut are counted with what follows it.
CHUNK = 1 << 18
BLANK = np.array([32], np.uint32)


def _count(counts: np.ndarray, codes: np.ndarray, begin: int) -> None:
    """Add the n-grams of ``codes`` that end at ``begin`` or after it."""
    one = codes * np.uint32(0x9E3779B1)
    two = (one[:-1] ^ (codes[1:] * np.uint32(0x85EBCA6B))) * np.uint32(0xC2B2AE35)
    three = (two[:-1] ^ (codes[2:] * np.uint32(0x27D4EB2F))) * np.uint32(0x165667B1)
    for k, grams in enumerate((one, two, three)):
        counts += np.bincount(grams[max(0, begin - k) :] >> np.uint32(20), minlength=FEATURES)


def vector(text: str) -> np.ndarray:
    """Root counts of hashed n-grams of one to three letters, of length one."""
    counts, text = np.zeros(FEATURES, np.int64), text.lower()
    before, word = BLANK, True  # the last two codes so far, and whether a blank may follow them
    _count(counts, BLANK, 0)
    for at in range(0, len(text), CHUNK):
        codes = np.frombuffer(text[at : at + CHUNK].encode("utf-32-le", "surrogatepass"), np.uint32)
        # Below 65 there are no letters; what stands between words becomes one blank.
        codes = np.where((codes < 97) | ((codes > 122) & (codes < 192)), np.uint32(32), codes)
        codes = codes[np.concatenate([[word], codes[:-1] != 32]) | (codes != 32)]
        _count(counts, np.concatenate([before, codes]), len(before))
        before, word = np.concatenate([before, codes])[-2:], bool(codes[-1] != 32) if len(codes) else word
    _count(counts, np.concatenate([before, BLANK]), len(before))
    out = np.sqrt(counts, dtype=np.float32)
    return out / max(float(np.sqrt((out * out).sum())), 1e-9)


def machine(x: np.ndarray, y: np.ndarray, cost: float = 2.0, rounds: int = 15) -> np.ndarray:
    """A linear support vector machine by dual coordinate descent: weights, bias last. y: 1 or -1.

    Squared hinge loss; both classes weigh the same, whatever their rows.
    """
    weight = np.where(y > 0, 0.5 / max((y > 0).mean(), 1e-9), 0.5 / max((y < 0).mean(), 1e-9))
    slack = 1 / (2 * cost * weight)
    norm = np.einsum("ij,ij->i", x, x) + 1 + slack
    w, bias, alpha, random = np.zeros(x.shape[1], np.float32), 0.0, np.zeros(len(x)), np.random.default_rng(7)
    for _ in range(rounds):
        most = 0.0
        for i in random.permutation(len(x)):
            step = (y[i] * (float(x[i] @ w) + bias) - 1 + alpha[i] * slack[i]) / norm[i]
            new = max(0.0, alpha[i] - step)
            if new != alpha[i]:
                change = (new - alpha[i]) * y[i]
                w += np.float32(change) * x[i]
                bias += change
                most = max(most, abs(new - alpha[i]))
                alpha[i] = new
        if most < 1e-3:
            break
    return np.append(w, np.float32(bias))


def sigmoid(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(3 * margin, -30, 30)))


class LanguageModel:
    """Family machines (one against the rest) and, in each family, one machine for each pair."""

    def __init__(self, x: np.ndarray, langs: list[str]):
        labels = np.array(langs, dtype=object)
        self.languages = sorted(set(langs))
        self.families = sorted({family_of(x) for x in self.languages})
        family = np.array([family_of(x) for x in langs], dtype=object)
        rows: list[np.ndarray] = []
        for f in self.families:
            rows.append(machine(x, np.where(family == f, 1, -1)) if len(self.families) > 1 else np.zeros(FEATURES + 1))
        self.members = [[k for k, lang in enumerate(self.languages) if family_of(lang) == f] for f in self.families]
        self.pairs: list[tuple[int, int]] = []
        for members in self.members:
            for a, b in combinations(members, 2):
                here = (labels == self.languages[a]) | (labels == self.languages[b])
                rows.append(machine(x[here], np.where(labels[here] == self.languages[a], 1, -1)))
                self.pairs.append((a, b))
        self.weights = np.array(rows, np.float32).T

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The language of each row, and the probability given to it."""
        margins = x @ self.weights[:-1] + self.weights[-1]
        n = len(self.families)
        chance = sigmoid(margins[:, :n])
        chance /= np.maximum(chance.sum(1, keepdims=True), 1e-9)
        votes = np.zeros((len(x), len(self.languages)))
        share = np.ones((len(x), len(self.languages)))
        for k, (a, b) in enumerate(self.pairs):
            p = sigmoid(margins[:, n + k])
            votes[:, a] += (p >= 0.5) + 1e-3 * p
            votes[:, b] += (p < 0.5) + 1e-3 * (1 - p)
            share[:, a] = np.minimum(share[:, a], p)
            share[:, b] = np.minimum(share[:, b], 1 - p)
        best_family = chance.argmax(1)
        langs, scores = [], np.zeros(len(x))
        for i, f in enumerate(best_family):
            best = max(self.members[f], key=lambda k, i=i: votes[i, k])
            langs.append(self.languages[best])
            scores[i] = chance[i, f] * share[i, best]
        return langs, np.clip(scores, 0, 1)


def fit(labelled: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE, all_rows: int = ALL_ROWS) -> LanguageModel | None:
    """A model of ``labelled`` (doc_id, text, lang), or None if no row has a language and a letter.

    About ``rows_per_language`` rows of each language, or an even share of ``all_rows`` where there
    are many, chosen by a hash of doc_id and text, are taken: the bound of what reaches the driver,
    as vectors of ``FEATURES`` small integers. Rows alike are one row of the sample, and a language
    has one row at least, whatever repeats.
    """
    place = F.pmod(F.xxhash64("doc_id", "text", F.lit(6)), F.lit(1 << 30))
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text", place.alias("place"))
    # Landed: a table of known size is sent to the rows, whose texts then needn't be dealt out by language.
    counts = landed(rows.groupBy("lang").agg(F.count("*").alias("n"), F.min("place").alias("least")), "languages")
    wanted = min(rows_per_language, all_rows // max(1, counts.count()))
    chosen = (F.col("place") * F.col("n") < F.lit(wanted * (1 << 30))) | (F.col("place") == F.col("least"))
    sample = rows.join(counts, "lang").where(chosen).dropDuplicates(["lang", "place"])

    def vectors(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for record in records:
            texts = texts_of(record)
            have = [i for i, x in enumerate(texts) if LETTER.search(x)]
            yield batch(
                place=longs([record.column("place")[i].as_py() for i in have]), lang=pa.array([record.column("lang")[i].as_py() for i in have], pa.string()),
                vector=binary_rows([(vector(texts[i]) * 65535).astype("<u2").tobytes() for i in have]),
            )

    found = over_batches(sample.select("place", "lang", "text"), vectors, "place long, lang string, vector binary").collect()
    found.sort(key=lambda r: (r.lang, r.place, bytes(r.vector)))
    if not found:
        return None
    langs = [r.lang for r in found]
    x = np.empty((len(found), FEATURES), np.float32)  # filled row by row: the sample is in memory once
    for i in range(len(found)):
        x[i] = np.frombuffer(bytes(found[i].vector), "<u2")
        found[i] = None
    x /= 65535
    return LanguageModel(x, langs)


def predict(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``docs`` (any columns, a text among them) with lang_pred and score.

    Texts that are null or have no letter are ``und`` with score 0, and so are all without a model.
    Texts are read whole, however long; a tie between languages goes to the one first in the
    alphabet; rows alike come out alike; an empty table gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few vectors of FEATURES numbers for each language
    out = docs.drop("lang_pred", "score")

    def rows(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for record in records:
            texts = texts_of(record)
            langs, scores = ["und"] * len(texts), np.zeros(len(texts))
            have = [i for i, x in enumerate(texts) if LETTER.search(x)] if shared.value else []
            if have:
                found, chance = shared.value.predict(np.array([vector(texts[i]) for i in have]))
                scores[have] = chance
                for i, lang in zip(have, found, strict=True):
                    langs[i] = lang
            arrays = [record.column(name) for name in names] + [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "lang_pred", "score"])

    names = out.columns
    return over_batches(out, rows, _with(out, "lang_pred string, score double"))


def _with(df: DataFrame, more: str):
    from pyspark.sql import types as T

    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(more).fields])


def held_out(doc_id: str = "doc_id"):
    """One document in five, by the checksum of its id as text; no model learns from these."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.where(~held_out()))
    return predict(docs.select("doc_id", held_out().alias("held_out"), "text"), model).drop("text")
