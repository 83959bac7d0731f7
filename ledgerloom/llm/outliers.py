"""Operator 3: documents whose statistics lie far from the rest of their language and source.

Location and scatter of each group come from regularised minimum-covariance-determinant estimates:
of all subsets of h rows that with the least determinant of its scatter, to which ``P + 1`` rows of
spread as the whole table has it are added. A group of a few rows then leans on the table, one of
hundreds on itself, and a statistic that is constant in a small group still has a scatter. Every
group has an estimate of its own, whatever its size.

Starts are fitted on a bounded sample of each group; all steps that follow (concentration,
reweighting, distances) are Spark aggregates over every row. A step needs the h nearest rows of each
group: rows are counted and summed by narrow bins of distance, so a group that holds a third of all
rows is summed where its rows are, and only its bins meet.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .shared import batch, landed, longs, over_batches, table, texts_of

# The base rules.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS, MOST_REPEATED = 50, 50

#: Rows of a group that the starts are fitted on, about.
SAMPLE_ROWS = 500
#: Share of a group that is taken to be sound, concentration steps, and the tail left to chance. Real
#: statistics have heavier tails than normal ones, so the tail is a far one.
SOUND, STEPS, TAIL = 0.75, 3, 1e-13
#: Words at the group's median rate that are added to each text: rates of short texts, which chance
#: moves most, come to vary about as much as those of long ones.
PRIOR_WORDS = 150
#: Statistics of a text: the logarithm of its words, and those of rates a word.
RATES = {"word_length": "word_chars", "repeats": "n_repeats", "punctuation": "n_punct", "capitals": "n_capitals", "lines": "n_lines"}
FEATURES = ["size", *RATES]
P = len(FEATURES)
BINS_PER_OCTAVE = 16

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_punct", "n_repeats"]
STATISTICS = "doc_id long, lang string, source string, tie long, " + ", ".join(f"{x} long" for x in COUNTS)
#: Bytes that are no punctuation: letters, digits, white space and all beyond ASCII.
_OTHER = bytes(b for b in range(256) if b > 126 or b < 33 or chr(b).isalnum())


def repeated_words(words: list[bytes]) -> tuple[int, int]:
    """Words that lie in a three-word window found twice or more, and different words."""
    n = len(words)
    if n < 4:
        return 0, len(set(words))
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    k = len(number)
    if k < 2_000_000:  # three numbers fit in 63 bits
        windows = (ids[:-2] * k + ids[1:-1]) * k + ids[2:]
    else:
        _, pairs = np.unique(ids[:-1] * k + ids[1:], return_inverse=True)
        windows = pairs[:-1] * k + ids[2:]
    _, which, counts = np.unique(windows, return_inverse=True, return_counts=True)
    twice = counts[which] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= twice
    return int(covered.sum()), k


def text_statistics(text: str) -> tuple[int, ...]:
    """``COUNTS`` of a whole text: words, their characters, symbols, repeated lines and words, lines, capitals, punctuation, words that came before."""
    raw = text.encode()
    words = raw.split()  # bytes split at exactly the six ASCII separators
    spaces = sum(map(text.count, " \t\n\v\f\r"))
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    capitals = len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    repeated, distinct = repeated_words(words)
    return (
        len(words), len(text) - spaces, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated, len(lines), capitals,
        len(raw.translate(None, _OTHER)), len(words) - distinct,
    )


def statistics(docs: DataFrame) -> DataFrame:
    """The statistics of every whole text (null: none)."""

    def rows(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for record in records:
            columns = list(zip(*map(text_statistics, texts_of(record)), strict=True)) or [[]] * len(COUNTS)
            yield batch(
                doc_id=record.column("doc_id"), lang=record.column("lang"), source=record.column("source"), tie=record.column("tie"),
                **{name: longs(x) for name, x in zip(COUNTS, columns, strict=True)},
            )

    return over_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "source", F.xxhash64("text").alias("tie"), "text"), rows, STATISTICS)


def chi2_below(x: float, k: int) -> float:
    """P(chi-square with an even number ``k`` of degrees of freedom <= x)."""
    term, total = 1.0, 0.0
    for i in range(k // 2):
        total += term
        term *= x / 2 / (i + 1)
    return 1 - math.exp(-x / 2) * total


def chi2_quantile(p: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_below(mid, k) < p else (low, mid)
    return high


def consistency(share: float) -> float:
    """Makes the scatter of the nearest ``share`` of normal data that of all."""
    return share / chi2_below(chi2_quantile(share, P), P + 2)


def subset_size(n: int) -> int:
    """How many of ``n`` rows are taken to be sound."""
    return max(math.ceil(SOUND * n), min(n, (n + P + 1) // 2))


def scatter_of(spread: np.ndarray, n: float, share: float) -> np.ndarray:
    """The scatter of ``n`` rows, the nearest ``share`` of their group, and ``P + 1`` rows of unit spread."""
    own = n / (n + P + 1)
    return (1 - own) * np.eye(P) + own * consistency(share) * spread


def fitted(mean: np.ndarray, spread: np.ndarray, n: float, share: float) -> list[float]:
    """Mean and the upper triangle of the inverse scatter, as ``distance`` takes them."""
    return [*mean.tolist(), *np.linalg.inv(scatter_of(spread, n, share))[np.triu_indices(P)].tolist()]


#: The fit before any row is seen: the group's medians and unit spread.
BEFORE = [0.0] * P + np.eye(P)[np.triu_indices(P)].tolist()


def start(x: np.ndarray) -> list[float]:
    """Fast minimum-covariance-determinant fit of a sample: small random subsets, concentrated."""
    n = len(x)
    h = subset_size(n)
    random = np.random.default_rng(n)

    def concentrated(chosen: np.ndarray, steps: int) -> tuple[float, np.ndarray]:
        for _ in range(steps):
            apart = x - x[chosen].mean(0)
            inverse = np.linalg.inv(scatter_of(np.cov(x[chosen].T, bias=True), len(chosen), h / n))
            before, chosen = chosen, np.sort(np.argsort(((apart @ inverse) * apart).sum(1), kind="stable")[:h])
            if np.array_equal(before, chosen):
                break
        return float(np.linalg.slogdet(scatter_of(np.cov(x[chosen].T, bias=True), h, h / n))[1]), chosen

    few = min(n, P + 1)
    tries = [concentrated(random.choice(n, few, replace=False), 2) for _ in range(60)]
    tries.append(concentrated(np.argsort((x * x).sum(1), kind="stable")[:h], 2))
    best = min((concentrated(c, 30) for _, c in sorted(tries, key=lambda t: t[0])[:6]), key=lambda t: t[0])[1]
    return fitted(x[best].mean(0), np.cov(x[best].T, bias=True), h, h / n)


def distance() -> Column:
    """Squared Mahalanobis distance of a row's features under the row's ``fit``."""
    apart = [F.col(c) - F.col("fit")[i] for i, c in enumerate(FEATURES)]
    total, k = F.lit(0.0), P
    for i in range(P):
        for j in range(i, P):
            total = total + apart[i] * apart[j] * F.col("fit")[k] * (1 if i == j else 2)
            k += 1
    return F.greatest(total, F.lit(0.0))


def median(x: Column) -> Column:
    return F.percentile_approx(x, 0.5)


def with_features(stats: DataFrame) -> DataFrame:
    """``cell`` (language and source) and the features of each row, in units of the table's spread.

    A rate is compared with the median of the cell's sound rows; the unit is the median of all sound
    rows' departures from their cell's medians.
    """
    part = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit("-"))
    stats = stats.withColumn("cell", F.concat_ws("\t", part("lang"), part("source")))
    sound = stats.where("sound")
    # Landed: a table of known size is sent to the rows, which then needn't be dealt out by cell.
    usual = landed(
        sound.groupBy("cell").agg(median(F.log("n_words")).alias("_size"), *(median(F.col(c) / F.col("n_words")).alias(f"_{name}") for name, c in RATES.items())), "medians"
    )

    def rate(name: str, c: str) -> Column:
        r = F.greatest(F.col(f"_{name}"), F.lit(1e-4))  # one in ten thousand words at least, or nothing could be compared
        return F.log((F.col(c) + r * PRIOR_WORDS) / (r * (F.col("n_words") + PRIOR_WORDS))).alias(name)

    raw = stats.join(usual, "cell", "left").select(*stats.columns, (F.log("n_words") - F.col("_size")).alias("size"), *(rate(name, c) for name, c in RATES.items()))
    units = raw.where("sound").agg(*(median(F.abs(c)).alias(c) for c in FEATURES), *(F.avg(F.abs(c)).alias(f"_{c}") for c in FEATURES)).first()
    # A statistic that is the same in most rows is measured by its mean departure, one that never departs by one.
    unit = {c: 1.4826 * (units[c] or 0.0) or units[f"_{c}"] or 1.0 for c in FEATURES}
    return raw.select(*stats.columns, *((F.col(c) / unit[c]).alias(c) for c in FEATURES))


def fits(rows: DataFrame) -> DataFrame:
    """(cell, fit) over all rows of ``rows`` (doc_id, tie, cell and features), landed in the shared folder."""
    counts = landed(rows.groupBy("cell").agg(F.count("*").alias("n")), "cells")
    # Rows alike are one row of the sample, so that it is bounded whatever repeats.
    sample = rows.join(counts, "cell").where(F.pmod(F.xxhash64("doc_id", "tie"), F.lit(1 << 20)) * F.col("n") < SAMPLE_ROWS * (1 << 20))

    def started(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values(["doc_id", "tie"])[FEATURES].to_numpy()
        return pd.DataFrame({"cell": [pdf["cell"].iloc[0]], "fit": [start(x)]})

    begun = sample.dropDuplicates(["cell", "doc_id", "tie"]).groupBy("cell").applyInPandas(started, "cell string, fit array<double>")
    before = F.array(*(F.lit(x) for x in BEFORE))  # of a cell without a row in the sample, as where one row repeats
    now = landed(counts.join(begun, "cell", "left").select("cell", F.col("n").alias("rows"), F.coalesce("fit", before).alias("fit")), "fit")
    pairs = [(i, j) for i in range(P) for j in range(i, P)]
    sums = [F.sum(c).alias(f"s{i}") for i, c in enumerate(FEATURES)] + [
        F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"s{P + k}") for k, (i, j) in enumerate(pairs)
    ]
    names = [f"s{i}" for i in range(P + len(pairs))]
    nearest = chi2_quantile(0.975, P)
    subset = F.greatest(F.ceil(F.col("rows") * SOUND), F.least("rows", F.floor((F.col("rows") + P + 1) / 2)))

    def refitted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            found = []
            for n, share, row in zip(pdf["n"], pdf["share"], pdf[names].to_numpy(), strict=True):
                mean = row[:P] / n
                spread = np.zeros((P, P))
                spread[np.triu_indices(P)] = row[P:] / n
                found.append(fitted(mean, spread + np.triu(spread, 1).T - np.outer(mean, mean), n, share))
            yield pd.DataFrame({"cell": pdf["cell"], "rows": pdf["rows"], "fit": found})

    for step in range(STEPS + 1):
        far = rows.join(now, "cell").withColumn("d2", distance())
        if step < STEPS:  # concentrate on the nearest rows of each cell; of the last bin that takes part, the share that is needed
            binned = far.withColumn("bin", F.floor(F.log2(F.col("d2") + 1e-9) * BINS_PER_OCTAVE))
            bins = binned.groupBy("cell", "rows", "bin").agg(F.count("*").alias("n"), *sums)
            upto = F.sum("n").over(W.partitionBy("cell").orderBy("bin")) - F.col("n")
            taken = bins.withColumn("taken", F.least(F.lit(1.0), (subset - upto) / F.col("n"))).where("taken > 0")
            near = taken.groupBy("cell", "rows").agg(F.sum(F.col("n") * F.col("taken")).alias("n"), *(F.sum(F.col(c) * F.col("taken")).alias(c) for c in names))
            near = near.withColumn("share", F.col("n") / F.col("rows"))
        else:  # reweight: all rows but the far ones
            near = far.where(F.col("d2") <= nearest).groupBy("cell", "rows").agg(F.count("*").cast("double").alias("n"), *sums).withColumn("share", F.lit(0.975))
        found = landed(near.select("cell", "rows", "n", "share", *names).mapInPandas(refitted, "cell string, rows long, fit array<double>"), "fit")
        # A cell no row of which is near keeps the fit that it has.
        now = found if step < STEPS else landed(now.join(found.select("cell", F.col("fit").alias("last")), "cell", "left").select("cell", F.coalesce("last", "fit").alias("fit")), "fit")
    return now


def judged(docs: DataFrame, tail: float = TAIL) -> DataFrame:
    """Every row of ``docs`` (doc_id, lang, source, text) with its statistics and verdict.

    ``base_failed``: too few words, or too many in repeated windows; such rows take no part in the
    estimates and have no ``distance``. Others are kept if their squared distance is one that normal
    rows reach with a probability of ``tail`` or more. Null texts have no words; null languages and
    sources are values of their own. Rows alike get verdicts alike, ties included; very long texts
    count whole; other columns are left out, and an empty table gives an empty one.
    """
    stats = statistics(docs).withColumn(
        "base_failed", (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    )
    # Landed once: each of the steps below reads the features of all rows.
    rows = landed(with_features(landed(stats.withColumn("sound", ~F.col("base_failed")), "statistics")), "features")
    fit = fits(rows.where("sound").select("doc_id", "tie", "cell", *FEATURES))
    # A cell without sound rows has no fit, and no rows that need one.
    far = rows.join(fit, "cell", "left").withColumn("distance", F.when(F.col("sound"), distance()))
    kept = F.coalesce(F.col("distance") <= chi2_quantile(1 - tail, P), F.lit(False))
    return far.select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "distance"
    )


def op3_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents")).drop("lang", "source")
