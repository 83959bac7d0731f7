"""Operator 4: removal of repeated multi-line chunks, at content-defined boundaries.

Lines are wrapped at sentence ends, so that a paragraph on one line has lines, too. A rolling hash
over the hashes of two wrapped lines chooses the boundaries: the lesser of every two hashes in a row
is one, so that a boundary depends on a few lines around it only, and of any three lines in a row
that come again, two are a chunk at every place. A chunk goes from its boundary to the next, two
lines at least. Chunks that come again anywhere in the table are repeated; so are then the pairs of
lines that overlap them and come again as well, by which a repeated passage grows up to its first
and last line. Of what is repeated the first occurrence stays and all others go, after the bytes of
their lines have been compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import batch, binary_rows, landed, longs, over_batches, set_aside, splitmix, table, texts_of

#: A wrapped line ends at the first sentence end from so many words on, or at so many words.
LEAST_WORDS, MOST_WORDS = 12, 24
SENTENCE_END = frozenset(".!?")
ROLL = np.uint64(0x9E3779B97F4A7C15)


def wrapped(line: str) -> list[str]:
    """``line`` cut at some of its blanks; joined by blanks, the parts are the line again."""
    words = line.split(" ")
    if len(words) <= LEAST_WORDS:
        return [line]
    ends = [i for i, word in enumerate(words, 1) if word[-1:] in SENTENCE_END]
    out, at, k = [], 0, 0
    while len(words) - at > LEAST_WORDS:
        while k < len(ends) and ends[k] < at + LEAST_WORDS:
            k += 1
        to = ends[k] if k < len(ends) and ends[k] <= at + MOST_WORDS else at + MOST_WORDS
        out.append(" ".join(words[at:to]))
        at = to
    if at < len(words):
        out.append(" ".join(words[at:]))
    return out


def blank(part: str | bytes) -> bool:
    return not (part.strip(" \t\r\v\f") if isinstance(part, str) else part.strip())


def spans(raw: bytes) -> list[tuple[int, int]]:
    """(start, end) of each wrapped line with words in the bytes of a text, as ``wrapped`` cuts them: what chunks are made of."""
    codes = np.frombuffer(raw + b"\n", np.uint8)
    stops = np.nonzero((codes == 32) | (codes == 10))[0]  # each ends a word, an empty one maybe
    feeds = np.nonzero(codes[stops] == 10)[0].tolist()
    before = codes[np.maximum(stops - 1, 0)]
    ends = np.nonzero((stops > 0) & ((before == 46) | (before == 33) | (before == 63)))[0].tolist()
    ends.append(len(stops) + MOST_WORDS)
    stops = stops.tolist()
    out, at, start, k = [], 0, 0, 0
    for feed in feeds:  # numbers of words: ``at`` is the first of a part, ``feed`` the last of its line
        while at <= feed:
            to = feed
            if feed - at >= LEAST_WORDS:
                while ends[k] < at + LEAST_WORDS - 1:
                    k += 1
                to = min(feed, ends[k] if ends[k] < at + MOST_WORDS else at + MOST_WORDS - 1)
            end = stops[to]
            if start < end and not blank(raw[start:end]):
                out.append((start, end))
            at, start = to + 1, end + 1
    return out


def line_hashes(text: str) -> np.ndarray:
    raw, digest = text.encode(), xxhash.xxh64_intdigest
    return np.array([digest(raw[a:b]) for a, b in spans(raw)], np.uint64)


def rolled(hashes: np.ndarray) -> np.ndarray:
    """The rolling hash of each two lines in a row."""
    with np.errstate(over="ignore"):
        return splitmix(hashes[:-1] * ROLL + hashes[1:])


def boundaries(hashes: np.ndarray, within: np.ndarray | None = None) -> np.ndarray:
    """For each place but the last: does a chunk begin here? The lesser of two rolling hashes in a row, both if alike.

    ``within``: are the line and the next of one text? Texts in a row don't know of each other.
    """
    rolling = rolled(hashes)
    within = np.ones(len(rolling), bool) if within is None else within
    both = within[:-1] & within[1:]
    less = np.concatenate([both & (rolling[:-1] <= rolling[1:]), [False]])
    greater = np.concatenate([[False], both & (rolling[:-1] >= rolling[1:])])
    alone = ~(np.concatenate([both, [False]]) | np.concatenate([[False], both]))
    return within & (less | greater | alone)[: len(rolling)]


PAIRS = "place long, tie long, h1 long, h2 long"


def _lines(record: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all rows' lines, and the row of each."""
    parts = record.column("lines").to_pylist()
    return np.frombuffer(b"".join(parts), "<u8"), np.repeat(np.arange(len(parts)), [len(x) // 8 for x in parts])


def _pairs(record: pa.RecordBatch, hashes: np.ndarray, row: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    """The pairs of lines that begin in ``at``."""
    return batch(
        place=longs(record.column("place").to_numpy()[row[at]]), tie=longs(record.column("tie").to_numpy()[row[at]]),
        h1=longs(hashes[at].view(np.int64)), h2=longs(hashes[at + 1].view(np.int64)),
    )


def _chunks(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for record in records:
        hashes, row = _lines(record)
        yield _pairs(record, hashes, row, np.nonzero(boundaries(hashes, row[:-1] == row[1:]))[0])


def _hits(record: pa.RecordBatch) -> Iterator[dict[tuple[int, int], int]]:
    """For each row: the first place of each of its repeated pairs."""
    for hits in record.column("hits"):
        x = hits.values
        yield dict(zip(zip(*(x.field(c).to_numpy().view(np.uint64).tolist() for c in ("h1", "h2")), strict=True), x.field("first").to_pylist(), strict=True))


def _overlapping(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repeated chunks again, and the pairs of lines that share a line with one."""
    for record in records:
        hashes, row = _lines(record)
        values, cuts, found = hashes.tolist(), np.searchsorted(row, np.arange(record.num_rows + 1)).tolist(), []
        for a, b, hits in zip(cuts[:-1], cuts[1:], _hits(record), strict=True):
            known = [i for i in range(a, b - 1) if (values[i], values[i + 1]) in hits]
            found += sorted({j for i in known for j in (i - 1, i, i + 1) if a <= j < b - 1})
        yield _pairs(record, hashes, row, np.array(found, np.int64))


def repeated_lines(hashes: list[int], first_of: dict[tuple[int, int], int], place: int) -> tuple[list[int], list[int]]:
    """Which lines go, and which take part in a repeated pair at all.

    In the place that comes first a pair stays where it stands first; a pair that overlaps the one
    like it, as in a run of one line again and again, is no repeat of it.
    """
    gone, told, seen = set(), set(), {}
    for i, pair in enumerate(zip(hashes[:-1], hashes[1:], strict=True)):
        if (first := first_of.get(pair)) is None:
            continue
        told |= {i, i + 1}
        if first != place or i >= seen.setdefault(pair, i) + 2:
            gone |= {i, i + 1}
    return sorted(gone), sorted(told)


def _decisions(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.int32())
    for record in records:
        lines, places = (record.column(c).to_pylist() for c in ("lines", "place"))
        found = [repeated_lines(np.frombuffer(h, "<u8").tolist(), hits, place) for h, place, hits in zip(lines, places, _hits(record), strict=True)]
        yield batch(place=longs(places), tie=record.column("tie"), gone=pa.array([x for x, _ in found], kind), told=pa.array([x for _, x in found], kind))


def _told(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash and bytes of the lines that take part."""
    for record in records:
        lines: set[bytes] = set()
        for text, told in zip(texts_of(record), record.column("told").to_pylist(), strict=True):
            raw = text.encode()
            parts = spans(raw)
            lines.update(raw[a:b] for a, b in map(parts.__getitem__, told))
        yield batch(hash=longs(np.array([xxhash.xxh64_intdigest(x) for x in lines], np.uint64).view(np.int64)), line=binary_rows(list(lines)))


def without(text: str, gone: list[int]) -> tuple[str, int]:
    """``text`` less those of its parts, and how many lines have lost something; blank lines between parts that go, go too."""
    out: list[str] = []
    dropped, lost, at, after, empty = set(gone), 0, 0, False, []
    for line in text.split("\n"):
        parts = wrapped(line)
        kept: list[str] = []
        begins = ends = None  # do the first and the last part with words go?
        for part in parts:
            if not blank(part):
                ends = at in dropped
                begins = ends if begins is None else begins
                at += 1
                if ends:
                    continue
            kept.append(part)
        if begins is None:
            empty.append(line)
            continue
        if after and begins:
            lost += len(empty)
        else:
            out += empty
        empty, after = [], ends
        if len(kept) == len(parts):
            out.append(line)
        else:
            lost += 1
            if not all(map(blank, kept)):
                out.append(" ".join(kept))
    return "\n".join(out + empty), lost


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text and any other columns) with text less its repeated chunks, and n_removed_lines.

    The first occurrence is the one with the least doc_id, and in it the first place; rows that
    share a doc_id count as one document. Rows with a null doc_id come after all others, each a
    document of its own, in the order of a hash of the text. Rows alike in both are treated alike.
    Null texts stay null, texts without repeats stay as they are, and a text may end empty. Very
    long texts are read whole, line by line. n_chars, if there is such a column, is set anew where
    text has changed. Other columns stay, whatever their names; an empty table gives an empty one.
    """
    docs, back = set_aside(docs.drop("n_removed_lines"), ["doc_id", "text", "n_chars"])
    columns = docs.columns
    tie = F.xxhash64("text")
    place = F.coalesce(F.col("doc_id").cast("long"), F.lit(1 << 62) + F.shiftrightunsigned(tie, 2))
    rows = docs.select(*columns, place.alias("_place"), tie.alias("_tie"))
    texts = rows.select(F.col("_place").alias("place"), F.col("_tie").alias("tie"), "text").where(F.length("text") > 0)

    def hashed(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for record in records:
            lines = [line_hashes(x) for x in texts_of(record)]
            yield batch(place=record.column("place"), tie=record.column("tie"), lines=binary_rows([x.astype("<u8").tobytes() for x in lines]))

    hashes = landed(over_batches(texts, hashed, "place long, tie long, lines binary").where(F.length("lines") >= 16), "lines")

    def hits_of(found: DataFrame) -> DataFrame:
        """(place, tie, h1, h2, first) of those pairs that are found more than once."""
        repeated = landed(found.groupBy("h1", "h2").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1").select("h1", "h2", "first"), "repeated")
        return landed(found.join(repeated, ["h1", "h2"]).select("place", "tie", "h1", "h2", "first"), "hits")

    def with_hits(hits: DataFrame) -> DataFrame:
        by_row = hits.groupBy("place", "tie").agg(F.collect_set(F.struct("h1", "h2", "first")).alias("hits"))
        return hashes.join(by_row, ["place", "tie"])

    hits = hits_of(hashes.mapInArrow(_chunks, PAIRS))
    hits = hits_of(landed(with_hits(hits).mapInArrow(_overlapping, PAIRS), "overlapping"))

    def decided(hits: DataFrame) -> DataFrame:
        found = landed(with_hits(hits).mapInArrow(_decisions, "place long, tie long, gone array<int>, told array<int>").dropDuplicates(["place", "tie"]), "decided")
        return found.select(F.col("place").alias("_p"), F.col("tie").alias("_t"), F.col("gone").alias("_gone"), "told")

    def joined(decisions: DataFrame, how: str) -> DataFrame:
        return rows.join(decisions, (F.col("_place") == F.col("_p")) & (F.col("_tie") == F.col("_t")), how)

    decisions = decided(hits)
    # The bytes of all lines that take part meet by hash: different lines under one hash are left alone.
    compared = over_batches(joined(decisions, "inner").select("text", "told"), _told, "hash long, line binary").distinct()
    clashing = landed(compared.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), "clashing")
    if not clashing.isEmpty():
        for side in ("h1", "h2"):
            hits = hits.join(clashing, F.col(side) == F.col("hash"), "left_anti")
        decisions = decided(hits)

    schema = T.StructType([*docs.schema.fields, T.StructField("n_removed_lines", T.LongType())])

    def cleaned(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for record in records:
            texts, lost = record.column(text_at).to_pylist(), [0] * record.num_rows
            sizes = record.column(chars_at).to_pylist() if chars_at is not None else []
            for i, gone in enumerate(record.column("_gone").to_pylist()):
                if gone:
                    texts[i], lost[i] = without(texts[i], gone)
                    if sizes:
                        sizes[i] = len(texts[i])
            new = {text_at: texts} | ({chars_at: sizes} if chars_at is not None else {})
            arrays = [pa.array(new[k], record.schema.field(k).type) if k in new else record.column(k) for k in range(len(columns))]
            yield pa.RecordBatch.from_arrays([*arrays, longs(lost)], names=[*columns, "n_removed_lines"])

    text_at, chars_at = columns.index("text"), columns.index("n_chars") if "n_chars" in columns else None
    changed = decisions.where(F.size("_gone") > 0).drop("told")
    return back(over_batches(joined(changed, "left").select(*columns, "_gone"), cleaned, schema), "n_removed_lines")


def op4_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
