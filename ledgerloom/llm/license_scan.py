"""Operator 5: licences by the digest of canonical texts, in Spark's own functions throughout.

A text's canonical form is lower-cased, without copyright lines, with one blank for each run of
other characters than letters and digits, and with one spelling for equivalent ones. Its SHA-256 is
joined with the digests of known licences. Lines that are a known notice are found in the same pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .license_texts import DIGESTS, LICENSES, NOTICES, SPELLINGS
from .shared import table

#: Lines that name a holder, as text without capitals, and what each of them holds.
COPYRIGHT_LINE = r"(^|\n)[^\na-z]*(copyright[ \t]*(\(c\)|©|[0-9])|©|\(c\)[ \t]*[0-9]|all rights reserved)[^\n]*"
COPYRIGHT_MARKS = ["copyright", "©", "(c)", "all rights reserved"]
OTHER = r"[^\p{L}\p{N}]+"
OTHER_WITHIN_LINES = r"[^\p{L}\p{N}\n]+"
ANY_SPELLING = "(^|[ \n])(" + "|".join(old.replace(" ", "[ \n]+") for old, _ in SPELLINGS) + ")($|[ \n])"


def spelt(plain: Column) -> Column:
    """Words with single blanks between them, in one spelling. Blanks are doubled meanwhile, so that words in a row don't share one."""
    wide = lambda x: f" {x.replace(' ', '  ')} "
    out = F.concat(F.lit(" "), F.replace(plain, F.lit(" "), F.lit("  ")), F.lit(" "))
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(wide(old)), F.lit(wide(new)))
    return F.replace(F.trim(out), F.lit("  "), F.lit(" "))


def plain_lines(text: Column) -> Column:
    """Lower case, no copyright lines, one blank for each run of other characters; lines stay."""
    lower = F.lower(text)
    marked = F.lit(False)
    for mark in COPYRIGHT_MARKS:
        marked = marked | F.contains(lower, F.lit(mark))
    return F.regexp_replace(F.when(marked, F.regexp_replace(lower, COPYRIGHT_LINE, "$1")).otherwise(lower), OTHER_WITHIN_LINES, " ")


def whole(lines: Column) -> Column:
    """The canonical form of a text from its plain lines."""
    plain = F.trim(F.regexp_replace(lines, "[ \n]+", " "))
    return F.when(lines.rlike(ANY_SPELLING), spelt(plain)).otherwise(plain)


def canonical(text: Column) -> Column:
    return whole(plain_lines(text))


def digest(canonical_text: Column) -> Column:
    return F.sha2(canonical_text.cast("binary"), 256)


def known(spark: SparkSession, texts: list[tuple[str, str]], digests: list[tuple[str, str]] = (), more: DataFrame | None = None) -> DataFrame:
    """digest and license_id of lists of texts and of digests, one row for each digest; ``more``: license_id, text."""
    rows = F.array(*(F.struct(F.lit(name).alias("license_id"), F.lit(text).alias("text")) for name, text in texts))
    listed = spark.range(1).select(F.explode(rows).alias("x")).select("x.license_id", "x.text")
    if more is not None:
        listed = listed.unionByName(more.select("license_id", "text").where("text IS NOT NULL"))
    listed = listed.select(digest(canonical(F.col("text"))).alias("digest"), "license_id")
    if digests:
        rows = F.array(*(F.struct(F.lit(x).alias("digest"), F.lit(name).alias("license_id")) for name, x in digests))
        listed = listed.unionByName(spark.range(1).select(F.explode(rows).alias("x")).select("x.digest", "x.license_id"))
    return listed.groupBy("digest").agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, more: DataFrame | None = None) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): text_digest, license_id, n_notices and notice_ids.

    ``license_id``: the licence that the entire text is, or null. ``n_notices``: lines that are a
    known notice, ``notice_ids`` their licences, sorted, comma-joined, null if none. Null texts are
    empty, and no licence; rows alike come out alike, each for itself; texts of any length are read
    once and whole; other columns are left out; an empty table gives an empty one. ``more`` are
    further licences (license_id, text); Spark sends the table of digests to the executors if it is
    small. The documents aren't dealt out.
    """
    spark = docs.sparkSession
    # Few and fixed: their canonical texts are the keys of a constant.
    notices = {r[0]: r[1] for r in spark.range(1).select(F.explode(F.array(*(F.struct(canonical(F.lit(t)).alias("t"), F.lit(n).alias("n")) for n, t in reversed(NOTICES)))).alias("x")).select("x.*").collect()}
    lookup = F.create_map(*(F.lit(x) for pair in notices.items() for x in pair))
    lines = plain_lines(F.coalesce("text", F.lit("")))
    rows = docs.select("doc_id", lines.alias("lines")).select("doc_id", digest(whole(F.col("lines"))).alias("text_digest"), notice_lines(list(notices)).alias("hits"))
    ids = F.array_sort(F.array_distinct(F.transform("hits", lambda x: F.element_at(lookup, x))))
    found = rows.join(known(spark, LICENSES, DIGESTS, more), F.col("text_digest") == F.col("digest"), "left")
    return found.select(
        "doc_id", "text_digest", "license_id", F.size("hits").cast("long").alias("n_notices"), F.when(F.size("hits") > 0, F.array_join(ids, ",")).alias("notice_ids")
    )


def notice_lines(notices: list[str]) -> Column:
    """The canonical lines of ``lines`` that are one of ``notices``."""
    lines = F.split("lines", "\n")
    rewritten = F.when(F.col("lines").rlike(ANY_SPELLING), F.transform(lines, lambda x: spelt(F.trim(x)))).otherwise(F.transform(lines, lambda x: F.trim(x)))
    return F.filter(rewritten, lambda x: x.isin(notices))


def op5_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql_canonical(text: str) -> str:
    copyright_line = COPYRIGHT_LINE.replace("'", "''")
    plain = f"trim(regexp_replace(regexp_replace(lower({text}), '{copyright_line}', '\\1', 'g'), '{OTHER}', ' ', 'g'))"
    spelt = f"' ' || replace({plain}, ' ', '  ') || ' '"
    for old, new in SPELLINGS:
        spelt = f"replace({spelt}, ' {old.replace(' ', '  ')} ', ' {new.replace(' ', '  ')} ')"
    return f"replace(trim({spelt}), '  ', ' ')"


def oracle() -> str:
    def listed(texts: list[tuple[str, str]], digests: list[tuple[str, str]] = ()) -> str:
        values = ", ".join(f"({_sql_text(name)}, sha256({_sql_canonical(_sql_text(text))}))" for name, text in texts)
        values += "".join(f", ({_sql_text(name)}, {_sql_text(x)})" for name, x in digests)
        return f"SELECT digest, min(n) AS license_id FROM (VALUES {values}) v(n, digest) GROUP BY 1"

    return f"""
    WITH licenses AS ({listed(LICENSES, DIGESTS)}), notices AS ({listed(NOTICES)}),
    docs AS (SELECT row_number() OVER () AS k, doc_id, text, sha256({_sql_canonical("coalesce(text, '')")}) AS text_digest FROM documents),
    lines AS (SELECT k, unnest(string_split(text, chr(10))) AS line FROM docs WHERE text IS NOT NULL),
    hits AS (SELECT k, license_id FROM (SELECT k, sha256({_sql_canonical('line')}) AS digest FROM lines WHERE trim(line) <> '') JOIN notices USING (digest)),
    by_doc AS (SELECT k, count(*) AS n_notices, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notice_ids FROM hits GROUP BY k)
    SELECT d.doc_id, text_digest, license_id, coalesce(n_notices, 0) AS n_notices, notice_ids
    FROM docs d LEFT JOIN licenses l ON d.text_digest = l.digest LEFT JOIN by_doc b ON d.k = b.k
    """
