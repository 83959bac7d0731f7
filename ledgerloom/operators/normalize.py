"""Nested company documents to flat rows, with one distributed parse and no Python.

Values whose type tells what they mean (truth, numbers or text) are parsed as VARIANT.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import variants
from ledgerloom.functions.scalars import digits, filled, iso_date, pad_cik, utc_timestamp
from ledgerloom.schemas import TABLES

from .tables import keep_one

# The documents' shapes, and (JSON name, column) pairs.
_PLACE = "struct<street1:variant,street2:variant,city:variant,stateOrCountry:variant,zipCode:variant>"
FILING_FIELDS = [("accessionNumber", "accession_number"), ("filingDate", "filing_date"), ("reportDate", "report_date"), ("acceptanceDateTime", "acceptance_datetime"), ("act",
    "act"), ("form", "form"), ("fileNumber", "file_number"), ("filmNumber", "film_number"), ("items", "items"), ("size", "size"), ("isXBRL", "is_xbrl"), ("isInlineXBRL",
    "is_inline_xbrl"), ("primaryDocument", "primary_document"), ("primaryDocDescription", "primary_doc_description")]
COMPANY_FIELDS = [("name", "primary_name"), ("entityType", "entity_type"), ("sic", "sic"), ("sicDescription", "sic_description"), ("ein", "ein"), ("description", "description"),
    ("category", "category"), ("stateOfIncorporation", "state_of_incorporation"), ("phone", "phone"), ("flags", "flags")]
PLACE_FIELDS = [("street1", "street1"), ("street2", "street2"), ("city", "city"), ("stateOrCountry", "state_or_country"), ("zipCode", "zip_code")]

SUBMISSION = (
    "cik string, fiscalYearEnd string, " + ", ".join(f"{name} variant" for name, _ in COMPANY_FIELDS)
    + f", addresses struct<mailing:{_PLACE},business:{_PLACE}>, tickers array<string>, exchanges array<string>, "
    "formerNames array<struct<name:string,`from`:string,`to`:string>>, filings struct<recent:map<string,string>>"
)
COMPANY_FACTS = (
    "cik string, entityName string, facts map<string,map<string,struct<label:string,description:string,units:map<string,array<struct<"
    "val:variant,accn:string,`end`:string,fy:variant,fp:string,form:string,filed:string,frame:string>>>>>>"
)


def submissions(texts: DataFrame, column: str = "value") -> DataFrame:
    """Documents parsed; those that are no JSON object or have no cik go. ``cik`` is padded."""
    parsed = texts.select(F.from_json(F.col(column), SUBMISSION).alias("d")).select("d.*").where("cik IS NOT NULL")
    return parsed.withColumn("cik", pad_cik("cik"))


def company_facts(texts: DataFrame, column: str = "value") -> DataFrame:
    """As ``submissions``; documents without facts go too."""
    parsed = texts.where(F.length(column) > 0).select(F.from_json(F.col(column), COMPANY_FACTS).alias("d")).select("d.*")
    return parsed.where("cik IS NOT NULL AND facts IS NOT NULL").withColumn("cik", pad_cik("cik"))


def companies(docs: DataFrame, parsed_at: Column, facts_docs: DataFrame | None = None) -> DataFrame:
    """A row for each document; the entity name comes from the company's facts document, if there is one."""
    place = [variants.text(f"addresses.{kind}.{name}").alias(f"{kind}_{to}") for kind in ("mailing", "business") for name, to in PLACE_FIELDS]
    rows = docs.select(
        "cik", *(variants.filled(name).alias(to) for name, to in COMPANY_FIELDS), F.coalesce("fiscalYearEnd", F.lit("")).alias("fiscal_year_end"), *place,
        F.lit(None).cast("timestamp").alias("first_added_timestamp"), parsed_at.cast("timestamp").alias("last_parsed_timestamp"),
    )
    if facts_docs is not None:
        names = facts_docs.groupBy("cik").agg(F.min(filled("entityName")).alias("entity_name_cf"))
        rows = rows.join(names, "cik", "left")
    else:
        rows = rows.withColumn("entity_name_cf", F.lit(None).cast("string"))
    return rows.select(*TABLES["companies"].columns)


def tickers(docs: DataFrame) -> DataFrame:
    """Pairs of the two parallel arrays, to the length of the shorter; pairs with an empty part go."""
    pairs = docs.select("cik", F.explode(F.arrays_zip("tickers", "exchanges")).alias("p"))
    return pairs.select("cik", F.col("p.tickers").alias("ticker"), F.col("p.exchanges").alias("exchange"), F.lit("submissions.json").alias("source")).where(
        "ticker <> '' AND exchange <> ''"
    )


def former_names(docs: DataFrame) -> DataFrame:
    names = docs.select("cik", F.explode("formerNames").alias("n")).where("n.name <> ''")
    return names.select("cik", F.col("n.name").alias("former_name"), utc_timestamp("n.from").alias("date_from"), utc_timestamp("n.to").alias("date_to"))


def filings(docs: DataFrame, processed: DataFrame | None = None) -> DataFrame:
    """A row for each place of the parallel arrays of ``filings.recent``.

    If a member is no array, or lengths differ, the document gives no filings. Rows without
    accession number, form or a valid filing date go, and so do those in ``processed``.
    """
    recent = docs.select("cik", F.col("filings.recent").alias("r")).where("r IS NOT NULL AND size(r) > 0")
    arrays = F.transform_values("r", lambda _, v: F.from_json(v, "array<string>"))
    kept = [F.from_json(F.try_element_at("r", F.lit(name)), "array<variant>").alias(name) for name in ("isXBRL", "isInlineXBRL")]
    sound = recent.where(F.forall(F.map_values("r"), lambda v: v.like("[%"))).select("cik", arrays.alias("a"), F.struct(*kept).alias("t"))
    lengths = F.transform(F.map_values("a"), lambda x: F.size(x))
    even = sound.where(F.size(F.array_distinct(lengths)) == 1).select("cik", "a", "t", F.posexplode(F.element_at(F.map_values("a"), 1)).alias("i", "_"))
    raw = {to: F.get(F.try_element_at("a", F.lit(name)), F.col("i")) for name, to in FILING_FIELDS}
    typed = {name: F.get(F.col(f"t.{name}"), F.col("i")) for name in ("isXBRL", "isInlineXBRL")}
    made = raw | {
        "filing_date": iso_date(raw["filing_date"]), "report_date": iso_date(raw["report_date"]), "acceptance_datetime": utc_timestamp(raw["acceptance_datetime"]),
        "size": digits(raw["size"]), "is_xbrl": variants.truthy(typed["isXBRL"]), "is_inline_xbrl": variants.truthy(typed["isInlineXBRL"]),
    }
    out = even.select("cik", *(c.alias(name) for name, c in made.items())).dropna(subset=["accession_number", "form", "filing_date", "cik"])
    if processed is not None:
        out = out.join(processed.select("accession_number"), "accession_number", "left_anti")
    return out.select(*TABLES["filings"].columns)


def tags(docs: DataFrame) -> DataFrame:
    """A row for each taxonomy and tag over all documents; where they differ, one by a fixed order."""
    found = docs.select(F.explode("facts").alias("taxonomy", "t")).select("taxonomy", F.explode("t").alias("tag_name", "d"))
    rows = found.select("taxonomy", "tag_name", filled("d.label").alias("label"), filled("d.description").alias("description"))
    return keep_one(rows.where("taxonomy IS NOT NULL AND tag_name IS NOT NULL"), ["taxonomy", "tag_name"])


def facts(docs: DataFrame) -> DataFrame:
    """A row for each fact; those without accession number or form go."""
    by_tag = docs.select("cik", F.explode("facts").alias("taxonomy", "t")).select("cik", "taxonomy", F.explode("t").alias("tag_name", "d"))
    by_unit = by_tag.select("cik", "taxonomy", "tag_name", F.explode("d.units").alias("unit", "list"))
    one = by_unit.select("cik", "taxonomy", "tag_name", "unit", F.explode("list").alias("f")).where("f.accn <> '' AND f.form <> ''")
    named = one.select("*", F.schema_of_variant("f.val").alias("_val"), F.schema_of_variant("f.fy").alias("_fy"))
    kinds = named.withColumns({"_val": variants.kind("f.val", F.col("_val")), "_fy": variants.kind("f.fy", F.col("_fy"))})
    numbers = kinds.withColumn("_number", variants.number("f.val", F.col("_val")))
    return numbers.select(
        "cik", F.col("f.accn").alias("accession_number"), "taxonomy", "tag_name", "unit", iso_date("f.end").alias("period_end_date"),
        F.col("_number").alias("value_numeric"), F.when(F.col("_number").isNull(), variants.text("f.val", F.col("_val"))).alias("value_text"),
        variants.whole("f.fy", what=F.col("_fy")).alias("fy"), F.col("f.fp").alias("fp"),
        F.col("f.form").alias("form"), iso_date("f.filed").alias("filed_date"), F.coalesce("f.frame", F.lit("")).alias("frame"),
    ).select(*TABLES["xbrl_facts"].columns)


def parse_summary(submission_docs: DataFrame, facts_docs: DataFrame) -> DataFrame:
    """What each company's documents hold, whichever of the two there is."""
    size = lambda c: F.greatest(F.size(c), F.lit(0))
    left = submission_docs.select("cik", size("tickers").alias("n_tickers"), size("formerNames").alias("n_former_names"))
    left = left.join(filings(submission_docs).groupBy("cik").agg(F.count("*").alias("n_filings")), "cik", "left")
    right = facts(facts_docs).groupBy("cik").agg(F.count("*").alias("n_facts"), F.count_distinct("taxonomy", "tag_name").alias("n_tags"))
    return left.join(right, "cik", "full").fillna(0)


def work_list(universe: DataFrame, processed: DataFrame, limit: int | None = None, only: str | None = None) -> DataFrame:
    """CIKs to parse: all, one, or those not yet processed, in order."""
    todo = universe.select("cik").distinct()
    todo = todo.where(F.col("cik") == only) if only else todo.join(processed.select("cik"), "cik", "left_anti")
    todo = todo.orderBy("cik")
    return todo.limit(limit) if limit else todo
