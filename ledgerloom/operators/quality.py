"""Checks of tables. Each is one row: check, passed, severity, value; a suite is their union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerloom.schemas import TableSpec


def verdict(name: str, value: Column, fine: Column, severity: str = "error") -> list[Column]:
    state = F.when(fine, "ok").otherwise(severity)
    return [F.lit(name).alias("check"), fine.alias("passed"), state.alias("severity"), value.cast("long").alias("value")]


def _count(df: DataFrame, name: str, bad: Column, most: int = 0, severity: str = "error") -> DataFrame:
    n = F.count_if(bad)
    return df.agg(*verdict(name, n, n <= most, severity))


Check = tuple[str, Column, Column, str]


def fault(name: str, bad: Column, most: int = 0, severity: str | None = None) -> Check:
    """A check of ``scalars``: rows with a fault; any is an error if none is expected, more than ``most`` a warning otherwise."""
    return name, F.count_if(F.coalesce(bad, F.lit(False))), F.col("value") <= most, severity or ("error" if most == 0 else "warning")


def scalars(df: DataFrame, *checks: Check) -> DataFrame:
    """Checks of one table in one pass: (name, an aggregate, a test of ``value``, severity)."""
    row = df.agg(*(value.cast("long").alias(f"_{i}") for i, (_, value, _, _) in enumerate(checks)))
    parts = F.array(*(F.struct(F.lit(name).alias("check"), F.col(f"_{i}").alias("value")) for i, (name, _, _, _) in enumerate(checks)))
    listed = row.select(F.posexplode(parts).alias("_at", "_x")).select("_at", "_x.check", "_x.value")
    passed, state = F.lit(False), F.lit("")
    for i, (_, _, fine, severity) in enumerate(checks):
        passed = F.when(F.col("_at") == i, fine).otherwise(passed)
        state = F.when(F.col("_at") == i, F.lit(severity)).otherwise(state)
    return listed.select("check", passed.alias("passed"), F.when(passed, "ok").otherwise(state).alias("severity"), "value")


def presence(spark: SparkSession, found: dict[str, DataFrame | None], optional: tuple[str, ...] = ()) -> DataFrame:
    """Whether each table is there; a missing one is an error, or a warning if it is optional."""
    rows = F.array(*(F.struct(F.lit(name).alias("name"), F.lit(df is not None).alias("there"), F.lit(name in optional).alias("optional")) for name, df in found.items()))
    one = spark.range(1).select(F.explode(rows).alias("x")).select("x.*")
    state = F.when(F.col("there"), "ok").when(F.col("optional"), "warning").otherwise("error")
    return one.select(F.concat("name", F.lit(" exists")).alias("check"), F.col("there").alias("passed"), state.alias("severity"), F.col("there").cast("long").alias("value"))


def in_catalog(spark: SparkSession, names: list[str]) -> dict[str, DataFrame | None]:
    """The tables of the catalogue by name, None for those that aren't there: what ``presence`` takes."""
    return {name: spark.table(name) if spark.catalog.tableExists(name) else None for name in names}


def table_exists(spark: SparkSession, name: str) -> DataFrame:
    there = spark.catalog.tableExists(name)
    return spark.range(1).select(*verdict(f"{name} exists", F.lit(int(there)), F.lit(there)))


def columns_match(df: DataFrame, name: str, wanted: list[str]) -> DataFrame:
    """Compared without regard to case; value: columns missing or over."""
    apart = {c.lower() for c in df.columns} ^ {c.lower() for c in wanted}
    return df.sparkSession.range(1).select(*verdict(f"{name} columns", F.lit(len(apart)), F.lit(not apart)))


def has_columns(df: DataFrame, name: str, wanted: list[str]) -> DataFrame:
    missing = {c.lower() for c in wanted} - {c.lower() for c in df.columns}
    return df.sparkSession.range(1).select(*verdict(f"{name} columns", F.lit(len(missing)), F.lit(not missing)))


def unique_key(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """Keys that come twice; a null in a key counts as a fault of its own by ``no_nulls``."""
    groups = df.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1")
    n = F.count("*")
    return groups.agg(*verdict(f"{name} duplicates on {','.join(keys)}", n, n == 0))


def primary_key(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """Key groups that come twice or have a null part."""
    null = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))
    groups = df.groupBy(*keys).agg(F.count("*").alias("_n")).where((F.col("_n") > 1) | null)
    n = F.count("*")
    return groups.agg(*verdict(f"{name} key {','.join(keys)}", n, n == 0))


def key_checks(df: DataFrame, name: str, keys: list[str], primary: bool = True) -> DataFrame:
    """``unique_key`` and, if ``primary``, ``primary_key``, nulls of each key part and whether there is a row, of one grouping."""
    null = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))
    groups = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    twice, label, none = F.col("_n") > 1, ",".join(keys), F.col("value") == 0
    checks: list[Check] = [(f"{name} duplicates on {label}", F.count_if(twice), none, "error")]
    if primary:
        checks.append((f"{name} key {label}", F.count_if(twice | null), none, "error"))
        checks += [(f"{name}.{k} null", F.coalesce(F.sum(F.when(F.col(k).isNull(), F.col("_n"))), F.lit(0)), none, "error") for k in keys]
        checks.append((f"{name} rows", F.coalesce(F.sum("_n"), F.lit(0)), F.col("value") >= 1, "error"))
    return scalars(groups, *checks)


def no_nulls(df: DataFrame, name: str, column: str, most: int = 0, severity: str = "error") -> DataFrame:
    return _count(df, f"{name}.{column} null", F.col(column).isNull(), most, severity)


def foreign_key(df: DataFrame, name: str, columns: list[str], parents: DataFrame, parent_columns: list[str], allow_null: bool = False) -> DataFrame:
    """Rows without a parent; a null key is one unless ``allow_null``."""
    keys = parents.select(*(F.col(p).alias(c) for p, c in zip(parent_columns, columns, strict=True))).distinct()
    lone = orphans(df, columns, keys, allow_null)
    n = F.count("*")
    return lone.agg(*verdict(f"{name}.{','.join(columns)} without parent", n, n == 0))


def foreign_keys(df: DataFrame, name: str, references: list[tuple[list[str], DataFrame, list[str]]], *more: Check, using: tuple[str, ...] = ()) -> DataFrame:
    """``foreign_key`` for several references (columns, parents, their columns) of one table, and ``more``
    checks, which read the columns ``using``: the table is read once."""
    rows = df.select(*dict.fromkeys([*(c for columns, _, _ in references for c in columns), *using]))
    for i, (columns, parents, parent_columns) in enumerate(references):
        keys = parents.select(*(F.col(p).alias(c) for p, c in zip(parent_columns, columns, strict=True))).distinct().withColumn(f"_hit{i}", F.lit(1))
        rows = rows.join(keys, columns, "left")
    return scalars(rows, *(fault(f"{name}.{','.join(columns)} without parent", F.col(f"_hit{i}").isNull()) for i, (columns, _, _) in enumerate(references)), *more)


def one_reference(tables: dict[str, DataFrame], column: str, parents: DataFrame) -> DataFrame:
    """``foreign_key`` of several tables on one column of the same parents, which are read once; tables are counted by key before they meet them."""
    parts = (df.groupBy(column).agg(F.count("*").alias("_n")).select(F.lit(name).alias("_table"), column, "_n") for name, df in tables.items())
    keys = parents.select(column).distinct().withColumn("_hit", F.lit(1))
    rows = reduce(DataFrame.unionByName, parts).join(keys, column, "left")
    lone = lambda name: F.coalesce(F.sum(F.when(F.col("_hit").isNull() & (F.col("_table") == name), F.col("_n"))), F.lit(0))
    return scalars(rows, *((f"{name}.{column} without parent", lone(name), F.col("value") == 0, "error") for name in tables))


def orphan_samples(df: DataFrame, columns: list[str], parents: DataFrame, parent_columns: list[str], n: int = 5, allow_null: bool = False) -> DataFrame:
    """Up to ``n`` different keys without a parent, in order."""
    keys = parents.select(*(F.col(p).alias(c) for p, c in zip(parent_columns, columns, strict=True))).distinct()
    return orphans(df, columns, keys, allow_null).select(*columns).distinct().orderBy(*columns).limit(n)


def orphans(df: DataFrame, columns: list[str], keys: DataFrame, allow_null: bool = False) -> DataFrame:
    if allow_null:
        df = df.dropna(subset=columns)
    return df.join(keys, columns, "left_anti")


def in_range(df: DataFrame, name: str, column: str, low: float | None = None, high: float | None = None) -> DataFrame:
    bad = F.lit(False)
    if low is not None:
        bad = bad | (F.col(column) < low)
    if high is not None:
        bad = bad | (F.col(column) > high)
    return _count(df, f"{name}.{column} out of range", F.coalesce(bad, F.lit(False)))


def row_count(df: DataFrame, name: str, least: int = 0, most: int | None = None) -> DataFrame:
    n = F.count("*")
    fine = n >= least if most is None else n.between(least, most)
    return df.agg(*verdict(f"{name} rows", n, fine))


def dates_in_order(df: DataFrame, name: str, start: str, end: str) -> DataFrame:
    return _count(df, f"{name}.{end} before {start}", F.coalesce(F.col(end) < F.col(start), F.lit(False)))


def at_most(df: DataFrame, name: str, bad: Column, most: int = 0, severity: str | None = None) -> DataFrame:
    """Rows with a fault: any is an error if none is expected, more than ``most`` a warning otherwise."""
    return _count(df, name, F.coalesce(bad, F.lit(False)), most, severity or ("error" if most == 0 else "warning"))


def suite(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def described(checks: DataFrame) -> DataFrame:
    """Checks with a ``message`` each: what was looked for, what was found, and what that means."""
    state = F.when(F.col("passed"), "passed").when(F.col("severity") == "warning", "above its threshold").otherwise("failed")
    return checks.withColumn("message", F.concat(F.initcap(state), F.lit(": "), "check", F.lit(", "), F.col("value").cast("string"), F.lit(" found")))


def overall(checks: DataFrame) -> DataFrame:
    errors, warnings = F.count_if(F.col("severity") == "error"), F.count_if(F.col("severity") == "warning")
    state = F.when(errors > 0, "failed").when(warnings > 0, "passed with warnings").otherwise("passed")
    return checks.agg(
        F.count("*").alias("checks"), F.count_if("passed").alias("passed"), errors.alias("errors"), warnings.alias("warnings"), state.alias("verdict"),
        F.round(F.count_if("passed") * 100 / F.count("*"), 2).alias("pass_rate"),
    )


def spec_checks(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Columns, key and required columns of a stored table."""
    parts = [columns_match(df, spec.name, spec.columns), primary_key(df, spec.name, list(spec.keys))]
    return suite(*parts, *(no_nulls(df, spec.name, c) for c in spec.required))


# Monetary units whose facts must have a number, and tags looked at for outliers.
MONETARY = ["USD", "EUR", "JPY", "GBP", "CAD", "CHF", "AUD", "CNY", "INR"]
OUTLIER_TAGS, OUTLIER = ["Assets", "Revenues", "NetIncomeLoss"], 1e14


def core_suite(
    companies: DataFrame, tickers: DataFrame, former_names: DataFrame, filings: DataFrame, facts: DataFrame, tags: DataFrame | None = None
) -> DataFrame:
    """The 24 checks that a build of the core tables must pass.

    A table is read once for its keys, which give its rows and nulls of the key, too, and once for its
    references; two small tables meet the companies together.
    """
    cik, acc = ["cik"], ["accession_number"]
    tables = {"companies": companies, "tickers": tickers, "former_names": former_names, "filings": filings, "xbrl_tags": tags, "xbrl_facts": facts}
    return suite(
        presence(companies.sparkSession, tables),
        has_columns(companies, "companies", ["cik", "primary_name", "entity_type", "sic", "sic_description"]),
        has_columns(filings, "filings", ["accession_number", "cik", "filing_date", "form"]),
        key_checks(companies, "companies", cik), key_checks(filings, "filings", acc), key_checks(tickers, "tickers", ["ticker", "exchange"], primary=False),
        foreign_keys(filings, "filings", [(cik, companies, cik)], *(fault(f"filings.{c} null", F.col(c).isNull()) for c in ("cik", "form")), using=("form",)),
        one_reference({"tickers": tickers, "former_names": former_names}, "cik", companies),
        foreign_keys(facts, "xbrl_facts", [(cik, companies, cik), (acc, filings, acc)]),
    )


def facts_suite(facts: DataFrame) -> DataFrame:
    null_key = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in ("cik", "accession_number", "taxonomy", "tag_name", "form")))
    return scalars(
        facts,
        fault("xbrl_facts null keys", null_key),
        fault("xbrl_facts monetary without number", F.col("unit").isin(MONETARY) & F.col("value_numeric").isNull()),
        fault("xbrl_facts.filed_date null", F.col("filed_date").isNull()),
        fault("xbrl_facts without unit", F.col("unit").isNull() | (F.col("unit") == ""), 1000),
        *(fault(f"xbrl_facts outliers of {t}", (F.col("tag_name") == t) & (F.abs("value_numeric") > OUTLIER), severity="warning") for t in OUTLIER_TAGS),
    )


def orphan_suite(orphaned: DataFrame, filings: DataFrame) -> DataFrame:
    """Orphans, and orphans of whose accession and company there is a filing by now; ``orphan_samples`` shows some."""
    keys = ["accession_number", "cik"]
    found = orphaned.select(*keys).join(filings.select(*keys).distinct().withColumn("_hit", F.lit(1)), keys, "left")
    return scalars(
        found, ("xbrl_facts_orphaned rows", F.count("*"), F.col("value") <= 1000, "warning"), fault("xbrl_facts_orphaned with a filing", F.col("_hit").isNotNull())
    )


def price_suite(prices: DataFrame, tickers: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Prices, and listed tickers of which there is no price of the last days, whether they ever had one or not."""
    day = F.lit(as_of).cast("date")
    recent = prices.where(F.col("date").between(F.date_sub(day, days), day)).select("ticker").distinct()
    no_price = F.col("open").isNull() & F.col("close").isNull() & F.col("adj_close").isNull()
    return suite(
        scalars(
            prices,
            fault("stock_history null key", F.col("ticker").isNull() | F.col("date").isNull()),
            fault("stock_history negative volume", F.col("volume") < 0),
            fault("stock_history volume without price", no_price & F.col("volume").isNotNull(), 1),
        ),
        scalars(tickers.join(recent, "ticker", "left_anti"), ("tickers without recent prices", F.count("*"), F.col("value") <= 100, "warning")),
    )


def supplementary_suite(profile: DataFrame, holders: DataFrame, actions: DataFrame, recommendations: DataFrame) -> DataFrame:
    """Keys and times of the feed's tables, CIK lengths, and shares between nothing and all; ``kinds`` lists the actions."""
    null = lambda *columns: reduce(lambda a, b: a | b, (F.col(c).isNull() for c in columns))
    outside = lambda *columns: reduce(lambda a, b: a | b, (F.coalesce((F.col(c) < 0) | (F.col(c) > 1), F.lit(False)) for c in columns))
    return suite(
        scalars(profile, fault("yf_profile_metrics null key or time", null("ticker", "fetch_timestamp")), fault("yf_profile_metrics cik length", F.length("cik") != 10)),
        scalars(
            holders, fault("yf_major_holders null key or time", null("ticker", "fetch_timestamp")),
            fault("yf_major_holders share out of range", outside("pct_insiders", "pct_institutions")),
        ),
        scalars(actions, fault("yf_stock_actions null key", null("ticker", "action_date", "action_type"))),
        scalars(recommendations, fault("yf_recommendations null key", null("ticker", "recommendation_timestamp", "firm"))),
    )


def ticker_suite(found: dict[str, DataFrame], *sources: DataFrame) -> DataFrame:
    """For each table of a feed: its rows with a ticker that none of the sources lists. Rows without a ticker don't count."""
    known = reduce(DataFrame.union, (s.select("ticker") for s in sources)).distinct()
    unknown = (df.select("ticker").join(known, "ticker", "left_anti").select(F.lit(name).alias("name"), "ticker") for name, df in found.items())
    rows = reduce(DataFrame.union, unknown)
    return scalars(rows, *(fault(f"{name} tickers not listed", (F.col("name") == name) & F.col("ticker").isNotNull()) for name in found))


def kinds(df: DataFrame, column: str) -> DataFrame:
    """The different values of a column that is to have few: action types, factor models, series; and their rows."""
    return df.groupBy(F.col(column).alias("kind")).agg(F.count("*").alias("n_rows"))


def macro_suite(macro: DataFrame, risk: DataFrame) -> DataFrame:
    return suite(
        scalars(
            macro, fault("macro_economic_data null key", F.col("series_id").isNull() | F.col("date").isNull()),
            fault("macro_economic_data.value null", F.col("value").isNull()),
            ("macro_economic_data series", F.count_distinct("series_id"), F.col("value") >= 1, "error"),
            ("macro_economic_data days", F.datediff(F.max("date"), F.min("date")), F.col("value") >= 0, "error"),
        ),
        scalars(
            risk, fault("market_risk_factors null key", F.col("date").isNull() | F.col("factor_model").isNull()),
            fault("market_risk_factors.mkt_minus_rf null", F.col("mkt_minus_rf").isNull()),
            ("market_risk_factors models", F.count_distinct("factor_model"), F.col("value") >= 1, "error"),
        ),
    )


def error_tables(found: dict[str, DataFrame]) -> DataFrame:
    """Tables of errors that aren't empty are warned of."""
    return suite(*(scalars(df, (f"{name} rows", F.count("*"), F.col("value") == 0, "warning")) for name, df in found.items()))


def counts_of(spark: SparkSession, found: dict[str, DataFrame | None], optional: tuple[str, ...] = ()) -> DataFrame:
    """Whether each table is there, and the rows of those that are."""
    return suite(presence(spark, found, optional), *(scalars(df, (f"{name} rows", F.count("*"), F.col("value") >= 1, "warning" if name in optional else "error")) for name,
        df in found.items() if df is not None))


#: Groupings of the profile of orphans.
PROFILED = (("taxonomy",), ("cik",), ("form",), ("taxonomy", "tag_name"))


def orphan_profile(orphaned: DataFrame, n: int = 10, groupings: tuple[tuple[str, ...], ...] = PROFILED) -> DataFrame:
    """The most frequent taxonomies, companies, forms, and tags of a taxonomy among orphans, ties by their values.

    One pass counts all groupings. Of each grouping, a column ``by``, Spark keeps the first ``n`` rows
    of every task before it brings them together.
    """
    columns = list(dict.fromkeys(c for g in groupings for c in g))
    sets = [[F.col(c) for c in g] for g in groupings]
    counted = orphaned.groupingSets(sets, *(F.col(c) for c in columns)).agg(F.grouping_id().alias("_id"), F.count("*").alias("n_rows"))
    by = F.lit(None).cast("string")
    for g in groupings:
        mark = sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in g)
        by = F.when(F.col("_id") == mark, ",".join(g)).otherwise(by)
    order = W.partitionBy("by").orderBy(F.desc("n_rows"), *(F.asc_nulls_last(c) for c in columns))
    named = counted.select(by.alias("by"), *columns, "n_rows").withColumn("_place", F.row_number().over(order))
    return named.where(F.col("_place") <= n).drop("_place")


def first_orphan(orphaned: DataFrame) -> DataFrame:
    """One example: the orphan first by filing date, then by all its columns."""
    order = ["filed_date", *(c for c in orphaned.columns if c != "filed_date")]
    return orphaned.orderBy(*(F.asc_nulls_last(c) for c in order)).limit(1)


def without_facts(companies: DataFrame, filings: DataFrame, facts: DataFrame, forms: list[str]) -> DataFrame:
    """What a join report recommends to fetch: companies with filings of the given forms and no facts, with their filings."""
    n = filings.where(F.col("form").isin(forms)).groupBy("cik").agg(F.count("*").alias("filings"))
    return companies.select("cik").join(n, "cik").join(facts.select("cik").distinct(), "cik", "left_anti")


def unknown_tickers(df: DataFrame, *sources: DataFrame) -> DataFrame:
    """Tickers of ``df`` that none of the sources has."""
    known = reduce(DataFrame.union, (s.select("ticker") for s in sources)).distinct()
    return df.select("ticker").distinct().join(known, "ticker", "left_anti")


def coverage_of_join(left: DataFrame, right: DataFrame, keys: list[str], name: str) -> DataFrame:
    """How many keys of the left have a row on the right: one row of counts and the share."""
    matched = left.select(*keys).distinct().join(right.select(*keys).distinct().withColumn("_hit", F.lit(1)), keys, "left")
    return matched.agg(F.lit(name).alias("join"), F.count("*").alias("keys"), F.count("_hit").alias("matched")).withColumn(
        "share", F.round(F.try_divide(F.col("matched").cast("double"), F.col("keys")), 6)
    )


def top_groups(df: DataFrame, columns: list[str], n: int = 10) -> DataFrame:
    """The ``n`` largest groups; ties by the columns."""
    return df.groupBy(*columns).agg(F.count("*").alias("n_rows")).orderBy(F.desc("n_rows"), *columns).limit(n)


def duplicate_groups(df: DataFrame, keys: list[str], n: int = 10) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1").orderBy(F.desc("n_rows"), *keys).limit(n)


def late_periods(facts: DataFrame, n: int = 10) -> DataFrame:
    """Facts whose period ends more than a day after they were filed, the first filed first."""
    return facts.where(F.col("period_end_date") > F.date_add("filed_date", 1)).orderBy("filed_date", "accession_number", "period_end_date").limit(n)


def ticker_companies(tickers: DataFrame, companies: DataFrame) -> DataFrame:
    """One row: distinct tickers, their distinct companies, those of them that are known, and the share of these."""
    known = companies.select("cik").distinct().withColumn("_hit", F.lit(1))
    counts = tickers.select("ticker", "cik").join(known, "cik", "left").agg(
        F.count_distinct("ticker").alias("tickers"), F.count_distinct(F.when(F.col("_hit") == 1, F.col("cik"))).alias("companies_matched"), F.count_distinct("cik").alias("ciks"),
    )
    return counts.withColumn("share", F.round(F.try_divide(F.col("companies_matched").cast("double"), F.col("ciks")), 6))


def ticker_filings(tickers: DataFrame, filings: DataFrame) -> DataFrame:
    """Filings of each ticker's company; none count 0. Filings are counted by company before tickers join them."""
    n = filings.groupBy("cik").agg(F.count("accession_number").alias("n_filings"))
    each = tickers.groupBy("ticker", "cik").agg(F.count("*").alias("_n")).join(n, "cik", "left")
    return each.select("ticker", "cik", (F.coalesce("n_filings", F.lit(0)) * F.col("_n")).alias("n_filings"))


def ticker_facts(tickers: DataFrame, facts: DataFrame) -> DataFrame:
    """Distinct tags and facts of each ticker's company, and whether there are any."""
    n = facts.groupBy("cik").agg(F.count_distinct("tag_name").alias("n_tags"), F.count("*").alias("n_facts"))
    each = tickers.groupBy("ticker", "cik").agg(F.count("*").alias("_n")).join(n, "cik", "left")
    tags, found = F.coalesce("n_tags", F.lit(0)), F.coalesce("n_facts", F.lit(0))
    return each.select("ticker", "cik", tags.alias("n_tags"), (found * F.col("_n")).alias("n_facts"), (tags > 0).alias("has_facts"))


def filing_facts(filings: DataFrame, facts: DataFrame, tickers: DataFrame) -> DataFrame:
    """For each company with filings: how many, how many of them have facts (by accession and company), the share, distinct tags, and its first ticker."""
    keys = ["cik", "accession_number"]
    tags = facts.groupBy(*keys, "tag_name").agg(F.lit(1).alias("_hit"))
    counts = filings.select(*keys).join(tags, keys, "left").groupBy("cik").agg(
        F.count_distinct("accession_number").alias("filings"), F.count_distinct(F.when(F.col("_hit") == 1, F.col("accession_number"))).alias("with_facts"),
        F.count_distinct("tag_name").alias("n_tags"),
    )
    first = tickers.groupBy("cik").agg(F.min("ticker").alias("ticker"))
    share = F.round(F.try_divide(F.col("with_facts").cast("double"), F.col("filings")), 6)
    return counts.withColumn("share", share).join(first, "cik", "left")
