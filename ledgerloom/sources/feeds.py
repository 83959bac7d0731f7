"""Landed feed documents and frames, conformed to the stored tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import epoch_ms_date, pad_cik, percent, utc_timestamp
from ledgerloom.operators.tables import keep_one
from ledgerloom.schemas import TABLES

BARS = "array<struct<v:double,vw:double,o:double,c:double,h:double,l:double,t:bigint,n:bigint>>"


def whole_files(spark: SparkSession, path: str) -> DataFrame:
    """Each file of a folder as one row: value, file."""
    return spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_name").alias("file"))


def universe(texts: DataFrame, column: str = "value") -> DataFrame:
    """Distinct padded CIKs of a ticker file, in order."""
    entries = texts.select(F.explode(F.map_values(F.from_json(F.col(column), "map<string,struct<cik_str:string>>"))).alias("e"))
    return entries.where("e.cik_str IS NOT NULL").select(pad_cik("e.cik_str").alias("cik")).distinct().orderBy("cik")


def zip_members(spark: SparkSession, path: str, suffix: str = ".json", tasks: int | None = None) -> DataFrame:
    """Members of zip archives as rows: archive, member, text.

    Archives are listed first, each by its directory alone, and then their members are dealt out: a
    task opens an archive where it lies, at any place that pyarrow's file systems reach, and reads
    one member after the other. No archive is ever whole in memory, and a large one keeps many tasks busy.
    """
    import zipfile

    import pandas as pd
    from pyarrow import fs

    def opened(archive: str):
        system, where = fs.FileSystem.from_uri(archive)
        return zipfile.ZipFile(system.open_input_file(where))

    def listed(frames):
        for pdf in frames:
            for archive in pdf["path"]:
                with opened(archive) as z:
                    names = [x for x in sorted(z.namelist()) if x.endswith(suffix)]
                yield pd.DataFrame({"archive": [archive] * len(names), "member": names})

    def read(frames):
        for pdf in frames:
            for archive, members in pdf.groupby("archive")["member"]:
                with opened(archive) as z:
                    for member in members:
                        yield pd.DataFrame({"archive": [archive], "member": [member], "text": [z.read(member).decode("utf-8", "replace")]})

    archives = spark.read.format("binaryFile").load(path).select(F.regexp_replace("path", "^file:/+", "file:///").alias("path"))
    members = archives.repartition("path").mapInPandas(listed, "archive string, member string")
    dealt = members.repartition(tasks, "archive", "member") if tasks else members.repartition("archive", "member")
    return dealt.mapInPandas(read, "archive string, member string, text string")


def bars(texts: DataFrame, column: str = "results", ticker: str = "ticker") -> DataFrame:
    """Price rows of JSON arrays of bars; weighted price and trade count are left out."""
    one = texts.select(ticker, F.explode(F.from_json(F.col(column), BARS)).alias("b"))
    return one.select(
        F.col(ticker).alias("ticker"), epoch_ms_date("b.t").alias("date"), F.col("b.o").alias("open"), F.col("b.h").alias("high"), F.col("b.l").alias("low"),
        F.col("b.c").alias("close"), F.col("b.c").alias("adj_close"), F.col("b.v").cast("bigint").alias("volume"),
    )


def daily_prices(frame: DataFrame, start: str, end: str) -> DataFrame:
    """A feed's frame with its own names, clipped to the range; rows without a valid date go, missing columns are null."""
    names = {"Date": "date", "Open": "open", "High": "high", "Low": "low", "Close": "close", "Adj Close": "adj_close", "Volume": "volume", "Ticker": "ticker"}
    renamed = frame.withColumnsRenamed({k: v for k, v in names.items() if k in frame.columns})
    spec = TABLES["stock_history"].schema
    made = [(F.col(f.name).try_cast(f.dataType) if f.name in renamed.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in spec]
    return renamed.select(*made).where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def price_errors(requested: DataFrame, frame: DataFrame, start: str, end: str) -> DataFrame:
    """(ticker, error) of each requested ticker that ends without a price, by the step that emptied it."""
    renamed = frame.withColumnsRenamed({"Date": "date", "Ticker": "ticker"})
    day = F.col("date").try_cast("date")
    within = day.between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    seen = renamed.groupBy("ticker").agg(F.count_if(day.isNotNull()).alias("dated"), F.count_if(within).alias("within"))
    error = F.when(F.col("dated").isNull(), "no data").when(F.col("dated") == 0, "no valid dates").when(F.col("within") == 0, "no data in range")
    return requested.select("ticker").distinct().join(seen, "ticker", "left").select("ticker", error.alias("error")).where("error IS NOT NULL")


def ticker_details(texts: DataFrame, fetched_at: str, column: str = "value") -> DataFrame:
    """The reference row of each details document: scalars, address, branding and two timestamps."""
    spec = TABLES["updated_ticker_info"].schema
    own = [f for f in spec if f.name not in ("fetch_timestamp", "last_updated_utc", "delisted_utc", "address_1", "city", "state", "postal_code", "logo_url", "icon_url")]
    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in own)
    shape += ", last_updated_utc string, delisted_utc string, address struct<address1:string,city:string,state:string,postal_code:string>, branding struct<logo_url:string,icon_url:string>"
    d = texts.select(F.from_json(F.col(column), shape).alias("d")).select("d.*").where("ticker IS NOT NULL")
    return d.select(
        *(f.name for f in own), F.lit(fetched_at).cast("timestamp").alias("fetch_timestamp"), utc_timestamp("last_updated_utc").alias("last_updated_utc"),
        utc_timestamp("delisted_utc").alias("delisted_utc"), F.col("address.address1").alias("address_1"), "address.city", "address.state", "address.postal_code",
        "branding.logo_url", "branding.icon_url",
    ).select(*spec.names)


def ticker_reference(texts: DataFrame, fetched_at: str, column: str = "value", source: str = "landed") -> DataFrame:
    spec = TABLES["massive_tickers"].schema
    own = [f for f in spec if f.name not in ("last_updated_utc", "delisted_utc", "source", "fetched_at")]
    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in own) + ", last_updated_utc string, delisted_utc string"
    d = texts.select(F.from_json(F.col(column), shape).alias("d")).select("d.*").where("ticker IS NOT NULL")
    stamps = [utc_timestamp(c).alias(c) for c in ("last_updated_utc", "delisted_utc")]
    return d.select(*(f.name for f in own), *stamps, F.lit(source).alias("source"), F.lit(fetched_at).cast("timestamp").alias("fetched_at"))


def macro(series: list[DataFrame], notes: DataFrame | None = None) -> DataFrame:
    """Series frames (series_id, date, value) put together; null values go, and so do series under copyright."""
    rows = reduce(lambda a, b: a.unionByName(b), series).dropna(subset=["date", "value"])
    if notes is not None:
        closed = notes.where(F.lower("notes").contains("copyright")).select("series_id")
        rows = rows.join(closed, "series_id", "left_anti")
    return rows.select("series_id", F.col("date").cast("date").alias("date"), F.col("value").cast("double").alias("value"))


def risk_factors(models: dict[str, DataFrame]) -> DataFrame:
    """Factor frames of several models: percentages to decimals, one row for each date and model."""
    spec = TABLES["market_risk_factors"].schema

    def conform(name: str, frame: DataFrame) -> DataFrame:
        lower = {c: c.lower().replace("-", "_minus_") for c in frame.columns}
        frame = frame.withColumnsRenamed(lower)
        values = [(percent(f.name) if f.name in frame.columns else F.lit(None).cast("double")).alias(f.name) for f in spec if f.name not in ("date", "factor_model")]
        return frame.select(F.col("date").cast("date").alias("date"), F.lit(name).alias("factor_model"), *values)

    rows = reduce(lambda a, b: a.unionByName(b), (conform(*x) for x in models.items()))
    return keep_one(rows.where("date IS NOT NULL"), ["date", "factor_model"])


def batches_normalized(spark: SparkSession, paths: list[str], name: str) -> DataFrame:
    """Batch files of a table by column name; 'nan' and 'None' are null, unreadable files are left out, types are the table's."""
    spec = TABLES[name].schema
    read = spark.read.option("ignoreCorruptFiles", "true").option("mergeSchema", "true").parquet(*paths)
    made = []
    for f in spec:
        if f.name not in read.columns:
            made.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c = F.col(f.name)
        text = c.cast("string")
        made.append(F.when(~text.isin("nan", "None", "NaT"), c.try_cast(f.dataType)).alias(f.name))
    return read.select(*made)
