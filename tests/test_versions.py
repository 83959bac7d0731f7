import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ledgerloom.schemas import TABLES, TableSpec
from ledgerloom.sources import batches, ledger, versions
from ledgerloom.streaming import ingest

SPEC = TableSpec("prices", "ticker string, day int, close double", ("ticker", "day"), nocase=("ticker",), upsert=True)


class Stopped(Exception):
    pass


def stopping(monkeypatch, at):
    """The ``at``-th change to a folder, counted from 0, stops its writer."""
    count = iter(range(10**6))

    def step(name):
        if next(count) == at:
            raise Stopped(name)

    for module in (versions, ingest):
        monkeypatch.setattr(module, "step", step)


def at_every_step(monkeypatch, write, read, old, new):
    """Stop ``write`` before each of its steps: readers see old or new, and then a whole run gives new."""
    at = 0
    while True:
        with monkeypatch.context() as m:
            stopping(m, at)
            try:
                write()
                done = True
            except Stopped:
                done = False
        seen = read()
        assert seen in (old, new) and (not done or seen == new), at
        if done:
            return at
        if seen == new:  # what was left of the work were removals
            old = new
        at += 1


def rows(*values):
    return lambda spark: spark.createDataFrame(list(values), "ticker string, day int, close double")


FIRST, SECOND = rows(("A", 1, 1.0), ("B", 1, 2.0), ("C", 3, 3.0)), rows(("B", 1, 9.0), ("D", 1, 4.0), (None, 1, 5.0))


def plain(df):
    return sorted(tuple(r) for r in df.collect())


def test_publication_has_no_gap(spark, tmp_path, monkeypatch):
    folder = f"file://{tmp_path}/build"
    read = lambda: [plain(versions.read(spark, folder, x, SPEC.schema)) for x in ("a", "b")]
    old, new = [[], []], [plain(FIRST(spark)), plain(FIRST(spark))]
    assert at_every_step(monkeypatch, lambda: batches.rebuild({"a": FIRST(spark), "b": FIRST(spark)}, folder, ["a"]), read, old, new) == 5
    changed = [("B", 1, 9.0)], [("C", 3, 3.0)]
    write = lambda: batches.rebuild({"a": rows(*changed[0])(spark), "b": rows(*changed[1])(spark)}, folder, ["a"])
    at_every_step(monkeypatch, write, read, new, [list(changed[0]), list(changed[1])])
    versions.vacuum(spark, folder, keep=1)
    assert read() == [list(changed[0]), list(changed[1])] and len(os.listdir(f"{tmp_path}/build/data")) == 2


def test_replacing_a_table_that_the_query_reads(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/table"
    read = lambda: plain(batches.replaced(spark, path, "id long"))
    batches.replace_table(spark.range(3), path)
    at_every_step(monkeypatch, lambda: batches.replace_table(batches.replaced(spark, path, "id long").select((F.col("id") + 3).alias("id")), path), read, [(0,), (1,), (2,)], [(3,), (4,), (5,)])


def test_merges_write_only_their_buckets(spark, tmp_path, monkeypatch):
    folder = f"file://{tmp_path}/merged"
    read = lambda: plain(versions.read(spark, folder, "prices", SPEC.schema))
    many = spark.range(500).select(F.col("id").cast("string").alias("ticker"), F.lit(1).alias("day"), F.lit(0.5).alias("close"))
    assert versions.merge(many, folder, SPEC, buckets=16) == 1
    old = versions.latest(spark, folder)
    assert len(old.tables["prices"]) == 16
    new = sorted([x for x in read() if x[0] != "7"] + [("7", 1, 9.0), ("new", 2, 1.0)])
    batch = rows(("7", 1, 9.0), ("new", 2, 1.0), (None, 2, 1.0))
    at_every_step(monkeypatch, lambda: versions.merge(batch(spark), folder, SPEC, buckets=99), read, read(), new)
    now = versions.latest(spark, folder)
    changed = [x for x, path in now.tables["prices"].items() if old.tables["prices"][x] != path]
    assert 1 <= len(changed) <= 2 and now.buckets == {"prices": 16}
    assert versions.merge(rows(("NEW", 2, 3.0))(spark), folder, SPEC) == now.number + 1  # the same bucket, whatever its case
    number = versions.latest(spark, folder).number
    assert versions.merge(rows((None, 2, 3.0))(spark), folder, SPEC) == number
    gone = versions.vacuum(spark, folder, keep=1)
    assert gone and versions.read(spark, folder, "prices", SPEC.schema).count() == 501 + (("NEW", 2, 3.0) in read())


def test_a_universe_is_guarded_by_its_sketch(spark, tmp_path, monkeypatch):
    folder = f"file://{tmp_path}/universe"
    many = lambda n, keys=10**9: spark.range(n).select((F.col("id") % keys).alias("k"))
    read = lambda: versions.read(spark, folder, "t", "k long").count()
    assert versions.publish_guarded(many(0), folder, "t", ["k"]) is None and versions.latest(spark, folder).number == 0
    assert versions.publish_guarded(many(5000), folder, "t", ["k"]) == 1
    assert versions.publish_guarded(many(4999), folder, "t", ["k"]) is None and versions.publish_guarded(many(9000, 3000), folder, "t", ["k"]) is None
    assert versions.publish_guarded(many(5000), folder, "t", ["k"]) == 2  # as many keys: they are counted
    assert versions.publish_guarded(many(5001, 4999), folder, "t", ["k"]) is None
    with monkeypatch.context() as m:  # where sketches tell, the old rows aren't asked
        m.setattr(versions, "swap_guard", lambda *a: 1 / 0)
        assert versions.publish_guarded(many(9000), folder, "t", ["k"]) == 3 and versions.publish_guarded(many(9000, 10), folder, "t", ["k"]) is None
        with pytest.raises(ZeroDivisionError):
            versions.publish_guarded(many(9000), folder, "t", ["k"])
    assert at_every_step(monkeypatch, lambda: versions.publish_guarded(many(20_000), folder, "t", ["k"]), read, 9000, 20_000) >= 4
    versions.vacuum(spark, folder, keep=1)
    assert read() == 20_000


def test_two_writers_at_once(spark, tmp_path):
    folder = f"file://{tmp_path}/both"
    now = versions.latest(spark, folder)
    versions.publish({"a": spark.range(1)}, folder)
    with pytest.raises(versions.Conflict):
        versions.commit(spark, folder, versions.Version(now.number + 1, {}))
    assert versions.read(spark, folder, "a", "id long").count() == 1


def test_ledgered_files_count_once_whatever_stops(spark, tmp_path, monkeypatch):
    spec = TABLES["macro_economic_data"]
    source, folder = f"{tmp_path}/macro", f"file://{tmp_path}/stored"
    land = lambda day, value: spark.createDataFrame([("gdp", dt.date(2024, 1, day), value)], spec.schema).coalesce(1).write.mode("append").parquet(source)
    read = lambda: (plain(ledger.merged_table(spark, folder, spec.name)), ledger.ledger(spark, folder).count())
    monkeypatch.setattr(ledger, "LEDGER_PARTS", 2)
    for k in range(4):
        land(1 + k // 2, float(k))
        old, new = read(), (sorted({d: ("gdp", dt.date(2024, 1, d), float(v)) for d, v in ((1, 0), (1, 1), (2, 2), (2, 3))[: k + 1]}.values()), k + 1)

        def write():
            outcome = ledger.merge_new_files(spark, {spec.name: source}, folder, "2024-01-03 00:00:00", buckets=4)[0]
            if outcome["error"]:
                assert outcome["error"].startswith("Stopped")
                raise Stopped

        at_every_step(monkeypatch, write, read, old, new)
    assert len(versions.latest(spark, folder).tables["parquet_file_log"]) <= 2


def test_batches_written_again_or_restricted(spark, tmp_path, monkeypatch):
    spec = TABLES["companies"]
    path = f"file://{tmp_path}/companies"
    batch = lambda *ciks: spark.createDataFrame([(c, f"Name {c}") for c in ciks], "cik string, primary_name string")
    read = lambda: sorted((r.cik or "", r.batch_id[-1]) for r in batches.read_batches(spark, path, spec).collect())
    for k, ciks in enumerate((["1", "2"], ["3", None], ["4", "5"], ["9"])):
        batches.append_batch(batch(*ciks), path, spec, f"20240101_00000{k}")
    old = read()
    universe = batch("1", "2", "4", "5", "6")
    at_every_step(monkeypatch, lambda: batches.restrict_batches(spark, path, spec, universe), read, old, [("1", "0"), ("2", "0"), ("4", "2"), ("5", "2")])
    assert batches.restrict_batches(spark, path, spec, universe) == [] and batches.read_table(spark, path, spec).count() == 4
    at_every_step(monkeypatch, lambda: batches.append_batch(batch("6"), path, spec, "20240101_000003"), read, read(), [*read(), ("6", "3")])
    at_every_step(monkeypatch, lambda: batches.append_batch(batch("1"), path, spec, "20240101_000000"), read, read(), sorted([("1", "0"), *(x for x in read() if x[1] != "0")]))


def test_rules_are_checked_while_a_batch_is_written(spark, tmp_path):
    spec = TABLES["stock_history"]
    path = f"file://{tmp_path}/prices"
    rules = batches.spec_rules(spec) | {"negative volume": F.col("volume") < 0, "low above high": F.col("low") > F.col("high")}
    df = spark.createDataFrame([("A", dt.date(2024, 1, 1), 1.0, 2.0, 5), ("A", dt.date(2024, 1, 2), 3.0, 2.0, -5), (None, dt.date(2024, 1, 2), None, 2.0, -5)], "ticker string, date date, low double, high double, volume bigint")
    with pytest.raises(batches.RuleBroken) as broken:
        batches.append_batch(df, path, spec, "20240101_000000", rules)
    assert broken.value.broken == {"ticker null": 1, "negative volume": 2, "low above high": 1}
    assert not os.path.exists(f"{tmp_path}/prices") and os.listdir(f"{tmp_path}/prices-staging") == []
    assert batches.append_batch(df.where("volume > 0"), path, spec, "20240101_000000", rules) == 1


def test_directory_report_names_bad_files(spark, tmp_path):
    spark.range(5).coalesce(1).write.parquet(f"{tmp_path}/t/good")
    spark.range(0).coalesce(1).write.parquet(f"{tmp_path}/t/empty")
    (tmp_path / "t" / "bad.parquet").write_bytes(b"no parquet at all")
    (tmp_path / "t" / "none.parquet").write_bytes(b"")
    got = batches.directory_report(spark, f"file://{tmp_path}/t").first()
    assert (got.files, got.valid, got.invalid, got.n_rows) == (4, 2, 2, 5)
    assert [x.split(":")[0] for x in got.errors] == ["Invalid file bad.parquet", "Invalid file none.parquet"]


def test_compaction_loses_nothing(spark, tmp_path, monkeypatch):
    folder = f"file://{tmp_path}/stream"
    for n, one in enumerate((FIRST, SECOND, rows(("A", 1, 7.0)))):
        one(spark).where("ticker IS NOT NULL").write.parquet(f"{folder}/delta={n}")
    read = lambda: plain(ingest.merged(spark, folder, SPEC))
    want = [("A", 1, 7.0), ("B", 1, 9.0), ("C", 3, 3.0), ("D", 1, 4.0)]
    assert read() == want
    assert at_every_step(monkeypatch, lambda: ingest.compact(spark, folder, SPEC), read, want, want) >= 3
    assert sorted(x for x in os.listdir(f"{tmp_path}/stream") if "=" in x) == ["base=2"]
    assert ingest.compact(spark, folder, SPEC) == 2 and ingest.compact(spark, f"{folder}-none", SPEC) is None
