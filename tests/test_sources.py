"""Files, stored tables and the file stream."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from donorloom.sources import files
from donorloom.sources.store import Store
from donorloom.streaming.incremental import file_stream, replace_into, run_available


def test_read_delimited(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("ï»¿Gift Id,Name\n1,café\n2\n3,x,extra\n\"4\",\"a,b\"\n".encode("latin-1"))
    df = files.read_delimited(spark, str(tmp_path))
    assert df.columns[:2] == ["Gift Id", "Name"]
    assert sorted(tuple(r) for r in files.good_lines(df).collect()) == [("1", "café"), ("2", None), ("4", "a,b")] or \
        sorted((r[0], r[1] or "") for r in files.good_lines(df).collect()) == [("1", "café"), ("2", ""), ("4", "a,b")]
    assert [r[0] for r in files.bad_lines(df).collect()] == ["3,x,extra"]
    assert files.good_lines(df).count() == 3
    (tmp_path / "b.csv").write_text('Gift Id,Name\n5,"cut\nhere"\n')
    assert sorted(r[0] for r in files.bad_lines(files.read_delimited(spark, str(tmp_path))).collect())[:1] == ["3,x,extra"]


def mixed_rows(df):
    from donorloom.sources.mixed import BAD_LINE
    good = df.filter(F.col(BAD_LINE).isNull()).drop(BAD_LINE, "_file").collect()
    return sorted((tuple(r) for r in good), key=repr), sorted(r[0] for r in df.filter(F.col(BAD_LINE).isNotNull()).select(BAD_LINE).collect())


def test_every_file_has_its_own_format(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("\ufeffGift; Id;'Note'\n1;'two\nlines; one field';9\n2;plain\n3;a;b;c\n\n".encode().replace(b"Gift; Id", b"'Gift; Id'").replace(b";9", b""))
    (tmp_path / "b.csv").write_bytes('Note\tGift; Id\tMore\ncaf\xe9, "x"\t4\t\n"tab\there\nand ""there"""\t5\tm\n'.encode("latin-1"))
    (tmp_path / "c.csv").write_text("Gift; Id|Note\n6|O'Brien\n7|5\\\" pipe\nGift; Id|Note\n8|é\n")
    (tmp_path / "d.csv").write_text('Gift; Id,Note\n9,"not closed\n10,ok\n')
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "e.csv").write_text("More\nonly one column\n")
    (tmp_path / "f.csv").write_text("")
    from donorloom.sources.mixed import read_mixed
    df = read_mixed(spark, str(tmp_path))
    assert set(df.columns) == {"Gift; Id", "Note", "More", "_bad_line", "_file"}
    good, bad = mixed_rows(df.select("Gift; Id", "Note", "More", "_bad_line", "_file"))
    assert good == sorted([
        ("1", "two\nlines; one field", None), ("2", "plain", None), ("4", 'café, "x"', None), ("5", 'tab\there\nand "there"', "m"), ("6", "O'Brien", None),
        ("7", '5\\" pipe', None), ("8", "é", None), ("10", "ok", None), (None, None, "only one column")], key=repr)
    assert bad == ["3;a;b;c", '9,"not closed']
    assert {r["_file"].rsplit("/", 1)[1] for r in df.collect()} == {"a.csv", "b.csv", "c.csv", "d.csv", "e.csv"}
    (tmp_path / "none").mkdir()
    assert read_mixed(spark, str(tmp_path / "none")).collect() == []


def test_a_large_file_with_line_breaks_is_read_by_several_tasks(spark, tmp_path):
    import random

    from donorloom.sources.mixed import read_mixed
    rng = random.Random(5)
    rows = [(str(i), "".join(rng.choice(["x", "\n", ",", "word ", "\n\n"]) for _ in range(rng.randint(1, 120)))) for i in range(900)]
    (tmp_path / "a.csv").write_text("id,text\n" + "".join(f'{i},"{t}"\n' if i != "500" else '500,x,y\n' for i, t in rows), newline="")
    want = [(i, t) for i, t in rows if i != "500"]
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "9000", "300"):  # in the last case single records run over several splits
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
            df = read_mixed(spark, str(tmp_path))
            good, bad = mixed_rows(df.select("id", "text", "_bad_line", "_file"))
            if size != "300":
                assert [g for g in good] == sorted(want, key=repr) and bad == ["500,x,y"]
            else:
                whole = [g for g in good if g in set(want)]
                assert len(whole) > 500 and bad
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def window_spills(df):
    """Bytes that the windows of an executed plan spilled."""
    def walk(node):
        name = node.nodeName()
        below = [node.executedPlan()] if name == "AdaptiveSparkPlan" else [node.plan()] if name.endswith("QueryStage") else [
            node.children().apply(i) for i in range(node.children().size())]
        own = [node.metrics().apply("spillSize").value()] if name == "Window" else []
        return own + [x for b in below for x in walk(b)]
    return walk(df._jdf.queryExecution().executedPlan())


def test_lines_are_put_together_by_chunks_not_by_splits(spark, tmp_path, monkeypatch):
    """A window holds a chunk and the end of one record, however large the split is."""
    from donorloom.sources import mixed
    (tmp_path / "a.csv").write_text("id,text\n" + "".join(f'{i},"a\nb, {i}"\n' for i in range(20_000)))
    conf = {"spark.sql.windowExec.buffer.in.memory.threshold": "4096", "spark.sql.windowExec.buffer.spill.threshold": "4096"}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        for limit in (10**6, 0):  # the chunks are broadcast, or joined
            monkeypatch.setattr(mixed, "BROADCAST_CHUNKS", limit, raising=False)
            df = mixed.read_mixed(spark, str(tmp_path))
            assert sorted((int(r.id), r.text, r._bad_line) for r in df.collect()) == [(i, f"a\nb, {i}", None) for i in range(20_000)]
            spilled = window_spills(df)
            assert spilled and sum(spilled) == 0
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_records_over_several_splits_are_whole(spark, tmp_path):
    from donorloom.sources.mixed import read_mixed
    long = "\n".join(f"{i},x" for i in range(1500))
    (tmp_path / "a.csv").write_text(f'id,text\n1,"{long}"\n2,"b\n\nc"\n3,"{long}\n{long}"\n4,d\n5,"e\nf"\n')
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "4000", "500"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
            good, bad = mixed_rows(read_mixed(spark, str(tmp_path)).select("id", "text", "_bad_line", "_file"))
            assert good == [("1", long), ("2", "b\n\nc"), ("4", "d"), ("5", "e\nf")]
            # A record of more lines than may be held is bad as a whole, and none of its lines is lost or taken for a record.
            assert sorted("\n".join(bad).split("\n")) == sorted(f'3,"{long}\n{long}"'.split("\n"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_store_round_trips(spark, tmp_path):
    s = Store(spark, str(tmp_path), "ACME")
    s.create("donor", {"donor_key": "object", "n": "Int64"})
    assert s.read("donor").dtypes == [("donor_key", "bigint"), ("n", "bigint")]
    s.create("donor", {"other": "object"})
    assert len(s.versions("donor")) == 1
    a = spark.createDataFrame([(1, 10), (2, 20)], "donor_key long, n long")
    s.append_aligned(a.withColumn("extra", F.lit("x")).unionAll(a.withColumn("extra", F.lit("x"))), "donor")
    assert s.read("donor").count() == 2
    s.upsert(spark.createDataFrame([(2, 21), (3, None)], "donor_key long, n long"), "donor", ["donor_key"])
    assert sorted(tuple(r) for r in s.read("donor").collect() if r.n) == [(1, 10), (2, 21)] and s.read("donor").count() == 3
    s.seed(spark.createDataFrame([(3, 99), (4, 40)], "donor_key long, n long"), "donor", ["donor_key"])
    assert s.read("donor").filter("n = 99").count() == 0 and s.read("donor").filter("n = 40").count() == 1
    assert s.read("donor", back=1).count() == 2 and s.read("donor").dtypes == [("donor_key", "bigint"), ("n", "bigint")]
    s.publish("donor")
    assert s.read("donor", "curated").count() == 4
    with pytest.raises(FileNotFoundError):
        s.read("nothing")


def test_replace_partition_keeps_the_others(spark, tmp_path):
    s = Store(spark, str(tmp_path), "ACME")
    s.replace_partition(spark.createDataFrame([("fy", 1), ("cy", 2)], "period string, n int"), "fh_group", "period")
    s.replace_partition(spark.createDataFrame([("cy", 3), ("cy", 4)], "period string, n int"), "fh_group", "period")
    assert sorted((r.period, r.n) for r in s.read("fh_group").collect()) == [("cy", 3), ("cy", 4), ("fy", 1)]


def test_stream_takes_each_file_once(spark, tmp_path):
    s = Store(spark, str(tmp_path / "store"), "ACME")
    inbox, log = tmp_path / "in", str(tmp_path / "log")
    inbox.mkdir()
    (inbox / "one.csv").write_text("id,d\n1,2020-01-01\n2,2020-02-01\n")
    schema = spark.createDataFrame([], "id int, d date").schema
    go = lambda: run_available(file_stream(spark, str(inbox), schema), s, "gift", "d", log)
    go()
    (inbox / "two.csv").write_text("id,d\n9,2020-02-01\n8,2020-03-01\n")
    go()
    go()
    assert sorted((r.id, r.d) for r in s.read("gift").collect()) == [
        (1, dt.date(2020, 1, 1)), (8, dt.date(2020, 3, 1)), (9, dt.date(2020, 2, 1))]
    assert [r.batch for r in s.read("gift_batches").orderBy("batch").collect()] == [0, 1]
    # A batch taken before is not taken again, so it cannot undo the newer one.
    replace_into(s, "gift", "d")(spark.createDataFrame([(1, dt.date(2020, 2, 1)), (2, dt.date(2020, 3, 1))], "id int, d date"), 0)
    assert sorted(r.id for r in s.read("gift").collect()) == [1, 8, 9]


def test_failed_write_does_not_lock_the_table(spark, tmp_path):
    s = Store(spark, str(tmp_path), "acme")
    s.overwrite(spark.range(3), "t")
    (tmp_path / "silver" / "acme_t" / "99990101T000000000000" / "_temporary").mkdir(parents=True)
    assert s.read("t").count() == 3 and len(s.versions("t")) == 1


def data_files(folder):
    return {str(p): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def test_writes_touch_only_their_partitions(spark, tmp_path):
    s = Store(spark, str(tmp_path), "acme")
    s.upsert(spark.range(1000).select("id", F.lit(0).alias("n")), "keyed", ["id"])
    table = tmp_path / "silver" / "acme_keyed"
    before = data_files(table)
    s.upsert(spark.createDataFrame([(5, 7), (5000, 1)], "id long, n int"), "keyed", ["id"])
    after = data_files(table)
    changed = {p.split("/")[-2] for p in {*before, *after} if after.get(p) != before.get(p)}
    assert 1 <= len(changed) <= 2 < 20 < len({p.split("/")[-2] for p in before})
    assert s.read("keyed").count() == 1001 and s.read("keyed").agg(F.sum("n")).first()[0] == 8
    assert s.read("keyed").columns == ["id", "n"] and len(s.versions("keyed")) == 1
    s.append(spark.createDataFrame([(6000, 2, "new")], "id int, n int, more string"), "keyed", key=["id"])
    assert s.read("keyed").filter("more = 'new'").count() == 1
    with pytest.raises(ValueError):
        s.append(spark.range(1), "keyed")
    s.upsert(spark.createDataFrame([(6000, 3)], "id int, n int"), "keyed", ["id"])
    assert [tuple(r) for r in s.read("keyed").filter("id = 6000").select("id", "n", "more").collect()] == [(6000, 3, "new")]
    s.publish("keyed")
    s.overwrite(s.read("keyed"), "keyed")
    assert len(s.versions("keyed")) == 2
    s.vacuum("keyed", 1)
    assert len(s.versions("keyed")) == 1 and s.read("keyed").count() == s.read("keyed", "curated").count() == 1002


def test_replaced_partition_leaves_the_other_files(spark, tmp_path):
    s = Store(spark, str(tmp_path), "acme")
    s.replace_partition(spark.createDataFrame([("fy", 1), ("cy", 2)], "period string, n int"), "t", "period")
    kept = data_files(tmp_path / "silver" / "acme_t")
    s.replace_partition(s.read("t").filter("period = 'cy'").withColumn("n", F.col("n") + 5), "t", "period")
    now = data_files(tmp_path / "silver" / "acme_t")
    assert {p for p in kept if "period=fy" in p} == {p for p in now if "period=fy" in p and now[p] == kept[p]}
    assert sorted((r.period, r.n) for r in s.read("t").collect()) == [("cy", 7), ("fy", 1)]


def test_range_replace_empties_months(spark, tmp_path):
    s = Store(spark, str(tmp_path), "acme")
    schema = "id int, d date"
    day = lambda m, d: dt.date(2020, m, d)
    s.replace_range(spark.createDataFrame([(1, day(1, 5)), (2, day(2, 5)), (3, day(3, 5)), (4, day(4, 5)), (5, None)], schema), "gift", "d")
    before = data_files(tmp_path / "silver" / "acme_gift")
    s.replace_range(spark.createDataFrame([(9, day(1, 20)), (8, day(3, 20))], schema), "gift", "d")
    assert sorted(r.id for r in s.read("gift").collect()) == [1, 4, 8, 9]
    after = data_files(tmp_path / "silver" / "acme_gift")
    april = [p for p in before if "_month=24243" in p]
    assert april and all(after[p] == before[p] for p in april)
    assert s.read("gift").columns == ["id", "d"]


def test_checks_are_counted_by_the_writes(spark, tmp_path):
    """Measures of the writes give the results of the checks that scan, also on an empty table; no scan only to count."""
    import datetime as dt
    from decimal import Decimal
    from donorloom.operators import quality
    schema = "gift_id string, donor_id string, gift_date date, gift_amount decimal(12,2)"
    rows = [(str(i) if i % 50 else None, f"d{i % 40}" if i % 30 else None, dt.date(2020, 1, 1) + dt.timedelta(i % 300), Decimal(i % 90) - 5) for i in range(400)]
    rows.append(("late", "d1", dt.date(2030, 1, 1), Decimal(0)))  # nothing positive then: outside the range
    for name, data in (("full", rows), ("empty", []), ("no positive amount", [("1", "d", dt.date(2020, 1, 1), Decimal(-3))])):
        staged = spark.createDataFrame(data, schema)
        table, seen = quality.measured(staged, quality.transaction_measures())
        table.write.parquet(f"{tmp_path}/{name}/transactions")
        found = seen.get
        gifts, counted = quality.measured(staged.filter("gift_amount <> 7"), quality.amount_measures(found))
        gifts.write.parquet(f"{tmp_path}/{name}/gift")
        got = quality.transaction_results(quality.one_row(spark, found), "A").unionByName(
            quality.amount_results(quality.one_row(spark, {"staged": found["staged"], **counted.get}), "A"))
        want = quality.transaction_checks(staged, "A").unionByName(
            quality.reconcile_amounts(staged, staged.filter("gift_amount <> 7"), "gift_date", "gift_amount", "A"))
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str), name


def test_dates_are_parsed_only_where_their_shape_fits(spark):
    """The same dates as by giving every format the whole text and its part before the time, with one guarded try per format."""
    texts = ["2001-01-02", " 2001-01-02", "2001-01-02 10:00:00", "2001-1-2", "1/2/2001", "01/02/2001 5pm", "1/2/-2001", "+12001-01-02", "2001-13-01",
             "2/30/2001", "", "no date", None, "2001-01-02\n", "2001-01-02x", "0000-01-01", "01.02.2001 19:30", "Jan 2001"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    day = F.split(F.trim("t"), " ").getItem(0)
    for formats in (("yyyy-MM-dd", "M/d/yyyy"), ("dd.MM.yyyy HH:mm", "MMM yyyy")):
        plain = F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in formats for t in (F.col("t"), day)]).cast("date")
        out = df.select(plain.alias("a"), files.lenient_date(F.col("t"), formats).alias("b"))
        assert out.filter("NOT a <=> b").count() == 0
        assert out.filter("b IS NOT NULL").count() > 1
    plan = df.select(files.lenient_date(F.col("t")).alias("d"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("gettimestamp(") == 2 and plan.count("RLIKE") == 2, plan
