"""Streams with state over several micro-batches, and tables under a commit: out-of-order and late rows, replays, stale writers."""

import pytest
from pyspark.sql import functions as F

from revlake.operators import ledger
from revlake.sources import sinks, versions
from revlake.streaming import streams

ROWS = "k long, at long, v string"


def put(spark, path, rows, schema=ROWS):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def test_upsert_keeps_the_newest_whatever_the_order(spark, tmp_path):
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    schema = spark.createDataFrame([], ROWS).schema
    rounds = [[(1, 9, "new"), (2, 1, "a"), (None, 1, "n")], [(1, 3, "old"), (2, 5, "b"), (3, None, "x")], [(3, 0, "y"), (None, 2, "m"), (2, 5, "b")], []]
    seen = []
    for rows in rounds:
        put(spark, source, rows)
        streams.start_upsert(streams.read_arrivals(spark, source, schema, files=1), out, ["k"], state, newest="at", buckets=4).awaitTermination()
        seen.append(sorted(map(tuple, streams.upserted(spark, out, schema).collect()), key=repr))
    assert seen[0] == [(1, 9, "new"), (2, 1, "a"), (None, 1, "n")]
    assert seen[1] == [(1, 9, "new"), (2, 5, "b"), (3, None, "x"), (None, 1, "n")]
    assert seen[2] == seen[3] == [(1, 9, "new"), (2, 5, "b"), (3, 0, "y"), (None, 2, "m")]


def test_upsert_batches_run_once_and_touch_their_buckets_only(spark, tmp_path):
    out = str(tmp_path / "out")
    frame = lambda rows: spark.createDataFrame(rows, ROWS)
    upsert = lambda rows, n: streams.upsert_batch(frame(rows), n, out, "s", ["k"], ["at"], 64)
    assert upsert([(k, 1, "a") for k in range(40)], 0)
    before = versions.current(spark, out)
    assert upsert([(7, 2, "b")], 1) and not upsert([(7, 3, "c")], 1) and not upsert([(7, 3, "c")], 0)
    after = versions.current(spark, out)
    assert after.number == before.number + 1 and sum(after.parts[b] != before.parts[b] for b in before.parts) == 1
    got = {r["k"]: r["v"] for r in streams.upserted(spark, out, frame([]).schema).collect()}
    assert got == {k: "b" if k == 7 else "a" for k in range(40)}
    assert streams.upsert_batch(frame([(7, 9, "d")]), 0, out, "another stream", ["k"], ["at"], 64)
    folder = versions.Folder(spark, out)
    assert versions.numbers(folder) == [2, 3], "older commits are swept"
    named = {f for n in (2, 3) for f in versions.current(spark, out, n).parts.values()}
    assert {f"data/{w}/{b}" for w in folder.names("data") for b in folder.names(f"data/{w}") if "=" in b} == named


def test_a_commit_that_came_first_wins(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = lambda x: spark.createDataFrame([(x,)], "x int")
    start = versions.current(spark, root)
    assert start == versions.Commit() and versions.read(spark, root, "x int").count() == 0
    one = versions.commit(spark, root, versions.write(rows(1), root), start)
    versions.write(rows(5), root)  # a writer that fails before its commit changes nothing
    for stale in (start, versions.Commit(7)):
        with pytest.raises(versions.StaleCommit):
            versions.commit(spark, root, versions.write(rows(2), root), stale)
    two = versions.commit(spark, root, versions.write(rows(3), root), one)
    versions.sweep(spark, root)
    assert [versions.read(spark, root, "x int", at=c).first()[0] for c in (one, two)] == [1, 3]
    assert not versions.Folder(spark, root).write_new(f"commits/{two.number:012d}", "{}")
    assert len(versions.Folder(spark, root).names("data")) == 2


def test_candidates_are_accepted_whole_or_refused(spark, tmp_path):
    root = str(tmp_path / "star")
    fact = lambda *rows: {"fact": spark.createDataFrame(rows, "g string, n long"), "dim": spark.createDataFrame([(r[0],) for r in rows], "g string")}
    faults = lambda t: ledger.grain_violations(t["fact"], ["g"])
    first = sinks.accept_candidate(spark, root, fact(("a", 1)), versions.current(spark, root), faults)
    with pytest.raises(ValueError, match="duplicate_grain"):
        sinks.accept_candidate(spark, root, fact(("a", 1), ("a", 2)), first, faults)
    with pytest.raises(ValueError, match="null_grain"):
        sinks.accept_candidate(spark, root, fact((None, 1)), first, faults)
    second = sinks.accept_candidate(spark, root, fact(("b", 2)), first, faults)
    with pytest.raises(versions.StaleCommit):
        sinks.accept_candidate(spark, root, fact(("c", 3)), first, faults)
    assert second.number == 2 and set(second.parts) == {"fact", "dim"}
    assert [tuple(r) for r in sinks.accepted(spark, root, "fact", spark.createDataFrame([], "g string, n long").schema).collect()] == [("b", 2)]


def test_late_watch_emits_when_state_expires(spark, tmp_path):
    notices, openings, out, state = (str(tmp_path / x) for x in ("n", "o", "out", "state"))
    n_schema, o_schema = "notify_no long, bid_open_date timestamp", "notify_no long, captured_at timestamp"

    def feed(n, o):
        for path, rows, schema in ((notices, n, n_schema), (openings, o, o_schema)):
            time = schema.split()[-2]
            put(spark, path, [(k, None if t is None else f"2024-01-{t}") for k, t in rows], schema.replace("timestamp", "string"))
            df = spark.read.schema(schema.replace("timestamp", "string")).parquet(path).withColumn(time, F.to_timestamp(time))
            df.write.mode("overwrite").parquet(f"{path}-t{len(n) + 10 * len(o)}")
        both = [streams.read_arrivals(spark, f"{p}-t*", spark.createDataFrame([], s).schema) for p, s in ((notices, n_schema), (openings, o_schema))]
        watch = streams.late_watch(*both)
        watch.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
        return {r["notify_no"]: (r["state"], None if r["captured_at"] is None else r["captured_at"].hour) for r in spark.read.schema(watch.schema).parquet(out).collect()}

    early = feed([(1, "01 10:00:00"), (2, "01 10:00:00"), (3, "01 10:00:00"), (4, None)], [(1, "01 10:30:00"), (2, "01 12:00:00")])
    assert early == {1: ("captured", 10)}, "others may still be captured"
    done = feed([(9, "09 00:00:00")], [(9, "09 05:00:00")])
    assert {k: v for k, v in done.items() if k != 9} == {1: ("captured", 10), 2: ("unresolved", None), 3: ("unresolved", None)}


def test_daily_fact_counts_late_rows_apart_and_batches_once(spark, tmp_path):
    out = str(tmp_path / "out")
    frame = lambda *rows: spark.createDataFrame([(None if d is None else f"2024-01-{d:02d} 12:00:00", g, x) for d, g, x in rows], "t string, g string, x long").withColumn("t", F.to_timestamp("t"))
    merge = lambda n, *rows: streams.merge_daily(frame(*rows), n, out, "s", "t", ["g"], ["x"], 2)
    assert merge(0, (1, "a", 5), (1, "a", 6), (5, "b", 1), (None, "a", 9)) and not merge(0, (1, "a", 5))
    assert merge(1, (3, "a", 7), (2, "a", 100), (1, "a", 100), (9, "c", 1), (5, "b", 1)) and merge(2)
    assert merge(3, (5, None, 4))
    got = sorted(((r["report_date"].day, r["g"], r["rows"], r["x"], r["late_rows"]) for r in versions.read(spark, out, "g string, rows long, x long, late_rows long, report_date date").collect()), key=repr)
    assert got == [(1, "a", 2, 11, 1), (2, "a", 0, None, 1), (3, "a", 1, 7, 0), (5, "b", 2, 2, 0), (5, None, 0, None, 1), (9, "c", 1, 1, 0)]
