from __future__ import annotations

import json
import random
from itertools import product

import duckdb
import pytest
from pyspark.sql import functions as F

from hearthlog.operators.fault_lookup import known_faults, lookup_faults_as_of
from hearthlog.plans.daily_counts import daily_operation_counts
from hearthlog.schemas import DAILY_COUNT, DEVICE_LOG, STORED
from hearthlog.sinks.analytic_table import AnalyticTable
from hearthlog.sinks.change_table import ChangeTable
from hearthlog.sinks.jdbc_upsert import JdbcUpsert, _not_before, merge_statement
from hearthlog.sources.device_log import bad_messages, decode_json, good_rows, kafka_options
from hearthlog.sources.fault_dictionary import (
    dictionary_at,
    range_predicates,
    read_dictionary_files,
)


def messages_of(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


GOOD = [
    ('{"iotId": "a", "gmtCreate": 5, "eventName": "E"}', ("a", 5, "E")),
    ('{"gmtCreate": "5", "unknown": 1}', (None, 5, None)),
    ('{"gmtCreate": " 5 ", "eventName": null}', (None, 5, None)),
    ('{"iotId": 7, "gmtCreate": null, "eventName": {"x": [1]}}', ("7", None, '{"x":[1]}')),
    ('{"gmtCreate": 1.6674912e12}', (None, 1667491200000, None)),
    ('{"gmtCreate": 5.0}', (None, 5, None)),
    ('{"gmtCreate": "9223372036854775807"}', (None, 9223372036854775807, None)),
    ("{}", (None, None, None)),
    ('{"iotId": "a", "iotId": "b"}', ("b", None, None)),
    ('{"IOTID": "a", "eventName": true}', (None, None, "true")),
    ("", (None, None, None)),
    (None, (None, None, None)),
]
BAD = ["{", "5", '{"gmtCreate": 5.5}', '[{"iotId": "a"}]', "{'iotId': 'a'}", '{"gmtCreate": "soon"}', "no json", '{"gmtCreate": "99999999999999999999"}']


def test_decode_json(spark):
    rows = decode_json(messages_of(spark, *[text for text, _ in GOOD])).collect()
    assert [(r.iotId, r.gmtCreate, r.eventName) for r in rows] == [want for _, want in GOOD]
    assert rows[0].ts_ltz is not None and rows[3].ts_ltz is None


def test_decoded_schema(spark):
    decoded = decode_json(messages_of(spark, "{}"))
    fields = [(f.name, f.dataType) for f in decoded.schema]
    assert fields[:-1] == [(f.name, f.dataType) for f in DEVICE_LOG]
    assert decoded.columns[-1] == "ts_ltz"


@pytest.mark.parametrize("text", BAD)
def test_undecodable_message_fails_the_job(spark, text):
    with pytest.raises(Exception, match="undecodable device log message"):
        decode_json(messages_of(spark, GOOD[0][0], text)).collect()


@pytest.mark.parametrize("text", BAD)
def test_undecodable_message_fails_a_job_that_filters(spark, dictionary_of, text):
    log = decode_json(messages_of(spark, GOOD[0][0], text))
    with pytest.raises(Exception, match="undecodable device log message"):
        daily_operation_counts(log, dictionary_of(("T", "P1", "E1", "one"))).collect()


def test_messages_are_parsed_once(spark, dictionary_of):
    log = decode_json(messages_of(spark, *[text for text, _ in GOOD]).repartition(2))
    counts = daily_operation_counts(log, dictionary_of(("T", "P1", "E1", "one")))
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_undecodable_messages_can_be_set_aside(spark):
    decoded = decode_json(messages_of(spark, GOOD[0][0], *BAD, GOOD[1][0]), quarantine=True)
    assert [r.gmtCreate for r in good_rows(decoded).collect()] == [5, 5]
    assert [r.bad_message for r in bad_messages(decoded).collect()] == BAD


def test_kafka_options():
    assert kafka_options("h:1", "log") == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "log",
        "startingOffsets": "latest",
    }
    options = kafka_options(
        "h:1,h:2", "log", {"log": {"0": 5, "1": -2}}, group_id="g", max_offsets_per_trigger=9
    )
    assert json.loads(options["startingOffsets"]) == {"log": {"0": 5, "1": -2}}
    assert options["kafka.group.id"] == "g" and options["maxOffsetsPerTrigger"] == "9"
    options = kafka_options("h", "log", "earliest", min_partitions=400, ending_offsets="latest")
    assert options["minPartitions"] == "400" and options["endingOffsets"] == "latest"


def test_dictionary_files(spark, tmp_path, dictionary_of):
    dictionary_of(("T", "P1", "E1", "one")).write.parquet(f"{tmp_path}/d")
    rows = read_dictionary_files(spark, f"{tmp_path}/d").collect()
    assert [tuple(r) for r in rows] == [("T", "P1", "E1", "one")]


def counts_of(spark, *rows):
    return spark.createDataFrame(list(rows), DAILY_COUNT)


ONE = ("2024-01-01", "P1", "iot1", "d1", "StOvMode", "2", None, 1)


def timed(frame, second):
    return frame.withColumn("last_ts", F.timestamp_seconds(F.lit(second)))


def test_change_table(spark, tmp_path):
    table = ChangeTable(f"{tmp_path}/t")
    assert table.current(spark).collect() == []
    other = ("2024-01-02", *ONE[1:])
    table.write(timed(counts_of(spark, ONE, other), 1), 0)
    table.write(timed(counts_of(spark, (*ONE[:7], 4)), 2), 1)
    table.write(timed(counts_of(spark, (*ONE[:7], 4)), 2), 1)
    table.write(timed(counts_of(spark, (ONE[0], "P2", *ONE[2:7], 2)), 3), 10)
    table.write(timed(counts_of(spark, (ONE[0], "P0", *ONE[2:7], 9)), 2), 11)
    rows = sorted((r.ds, r.productKey, r.cnt, r.overwritten) for r in table.settled(spark).collect())
    assert rows == [("2024-01-01", "P2", 2, 2), ("2024-01-02", "P1", 1, 0)]
    assert sorted((r.ds, r.cnt) for r in table.current(spark).collect()) == [
        ("2024-01-01", 2), ("2024-01-02", 1)
    ]


@pytest.mark.parametrize("partial", [True, False])
def test_closed_epochs(spark, tmp_path, partial):
    table = ChangeTable(f"{tmp_path}/t", partial, epoch_batches=4)
    days = ["2024-01-01", "2024-01-02"]

    def write(batch):
        rows = [(days[batch % 2], *ONE[1:7], 1 if partial else batch)]
        table.write(timed(counts_of(spark, *rows), batch), batch)

    def counts():
        return sorted(r.cnt for r in table.current(spark).collect())

    assert table.close_epochs(spark) == []
    for batch in range(10):
        write(batch)
    want = [5, 5] if partial else [8, 9]
    assert counts() == want
    assert table.close_epochs(spark) == [0, 1]
    assert counts() == want
    assert table.close_epochs(spark) == [] and counts() == want
    # The newest batch may come again; its epoch is open.
    write(9)
    assert counts() == want
    assert not list((tmp_path / "t" / "open" / "epoch=0").glob("batch_id=*"))
    for batch in range(10, 13):
        write(batch)
    assert table.close_epochs(spark) == [2]
    assert counts() == ([6, 7] if partial else [11, 12])
    closed = spark.read.parquet(f"{tmp_path}/t/closed")
    assert closed.groupBy("epoch").count().where("count <> 2").count() == 0
    day = table.current(spark).where(F.col("ds") == days[0])
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ds), EqualTo(ds" in plan


def test_an_epoch_that_was_closed_but_not_emptied(spark, tmp_path, monkeypatch):
    """A job that ends between the two steps, and is repeated."""
    table = ChangeTable(f"{tmp_path}/t", partial=True, epoch_batches=2)
    for batch in range(5):
        table.write(timed(counts_of(spark, ONE), batch), batch)
    stop = RuntimeError("the job was ended")

    def fails(*args):
        raise stop

    with monkeypatch.context() as patch:
        patch.setattr(spark, "createDataFrame", fails)
        with pytest.raises(RuntimeError):
            table.close_epochs(spark)
    assert [r.cnt for r in table.current(spark).collect()] == [5]
    assert table.close_epochs(spark) == [0, 1]
    assert [r.cnt for r in table.current(spark).collect()] == [5]


def by_hand(batches, ttl):
    """Counts per group when an idle time of ``ttl`` forgets; batches: (time, {group: cnt})."""
    totals, seen = {}, {}
    for at, counts in batches:
        for group, cnt in counts.items():
            if group in seen and at - seen[group] >= ttl:
                totals[group] = 0
            totals[group] = totals.get(group, 0) + cnt
            seen[group] = at
    return totals


@pytest.mark.parametrize("seed", range(4))
def test_time_to_live_does_not_depend_on_epochs(spark, tmp_path, seed):
    random.seed(seed)
    table = ChangeTable(f"{tmp_path}/t", partial=True, ttl_ms=10_000, epoch_batches=3)
    at, batches = 0, []
    for batch in range(11):
        at += random.choice([1, 4, 5, 6, 10])
        batches.append((at, {f"iot{i}": random.randrange(1, 4) for i in range(6) if random.random() < 0.5}))
        rows = [(*ONE[:2], iot, *ONE[3:7], cnt) for iot, cnt in batches[-1][1].items()]
        if rows:
            table.write(counts_of(spark, *rows), batch, at)
        if batch == 7:
            table.close_epochs(spark)
    want = by_hand(batches, 10)
    assert {r.iotId: r.cnt for r in table.current(spark).collect()} == want
    last = table.changes(spark).orderBy("batch_id").where("kind <> '-U'").collect()
    assert {r.iotId: r.cnt for r in last} == {
        iot: cnt for iot, cnt in want.items() if iot in {r.iotId for r in last}
    }
    table.close_epochs(spark)
    assert {r.iotId: r.cnt for r in table.current(spark).collect()} == want


def test_changes_fold_to_counts(spark, tmp_path):
    table = ChangeTable(f"{tmp_path}/t", partial=True)
    for batch, cnt in enumerate([2, 3, 1]):
        table.write(counts_of(spark, (*ONE[:7], cnt)), batch)
    rows = table.changes(spark).orderBy("batch_id", F.desc("kind")).collect()
    assert [(r.batch_id, r.kind, r.cnt) for r in rows] == [
        (0, "+I", 2), (1, "-U", 2), (1, "+U", 5), (2, "-U", 5), (2, "+U", 6)
    ]
    absolute = ChangeTable(f"{tmp_path}/a")
    for batch, cnt in enumerate([2, 5]):
        absolute.write(counts_of(spark, (*ONE[:7], cnt)), batch)
    rows = absolute.changes(spark, 1).collect()
    assert sorted((r.kind, r.cnt) for r in rows) == [("+U", 5), ("-U", 2)]
    with pytest.raises(ValueError, match="adds batches up"):
        ChangeTable("unused", ttl_ms=1)


def test_versions_of_a_dictionary(spark):
    versions = spark.createDataFrame(
        [
            ("T", "P1", "E1", "first", None),
            ("T", "P1", "E1", "second", 100),
            ("T", "P1", "E1", "also second", 100),
            (None, "P1", "E1", "gone", 200),
            ("T", "P2", "E1", "late", 150),
        ],
        "fault_type_code string, smart_product_code string, fault_code string, fault_name string, s int",
    ).select("*", F.timestamp_seconds("s").alias("valid_from"))

    def named(at):
        rows = known_faults(dictionary_at(versions, at)).collect()
        return sorted(r["_name"] for r in rows)

    assert named(-1e9) == ["first"] and named(99.9) == ["first"]
    assert named(100) == ["also second", "second"]
    assert named(199) == ["also second", "late", "second"]
    assert named(200) == ["late"]
    faults = spark.createDataFrame(
        [(1, "P1", "1", 5), (2, "P1", "1", 100), (3, "P1", "1", 250), (4, "P2", "1", 149), (5, "P1", "1", None)],
        "requestId int, productKey string, fault_number string, s int",
    ).select("*", F.timestamp_seconds("s").alias("ts_ltz"))
    rows = lookup_faults_as_of(faults, versions).collect()
    assert sorted((r.requestId, r.fault_name) for r in rows) == [
        (1, "first"), (2, "also second"), (2, "second")
    ]


def test_ranges_of_a_table():
    assert range_predicates("c", []) == range_predicates("c", ["a"]) == ["1 = 1"]
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT * FROM (VALUES ('a'), ('b'), ('c''d'), ('e'), (NULL)) v(c)")
    conditions = range_predicates("c", ["a", "b", "b", "c'd"])
    assert len(conditions) == 3
    counts = [con.execute(f"SELECT count(*) FROM t WHERE {w}").fetchone()[0] for w in conditions]
    assert counts == [2, 1, 2]


def test_merge_statements():
    later = (
        "VALUES(v) > v OR (v IS NULL AND VALUES(v) IS NOT NULL) OR "
        "(VALUES(v) = v OR (VALUES(v) IS NULL AND v IS NULL))"
    )
    assert merge_statement("mysql", "t", "s", ["k", "w", "v"], ["k"], ["v"]) == (
        "INSERT INTO t (k, w, v) SELECT DISTINCT k, w, v FROM s ON DUPLICATE KEY UPDATE "
        f"w = IF({later}, VALUES(w), w), v = IF({later}, VALUES(v), v)"
    )
    assert merge_statement("mysql", "t", "s", ["k", "w"], ["k"], []) == (
        "INSERT INTO t (k, w) SELECT DISTINCT k, w FROM s ON DUPLICATE KEY UPDATE w = VALUES(w)"
    )
    later = (
        "EXCLUDED.v > t.v OR (t.v IS NULL AND EXCLUDED.v IS NOT NULL) OR "
        "(EXCLUDED.v = t.v OR (EXCLUDED.v IS NULL AND t.v IS NULL))"
    )
    assert merge_statement("postgresql", "t", "s", ["k", "l", "v"], ["k", "l"], ["v"]) == (
        "INSERT INTO t (k, l, v) SELECT DISTINCT k, l, v FROM s "
        f"ON CONFLICT (k, l) DO UPDATE SET v = EXCLUDED.v WHERE {later}"
    )
    assert merge_statement("ansi", "t", "s", ["k", "l", "v"], ["k", "l"], []) == (
        "MERGE INTO t t USING (SELECT DISTINCT k, l, v FROM s) s ON t.k = s.k AND t.l = s.l "
        "WHEN MATCHED THEN UPDATE SET v = s.v "
        "WHEN NOT MATCHED THEN INSERT (k, l, v) VALUES (s.k, s.l, s.v)"
    )
    whole = merge_statement("ansi", "t", "s")
    assert whole.count("last_ts") > 4 and "WHEN MATCHED AND (s.last_ts > t.last_ts" in whole
    with pytest.raises(ValueError, match="unknown dialect"):
        merge_statement("other", "t", "s")


def test_the_later_row_wins_whatever_the_order():
    """The merge condition, run by an engine of this process over all pairs of rows."""
    con = duckdb.connect()
    order = ["last_ts", "productKey", "optName"]
    values = list(product([1, 2], ["P1", "P2"], [None, "", "a"]))
    rows = ", ".join(str(v).replace("None", "NULL") for v in values)
    con.execute(f"CREATE TABLE r AS SELECT * FROM (VALUES {rows}) v(last_ts, productKey, optName)")
    found = con.execute(
        f"SELECT s.*, t.*, {_not_before('s.{}', 't.{}', order)} FROM r s, r t"
    ).fetchall()
    assert len(found) == len(values) ** 2
    rank = lambda row: (row[0], row[1], row[2] is not None, row[2] or "")
    for row in found:
        assert bool(row[6]) == (rank(row[:3]) >= rank(row[3:6]))


def test_jdbc_upsert_stages_before_it_merges(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(
        JdbcUpsert, "_stage", lambda self, rows: calls.append(("stage", rows.collect()))
    )
    sink = JdbcUpsert(
        "jdbc:x", "counts", "counts_staging", execute=lambda sql: calls.append(("run", sql))
    )
    sink.write(counts_of(spark, ONE).withColumn("last_ts", F.current_timestamp()), 0)
    (row,) = calls[0][1]
    assert tuple(row)[:-2] == ONE and row.staged_by.startswith("0-")
    assert calls[1:] == [
        ("run", merge_statement("mysql", "counts", "counts_staging", run=row.staged_by)),
        ("run", f"DELETE FROM counts_staging WHERE staged_by = '{row.staged_by}'"),
    ]


@pytest.mark.parametrize("dialect", ["postgresql", "ansi"])
def test_writers_that_stage_at_one_time_do_not_mix(spark, monkeypatch, dialect):
    """An older write that was overtaken, and one that failed before it merged."""
    con = duckdb.connect()
    names = ", ".join(f'{f.name} {"BIGINT" if f.name == "cnt" else "TIMESTAMP" if f.name == "last_ts" else "VARCHAR"}' for f in STORED)
    con.execute(f"CREATE TABLE counts ({names}, PRIMARY KEY (ds, iotId, eventName, optId))")
    con.execute(f"CREATE TABLE staging ({names}, staged_by VARCHAR)")

    def stage(self, rows):
        for r in rows.withColumn("last_ts", F.col("last_ts").cast("string")).collect():
            con.execute(f"INSERT INTO staging VALUES ({', '.join('?' * len(r))})", list(r))

    monkeypatch.setattr(JdbcUpsert, "_stage", stage)

    def write(cnt, second, execute=con.execute):
        sink = JdbcUpsert("jdbc:x", "counts", "staging", dialect, execute=execute)
        sink.write(timed(counts_of(spark, (*ONE[:7], cnt)), second), cnt)

    def fails(statement):
        raise RuntimeError("lost the driver")

    with pytest.raises(RuntimeError):
        write(99, 900, fails)
    waiting = []
    write(1, 100, waiting.append)  # staged, but another writer comes before its merge
    write(5, 500)
    assert con.execute("SELECT cnt FROM counts").fetchall() == [(5,)]
    for statement in waiting:
        con.execute(statement)
    assert con.execute("SELECT cnt FROM counts").fetchall() == [(5,)]
    write(7, 500)
    assert con.execute("SELECT cnt FROM counts").fetchall() == [(7,)]
    # Only what the failed write staged is left.
    assert con.execute("SELECT cnt FROM staging").fetchall() == [(99,)]


def test_jdbc_upsert_hides_its_secrets():
    assert "hidden" not in repr(JdbcUpsert("u", "t", "s", properties={"password": "hidden"}))


def test_analytic_table_appends(spark, tmp_path):
    sink = AnalyticTable("parquet", {"path": f"{tmp_path}/a"})
    sink.write(counts_of(spark, ONE), 0)
    sink.write(counts_of(spark, (*ONE[:7], 2)), 1)
    written = spark.read.parquet(f"{tmp_path}/a")
    assert written.columns == [
        "productkey",
        "iotid",
        "devicename",
        "event_name",
        "opt_id",
        "opt_name",
        "cnt",
    ]
    assert sorted(r.cnt for r in written.collect()) == [1, 2]
