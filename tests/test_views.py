from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from hearthlog.operators.counts import last_write_per_key, sink_key_collisions
from hearthlog.plans import sql_views
from hearthlog.plans.daily_counts import daily_operation_counts, daily_operation_counts_union
from hearthlog.plans.views import fault_events, operation_events, recipe_events, working_mode_events
from hearthlog.schemas import DAILY_COUNT, OPERATION_EVENT


def error(new, old="0", **more):
    return {
        "eventName": "ErrorCode",
        "eventValue": f"ErrorCode:{new}",
        "eventOriValue": f"ErrorCode:{old}",
        **more,
    }


MODES = [
    ("StOvMode", "StOvMode:2", ["2"]),
    ("StOvMode", "StOvMode:0", []),
    ("StOvMode", "StOvMode:", [""]),
    ("StOvMode", "StOvMode", []),
    ("StOvMode", "StOvMode:2,MultiStageName:", ["2"]),
    ("StOvMode", "StOvMode:2,MultiStageName", ["2"]),
    ("StOvMode", "StOvMode:2,MultiStageName:soup", []),
    ("LStOvMode", "LStOvMode:2", []),
    ("LStOvMode", "LStOvMode:2,StOvMode:7", ["7"]),
    ("RStOvMode", "RStOvMode:2,StOvMode:0", []),
    ("RStOvMode", "RStOvMode:2,StOvMode:4", ["4"]),
    ("StOvMode", "StOvMode:1,StOvMode:2", ["2"]),
    ("StOvMode", " StOvMode:2", []),
    ("stovmode", "StOvMode:2", []),
    ("StOvMode", None, []),
]
RECIPES = [
    ("MultiStageName", "MultiStageName:soup", ["soup"]),
    ("MultiStageName", "MultiStageName:a:b", ["a:b"]),
    ("MultiStageName", "MultiStageName:", []),
    ("MultiStageName", "MultiStageName", []),
    ("MultiStageName", "Other:1", []),
    ("MultiStageName", None, []),
    ("MultiStageName", "MultiStageName:0", ["0"]),
]


def found_ids(view, log_of, cases):
    """The rows of a view per case, in one run: each case is a device of its own."""
    log = log_of(
        *({"iotId": str(i), "eventName": n, "eventValue": v} for i, (n, v, _) in enumerate(cases))
    )
    rows = view(log).collect()
    return [
        [(r.eventName, r.optId, r.optName) for r in rows if r.iotId == str(i)]
        for i in range(len(cases))
    ]


def test_working_modes(log_of):
    assert found_ids(working_mode_events, log_of, MODES) == [
        [("StOvMode", e, None) for e in expected] for _, _, expected in MODES
    ]


def test_recipes(log_of):
    assert found_ids(recipe_events, log_of, RECIPES) == [
        [("MultiStageName", e, e) for e in expected] for _, _, expected in RECIPES
    ]


DICTIONARY = [
    ("T", "P1", "E1", "one"),
    (None, "P1", "E2", "untyped"),
    ("T", "P1", "E3", "three"),
    ("U", "P1", "E3", "three"),
    ("T", "P2", "E4", "other product"),
    ("T", "P1", "e5", "lower case"),
    ("T", "P1", "E6", "six"),
    ("T", "P1", "E6", "six again"),
    ("T", "P1", "E7", None),
    ("T", None, "E8", "no product"),
]


@pytest.mark.parametrize("broadcast", [True, False, None])
def test_fault_lookup(log_of, dictionary_of, broadcast):
    log = log_of(error(255), error(1, productKey="P9"), error("x"), error(1, 1))
    rows = fault_events(log, dictionary_of(*DICTIONARY), broadcast).collect()
    assert sorted((r.optId, r.optName or "") for r in rows) == [
        ("E1", "one"),
        ("E3", "three"),
        ("E3", "three"),
        ("E6", "six"),
        ("E6", "six again"),
        ("E7", ""),
    ]


def test_fault_lookup_can_ignore_case(log_of, dictionary_of):
    log = log_of(error(16), error(16, productKey="p1"))
    dictionary = dictionary_of(*DICTIONARY, ("T", "p1", "e5", "lower case"))
    rows = fault_events(log, dictionary, normalize=F.upper).collect()
    assert [r.optId for r in rows] == ["e5"] * 4
    for broadcast in (True, False):
        counts = daily_operation_counts(log, dictionary, broadcast, normalize=F.upper)
        assert sorted((r.productKey, r.optId, r.cnt) for r in counts.collect()) == [
            ("P1", "e5", 2),
            ("p1", "e5", 2),
        ]


@pytest.fixture
def edge_log(log_of):
    rows = [{"eventName": n, "eventValue": v} for n, v, _ in MODES + RECIPES]
    rows += [error(255), error(255, iotId=None), error("x"), error(5, "y"), error(1, gmtCreate=None)]
    for missing in ("productKey", "iotId", "deviceName", "gmtCreate", "eventOriValue"):
        rows += [
            {"eventName": "StOvMode", "eventValue": "StOvMode:2", missing: None},
            {"eventName": "MultiStageName", "eventValue": "MultiStageName:soup", missing: None},
            error(7, **{missing: None}),
        ]
    rows += [error("３"), error(1, gmtCreate=1667491200000000)]
    rows += [error(2**62 + 1), {"eventName": "Temp", "eventValue": "Temp:1"}, {"eventName": None}]
    rows += [error(1, productKey=None), error(1, deviceName=None)]
    return log_of(*rows, *rows, *({**r, "gmtCreate": 1667600000000} for r in rows))


def bag(frame):
    return sorted(map(repr, frame.select(*DAILY_COUNT.names).collect()))


def test_every_form_of_the_counts_agrees_on_edge_rows(spark, edge_log, dictionary_of):
    dictionary = dictionary_of(*DICTIONARY, ("T", "P1", "E63", "top"), ("T", "P1", "E64", "spurious"))
    union = bag(daily_operation_counts_union(edge_log, dictionary))
    assert union
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for broadcast in (True, False, None):
            assert bag(daily_operation_counts(edge_log, dictionary, broadcast)) == union
            assert bag(daily_operation_counts_union(edge_log, dictionary, broadcast)) == union
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    sql_views.register_functions(spark)
    sql_views.register_views(spark, edge_log, dictionary)
    assert bag(spark.sql(sql_views.DAILY_OPERATION_COUNTS)) == union
    assert bag(spark.table("daily_operation_counts")) == union


def test_counts_do_not_depend_on_the_ansi_mode(spark, edge_log, dictionary_of):
    dictionary = dictionary_of(*DICTIONARY)
    strict = bag(daily_operation_counts(edge_log, dictionary))
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert bag(daily_operation_counts(edge_log, dictionary)) == strict
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_schemas(log_of, dictionary_of):
    log, dictionary = log_of(error(1)), dictionary_of(*DICTIONARY)
    operations = operation_events(log, dictionary)
    assert [(f.name, f.dataType) for f in operations.schema] == [
        (f.name, f.dataType) for f in OPERATION_EVENT
    ]
    for counts in (
        daily_operation_counts(log, dictionary),
        daily_operation_counts(log, dictionary, broadcast=False),
        daily_operation_counts_union(log, dictionary),
    ):
        assert [(f.name, f.dataType) for f in counts.schema] == [
            (f.name, f.dataType) for f in DAILY_COUNT
        ]


def test_days_are_counted_apart(log_of, dictionary_of):
    mode = {"eventName": "StOvMode", "eventValue": "StOvMode:1"}
    log = log_of(mode, mode, {**mode, "gmtCreate": 1667600000000})
    counts = daily_operation_counts(log, dictionary_of(*DICTIONARY)).collect()
    assert sorted((r.ds, r.cnt) for r in counts) == [("2022-11-03", 2), ("2022-11-04", 1)]


@pytest.mark.parametrize("broadcast", [True, False])
def test_last_write_wins_on_a_shared_key(log_of, dictionary_of, broadcast):
    mode = {"eventName": "StOvMode", "eventValue": "StOvMode:1"}
    later = {**mode, "productKey": "P0", "gmtCreate": 1667491200001}
    log = log_of(mode, mode, mode, later, {**mode, "iotId": "iot2"})
    counts = daily_operation_counts(log, dictionary_of(*DICTIONARY), broadcast, last_event=True)
    kept = last_write_per_key(counts).collect()
    assert sorted((r.iotId, r.productKey, r.cnt, r.overwritten) for r in kept) == [
        ("iot1", "P0", 1, 1),
        ("iot2", "P1", 1, 0),
    ]
    shared = sink_key_collisions(counts).collect()
    assert [(r.iotId, r.groups, r.total_cnt) for r in shared] == [("iot1", 2, 4)]
