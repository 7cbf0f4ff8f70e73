"""Dated lists against a plain replay of their events for every capture."""

import datetime as dt
import random
from urllib.parse import urlsplit

from compare import differences, duck
from llm.cases import TINY

from barlake.llm.queries import OP10_SQL, op10_temporal_lists
from barlake.llm.temporal_lists import judge, lookup_values, url_host, url_path, validity

DAY = [dt.datetime(2024, 1, 1) + dt.timedelta(days=k) for k in range(40)]
CAPTURE = "capture_id long, url string, fetched_at timestamp"
EVENT = "list_name string, verdict string, value string, action string, dated timestamp"


def replayed(captures, events):
    """capture_id: (blocked, n_entries, lists, value) by going through all events for each capture."""
    out = {}
    for capture, url, at in captures:
        state = {}
        for name, verdict, value, action, dated in sorted(events, key=lambda e: (e[4], e[3] == "add")):
            if at is not None and dated <= at:
                state[name, verdict, value] = action == "add"
        parts = urlsplit(url or "")
        host, steps = parts.hostname or "", [s for s in parts.path.split("/") if s]
        full = "/".join([host, *steps])
        active = [
            (len(v), verdict == "allow", v, name)
            for (name, verdict, v), on in state.items()
            if on and host and (v == host or host.endswith("." + v) or full == v or full.startswith(v + "/"))
        ]
        top = max(active, default=None)
        out[capture] = (bool(top and not top[1]), len(active), sorted({a[3] for a in active}), top and top[2])
    return out


def collected(frame):
    return {r.capture_id: (r.blocked, r.n_entries, r.lists, r.verdict_value) for r in frame.collect()}


def test_any_history(spark):
    rng = random.Random(11)
    hosts = ["a.com", "b.a.com", "c.b.a.com", "x.org", "deep.x.org", "a.com.evil.net"]
    values = [*hosts, "com", "a.com/p", "a.com/p/q", "x.org/p", "b.a.com/p/q/r", "evil.net"]
    events = [
        (rng.choice("LM"), rng.choice(["block", "block", "allow"]), rng.choice(values), rng.choice(["add", "add", "remove"]), rng.choice(DAY))
        for _ in range(150)
    ]
    captures = [
        (k, f"http{rng.choice(['', 's'])}://{rng.choice(hosts)}{rng.choice(['', '/', '/p', '/p/', '/p/q?x=/p', '/pq', '/p/q/r#a', '//p'])}", rng.choice([*DAY, None]))
        for k in range(400)
    ] + [(1000, None, DAY[5]), (1001, "", DAY[5]), (1002, "no url", DAY[5]), (1003, "mailto:x@a.com", DAY[5])]
    got = collected(judge(spark.createDataFrame(captures, CAPTURE), spark.createDataFrame(events, EVENT)))
    assert got == replayed(captures, events)


def test_intervals(spark):
    events = [
        ("L", "block", "A.com/", "add", DAY[1]),
        ("L", "block", "a.com", "add", DAY[2]),  # already active
        ("L", "block", "a.com", "remove", DAY[4]),
        ("L", "block", "a.com", "remove", DAY[5]),  # already gone
        ("L", "block", "a.com", "add", DAY[7]),
        ("L", "block", "a.com", "remove", DAY[7]),  # at the same time, the add wins
        ("L", "block", "a.com", "add", DAY[7]),
        ("L", "block", None, "add", DAY[1]), (None, "block", "a.com", "add", DAY[1]), ("L", "maybe", "a.com", "add", DAY[1]),
        ("L", "block", "a.com", "drop", DAY[1]), ("L", "block", "a.com", "add", None), ("L", "block", " ", "add", DAY[1]),
    ]
    got = sorted((r.value, r.valid_from, r.valid_to.year) for r in validity(spark.createDataFrame(events, EVENT)).collect())
    assert got == [("a.com", DAY[1], 2024), ("a.com", DAY[7], 9999)]
    captures = [(k, "http://www.a.com/x", DAY[k]) for k in range(9)]
    blocked = collected(judge(spark.createDataFrame(captures, CAPTURE), spark.createDataFrame(events, EVENT)))
    assert [k for k in range(9) if blocked[k][0]] == [1, 2, 3, 7, 8]


def test_hosts_and_paths(spark):
    from pyspark.sql import functions as F

    cases = {
        "HTTP://User:pw@WWW.Example.COM.:8080/A/b//c/?q=/z#f": ("www.example.com", "/A/b//c"),
        "https://[::1]:80/x": ("[::1]", "/x"),
        "ftp://h": ("h", ""),
        "http:///path": (None, "/path"),
        "//h/x": (None, ""),
        "x": (None, ""),
    }
    frame = spark.createDataFrame([(u,) for u in cases], "url string").select("url", url_host(F.col("url")).alias("h"), url_path(F.col("url")).alias("p"))
    assert {r.url: (r.h, r.p) for r in frame.collect()} == cases
    values = frame.select(lookup_values(F.col("h"), F.col("p")).alias("v")).first().v
    assert values == ["www.example.com", "example.com", "com", "www.example.com/A", "www.example.com/A/b", "www.example.com/A/b/c"]


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    rows = [(1, "http://a.com/", DAY[3], "x", 1), (1, "http://a.com/", DAY[3], "y", 2), (None, "http://a.com", DAY[3], "z", 3), (2, "http://b.com", DAY[3], "z", 3)]
    captures = spark.createDataFrame(rows, CAPTURE + ", value string, blocked int")
    events = spark.createDataFrame([("L", "block", "a.com", "add", DAY[1], "x")], EVENT + ", url string")
    got = collected(judge(captures, events))
    assert got.keys() == {1, None, 2} and got[None][:2] == (True, 1) and got[1][0] and got[2] == (False, 0, [], None)


def test_every_capture_has_its_own_row(spark):
    """Captures of one id, fetched again later or of another URL, without an id, and equal rows."""
    a, b = "http://a.com/", "http://b.com/"
    rows = [(1, a, DAY[1]), (1, a, DAY[3]), (1, b, DAY[3]), (None, a, DAY[3]), (None, b, DAY[3]), (2, a, DAY[5]), (2, a, DAY[5]), (2, a, None), (3, None, DAY[3])]
    events = spark.createDataFrame([("L", "block", "a.com", "add", DAY[2])], EVENT)
    got = judge(spark.createDataFrame(rows, CAPTURE), events).collect()
    found = [(r.capture_id, r.blocked, r.n_entries, r.verdict_value) for r in got]
    blocked = (True, 1, "a.com")
    free = (False, 0, None)
    expected = [(1, *free), (1, *blocked), (1, *free), (None, *blocked), (None, *free), (2, *blocked), (2, *blocked), (2, *free), (3, *free)]
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_empty_tables(spark):
    captures = spark.createDataFrame([(1, "http://a.com/", DAY[3])], CAPTURE)
    events = spark.createDataFrame([("L", "block", "a.com", "add", DAY[1])], EVENT)
    assert judge(captures.limit(0), events).count() == 0
    assert collected(judge(captures, events.limit(0))) == {1: (False, 0, [], None)}


def test_no_python_in_the_plan(spark):
    plan = op10_temporal_lists(spark, TINY)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_query_equals_sql(spark):
    assert differences(op10_temporal_lists(spark, TINY), duck(TINY), OP10_SQL) is None
