"""Cases that the registered queries cannot reach: empty dimensions, repeated log rows, failed runs, null dates, broken pages."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from dimwright.functions.text import option_ids
from dimwright.operators import control, dims, facts, sprints
from dimwright.operators.keys import assign_keys
from dimwright.sources import landed
from tests.conftest import rows

T = dt.datetime


def test_not_in_an_empty_dimension_inserts_the_null_as_none(spark):
    empty = spark.createDataFrame([], "name string, id long")
    src = spark.createDataFrame([("a",), (None,)], "n string")
    out = dims.insert_missing_names(empty, F.col("n"), src, "name", "id", null_aware=True, default_null=False)
    assert sorted(r.name for r in out.collect()) == ["None", "a"]
    full = spark.createDataFrame([("b", 1)], "name string, id long")
    out = dims.insert_missing_names(full, F.col("n"), src, "name", "id", null_aware=True, default_null=False)
    assert sorted(r.name for r in out.collect()) == ["a", "b"]


def test_failed_sub_task_ends_its_run_and_product_is_carried(spark):
    log = spark.createDataFrame([
        (1, None, "run", "IN-PROGRESS", T(2024, 1, 1), "X"), (1, 7, "part", "IN-PROGRESS", T(2024, 1, 2), "X"),
        (1, 7, "part", "FAILED", T(2024, 1, 3), "X"), (2, None, "run", "SUCCESS", T(2024, 1, 4), "X"),
        (3, None, "run", "SUCCESS", T(2024, 1, 9), "Y")],
        "audit_id long, audit_details_id long, task_name string, status string, event_time timestamp_ntz, product_name string")
    state = control.run_state(log)
    assert rows(state.filter("audit_details_id is null and audit_id = 1"), "status", "end_date") == [("FAILED", T(2024, 1, 3))]
    assert control.last_success(state, "X").first()[0] == T(2024, 1, 4)


def test_headcount_with_null_backward_and_far_dates(spark):
    members = spark.createDataFrame([(1, "t", T(2024, 1, 1), None), (2, "t", T(2024, 1, 1), T(9999, 12, 31)), (3, "t", T(2024, 1, 9), T(2024, 1, 30))],
                                    "user_dim_id long, team_dim_id string, team_entry_date timestamp_ntz, team_exit_date timestamp_ntz")
    sp = spark.createDataFrame([("t", 1, T(2024, 1, 8), T(2024, 1, 15)), ("t", 2, T(2024, 1, 8), None), ("t", 3, None, None),
                                ("t", 4, T(2024, 1, 20), T(2024, 1, 10))],
                               "team_dim_id string, sprint_number long, sprint_start_date timestamp_ntz, sprint_end_date timestamp_ntz")
    assert rows(sprints.headcount(members, sp, T(2024, 2, 1)), "sprint_number", "no_of_devs") == [(1, 2), (4, 3)]


def test_headcount_pairs_no_member_with_a_sprint(spark):
    """Many stays at few times, so that equal times, several digits and many buckets occur."""
    rnd = random.Random(3)
    day = lambda lo, hi: T(2024, 1, 1) + dt.timedelta(hours=12 * rnd.randint(lo, hi))
    team = lambda: rnd.choice(["a"] * 8 + ["b", None])
    stays = [(rnd.choice([u, 1, None]), team(), rnd.choice([day(0, 60), day(0, 60), None]), rnd.choice([day(0, 90), None])) for u in range(500)]
    sps = [(team(), rnd.choice([None, *range(80)]), day(0, 70), rnd.choice([day(0, 90), day(0, 90), None])) for _ in range(150)]
    members = spark.createDataFrame(stays, "user_dim_id long, team_dim_id string, team_entry_date timestamp_ntz, team_exit_date timestamp_ntz")
    sp = spark.createDataFrame(sps, "team_dim_id string, sprint_number long, sprint_start_date timestamp_ntz, sprint_end_date timestamp_ntz")
    out, as_of = sprints.headcount(members, sp, "2024-02-01 00:00:00"), T(2024, 2, 1)
    want = {}
    for t, n, start, end in sps:
        met = [u for u, of, entry, exit_ in stays if t and of == t and entry and end and entry < start and (exit_ or as_of) > end]
        if met:
            want[t, n] = want.get((t, n), 0) + sum(u is not None for u in met)
    assert len(want) > 40 and {(r.team_dim_id, r.sprint_number): r.no_of_devs for r in out.collect()} == want
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.split("\n") if "Join " in line and re.search(" [<>]=? ", line)]


def test_first_row_per_key_follows_the_page(spark):
    pages = spark.createDataFrame([(2, '[{"key":"u","displayName":"late"}]'), (1, '[{"key":"x"},{"key":"u","displayName":"early"}]')], "page int, value string")
    assert rows(landed.read_users(pages, page="page").filter("user_id = 'u'"), "user_name") == [("early",)]


def test_a_truncated_page_stops_the_run(spark):
    pages = spark.createDataFrame([('[{"key":"u"}]',), ('[{"key":"u"',)], "value string")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        landed.read_users(pages).collect()


def test_keys_of_an_empty_set(spark):
    assert assign_keys(spark.createDataFrame([], "k string"), ["k"], "key").collect() == []


def test_match_codes_equal_the_least_over_matched_contacts(spark):
    """Every pairing of present, blank, unknown and null ids and emails, with many blank contacts."""
    texts = ["g1", " g1 ", "zz", "", " ", None]
    st = [(f"{i}.{j}", g, m) for i, g in enumerate(texts) for j, m in enumerate(["e1", " e1 ", "zz", "", None])]
    base = [("g1", "e9"), ("g9", "e1")]
    for contacts in (base, base + [("g5", "")] * 50, base + [("", None)] * 50, base + [(None, "e1"), (" ", " ")]):
        want = []
        for k, g, m in st:
            g_, m_ = (None if x is None else x.strip(" ") for x in (g, m))
            met = [(c, e) for c, e in contacts if (c is not None and c.strip(" ") == g_) or (e is not None and e.strip(" ") == m_)]
            codes = []
            for c, e in met or [(None, None)]:
                mail = 2 if not m_ else 6 if e is not None and e.strip(" ") == m_ else 4
                codes.append(1 if c is not None and c.strip(" ") == g_ else mail + bool(g_))
            want.append((k, min(codes)))
        s = spark.createDataFrame(st, "key_stage string, crm_contact_stage string, reporter_email_stage string")
        c = spark.createDataFrame([(i, *x) for i, x in enumerate(contacts)], "contact_dim_id long, contactid string, emailaddress string")
        assert rows(facts.match_codes(s, c)) == sorted(want)


def test_fuzzy_assign_equals_like(spark):
    names = ["red widget pro", "Red  Widget", "a_b", "a%b", "aXb", "x", "", "widg", None, "back\\slash", "100% wool", "other"]
    patterns = ["Red Widget", "widget", "w", "a_b", "a%b", " ", "", "x", "zz", "k\\\\s", "% w", None, "__", "dg"]
    child = spark.createDataFrame([(i, n, None) for i, n in enumerate(names)], "id long, name string, fk long")
    parent = spark.createDataFrame([(i + 1, p) for i, p in enumerate(patterns)], "pid long, pname string")
    for kept in (parent, parent.filter("pname not in ('', ' ')"), parent.filter("length(pname) > 2")):
        got = rows(dims.fuzzy_assign(child, kept, "id", "name", "fk", "pid", "pname"), "id", "fk")
        pairs = child.crossJoin(kept).filter("lower(name) like concat('%', lower(replace(pname, ' ', '%')), '%')")
        best = {r.id: r.fk for r in pairs.groupBy("id").agg(F.min("pid").alias("fk")).collect()}
        assert got == [(i, best.get(i)) for i in range(len(names))]


def test_option_objects_and_rendered_options(spark):
    page = ('{"issues":[{"key":"A-1","fields":{"customfield_11809":{"value":"Mail","id":"3"},"customfield_11813":"Question",'
            '"customfield_13609":[{"self":"u","value":"id=\'9\'>","id":"10"},{"value":"B","id":"11"}]}},'
            '{"key":"A-2","fields":{"customfield_13609":"[<O: value=\'A\', id=\'12\'>]"}},{"key":"A-3","fields":{"customfield_13609":[]}}]}')
    stage = landed.flatten_issues(landed.read_issue_pages(spark.createDataFrame([(page,)], "value string")))
    got = stage.select("key", "channel", "request_type", option_ids("product_name").alias("ids")).orderBy("key").collect()
    assert [tuple(r) for r in got] == [("A-1", "Mail", "Question", ["10", "11"]), ("A-2", None, None, ["12"]), ("A-3", None, None, [])]
