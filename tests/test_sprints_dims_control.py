import datetime as dt
import json
import random
from decimal import Decimal

from pyspark.sql import functions as F

from dimwright.operators import control, dims, sprints
from tests.conftest import rows


def test_status_as_of_latest_before_close(spark):
    def hist(ts, to):
        return {"created": ts, "items": [{"field": "status", "fromString": "x", "toString": to}]}
    details = json.dumps({"changelog": {"histories": [
        hist("2024-01-01T10:00:00.000-0500", "Doing"), hist("2024-01-03T10:00:00.000-0500", "Review"),
        hist("2024-01-09T10:00:00.000-0500", "Done")]}})
    issues = spark.createDataFrame([
        ("T-1", 7, 1, details, True, None), ("T-2", 7, 1, json.dumps({"changelog": {"histories": []}}), True, None),
        ("T-3", 7, 1, details, False, None)],
        "jira_ticket_key string, sprint_number long, team_dim_id long, ticket_details string, is_active boolean, "
        "status_on_sprint_closure string")
    sprint = spark.createDataFrame([(7, dt.datetime(2024, 1, 5))], "sprint_number long, sprint_complete_date timestamp_ntz")
    out = sprints.status_as_of(issues, sprint)
    assert rows(out, "jira_ticket_key", "status_on_sprint_closure") == [("T-1", "Review"), ("T-2", "Open"), ("T-3", None)]


def test_epics_meet_by_a_column(spark):
    """No join compares ids that it parses from the issues as it goes."""
    docs = [json.dumps({"fields": {"epic": {"id": e}}}) for e in (3, "4", "x")] + [None, "no json", "{}"]
    issues = spark.createDataFrame([(i, d, True, None) for i, d in enumerate(docs)] + [(6, docs[0], False, None), (7, docs[0], True, 9)],
                                   "jira_ticket_id long, ticket_details string, is_active boolean, epic_dim_id long")
    epics = spark.createDataFrame([(3, 30), (4, 40)], "epic_id long, epic_dim_id long")
    out = sprints.link_epics(issues, epics)
    assert out.columns == issues.columns
    assert rows(out, "jira_ticket_id", "epic_dim_id") == [(0, 30), (1, 40), (2, None), (3, None), (4, None), (5, None), (6, None), (7, 9)]
    joins = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line]
    assert joins and not [j for j in joins if "get_json_object" in j]


def test_high_water_team_without_loaded_sprint(spark):
    team = spark.createDataFrame([(1, "a", 10, True), (2, "b", 20, True), (3, "c", 30, False)],
                                 "team_dim_id long, team_name string, jira_rapid_view_id long, is_active boolean")
    sprint = spark.createDataFrame([(5, 1, True), (9, 1, False), (4, 2, None)],
                                   "sprint_serial_id long, team_dim_id long, is_issues_loaded boolean")
    assert rows(sprints.sprint_high_water(team, sprint)) == [(0, 20, 2), (5, 10, 1)]


def test_headcount_matches_brute_force(spark):
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    members = []
    for u in range(60):
        start = base + dt.timedelta(hours=rnd.randint(0, 24 * 60))
        end = None if rnd.random() < 0.3 else start + dt.timedelta(hours=rnd.randint(1, 24 * 40))
        members.append((u, rnd.choice(["a", "b"]), start, end))
    sps = [(t, 1000 + i, base + dt.timedelta(days=7 * i), base + dt.timedelta(days=7 * i + 13))
           for i in range(10) for t in ("a", "b")]
    as_of = dt.datetime(2024, 4, 1)
    m = spark.createDataFrame(members, "user_dim_id long, team_dim_id string, team_entry_date timestamp_ntz, "
                                       "team_exit_date timestamp_ntz")
    s = spark.createDataFrame(sps, "team_dim_id string, sprint_number long, sprint_start_date timestamp_ntz, "
                                   "sprint_end_date timestamp_ntz")
    got = rows(sprints.headcount(m, s, "2024-04-01 00:00:00", bucket_days=3))
    expect = {}
    for t, n, st, en in sps:
        c = sum(1 for _, mt, e, x in members if mt == t and e < st and (x or as_of) > en)
        if c:
            expect[(t, n)] = c
    assert got == sorted((t, n, c) for (t, n), c in expect.items())


def test_insert_missing_users_marker(spark):
    users = spark.createDataFrame([(4, "bob", "Bob")], "jira_user_dim_id long, jira_user_id string, jira_user_name string")
    stage = spark.createDataFrame([("ann", "Ann [X]"), ("bob", "Bob"), (None, None)], "assignee string, assignee_name string")
    out = dims.insert_missing_users(users, stage)
    assert rows(out, "jira_user_dim_id", "jira_user_id", "jira_user_name", "is_active") == [
        (4, "bob", "Bob", None), (5, "None", None, True), (6, "ann", "Ann", False)]


def test_fuzzy_assign_tie(spark):
    child = spark.createDataFrame([(1, "Big Red Widget Pro", None), (2, "Other", None), (3, "red widget", 9)],
                                  "id long, name string, fk long")
    parent = spark.createDataFrame([(5, "red widget"), (2, "Widget"), (8, "nothing")], "pid long, pname string")
    one = dims.fuzzy_assign(child, parent, "id", "name", "fk", "pid", "pname")
    assert rows(one) == [(1, "Big Red Widget Pro", 2), (2, "Other", None), (3, "red widget", 9)]


def test_assign_department_priority(spark):
    users = spark.createDataFrame([(1, "acct1", "Disp One", None), (2, "x", "Disp Two", 0), (3, "y", "Nobody", 7)],
                                  "jira_user_dim_id long, jira_user_id string, jira_user_name string, department_dim_id long")
    mapping = spark.createDataFrame([("disp one", " ACCT1 ", "Sales"), ("disp one", None, "Ops"), ("DISP TWO", None, "Ops")],
                                    "displayname string, samaccountname string, department string")
    dept = spark.createDataFrame([(10, "Sales"), (11, "Ops")], "department_dim_id long, department_name string")
    out = dims.assign_department(users, mapping, dept)
    assert rows(out, "jira_user_dim_id", "department_dim_id") == [(1, 10), (2, 11), (3, 7)]


def test_upsert_products(spark):
    dim = spark.createDataFrame([(1, "Old name", "10"), (2, "Same", "11")],
                                "jira_product_dim_id long, jira_product_name string, jira_product_api_id string")
    src = spark.createDataFrame([("New name", "10"), ("Same", "11"), ("Fresh", "12")], "product_name string, api_id string")
    assert rows(dims.upsert_products(dim, src)) == [(1, "New name", "10"), (2, "Same", "11"), (3, "Fresh", "12")]


def test_run_state_failure_propagates(spark):
    t = [dt.datetime(2024, 1, 1, h) for h in range(6)]
    log = spark.createDataFrame([
        (1, None, "main", "IN-PROGRESS", t[0]), (1, 10, "load", "IN-PROGRESS", t[1]), (1, 10, "load", "FAILED", t[2]),
        (2, None, "main", "IN-PROGRESS", t[0]), (2, None, "main", "SUCCESS", t[5]), (2, 20, "load", "SUCCESS", t[3])],
        "audit_id long, audit_details_id long, task_name string, status string, event_time timestamp_ntz")
    st = control.run_state(log)
    assert rows(st, "audit_id", "audit_details_id", "status") == [
        (1, 10, "FAILED"), (1, None, "FAILED"), (2, 20, "SUCCESS"), (2, None, "SUCCESS")]
    wm = control.last_success(st.withColumn("product_name", F.lit("JIRA")), "JIRA")
    assert wm.first()[0] == t[0]


def test_incremental_and_checks(spark):
    df = spark.createDataFrame([(1, "2023-12-31T10:00:00.000-0500", None), (2, "2024-01-05T10:00:00.000-0500", None)],
                               "id long, created string, updated string")
    none = spark.createDataFrame([(None,)], "watermark timestamp_ntz")
    assert control.incremental(df, none).count() == 2
    wm = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23, 0),)], "watermark timestamp_ntz")
    assert rows(control.incremental(df, wm), "id") == [(2,)]
    spark.range(5).createOrReplaceTempView("dw_five")
    out = control.run_checks(spark, [control.Check("five", "select count(*) from dw_five", 5),
                                     control.Check("none", "select id from dw_five where id < 0", 1)])
    assert rows(out, "condition", "actual_value", "status") == [("five", 5, "Success"), ("none", 0, "Fail")]


def test_origins_two_codes_two_members(spark):
    dim = spark.createDataFrame([(1, "Email", 2)], "jira_origin_dim_id long, jira_origin_name string, source_case_origin_id long")
    inc = spark.createDataFrame([("Phone", 1), ("Phone", 3), (None, None), ("Email", 9)],
                                "caseorigincodename string, caseorigincode int")
    out = dims.insert_missing_origins(dim, inc)
    assert rows(out) == [(1, "Email", 2), (2, "None", 0), (3, "Phone", 1), (4, "Phone", 3)]


def test_upsert_statuses_update_then_insert(spark):
    dim = spark.createDataFrame([(1, "Open", False, None), (2, " Done ", False, 7)],
                                "jira_status_dim_id long, jira_status string, is_workflow_status boolean, jira_api_id long")
    wf = spark.createDataFrame([("Open", 10, True), ("Done", 11, False), ("Review", None, True)],
                               "status string, id long, flag boolean")
    out = dims.upsert_statuses(dim, wf)
    assert rows(out) == [(1, "Open", True, 10), (2, " Done ", False, 11), (3, "Review", True, 0)]


def test_not_in_names_blocked_by_null_member(spark):
    dim = spark.createDataFrame([(1, None)], "department_dim_id long, department_name string")
    src = spark.createDataFrame([("Sales",)], "department string")
    out = dims.insert_missing_names(dim, F.col("department"), src, "department_name", "department_dim_id",
                                    null_aware=True, default_null=False)
    assert out.count() == 1


def test_active_teams_and_staged_keys(spark):
    from dimwright.operators import transitions
    team = spark.createDataFrame([(1, "A", 10, True), (2, "B", 20, False), (3, "C", 30, None)],
                                 "team_dim_id long, team_name string, jira_rapid_view_id long, is_active boolean")
    assert rows(sprints.active_teams(team)) == [(1, "A", 10)]
    stage = spark.createDataFrame([("K1",), ("K1",), ("K2",)], "key string")
    assert rows(transitions.staged_keys(stage)) == [("K1",), ("K2",)]


def test_points_from_stored_issues(spark):
    issue = lambda p, r: json.dumps({"fields": {"customfield_10411": p, "resolutiondate": r}})
    at = "2024-01-05T10:00:00.000-0500"
    texts = [issue(2.5, at), issue("3", at), issue(None, at), issue("many", at), issue(4, "soon"), issue(8, None), "{}", "no json", None]
    issues = spark.createDataFrame([(i, 1, t) for i, t in enumerate(texts)], "sprint_number long, team_dim_id long, ticket_details string")
    got = sprints.issue_points(issues).orderBy("sprint_number").collect()
    assert [None if r.points is None else float(r.points) for r in got] == [2.5, 3, None, None, 4, 8, None, None, None]
    assert [r.resolution_date and r.resolution_date.hour for r in got] == [10, 10, 10, 10, None, None, None, None, None]


def test_only_touched_sprints_get_measures(spark):
    d = lambda n: dt.datetime(2024, 1, n)
    issue = json.dumps({"fields": {"customfield_10411": 5, "resolutiondate": "2024-01-03T00:00:00.000"}})
    summary = spark.createDataFrame([(1, 1, d(1), d(9), Decimal(7), 70), (2, 1, d(1), d(9), None, None), (3, 1, d(1), d(9), Decimal(9), 90)],
                                    "sprint_number long, team_dim_id long, sprint_start_date timestamp_ntz, sprint_end_date timestamp_ntz, "
                                    "non_maintenance_feature_points decimal(38,6), number_of_devs long")
    issues = spark.createDataFrame([(s, 1, issue, True, m) for s, m in ((1, False), (2, False), (2, False), (2, True))],
                                   "sprint_number long, team_dim_id long, ticket_details string, is_active boolean, is_maintenance boolean")
    members = spark.createDataFrame([(u, 1, dt.datetime(2023, 1, 1), None) for u in (1, 2)],
                                    "user_dim_id long, team_dim_id long, team_entry_date timestamp_ntz, team_exit_date timestamp_ntz")
    touched = spark.createDataFrame([(2, 1), (2, 1), (3, 1), (4, 1)], "sprint_number long, team_dim_id long")
    out = sprints.store_measures(summary, issues, members, touched, "2024-02-01 00:00:00")
    assert rows(sprints.sprint_measures(out)) == [(1, 1, 7, 70), (2, 1, 10, 2), (3, 1, 0, 2)]
    assert rows(sprints.sprint_measures(sprints.store_measures(summary, issues, members, summary, "2024-02-01 00:00:00"))) == [(1, 1, 5, 2), (2, 1, 10, 2), (3, 1, 0, 2)]


def test_checks_from_a_table_scan_each_table_once(spark):
    t = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "k long, v string")
    spec = [("t", "rows", "count(*)", None, 3), ("t", "keys", "count(distinct k)", "v is not null", 1), ("t", "none", "max(k)", "k > 9", 0), ("gone", "rows", "count(*)", None, 0)]
    out = control.run_check_table(spark.createDataFrame(spec, control.CHECK_T), {"t": t})
    assert rows(out, "condition", "actual_value", "status") == [("keys", 1, "Success"), ("none", 0, "Success"), ("rows", 3, "Success"), ("rows", None, "Fail")]
    assert control.run_check_table(spark.createDataFrame([], control.CHECK_T), {}).collect() == []
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    both = [("o", "rows", "count(*)", None, 1500), ("o", "open", "count(*)", "o_orderstatus = 'O'", 0), ("o", "customers", "count(distinct o_custkey)", None, 0)]
    plan = control.run_check_table(spark.createDataFrame(both, control.CHECK_T), {"o": o})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
