import json

from pyspark.sql import functions as F

from dimwright.sources import landed
from tests.conftest import rows


def _item(field, frm, to, fs, ts):
    return {"field": field, "from": frm, "to": to, "fromString": fs, "toString": ts}


def test_issue_page_and_changelog(spark):
    issue = {"id": "1", "key": "SD-1", "fields": {"created": "2024-01-01T08:00:00.000-0500",
                                                  "assignee": None, "status": {"name": "Open"}},
             "changelog": {"histories": [
                 {"created": "2024-01-02T08:00:00.000-0500",
                  "items": [_item("status", "1", "2", "Open", "Doing"), _item("status", "2", "3", "Doing", "Done")]},
                 {"created": "2024-01-03T08:00:00.000-0500", "items": [_item("assignee", None, "u2", None, "User 2")]},
                 {"created": "2024-01-04T08:00:00.000-0500", "items": [_item("comment", None, None, None, None)]},
                 {"created": "2024-01-05T08:00:00.000-0500", "items": []}]}}
    page = json.dumps({"startAt": 0, "total": 1, "issues": [issue]})
    issues = landed.read_issue_pages(spark.createDataFrame([(page,)], "value string"))
    flat = landed.flatten_issues(issues)
    assert flat.first()["assignee"] is None and len(flat.columns) == 27
    log = landed.flatten_changelog(issues)
    got = rows(log, "hist_pos", "to_status", "from_status", "to_id", "from_id", "to_user", "from_user")
    assert got == [(0, "Done", "Doing", "3", "2", "0", "0"), (1, "0", "0", "0", "0", "u2", "0")]


def test_statuses_users_products(spark):
    wf = json.dumps([{"name": "Bug", "statuses": [{"name": "Open", "id": "1"}, {"name": "Done", "id": "3"}]},
                     {"name": "Task", "statuses": [{"name": "Open again", "id": "1"}]}])
    res = json.dumps([{"name": "Closed", "id": "9"}, {"name": "Fixed", "id": "8"}])
    s = landed.union_statuses(landed.read_workflow_statuses(spark.createDataFrame([(wf,)], "value string")),
                              landed.read_resolutions(spark.createDataFrame([(res,)], "value string")))
    assert rows(s, "id", "status", "flag") == [(1, "Open", True), (3, "Done", True), (8, "Fixed", False)]
    users = json.dumps([{"key": "a", "displayName": "A", "emailAddress": "a@x", "active": True},
                        {"key": "a", "displayName": "A2", "emailAddress": "a@y", "active": False}])
    assert rows(landed.read_users(spark.createDataFrame([(users,)], "value string")), "user_id", "user_name") == [("a", "A")]
    prod = json.dumps({"projects": [{"issuetypes": [
        {"fields": {"customfield_13609": {"allowedValues": [{"value": "P1", "id": "10"}, {"value": "P1", "id": "10"}]}}},
        {"fields": {}}]}]})
    assert rows(landed.read_products(spark.createDataFrame([(prod,)], "value string"))) == [("P1", "10")]


def test_department_lines_and_serials(spark):
    lines = spark.createDataFrame([("Ann|ann||",), ("Bob||Sales",)], "value string")
    got = rows(landed.parse_department_lines(lines))
    assert got == [("Ann", "ann", None), ("Bob", None, "Sales")]
    sp = spark.createDataFrame([(11, "s11", 5, 0), (12, "s12", 6, 1), (13, "s13", 5, 2)],
                               "sprint_number long, sprint_name string, originBoardId long, pos long")
    out = landed.number_sprints(sp, ["pos"], 100, 5, team_dim_id=3)
    # serial counts every listed sprint, then the other board's sprint is dropped
    assert rows(out, "sprint_number", "sprint_serial_id") == [(11, 101), (13, 103)]


def test_department_csv_file_and_table_reads(spark, tmp_path):
    f = tmp_path / "mapping.csv"
    f.write_text("displayName,SamAccountName,Department\nAnn Lee,alee,Support\nBob Roe,,\n")
    got = rows(landed.read_department_csv(spark, str(f)))
    assert got == [("Ann Lee", "alee", "Support"), ("Bob Roe", None, None)]
    path = landed.write_stage(spark.range(4).withColumn("x", F.col("id") * 2), str(tmp_path / "stage"), 7)
    assert path.endswith("run_id=7")
    assert rows(landed.read_table(spark, path, ["x"])) == [(0,), (2,), (4,), (6,)]


def test_board_sprint_serials_across_pages(spark):
    def page(board, n, values):
        return (json.dumps({"isLast": False, "values": [{"id": i, "name": f"s{i}", "originBoardId": b}
                                                        for i, b in values]}), board, n)
    pages = spark.createDataFrame([page(5, 0, [(1, 5), (2, 9)]), page(5, 1, [(3, 5)]), page(6, 0, [(4, 6)])],
                                  "value string, board_id long, page long")
    hw = spark.createDataFrame([(10, 5, 1), (0, 6, 2)], "sprint_number long, jira_rapid_view_id long, team_dim_id long")
    listed = landed.read_sprint_pages(pages, page_pos="page", keep=["board_id"])
    out = landed.number_board_sprints(listed, hw).filter(F.col("originBoardId") == F.col("board_id"))
    # board 5: sprint 2 belongs to board 9 but still counts for the position
    assert rows(out, "sprint_number", "sprint_serial_id", "team_dim_id") == [(1, 11, 1), (3, 13, 1), (4, 1, 2)]
