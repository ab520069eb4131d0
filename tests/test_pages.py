"""Pages that cannot be read, and listings that are not whole."""

import json

import pytest
from pyspark.sql import functions as F

from dimwright.sources import landed, pages
from tests.conftest import rows

GOOD = {"startAt": 0, "total": 2, "issues": [{"id": "1", "key": "A-1"}, {"id": "2", "key": "A-2"}]}


def docs(spark, *values):
    return spark.createDataFrame([(i, v if v is None or isinstance(v, str) else json.dumps(v)) for i, v in enumerate(values)], "page long, value string")


BAD = [None, "", " \n\t", "<html>", {"errorMessages": ["no"]}, {"issues": "x"}, "[1]", '{"startAt": 0, "issu', {"total": 0, "issues": None}]


def test_rejects_name_page_and_reason(spark):
    got = rows(pages.rejects(docs(spark, GOOD, *BAD, {"total": 0, "issues": []}), landed.ISSUES), "listing", "page", "reason")
    want = ["null page", "empty page", "empty page", "not readable", "no issues", "not readable", "not readable", "not readable", "no issues"]
    assert got == [("issues", str(i + 1), w) for i, w in enumerate(want)]
    lists = docs(spark, [{"key": "a"}], None, "", {"errorMessages": []}, "[", "null", [])
    assert rows(pages.rejects(lists, landed.USERS), "page", "reason") == [("1", "null page"), ("2", "empty page"), ("3", "not readable"), ("4", "not readable"), ("5", "no list")]


@pytest.mark.parametrize("bad", BAD)
def test_readers_end_on_a_page_they_cannot_read(spark, bad):
    both = docs(spark, GOOD, bad)
    for read in (landed.read_issue_pages, landed.read_sprint_issue_pages):
        with pytest.raises(Exception, match="issues: "):
            read(both).collect()
    assert landed.read_issue_pages(docs(spark, GOOD)).count() == 2


def test_every_reader_ends_on_an_error_body(spark):
    d = docs(spark, {"errorMessages": ["no"]})
    for read in (landed.read_workflow_statuses, landed.read_resolutions, landed.read_users, landed.read_products, landed.read_projects,
                 landed.read_sprint_pages, landed.read_epics, landed.read_boards):
        with pytest.raises(Exception, match="USER_RAISED|not readable|no "):
            read(d).collect()


def test_first_row_per_key_follows_the_page(spark, tmp_path):
    """The key is last on the first page and first on the second."""
    one, two = [{"key": "z", "displayName": "Z"}, {"key": "k", "displayName": "first"}], [{"key": "k", "displayName": "second"}]
    assert ("k", "first") in rows(landed.read_users(docs(spark, one, two)), "user_id", "user_name")
    for n, page in ((1, one), (2, two)):
        (tmp_path / f"page-{n}.json").write_text(json.dumps(page) + "\n")
    assert rows(landed.read_users(landed.read_json_docs(spark, str(tmp_path))), "user_id", "user_name") == [("k", "first"), ("z", "Z")]


def test_csv_rejects(spark):
    d = docs(spark, "Ann|ann|Sales", None, "", "one|two", "a|b|c|d", "||")
    got = rows(pages.csv_rejects(d, landed.DEPARTMENT_CSV_T, "departments"), "page", "reason", "body")
    assert got == [("1", "null line", None), ("2", "empty line", ""), ("3", "not readable", "one|two"), ("4", "not readable", "a|b|c|d")]


def brute(spans):
    """Faults by walking the sorted pages."""
    out, reach = [], 0
    for start, end, _ in sorted((s, s + n, t) for s, n, t in spans):
        if start > reach:
            out.append(("gap", reach, start))
        elif start < reach and end > start:
            out.append(("overlap", start, min(end, reach)))
        reach = max(reach, end)
    totals = [t for _, _, t in spans]
    if reach < max(totals):
        out.append(("gap", reach, max(totals)))
    if reach > max(totals):
        out.append(("beyond", max(totals), reach))
    if min(totals) < max(totals):
        out.append(("total changed", min(totals), max(totals)))
    return sorted(out)


def test_coverage(spark, monkeypatch):
    monkeypatch.setattr(pages, "RANGE", 250)
    full = [(i, 100, 1000) for i in range(0, 1000, 100)]
    cases = {
        "whole": full, "missing": full[:3] + full[4:], "first": full[1:], "last": full[:-1], "double": full + [full[4]],
        "short": [(s, 60 if s == 500 else n, t) for s, n, t in full], "long": [(s, 160 if s == 200 else n, t) for s, n, t in full],
        "huge": full[:2] + [(200, 700, 1000), (900, 100, 1000), (300, 100, 1000)], "moved": full[:-1] + [(900, 120, 1020)],
        "beyond": full + [(1000, 30, 1000)], "none": [(0, 0, 0)], "lost": [(0, 0, 40)],
    }
    d = spark.createDataFrame([(k, *p) for k, ps in cases.items() for p in ps], "board string, start int, n int, total int").repartition(3)
    got = {}
    for r in pages.coverage(d, ["board"]).collect():
        got.setdefault(r.board, []).append((r.fault, r.low, r.high))
    assert {k: sorted(v) for k, v in got.items()} == {k: brute(v) for k, v in cases.items() if brute(v)}
    assert "whole" not in got and "none" not in got
    alone = pages.coverage(d.where("board = 'missing'").drop("board"))
    assert rows(alone) == [("gap", 300, 400)]
    with pytest.raises(pages.PagesMissing, match="fault=gap low=300 high=400"):
        pages.require_whole({"issues": alone})
    odd = spark.createDataFrame([(None, 5, 10), (0, 10, 10)], "start int, n int, total int")
    assert rows(pages.coverage(odd)) == [("page without offsets", None, 5)]


def test_spans_of_pages(spark):
    d = docs(spark, GOOD, {"startAt": 3, "total": 9, "issues": [{"id": "3"}]}, None)
    assert rows(pages.spans(d, landed.ISSUES)) == [(0, 2, 2), (3, 1, 9)]
    assert rows(pages.coverage(pages.spans(d, landed.ISSUES)), "fault", "low", "high") == [("gap", 2, 3), ("gap", 4, 9), ("total changed", 2, 9)]
    with pytest.raises(pages.PagesRejected, match="issues page 2: null page"):
        pages.require_readable(pages.rejects(d, landed.ISSUES))
    pages.require_readable(pages.rejects(d.where(F.col("page") < 2), landed.ISSUES))


def test_a_page_is_parsed_once(spark):
    from dimwright.plans.bindings import landed_options
    from dimwright.plans.load_bindings import issue_columns
    from tests.test_oracle import SF

    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    docs = spark.createDataFrame([(1, '{"issues":[{"id":"1","key":"K-1"}]}'), (2, '{"issues":[]}'), (3, '{"issues":[null]}')], "page long, value string")
    for read in (landed.read_issue_pages, landed.read_sprint_issue_pages):
        assert plan(read(docs)).count("from_json") == 1
    assert rows(landed.read_issue_pages(docs), "key") == [("K-1",), (None,)]
    for query in (issue_columns, landed_options):
        text = plan(query(spark, SF))
        assert text.count("columnNameOfCorruptRecord") == 1
        assert "collect_list(struct(l_orderkey, l_orderkey#" in text      # lines as they are, not rendered


def test_ticket_pages_grow_in_number_not_in_size(spark):
    from dimwright.plans.load_bindings import PER_PAGE, _ticket_pages

    e = spark.range(1200).selectExpr("concat('T-', id % 400) as key", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, id) as ts",
                                     "id as event_id", "'view' as event_type", "'a1' as who")
    p = _ticket_pages(e)
    assert sorted({r.page for r in p.collect()}) == list(range(400 // PER_PAGE))
    assert landed.read_issue_pages(p).select("key").distinct().count() == landed.read_issue_pages(p).count() == 400


def test_pages_seen_once_tell_rejects_and_spans(spark):
    d = docs(spark, GOOD, *BAD, {"total": 0, "issues": []}, {"startAt": 5, "issues": [{"id": "3"}]})
    once = pages.seen(d, landed.RAW_ISSUES, ["page"])
    assert once._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
    assert rows(pages.unread(once)) == rows(pages.rejects(d, landed.RAW_ISSUES))
    assert rows(pages.told(once, ["page"])) == [(0, 0, 2, 2), (10, None, 0, 0), (11, 5, 1, None)]
    assert rows(pages.spans(d, landed.RAW_ISSUES, ["page"])) == rows(pages.told(once, ["page"]))
