"""Whole loads bound to the driver's tables: publishing, page checks, the run
log, the watermark, and E1 and E2 from landed pages to published tables.

Every binding renders its pages from whole driver tables, writes to a folder of
its own in the shared folder, and reads its result back from what was published.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimwright.operators import control, dims, facts, sprints, transitions
from dimwright.operators.keys import materialize
from dimwright.plans import jobs
from dimwright.plans.bindings import _empty, _t, _ts
from dimwright.session import ensure_checkpoint_dir
from dimwright.sources import landed, pages
from dimwright.sources.publish import Store, blank_to_null

# Fixed parameters of the bindings (the oracle uses the same literals).
ORDERS_CUT = "1998-01-01 00:00:00"
EVENTS_CUT = "2024-01-24 00:00:00"
LOADS = ("2024-02-10 00:00:00", "2024-02-20 00:00:00")      # times of the two runs
PER_PAGE = 100
TYPE_IDS = {"click": 1, "error": 2, "purchase": 3, "signup": 4, "view": 5}
BUCKETS = 32


def _folder(spark: SparkSession, label: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _iso(c: Column | str, zone: str = "") -> Column:
    return F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit(zone))


def _clock(start: str) -> Callable[[], datetime]:
    """A minute later each time it is asked."""
    now = [datetime.fromisoformat(start)]

    def tick() -> datetime:
        now[0] += timedelta(minutes=1)
        return now[0]
    return tick


def _in_order(c: Column, *order: str) -> Column:
    """The group's values of ``c`` as an array."""
    ordered = F.sort_array(F.collect_list(F.struct(*(F.col(o).alias(f"_o{i}") for i, o in enumerate(order)), c.alias("v"))))
    return F.transform(ordered, lambda x: x["v"])


# ------------------------------------------------------------------ S13-S17
def stage_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Two runs of a stage and its history; the second run's first try ends half
    way, after it has replaced the stage by other rows, and its retry succeeds."""
    o = blank_to_null(_t(spark, d, "orders").select(
        F.concat(F.lit("O-"), F.col("o_orderkey").cast("string")).alias("key"), F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderpriority").startswith("5"), F.lit("")).otherwise(F.col("o_orderpriority")).alias("priority"),
        F.col("o_orderdate").alias("created")))
    early, late = o.filter(F.col("created") < _ts(ORDERS_CUT)), o.filter(F.col("created") >= _ts(ORDERS_CUT))
    store = Store(spark, _folder(spark, "stage-roundtrip"))
    for run, part in ((1, early), (2, o), (2, late)):
        attempt = store.begin(run)
        attempt.replace("stage", part)
        if part is o:
            continue            # this try ends here
        attempt.append("history", landed.append_history(None, part, run, LOADS[run - 1]))
        attempt.commit()
    stage = store.read("stage").select(F.lit("stage").alias("source"), "key", "status", "priority", F.lit(2).cast("long").alias("run_id"))
    return stage.unionByName(store.read("history").select(F.lit("history").alias("source"), "key", "status", "priority", "run_id"))


# ------------------------------------------------------------------ S1 / S9: listings
def page_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Event pages of boards of 2,500 events; some pages are lost, landed twice,
    short or told another total, and each fault is found with its offsets."""
    ev = _t(spark, d, "events")
    page, board = F.floor(F.col("event_id") / PER_PAGE), F.floor(F.col("event_id") / 2500)
    issue = F.struct(F.col("event_id").cast("string").alias("id"), F.concat(F.lit("EV-"), F.col("event_id").cast("string")).alias("key"))
    total = ev.groupBy(board.alias("_b")).agg(F.count(F.lit(1)).alias("total"))
    held = ev.filter(~((page % 13 == 6) & (F.col("event_id") % PER_PAGE >= 60)))
    p = held.groupBy(board.alias("board"), page.alias("page")).agg(_in_order(issue, "event_id").alias("issues"))
    p = p.join(total, F.col("board") == F.col("_b")).filter(F.col("page") % 9 != 4)
    p = p.withColumn("total", F.when((F.col("page") % 25 == 0) & (F.col("board") % 3 == 1), F.col("total") - 100).otherwise(F.col("total")))
    p = p.withColumn("_c", F.explode(F.when(F.col("page") % 11 == 5, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    start = (F.col("page") * PER_PAGE - F.col("board") * 2500).cast("int")
    docs = p.select("board", "page", F.to_json(F.struct(start.alias("startAt"), F.col("total").cast("int").alias("total"), "issues")).alias("value"))
    return pages.coverage(pages.spans(docs, landed.ISSUES, ["board"]), ["board"])


# ------------------------------------------------------------------ all readers, S12: rejects
def landed_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Pages of events and lines of suppliers, some of them null, empty, error bodies or cut off."""
    ev = _t(spark, d, "events")
    issue = F.struct(F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("key"))
    p = ev.groupBy(F.floor(F.col("event_id") / PER_PAGE).alias("page")).agg(_in_order(issue, "event_id").alias("issues"))
    whole, kind = F.to_json(F.struct("issues")), F.col("page") % 7
    value = (F.when(kind == 1, F.lit("")).when(kind == 2, F.lit('{"errorMessages":["down"]}')).when(kind == 3, F.lit("<html>"))
             .when(kind == 4, F.substring(whole, 1, 40)).when(kind != 0, whole))
    issues = pages.rejects(p.select("page", value.alias("value")), landed.ISSUES)
    users = pages.rejects(p.select("page", F.when(kind == 5, F.lit('{"errorMessages":[]}')).when(kind != 6, F.lit("[]")).alias("value")), landed.USERS)
    s = _t(spark, d, "supplier")
    which = F.col("s_suppkey") % 5
    line = (F.when(which == 0, F.concat_ws("|", "s_name", "s_name")).when(which == 1, F.concat_ws("|", "s_name", F.lit("a"), F.lit("b"), F.lit("c")))
            .when(which == 3, F.concat_ws("|", "s_name", F.lit(""), F.lit("Sales"))).when(which == 4, F.lit("")))
    lines = pages.csv_rejects(s.select(F.col("s_suppkey").alias("page"), line.alias("value")), landed.DEPARTMENT_CSV_T, "departments")
    return issues.unionByName(users).unionByName(lines).select("listing", F.col("page").cast("long").alias("page"), "reason")


# ------------------------------------------------------------------ A1 / A2: the log that jobs write
def run_log(spark: SparkSession, d: str) -> DataFrame:
    """Two runs that publish orders and lines; a step of the second fails, with
    its error, after its first step has written. The watermark is the start of the first."""
    store, folder = Store(spark, _folder(spark, "run-log-store")), _folder(spark, "run-log")
    o, li = _t(spark, d, "orders").select("o_orderkey"), _t(spark, d, "lineitem").select("l_orderkey", "l_quantity")
    broken = li.select(F.when(F.col("l_quantity") < 0, F.col("l_quantity")).otherwise(F.raise_error(F.lit("no such unit"))).cast("double").alias("l_quantity"))
    clock = _clock("2024-03-01 00:00:00")
    for run, lines in ((1, li), (2, broken)):
        log = control.RunLog(spark, folder, "servicedesk", run, clock)
        try:
            with log.run():
                attempt = store.begin(run)
                for table, df in (("orders", o), ("lines", lines)):
                    with log.step(table) as step:
                        step.wrote(attempt.replace(table, df))
                attempt.commit()
        except Exception as e:
            if "no such unit" not in str(e):
                raise
    state = control.run_state(control.read_log(spark, folder))
    mark = control.last_success(state, "servicedesk").scalar()
    return state.select("audit_id", "audit_details_id", "task_name", "status", "rows_written", F.col("error").contains("no such unit").alias("told"),
                        "start_date", "end_date", mark.alias("watermark"))


# ------------------------------------------------------------------ A2 / A3: the watermark on day folders
def watermark_load(spark: SparkSession, d: str) -> DataFrame:
    """Event pages landed in a folder a day; after a successful run on the 15th,
    folders of earlier days are not opened, and of that day on the rows changed after its start are read."""
    ev = _t(spark, d, "events")
    folder, logs = _folder(spark, "watermark-in"), _folder(spark, "watermark-log")
    fields = F.struct(_iso("ts", "-0500").alias("created"), _iso("ts", "-0500").alias("updated"))
    issue = F.struct(F.col("event_id").cast("string").alias("id"), F.concat(F.lit("EV-"), F.col("event_id").cast("string")).alias("key"), fields.alias("fields"))
    docs = (ev.groupBy(F.to_date("ts").alias("day"), F.floor(F.col("event_id") / PER_PAGE).alias("_p"))
            .agg(_in_order(issue, "event_id").alias("issues")).select("day", F.to_json(F.struct("issues")).alias("value")))
    docs.write.partitionBy("day").text(folder)
    log = control.RunLog(spark, logs, "servicedesk", 1, _clock("2024-01-15 13:00:00"))
    with log.run():
        pass
    mark = control.last_success(control.run_state(control.read_log(spark, logs)), "servicedesk")
    issues = landed.read_issue_pages(landed.read_json_docs(spark, folder, mark))
    return control.incremental(issues, mark, "fields.created", "fields.updated").select("key")


# ------------------------------------------------------------------ E1
def _weeks(ev: DataFrame) -> DataFrame:
    """Events of tickets: a ticket is a user's week; of events at the same time the first counts."""
    week = F.floor((F.dayofmonth("ts") - 1) / 7).cast("string")
    e = ev.withColumn("key", F.concat(F.lit("T-"), F.col("user_id").cast("string"), F.lit("-"), week))
    e = e.groupBy("key", "ts").agg(F.min(F.struct("event_id", "event_type")).alias("e"))
    return e.select("key", "ts", "e.event_id", "e.event_type", F.concat(F.lit("a"), (F.col("e.event_id") % 7).cast("string")).alias("who"))


def _ticket_pages(e: DataFrame) -> DataFrame:
    """Search pages of tickets with their whole changelog, about PER_PAGE tickets a page."""
    type_id = F.create_map(*(F.lit(x) for kv in TYPE_IDS.items() for x in (kv[0], str(kv[1]))))
    t = e.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("ts", "event_type", "who"))).alias("h"))
    before = lambda i: F.get("h", i - 1)
    history = lambda x, i: F.struct(_iso(x["ts"], "-0500").alias("created"), F.array(
        F.struct(F.lit("status").alias("field"), type_id[before(i)["event_type"]].alias("from"), type_id[x["event_type"]].alias("to"),
                 before(i)["event_type"].alias("fromString"), x["event_type"].alias("toString")),
        F.struct(F.lit("assignee").alias("field"), before(i)["who"].alias("from"), x["who"].alias("to"),
                 F.upper(before(i)["who"]).alias("fromString"), F.upper(x["who"]).alias("toString"))).alias("items"))
    last = F.element_at("h", -1)
    fields = F.struct(F.struct(last["who"].alias("key"), F.upper(last["who"]).alias("displayName")).alias("assignee"),
                      _iso(F.element_at("h", 1)["ts"], "-0500").alias("created"), _iso(last["ts"], "-0500").alias("updated"),
                      F.when(last["event_type"] == "purchase", _iso(last["ts"], "-0500")).alias("resolutiondate"),
                      F.struct(last["event_type"].alias("name")).alias("status"))
    issue = F.struct(F.col("key").alias("id"), F.col("key"), fields.alias("fields"), F.struct(F.transform("h", history).alias("histories")).alias("changelog"))
    pages_ = e.select("key").distinct().agg(F.greatest(F.ceil(F.count(F.lit(1)) / PER_PAGE), F.lit(1))).scalar()
    p = t.select("key", issue.alias("i")).groupBy(F.pmod(F.crc32(F.col("key").cast("binary")), pages_).alias("page")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("key").alias("_o"), "i"))).alias("is"))
    return p.select("page", F.to_json(F.struct(F.transform("is", lambda x: x["i"]).alias("issues"))).alias("value"))


def ticket_load(spark: SparkSession, d: str) -> DataFrame:
    """E1 in two published runs: tickets as they stood on the 24th, then those
    changed since, in which only buckets with such tickets are rewritten.

    Per ticket: its active fact, the versions of it, and its transition history summed up."""
    e = _weeks(_t(spark, d, "events"))
    before = e.filter(F.col("ts") < _ts(EVENTS_CUT))
    since = e.join(e.filter(F.col("ts") >= _ts(EVENTS_CUT)).select("key").distinct(), "key", "left_semi")
    one = lambda doc: spark.createDataFrame([(doc,)], "value string")
    statuses = ", ".join(f'{{"name": "{k}", "id": "{v}"}}' for k, v in TYPE_IDS.items())
    reference = {
        "workflow": one(f'[{{"name": "Ticket", "statuses": [{statuses}]}}]'), "resolutions": one('[{"name": "Closed", "id": "9"}]'),
        "users": one('[{"key": "a0", "displayName": "A0", "active": true}, {"key": "a1", "displayName": "A1", "active": true}]'),
        "products": one('{"projects": []}'),
        "contacts": _empty(spark, "contactid string, salutation string, firstname string, lastname string, fullname string, jobtitle string, emailaddress1 string"),
        "incidents": _empty(spark, "ticketnumber string, caseorigincode int, caseorigincodename string"),
        "department_map": spark.createDataFrame([("A1", "a1", "Support")], landed.DEPARTMENT_CSV_T)}
    lookups = {"customer_dim": _empty(spark, jobs.WAREHOUSE_SCHEMAS["customer_dim"]), "channel_dim": _empty(spark, jobs.WAREHOUSE_SCHEMAS["channel_dim"]),
               "priority_dim": _empty(spark, jobs.WAREHOUSE_SCHEMAS["priority_dim"]), "date_dim": facts.date_key_frame(e, "ts")}
    store = jobs.ticket_store(spark, _folder(spark, "ticket-load"), BUCKETS)
    for run, part in ((1, before), (2, since)):
        jobs.ticket_run(store, {**reference, "issues": materialize(_ticket_pages(part), "issues")}, lookups, LOADS[run - 1], run, listing=None)
    fact, tmap = store.read("fact"), store.read("transition_map")
    st = store.read("status_dim").select(F.col("jira_status_dim_id").alias("status_dim_id"), F.col("jira_status").alias("status"))
    us = store.read("user_dim").select(F.col("jira_user_dim_id").alias("assignee_dim_id"), F.col("jira_user_id").alias("assignee"))
    versions = fact.groupBy("jira_key").agg(F.count(F.lit(1)).alias("versions"))
    history = tmap.groupBy("jira_key").agg(
        F.count(F.lit(1)).alias("map_rows"), F.count("status_change_date").alias("changes"),
        F.sum(F.when(F.col("is_current_state"), 1).otherwise(0)).cast("long").alias("current_rows"),
        F.coalesce(F.sum("time_spent_in_status_in_minutes"), F.lit(0)).cast("long").alias("status_minutes"),
        F.coalesce(F.sum("time_spent_by_assignee_in_minutes"), F.lit(0)).cast("long").alias("assignee_minutes"))
    return (fact.filter("is_active").join(st, "status_dim_id").join(us, "assignee_dim_id").join(versions, "jira_key").join(history, "jira_key")
            .select("jira_key", "status", "assignee", F.col("date_created").alias("loaded"), "date_created_dim_id", "time_to_close_in_days",
                    "time_to_close_in_hours", "time_to_close_in_minutes", "pending_since_in_days",
                    (F.col("department_dim_id") > 0).alias("has_department"), "versions", "map_rows", "changes", "current_rows", "status_minutes", "assignee_minutes"))


# ------------------------------------------------------------------ E2, Q1, Q6
def sprint_load(spark: SparkSession, d: str) -> DataFrame:
    """E2 in two published runs: all sprints (orders, a board per nation) are
    listed; issues (lines) of sprints before 1998 come first, the others in the
    second run, which stores points and developers for its own sprints only.

    Per sprint: its serial, the stored measures, points from the stored JSON, and its issues."""
    o = _t(spark, d, "orders").join(_t(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    board = (F.col("c_nationkey") + 100).cast("long")
    end = F.col("o_orderdate") + F.expr("INTERVAL 14 DAYS")
    sprint = F.struct(F.col("o_orderkey").alias("id"), F.concat(F.lit("S"), F.col("o_orderkey").cast("string")).alias("name"), board.alias("originBoardId"),
                      _iso("o_orderdate", "Z").alias("startDate"), _iso(end, "Z").alias("endDate"), _iso(end + F.expr("INTERVAL 12 HOURS"), "Z").alias("completeDate"))
    listed = (o.groupBy(board.alias("board_id"), F.floor(F.col("o_orderkey") / PER_PAGE).alias("page")).agg(_in_order(sprint, "o_orderkey").alias("values"))
              .select("board_id", "page", F.to_json(F.struct(F.lit(True).alias("isLast"), "values")).alias("value")))
    li = _t(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.min(F.struct("l_partkey", "l_suppkey", "l_quantity", "l_shipdate", "l_returnflag", "l_linestatus")).alias("x")).select("l_orderkey", "l_linenumber", "x.*")
    part = _t(spark, d, "part").withColumn("brand", F.regexp_replace("p_brand", "#", ""))
    li = (li.join(part.select(F.col("p_partkey").alias("l_partkey"), "brand"), "l_partkey")
          .join(o.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", F.col("c_nationkey").cast("long").alias("team_dim_id")), "l_orderkey"))
    kind = F.when(F.col("l_returnflag") == "R", "Sub-task").when(F.col("l_returnflag") == "A", "Maintenance").otherwise("Story")
    issue = F.struct(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("id"),
        F.concat_ws("-", "brand", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("key"),
        F.struct(F.struct(kind.alias("name")).alias("issuetype"), F.struct(F.col("l_partkey").alias("id")).alias("epic"),
                 F.col("l_quantity").alias("customfield_10411"), _iso("l_shipdate", "Z").alias("resolutiondate")).alias("fields"),
        F.struct(F.array(F.struct(_iso("l_shipdate", "Z").alias("created"), F.array(F.struct(
            F.lit("status").alias("field"), F.lit("Open").alias("fromString"), F.col("l_linestatus").alias("toString"))).alias("items"))).alias("histories")).alias("changelog"))
    staged = (li.groupBy(F.col("l_orderkey").alias("sprint_number"), "team_dim_id", "o_orderdate").agg(_in_order(issue, "l_linenumber").alias("issues"))
              .select("sprint_number", "team_dim_id", "o_orderdate", F.to_json(F.struct(F.lit(0).alias("startAt"), F.size("issues").alias("total"), "issues")).alias("value")))
    epic = F.struct(F.col("p_partkey").cast("string").alias("id"), F.concat(F.lit("EP-"), F.col("p_partkey").cast("string")).alias("key"),
                    F.struct(F.col("p_name").alias("customfield_10416")).alias("fields"))
    epics = (part.groupBy(F.col("brand").alias("project_key"), F.floor(F.col("p_partkey") / PER_PAGE).alias("page")).agg(_in_order(epic, "p_partkey").alias("issues"))
             .select("project_key", "page", F.to_json(F.struct("issues")).alias("value")))
    project = F.struct(F.regexp_extract("brand", "([0-9]+)", 1).alias("id"), F.col("brand").alias("key"), F.col("brand").alias("name"))
    projects = part.select("brand").distinct().groupBy(F.lit(0).alias("page")).agg(_in_order(project, "brand").alias("p")).select("page", F.to_json("p").alias("value"))
    entry = _ts("1995-01-01 00:00:00") + F.make_dt_interval(F.pmod(F.col("s_suppkey") * 37, F.lit(1000)))
    members = _t(spark, d, "supplier").select(
        F.col("s_suppkey").alias("user_dim_id"), F.col("s_nationkey").cast("long").alias("team_dim_id"), entry.alias("team_entry_date"),
        F.when(F.col("s_suppkey") % 3 == 0, entry + F.expr("INTERVAL 900 DAYS")).alias("team_exit_date"))
    team = _t(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("team_dim_id"), F.col("n_name").alias("team_name"),
                                         (F.col("n_nationkey") + 100).cast("long").alias("jira_rapid_view_id"), F.lit(True).alias("is_active"))
    # landed before they are read: a run looks at its pages several times
    landed_now = {k: materialize(p, k) for k, p in {"projects": projects, "sprints": listed, "epics": epics}.items()} | {"members": members}
    staged = materialize(staged, "sprint-issues")
    store = Store(spark, _folder(spark, "sprint-load"))
    for run, some in ((1, F.col("o_orderdate") < _ts(ORDERS_CUT)), (2, F.col("o_orderdate") >= _ts(ORDERS_CUT))):
        jobs.sprint_run(store, {**landed_now, "sprint_issues": staged.filter(some).drop("o_orderdate")}, team, LOADS[run - 1], run,
                        sprint_cutoff="1990-01-01 00:00:00", maintenance=("maintenance",))
    summary, issues = store.read("sprint_summary"), store.read("sprint_issues")
    keys = ["sprint_number", "team_dim_id"]
    again = sprints.completed_points(sprints.issue_points(issues), summary).select(*keys, F.round("completed_points").cast("long").alias("points_again"))
    held = issues.filter("is_active").groupBy(*keys).agg(
        F.count(F.lit(1)).alias("issues"), F.sum(F.when(F.col("status_on_sprint_closure") == "Open", 1).otherwise(0)).cast("long").alias("open_at_close"),
        F.count("epic_dim_id").alias("with_epic"), F.count("project_dim_id").alias("with_project"))
    return (summary.select(*keys, "sprint_serial_id", "is_issues_loaded").join(sprints.sprint_measures(summary), keys).join(again, keys, "left").join(held, keys, "left"))


# ------------------------------------------------------------------ S1b: all 27 columns
def issue_columns(spark: SparkSession, d: str) -> DataFrame:
    """Search pages of line items whose issues hold every field of the stage, some of them null, read with S1 and S1b."""
    li = _t(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.min(F.struct("l_partkey", "l_suppkey", "l_quantity", "l_shipdate", "l_returnflag", "l_linestatus")).alias("x")).select("l_orderkey", "l_linenumber", "x.*")
    person = lambda kind, i: F.struct(F.concat(F.lit(kind), i).alias("key"), F.concat(F.lit(f"{kind.title()} "), i).alias("displayName"))
    named = lambda n: F.array(F.struct(n.alias("name")))
    option = lambda v: F.struct(F.lit("x").alias("self"), v.alias("value"))

    def issue(l: Column) -> Column:
        key = F.concat(F.lit("LI-"), l["l_orderkey"].cast("string"), F.lit("-"), l["l_linenumber"].cast("string"))
        supplier, part_ = l["l_suppkey"].cast("string"), l["l_partkey"].cast("string")
        returned, done = l["l_returnflag"] == "R", l["l_linestatus"] == "F"
        fields = F.struct(
            F.when(~returned, person("agent", supplier)).alias("assignee"), person("maker", part_).alias("creator"), F.when(done, person("caller", part_)).alias("reporter"),
            l["shipped"].alias("created"), l["shipped"].alias("updated"), F.when(done, l["shipped"]).alias("resolutiondate"),
            F.when(returned, named(part_)).alias("components"), F.concat(F.lit("line\n"), l["l_returnflag"]).alias("description"), F.concat(F.lit('"q" '), part_).alias("summary"),
            named(l["l_returnflag"]).alias("fixVersions"), named(l["l_linestatus"]).alias("versions"),
            F.struct(F.when(returned, "Return").otherwise("Line").alias("name"), returned.alias("subtask")).alias("issuetype"),
            F.when(~returned, F.struct(l["l_linestatus"].alias("name"))).alias("priority"), F.when(done, F.struct(F.lit("Done").alias("name"))).alias("resolution"),
            F.struct(l["l_linestatus"].alias("name"), F.lit("as shipped").alias("description")).alias("status"),
            F.struct(l["l_linenumber"].alias("watchCount")).alias("watches"), F.concat(F.lit("C-"), part_).alias("customfield_12409"),
            F.when(~done, supplier).alias("customfield_12410"), F.concat(F.lit(" "), supplier).alias("customfield_12411"), F.concat(supplier, F.lit("@x.test")).alias("customfield_11905"),
            option(l["l_returnflag"]).alias("customfield_11809"), F.when(returned, F.array(option(part_))).alias("customfield_13609"), F.lit("Plain").alias("customfield_11813"))
        return F.struct(key.alias("id"), key.alias("key"), fields.alias("fields"))

    # a page gathers its lines as they are and renders them in place: gathered as issues, they are many times the size
    line = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", _iso("l_shipdate", "-0500").alias("shipped"))
    docs = (li.groupBy(F.floor(F.col("l_orderkey") / PER_PAGE).alias("_p")).agg(F.sort_array(F.collect_list(line)).alias("lines"))
            .select(F.to_json(F.struct(F.transform("lines", issue).alias("issues"))).alias("value")))
    return landed.flatten_issues(landed.read_issue_pages(docs))


# ------------------------------------------------------------------ F2: all nine lookups
def star_lookup_nine(spark: SparkSession, d: str) -> DataFrame:
    """Orders against nine dimensions, two of them the same one in two roles: null,
    padded and unknown names, dimensions with repeated names, a carried column."""
    o = _t(spark, d, "orders")
    c = _t(spark, d, "customer")
    k = F.col("o_custkey")
    stage = o.join(c.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey", "c_name"), "o_custkey").select(
        F.col("o_orderkey").alias("key"), F.concat(F.lit(" "), F.col("c_name"), F.lit(" ")).alias("account"), F.when(k % 3 != 0, F.col("c_mktsegment")).alias("channel"),
        F.when(k % 4 != 0, F.col("c_name")).alias("contact"), F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderkey") % 2 == 0, F.lit("P")).when(F.col("o_orderkey") % 3 == 0, F.lit("F")).alias("resolution"),
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority")).otherwise(F.lit("unheard of")).alias("priority"), "o_orderdate",
        F.concat(F.lit("type "), (F.col("o_orderkey") % 11).cast("string")).alias("kind"), F.col("c_nationkey").cast("string").alias("who"))
    member = lambda df, name, i, label: df.select(F.col(i).cast("long").alias(f"{label}_id"), F.col(name).alias(label))
    numbered = lambda df, c_, label: member(df.select(c_).distinct().withColumn("_i", F.crc32(F.col(c_).cast("binary"))), c_, "_i", label)
    none = lambda label: spark.createDataFrame([(0, "None")], f"{label}_id long, {label} string")
    account = member(c, "c_name", "c_custkey", "account").filter(F.col("account_id") % 7 != 0)
    channel = numbered(c, "c_mktsegment", "channel").unionByName(none("channel"))
    contact = member(c.withColumn("_i", F.col("c_custkey") + 5), "c_name", "_i", "contact").unionByName(member(c.withColumn("_i", F.col("c_custkey") + 3), "c_name", "_i", "contact"))
    status = numbered(o, "o_orderstatus", "status").unionByName(none("status"))
    priority = numbered(o, "o_orderpriority", "priority")
    kinds = numbered(stage, "kind", "kind").filter(F.col("kind") != "type 3")
    n = _t(spark, d, "nation")
    people = n.select((F.col("n_nationkey") + 50).cast("long").alias("who_id"), F.concat(F.col("n_nationkey").cast("string"), F.lit("  ")).alias("who"), F.col("n_regionkey").cast("long").alias("department_dim_id"))
    out = facts.star_lookup(stage, [
        facts.Lookup(account, "account", "account", "account_id", "account_dim_id", default_member=False),
        facts.Lookup(channel, "channel", "channel", "channel_id", "channel_dim_id"),
        facts.Lookup(contact, "contact", "contact", "contact_id", "contact_dim_id", default_member=False),
        facts.Lookup(status, "status", "status", "status_id", "status_dim_id"), facts.Lookup(status, "resolution", "status", "status_id", "resolution_dim_id"),
        facts.Lookup(priority, "priority", "priority", "priority_id", "priority_dim_id"),
        facts.Lookup(facts.date_key_frame(o.filter(F.col("o_orderkey") % 6 != 0), "o_orderdate"), "o_orderdate", "dt", "sk_date", "date_dim_id", on_date=True),
        facts.Lookup(kinds, "kind", "kind", "kind_id", "kind_dim_id"),
        facts.Lookup(people, "who", "who", "who_id", "assignee_dim_id", extra=[("department_dim_id", "department_dim_id")])])
    return out.select("key", "account_dim_id", "channel_dim_id", "contact_dim_id", "status_dim_id", "resolution_dim_id", "priority_dim_id", "date_dim_id",
                      "kind_dim_id", "assignee_dim_id", "department_dim_id")


# ------------------------------------------------------------------ D11, D13-D15, T2, C9
def absent_members(spark: SparkSession, d: str) -> DataFrame:
    """Projects, seeded products, sprints and epics inserted where absent, some rows
    listed twice; per dimension the new members with their keys."""
    p = _t(spark, d, "part")
    brand = p.select("p_brand").distinct()
    known = brand.filter(F.substring("p_brand", -1, 1) < "3")
    project = known.select(F.crc32(F.col("p_brand").cast("binary")).alias("project_dim_id"), F.col("p_brand").alias("project_key"), F.lit("old").alias("project_name"))
    project = dims.insert_if_absent(project, p.select(F.col("p_brand").alias("project_key"), F.col("p_name").alias("project_name")), ["project_key"], "project_dim_id")
    segment = _t(spark, d, "customer").select("c_mktsegment").distinct()
    product = segment.filter(F.col("c_mktsegment") > "F").select(F.length("c_mktsegment").cast("long").alias("product_dim_id"), F.col("c_mktsegment").alias("product_name"))
    product = dims.insert_if_absent(product, segment.select(F.col("c_mktsegment").alias("product_name")).unionByName(
        segment.select(F.concat(F.lit("Seed "), "c_mktsegment").alias("product_name"))), ["product_name"], "product_dim_id")
    o = _t(spark, d, "orders")
    listed = o.select(F.col("o_orderkey").alias("sprint_number"), F.col("o_custkey").alias("team_dim_id"), F.concat(F.lit("S"), "o_orderkey").alias("sprint_name"))
    have = listed.filter(F.col("sprint_number") % 3 == 0).withColumns({"team_dim_id": F.lit(-1).cast("long"), "sprint_name": F.lit("old")})
    sprint = dims.insert_if_absent(have, listed.unionByName(listed.withColumn("team_dim_id", F.col("team_dim_id") + 1)), ["sprint_number"], None)
    epic = p.select(F.concat(F.lit("EP-"), F.col("p_partkey").cast("string")).alias("epic_key"), F.col("p_name").alias("epic_name"))
    held = epic.filter(F.col("epic_key").endswith("7")).select(F.lit(9).cast("long").alias("epic_dim_id"), "epic_key", F.lit("old").alias("epic_name"))
    epic = dims.insert_if_absent(held, epic.unionByName(epic.withColumn("epic_name", F.concat("epic_name", F.lit(" again")))), ["epic_key"], "epic_dim_id")
    row = lambda df, dim, k, i, name: df.select(F.lit(dim).alias("dimension"), F.col(k).cast("string").alias("member"), F.col(i).alias("member_id"), F.col(name).alias("told"))
    return (row(project, "project", "project_key", "project_dim_id", "project_name").unionByName(row(product, "product", "product_name", "product_dim_id", "product_name"))
            .unionByName(row(sprint, "sprint", "sprint_number", "team_dim_id", "sprint_name")).unionByName(row(epic, "epic", "epic_key", "epic_dim_id", "epic_name")))


def staged_ticket_keys(spark: SparkSession, d: str) -> DataFrame:
    """Keys of tickets staged by several searches, each once, a null key too."""
    li = _t(spark, d, "lineitem")
    return transitions.staged_keys(li.select(F.when(F.col("l_orderkey") % 10 != 0, F.concat(F.lit("LI-"), F.col("l_orderkey").cast("string"))).alias("key")))


def teams_at_work(spark: SparkSession, d: str) -> DataFrame:
    """Active teams; a team whose flag is null is not one."""
    c = _t(spark, d, "customer")
    return sprints.active_teams(c.select(F.col("c_custkey").alias("team_dim_id"), F.col("c_name").alias("team_name"), F.col("c_nationkey").cast("long").alias("jira_rapid_view_id"),
                                         F.when(F.col("c_acctbal") < 1000, F.col("c_acctbal") > 0).alias("is_active"), F.lit(1).alias("other")))


# ------------------------------------------------------------------ A4 from a table
CHECK_ROWS = [
    ("orders", "orders", "count(*)", None, 0), ("orders", "keys beyond orders", "count(*) - count(distinct o_orderkey)", None, 0),
    ("orders", "open orders", "count(*)", "o_orderstatus = 'O'", 0), ("orders", "orders without a customer", "count(*)", "o_custkey is null", 0),
    ("orders", "customers of open orders", "count(distinct o_custkey)", "o_orderstatus = 'O'", 5), ("lineitem", "lines", "count(*)", None, 0),
    ("lineitem", "lines of no quantity", "count(*)", "l_quantity <= 0", 0), ("lineitem", "highest line beyond 99", "max(l_linenumber)", "l_linenumber > 99", 0),
    ("nowhere", "rows of a lost table", "count(*)", None, 0)]


def check_table(spark: SparkSession, d: str) -> DataFrame:
    checks = spark.createDataFrame(CHECK_ROWS, control.CHECK_T)
    out = control.run_check_table(checks, {t: _t(spark, d, t) for t in ("orders", "lineitem")}, as_of=LOADS[0], task_id=3)
    return out.select("table_name", "condition", "expected_value", "actual_value", "status", "created_date", "task_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        stage_roundtrip, page_gaps, landed_rejects, run_log, watermark_load, ticket_load, sprint_load, issue_columns, star_lookup_nine, absent_members,
        staged_ticket_keys, teams_at_work, check_table)}

ORACLE: dict[str, str] = {}

ORACLE["stage_roundtrip"] = f"""
WITH o AS (SELECT 'O-' || o_orderkey AS key, o_orderstatus AS status, CASE WHEN o_orderpriority NOT LIKE '5%' THEN o_orderpriority END AS priority,
                  CASE WHEN o_orderdate < TIMESTAMP '{ORDERS_CUT}' THEN 1 ELSE 2 END AS run FROM orders)
SELECT 'stage' AS source, key, status, priority, CAST(2 AS BIGINT) AS run_id FROM o WHERE run = 2
UNION ALL SELECT 'history', key, status, priority, run FROM o
"""

ORACLE["page_gaps"] = """
WITH e AS (SELECT event_id, event_id // 100 AS page, event_id // 2500 AS board FROM events),
t AS (SELECT board, count(*) AS total FROM e GROUP BY board),
p AS (SELECT board, page, page * 100 - board * 2500 AS s, count(*) AS n FROM e WHERE NOT (page % 13 = 6 AND event_id % 100 >= 60) GROUP BY board, page),
q AS (SELECT board, s, s + n AS e, total - CASE WHEN page % 25 = 0 AND board % 3 = 1 THEN 100 ELSE 0 END AS total
      FROM p JOIN t USING (board), (SELECT unnest([1, 2]) AS c) WHERE page % 9 <> 4 AND (c = 1 OR page % 11 = 5)),
r AS (SELECT *, coalesce(max(e) OVER (PARTITION BY board ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS reach FROM q),
w AS (SELECT board, max(e) AS e, max(total) AS total, min(total) AS least FROM q GROUP BY board)
SELECT CAST(board AS BIGINT) AS board, 'gap' AS fault, CAST(reach AS BIGINT) AS low, CAST(s AS BIGINT) AS high FROM r WHERE s > reach
UNION ALL SELECT board, 'overlap', s, least(e, reach) FROM r WHERE s < reach AND e > s
UNION ALL SELECT board, 'gap', e, total FROM w WHERE e < total
UNION ALL SELECT board, 'beyond', total, e FROM w WHERE e > total
UNION ALL SELECT board, 'total changed', least, total FROM w WHERE least < total
"""

ORACLE["landed_rejects"] = """
WITH p AS (SELECT DISTINCT event_id // 100 AS page FROM events)
SELECT 'issues' AS listing, CAST(page AS BIGINT) AS page,
       CASE page % 7 WHEN 0 THEN 'null page' WHEN 1 THEN 'empty page' WHEN 2 THEN 'no issues' ELSE 'not readable' END AS reason FROM p WHERE page % 7 < 5
UNION ALL SELECT 'users', page, CASE page % 7 WHEN 5 THEN 'not readable' ELSE 'null page' END FROM p WHERE page % 7 >= 5
UNION ALL SELECT 'departments', s_suppkey, CASE s_suppkey % 5 WHEN 2 THEN 'null line' WHEN 4 THEN 'empty line' ELSE 'not readable' END
FROM supplier WHERE s_suppkey % 5 <> 3
"""

ORACLE["run_log"] = """
WITH n AS (SELECT (SELECT count(*) FROM orders) AS o, (SELECT count(*) FROM lineitem) AS l),
t(audit_id, sub, task_name, status, table_name, told, a, b) AS (VALUES
    (1, NULL, 'servicedesk', 'SUCCESS', NULL, NULL, 1, 6), (1, 1, 'orders', 'SUCCESS', 'o', NULL, 2, 3), (1, 2, 'lines', 'SUCCESS', 'l', NULL, 4, 5),
    (2, NULL, 'servicedesk', 'FAILED', NULL, true, 7, 12), (2, 1, 'orders', 'SUCCESS', 'o', NULL, 8, 9), (2, 2, 'lines', 'FAILED', NULL, true, 10, 11))
SELECT CAST(audit_id AS BIGINT) AS audit_id, CAST(sub AS BIGINT) AS audit_details_id, task_name, status,
       CASE table_name WHEN 'o' THEN o WHEN 'l' THEN l END AS rows_written, told,
       TIMESTAMP '2024-03-01 00:00:00' + a * INTERVAL 1 MINUTE AS start_date, TIMESTAMP '2024-03-01 00:00:00' + b * INTERVAL 1 MINUTE AS end_date,
       TIMESTAMP '2024-03-01 00:01:00' AS watermark
FROM t, n
"""

ORACLE["watermark_load"] = "SELECT 'EV-' || event_id AS key FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'"

ORACLE["ticket_load"] = f"""
WITH x AS (SELECT 'T-' || user_id || '-' || ((day(ts) - 1) // 7) AS k, ts, event_id, event_type FROM events),
e AS (SELECT k, ts, event_type, 'a' || (event_id % 7) AS who FROM x QUALIFY row_number() OVER (PARTITION BY k, ts ORDER BY event_id) = 1),
t AS (SELECT k, min(ts) AS a, max(ts) AS z, arg_max(event_type, ts) AS status, arg_max(who, ts) AS assignee, count(*) AS n,
             count(DISTINCT event_type) AS kinds, min(ts) < TIMESTAMP '{EVENTS_CUT}' AS early, max(ts) >= TIMESTAMP '{EVENTS_CUT}' AS late FROM e GROUP BY k),
g AS (SELECT k, sum(floor((epoch_us(ts) - epoch_us(prev)) / 60000000)) AS m
      FROM (SELECT k, ts, lag(ts) OVER (PARTITION BY k ORDER BY ts) AS prev FROM e) GROUP BY k),
u AS (SELECT *, (epoch_us(z) - epoch_us(a)) // 60000000 AS mins, CASE WHEN late THEN TIMESTAMP '{LOADS[1]}' ELSE TIMESTAMP '{LOADS[0]}' END AS loaded FROM t JOIN g USING (k))
SELECT k AS jira_key, status, assignee, loaded, CAST(strftime(a, '%Y%m%d') AS BIGINT) AS date_created_dim_id,
       CASE WHEN status = 'purchase' THEN mins // 1440 END AS time_to_close_in_days,
       CASE WHEN status = 'purchase' THEN mins // 60 + CASE WHEN mins % 60 >= 30 THEN 1 ELSE 0 END END AS time_to_close_in_hours,
       CASE WHEN status = 'purchase' THEN mins END AS time_to_close_in_minutes,
       CASE WHEN status <> 'purchase' THEN (epoch_us(loaded) - epoch_us(a)) // 86400000000 END AS pending_since_in_days,
       assignee = 'a1' AS has_department,
       CAST(CASE WHEN early AND late THEN 2 ELSE 1 END AS BIGINT) AS versions, n + 5 - kinds AS map_rows, n AS changes,
       CAST(CASE WHEN n > 1 THEN 1 ELSE 0 END AS BIGINT) AS current_rows, CAST(coalesce(m, 0) AS BIGINT) AS status_minutes, CAST(coalesce(m, 0) AS BIGINT) AS assignee_minutes
FROM u
"""

ORACLE["sprint_load"] = """
WITH s AS (SELECT o_orderkey AS k, CAST(c_nationkey AS BIGINT) AS team, o_orderdate AS a, o_orderdate + INTERVAL 14 DAY AS z,
                  row_number() OVER (PARTITION BY c_nationkey ORDER BY o_orderkey) AS serial FROM orders JOIN customer ON o_custkey = c_custkey),
l AS (SELECT l_orderkey, l_linenumber, unnest(min({'l_partkey': l_partkey, 'l_suppkey': l_suppkey, 'l_quantity': l_quantity, 'l_shipdate': l_shipdate,
             'l_returnflag': l_returnflag, 'l_linestatus': l_linestatus})) FROM lineitem GROUP BY l_orderkey, l_linenumber),
i AS (SELECT s.k, CASE WHEN l_returnflag <> 'A' AND l_shipdate BETWEEN a AND z THEN l_quantity END AS points,
             CASE WHEN l_shipdate <= z + INTERVAL 12 HOUR THEN l_linestatus ELSE 'Open' END AS st, l_partkey > 0 AS epic
      FROM l JOIN s ON l_orderkey = s.k JOIN part ON p_partkey = l_partkey WHERE l_returnflag <> 'R'),
h AS (SELECT k, count(*) AS issues, count(*) FILTER (st = 'Open') AS open_at_close, count(*) FILTER (epic) AS with_epic, sum(points) AS points FROM i GROUP BY k),
m AS (SELECT s_suppkey, s_nationkey, TIMESTAMP '1995-01-01' + (s_suppkey * 37 % 1000) * INTERVAL 1 DAY AS x FROM supplier),
d AS (SELECT k, count(*) AS n FROM s JOIN m ON s_nationkey = team AND x < a
      AND CASE WHEN s_suppkey % 3 = 0 THEN x + INTERVAL 900 DAY ELSE TIMESTAMP '2024-02-10' END > z GROUP BY k),
o AS (SELECT DISTINCT l_orderkey AS k FROM l JOIN part ON p_partkey = l_partkey)
SELECT s.k AS sprint_number, team AS team_dim_id, serial AS sprint_serial_id, CASE WHEN o.k IS NOT NULL THEN true END AS is_issues_loaded,
       CASE WHEN o.k IS NOT NULL THEN CAST(round(coalesce(points, 0)) AS BIGINT) END AS points, CASE WHEN o.k IS NOT NULL THEN coalesce(d.n, 0) END AS number_of_devs,
       CAST(round(points) AS BIGINT) AS points_again, issues, open_at_close, with_epic, issues AS with_project
FROM s LEFT JOIN o USING (k) LEFT JOIN h USING (k) LEFT JOIN d USING (k)
"""

_SQL_LINES = """(SELECT l_orderkey, l_linenumber, unnest(min({'l_partkey': l_partkey, 'l_suppkey': l_suppkey, 'l_quantity': l_quantity, 'l_shipdate': l_shipdate,
             'l_returnflag': l_returnflag, 'l_linestatus': l_linestatus})) FROM lineitem GROUP BY l_orderkey, l_linenumber)"""

ORACLE["issue_columns"] = f"""
WITH l AS (SELECT *, l_returnflag = 'R' AS r, l_linestatus = 'F' AS f, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.%f') || '-0500' AS t FROM {_SQL_LINES})
SELECT CASE WHEN NOT r THEN 'agent' || l_suppkey END AS assignee, 'C-' || l_partkey AS jira_case, CASE WHEN r THEN '[{{"name":"' || l_partkey || '"}}]' END AS components,
       t AS created, 'Maker ' || l_partkey AS creator, ' ' || l_suppkey AS crm_account, CASE WHEN NOT f THEN CAST(l_suppkey AS VARCHAR) END AS crm_contact,
       'line' || chr(10) || l_returnflag AS description, '[{{"name":"' || l_returnflag || '"}}]' AS fixVersions, CASE WHEN r THEN 'Return' ELSE 'Line' END AS issuetype,
       'LI-' || l_orderkey || '-' || l_linenumber AS key, CASE WHEN NOT r THEN l_linestatus END AS priority, CASE WHEN f THEN 'Caller ' || l_partkey END AS reporter,
       CASE WHEN f THEN 'Done' END AS resolution, CASE WHEN f THEN t END AS resolution_date, 'as shipped' AS status_description, l_linestatus AS status_name,
       CASE WHEN r THEN 'true' ELSE 'false' END AS subtask, '"q" ' || l_partkey AS summary, t AS updated, '[{{"name":"' || l_linestatus || '"}}]' AS versions,
       CAST(l_linenumber AS VARCHAR) AS watches, l_suppkey || '@x.test' AS reporter_email, l_returnflag AS channel,
       CASE WHEN r THEN '[{{"self":"x","value":"' || l_partkey || '"}}]' END AS product_name, 'Plain' AS request_type, CASE WHEN NOT r THEN 'Agent ' || l_suppkey END AS assignee_name
FROM l
"""

# crc32 of a text's bytes, which numbers the dimensions of the binding
_SQL_CRC = """xor(list_reduce(list_transform(string_split({c}, ''), lambda ch: CAST(ascii(ch) AS BIGINT)),
    lambda h, b: list_reduce([xor(h, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END),
    4294967295), 4294967295)"""

ORACLE["star_lookup_nine"] = f"""
WITH s AS (SELECT o_orderkey AS key, c_custkey, c_name, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS channel, o_orderstatus, o_orderpriority, o_orderdate, c_nationkey,
           CASE WHEN o_orderkey % 2 = 0 THEN 'P' WHEN o_orderkey % 3 = 0 THEN 'F' END AS resolution FROM orders JOIN customer ON o_custkey = c_custkey),
known AS (SELECT DISTINCT o_orderstatus AS x FROM orders),
dates AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS dt FROM orders WHERE o_orderkey % 6 <> 0),
num AS (SELECT x, {_SQL_CRC.format(c="x")} AS i FROM (SELECT DISTINCT c_mktsegment AS x FROM customer UNION SELECT x FROM known UNION SELECT DISTINCT o_orderpriority FROM orders
        UNION SELECT DISTINCT 'type ' || (o_orderkey % 11) FROM orders))
SELECT key, CASE WHEN c_custkey % 7 <> 0 THEN c_custkey END AS account_dim_id, CASE WHEN channel IS NULL THEN 0 ELSE n1.i END AS channel_dim_id,
       CASE WHEN c_custkey % 4 <> 0 THEN c_custkey + 3 END AS contact_dim_id, n2.i AS status_dim_id,
       CASE WHEN resolution IS NULL THEN 0 WHEN resolution IN (SELECT x FROM known) THEN n3.i END AS resolution_dim_id,
       CASE WHEN key % 5 <> 0 THEN n4.i END AS priority_dim_id, CASE WHEN dt IS NOT NULL THEN CAST(strftime(dt, '%Y%m%d') AS BIGINT) END AS date_dim_id,
       CASE WHEN key % 11 <> 3 THEN n5.i END AS kind_dim_id, CAST(n_nationkey + 50 AS BIGINT) AS assignee_dim_id, CAST(n_regionkey AS BIGINT) AS department_dim_id
FROM s LEFT JOIN num n1 ON n1.x = channel LEFT JOIN num n2 ON n2.x = o_orderstatus LEFT JOIN num n3 ON n3.x = resolution LEFT JOIN num n4 ON n4.x = o_orderpriority
LEFT JOIN num n5 ON n5.x = 'type ' || (key % 11) LEFT JOIN dates ON dt = CAST(o_orderdate AS DATE) LEFT JOIN nation ON n_nationkey = c_nationkey
"""

ORACLE["absent_members"] = f"""
WITH b AS (SELECT p_brand AS k, min(p_name) AS name, right(p_brand, 1) < '3' AS old FROM part GROUP BY p_brand),
ob AS (SELECT coalesce(max({_SQL_CRC.format(c="k")}), 0) AS m FROM b WHERE old),
g AS (SELECT DISTINCT c_mktsegment AS k FROM customer), og AS (SELECT k, length(k) AS i FROM g WHERE k > 'F'),
ng AS (SELECT k FROM (SELECT k FROM g UNION SELECT 'Seed ' || k FROM g) WHERE k NOT IN (SELECT k FROM og)),
e AS (SELECT 'EP-' || p_partkey AS k, min(p_name) AS name FROM part GROUP BY 1)
SELECT 'project' AS dimension, k AS member, {_SQL_CRC.format(c="k")} AS member_id, 'old' AS told FROM b WHERE old
UNION ALL SELECT 'project', k, m + row_number() OVER (ORDER BY k), name FROM b, ob WHERE NOT old
UNION ALL SELECT 'product', k, i, k FROM og
UNION ALL SELECT 'product', k, (SELECT coalesce(max(i), 0) FROM og) + row_number() OVER (ORDER BY k), k FROM ng
UNION ALL SELECT 'sprint', CAST(o_orderkey AS VARCHAR), CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE o_custkey END, CASE WHEN o_orderkey % 3 = 0 THEN 'old' ELSE 'S' || o_orderkey END FROM orders
UNION ALL SELECT 'epic', k, 9, 'old' FROM e WHERE k LIKE '%7'
UNION ALL SELECT 'epic', k, (SELECT CASE WHEN count(*) > 0 THEN 9 ELSE 0 END FROM e WHERE k LIKE '%7') + row_number() OVER (ORDER BY k), name FROM e WHERE k NOT LIKE '%7'
"""

ORACLE["staged_ticket_keys"] = "SELECT DISTINCT CASE WHEN l_orderkey % 10 <> 0 THEN 'LI-' || l_orderkey END AS key FROM lineitem"

ORACLE["teams_at_work"] = """
SELECT c_custkey AS team_dim_id, c_name AS team_name, CAST(c_nationkey AS BIGINT) AS jira_rapid_view_id FROM customer WHERE c_acctbal > 0 AND c_acctbal < 1000
"""

ORACLE["check_table"] = f"""
WITH c(table_name, condition, expected_value, actual_value) AS (
    SELECT 'orders', 'orders', 0, (SELECT count(*) FROM orders)
    UNION ALL SELECT 'orders', 'keys beyond orders', 0, (SELECT count(*) - count(DISTINCT o_orderkey) FROM orders)
    UNION ALL SELECT 'orders', 'open orders', 0, (SELECT count(*) FROM orders WHERE o_orderstatus = 'O')
    UNION ALL SELECT 'orders', 'orders without a customer', 0, (SELECT count(*) FROM orders WHERE o_custkey IS NULL)
    UNION ALL SELECT 'orders', 'customers of open orders', 5, (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_orderstatus = 'O')
    UNION ALL SELECT 'lineitem', 'lines', 0, (SELECT count(*) FROM lineitem)
    UNION ALL SELECT 'lineitem', 'lines of no quantity', 0, (SELECT count(*) FROM lineitem WHERE l_quantity <= 0)
    UNION ALL SELECT 'lineitem', 'highest line beyond 99', 0, (SELECT coalesce(max(l_linenumber), 0) FROM lineitem WHERE l_linenumber > 99)
    UNION ALL SELECT 'nowhere', 'rows of a lost table', 0, NULL)
SELECT table_name, condition, CAST(expected_value AS BIGINT) AS expected_value, CAST(actual_value AS BIGINT) AS actual_value,
       CASE WHEN expected_value = actual_value THEN 'Success' ELSE 'Fail' END AS status, TIMESTAMP '{LOADS[0]}' AS created_date, CAST(3 AS BIGINT) AS task_id FROM c
"""
