"""Sources and sinks (S1-S17): landed tracker payloads and staging writes.

The HTTP client is not part of the build; each API response page is landed
as one JSON document (a file line or a string column) and read here with an
explicit schema - no inference, nested fields selected by path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimwright.operators.keys import assign_keys
from dimwright.operators.patterns import one_per_key
from dimwright.sources.pages import Listing

# ---------------------------------------------------------------- schemas
ITEM_T = "struct<field:string, `from`:string, `to`:string, fromString:string, toString:string>"
HISTORY_T = f"struct<created:string, items:array<{ITEM_T}>>"
USER_T = "struct<key:string, displayName:string>"
FIELDS_T = (
    f"struct<assignee:{USER_T}, creator:{USER_T}, reporter:{USER_T}, created:string, updated:string, "
    "resolutiondate:string, components:array<struct<name:string>>, description:string, summary:string, "
    "fixVersions:array<struct<name:string>>, versions:array<struct<name:string>>, "
    "issuetype:struct<name:string, subtask:boolean>, priority:struct<name:string>, resolution:struct<name:string>, "
    "status:struct<name:string, description:string>, watches:struct<watchCount:int>, "
    "customfield_12409:string, customfield_12410:string, customfield_12411:string, customfield_11905:string, "
    "customfield_11809:string, customfield_13609:string, customfield_11813:string>"
)
ISSUE_T = f"struct<id:string, key:string, fields:{FIELDS_T}, changelog:struct<histories:array<{HISTORY_T}>>>"
ISSUE_PAGE_T = f"struct<startAt:int, total:int, issues:array<{ISSUE_T}>>"
# Issues kept whole: a string-typed field receives the raw JSON text of the object.
RAW_ISSUE_PAGE_T = "struct<startAt:int, total:int, issues:array<string>>"
SPRINT_PAGE_T = ("struct<isLast:boolean, values:array<struct<id:long, name:string, originBoardId:long, "
                 "startDate:string, endDate:string, completeDate:string>>>")
WORKFLOW_T = "array<struct<name:string, statuses:array<struct<name:string, id:string>>>>"
RESOLUTION_T = "array<struct<name:string, id:string>>"
USERS_T = "array<struct<key:string, displayName:string, emailAddress:string, active:boolean>>"
PRODUCTS_T = ("struct<projects:array<struct<issuetypes:array<struct<fields:struct<customfield_13609:"
              "struct<allowedValues:array<struct<value:string, id:string>>>>>>>>>")
PROJECTS_T = "array<struct<id:string, key:string, name:string>>"
EPIC_PAGE_T = ("struct<issues:array<struct<id:string, key:string, fields:struct<customfield_10416:string, "
               "customfield_12741:double, customfield_12740:string, created:string, updated:string, "
               "resolutiondate:string>>>>")
BOARDS_T = ("struct<views:array<struct<id:long, name:string, filter:struct<owner:struct<userName:string, "
            "displayName:string>>>>>")
DEPARTMENT_CSV_T = "displayname string, samaccountname string, department string"


# ---------------------------------------------------------------- kinds of pages
ISSUES = Listing("issues", ISSUE_PAGE_T, "issues")
RAW_ISSUES = Listing("sprint issues", RAW_ISSUE_PAGE_T, "issues")
SPRINTS = Listing("sprints", SPRINT_PAGE_T, "values")
WORKFLOW = Listing("workflow", WORKFLOW_T)
RESOLUTIONS = Listing("resolutions", RESOLUTION_T)
USERS = Listing("users", USERS_T)
PRODUCTS = Listing("products", PRODUCTS_T, "projects")
PROJECTS = Listing("projects", PROJECTS_T)
EPICS = Listing("epics", EPIC_PAGE_T, "issues")
BOARDS = Listing("boards", BOARDS_T, "views")


def _parse(docs: DataFrame, listing: Listing, col: str = "value", keep: Sequence[str | Column] = ()) -> DataFrame:
    """Documents of pages; one that cannot be read ends the run (see :mod:`dimwright.sources.pages`)."""
    return docs.select(*keep, listing.read(F.col(col)).alias("doc"))


def _page(docs: DataFrame, page: str | None) -> Column:
    """The landed page's place, for "first row per key": the column named, else
    ``page`` where the pages carry one; without one they are a single list."""
    name = page or ("page" if "page" in docs.columns else None)
    return (F.col(name) if name else F.lit(0)).alias("_page")


def landed_since(docs: DataFrame, watermark: DataFrame, day: str = "day") -> DataFrame:
    """A3 on landed pages: those of day folders from the watermark's day on; all of them before the first run.

    A row changed on or after that day was landed no earlier, so no page that
    :func:`dimwright.operators.control.incremental` would take rows from is left
    out. ``day`` is a partition column and the watermark a scalar subquery:
    older folders are not opened.
    """
    since = watermark.select(F.to_date("watermark")).scalar()
    return docs.filter(since.isNull() | (F.col(day) >= since))


def read_json_docs(spark: SparkSession, path: str, watermark: DataFrame | None = None) -> DataFrame:
    """Landed documents, one per line, as a ``value`` string column, with the
    columns of their folders and their place ``page``: file name, block of the
    file, line in it. Pages are landed in files whose names sort in request
    order. ``watermark`` leaves out folders of earlier days (:func:`landed_since`)."""
    docs = spark.read.text(path)
    if watermark is not None:       # before the line numbers, which no filter passes
        docs = landed_since(docs, watermark)
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    return docs.select("*", at.alias("page"))


# ---------------------------------------------------------------- S1 / S1b / S9
def read_issue_pages(pages: DataFrame, col: str = "value") -> DataFrame:
    """Issues of every landed search page (pages of 100, concatenated)."""
    # exploded where it is parsed: over a column of its own, the filter on its size would parse it again
    return pages.select(F.explode(ISSUES.read(F.col(col))["issues"]).alias("issue")).select("issue.*")


def _option(c: str) -> Column:
    """The value of a single-choice field landed as an option object; a plain text as it is."""
    return F.when(F.col(c).startswith("{"), F.get_json_object(c, "$.value")).otherwise(F.col(c))


def flatten_issues(issues: DataFrame) -> DataFrame:
    """The 27 stage columns. The assignee key is null-safe; custom fields
    get their business names, channel and request type the value of their
    option; ``product_name`` keeps the option list (see ``option_ids``)."""
    f = "fields."
    return issues.select(
        F.col(f + "assignee.key").alias("assignee"), F.col(f + "customfield_12409").alias("jira_case"),
        F.to_json(f + "components").alias("components"), F.col(f + "created").alias("created"),
        F.col(f + "creator.displayName").alias("creator"), F.col(f + "customfield_12411").alias("crm_account"),
        F.col(f + "customfield_12410").alias("crm_contact"), F.col(f + "description").alias("description"),
        F.to_json(f + "fixVersions").alias("fixVersions"), F.col(f + "issuetype.name").alias("issuetype"),
        F.col("key"), F.col(f + "priority.name").alias("priority"),
        F.col(f + "reporter.displayName").alias("reporter"), F.col(f + "resolution.name").alias("resolution"),
        F.col(f + "resolutiondate").alias("resolution_date"),
        F.col(f + "status.description").alias("status_description"), F.col(f + "status.name").alias("status_name"),
        F.col(f + "issuetype.subtask").cast("string").alias("subtask"), F.col(f + "summary").alias("summary"),
        F.col(f + "updated").alias("updated"), F.to_json(f + "versions").alias("versions"),
        F.col(f + "watches.watchCount").cast("string").alias("watches"),
        F.col(f + "customfield_11905").alias("reporter_email"), _option(f + "customfield_11809").alias("channel"),
        F.col(f + "customfield_13609").alias("product_name"), _option(f + "customfield_11813").alias("request_type"),
        F.col(f + "assignee.displayName").alias("assignee_name"))


def read_sprint_issue_pages(pages: DataFrame, col: str = "value") -> DataFrame:
    """Issues of sprint-issue pages, each issue kept whole as its JSON text
    (every field, not only those of a schema)."""
    iss = pages.select(F.explode(RAW_ISSUES.read(F.col(col))["issues"]).alias("i"))
    return iss.select(F.get_json_object("i", "$.id").alias("jira_ticket_id"),
                      F.get_json_object("i", "$.key").alias("jira_ticket_key"), F.col("i").alias("ticket_details"))


# ---------------------------------------------------------------- S2
def _last_item(items: Column, field: str) -> Column:
    picked = F.filter(items, lambda x: x["field"] == field)
    return F.when(F.size(picked) > 0, F.element_at(picked, -1))


def flatten_changelog(issues: DataFrame) -> DataFrame:
    """One row per history with its last status item and last assignee
    item; histories with neither are dropped; missing values become '0'.

    Items are picked with array functions inside the history row, so the
    only expansion is one row per history - no shuffle.
    """
    h = issues.select(F.col("key").alias("jira_key"), F.col("fields.created").alias("issue_create_date"),
                      F.posexplode("changelog.histories").alias("hist_pos", "h"))
    h = h.select("jira_key", "issue_create_date", "hist_pos", F.col("h.created").alias("date"),
                 _last_item(F.col("h.items"), "status").alias("s"), _last_item(F.col("h.items"), "assignee").alias("a"))
    vals = {
        "to_status": F.col("s.toString"), "from_status": F.col("s.fromString"),
        "to_id": F.col("s.to"), "from_id": F.col("s.from"),
        "to_user": F.col("a.to"), "from_user": F.col("a.from"),
        "to_user_name": F.col("a.toString"), "from_user_name": F.col("a.fromString"),
    }
    any_value = None
    for v in vals.values():
        any_value = v.isNotNull() if any_value is None else (any_value | v.isNotNull())
    out = h.filter(any_value).select(
        "jira_key", F.col("hist_pos").cast("long").alias("hist_pos"),
        *[F.coalesce(v, F.lit("0")).alias(k) for k, v in vals.items()],
        F.coalesce(F.col("date"), F.lit("0")).alias("date"),
        F.coalesce(F.col("issue_create_date"), F.lit("0")).alias("issue_create_date"))
    return out.select("jira_key", "hist_pos", "to_status", "from_status", "date", "to_id", "from_id",
                      "issue_create_date", "to_user", "from_user", "to_user_name", "from_user_name")


# ---------------------------------------------------------------- S3 / S4 / S4b / S5 / S6 / S7
def read_workflow_statuses(docs: DataFrame, col: str = "value", page: str | None = None) -> DataFrame:
    """S3: statuses of every issue type, flag true, first occurrence per id."""
    it = _parse(docs, WORKFLOW, col, [_page(docs, page)]).select("_page", F.posexplode("doc").alias("p1", "t"))
    st = it.select("_page", "p1", F.posexplode("t.statuses").alias("p2", "s"))
    st = st.select(F.col("s.name").alias("status"), F.col("s.id").cast("long").alias("id"), "_page", "p1", "p2")
    first = one_per_key(st, ["id"], ["_page", "p1", "p2"])
    return first.select("status", "id", F.lit(True).alias("flag"))


def read_resolutions(docs: DataFrame, col: str = "value", page: str | None = None) -> DataFrame:
    """Resolutions other than 'Closed', flag false, first occurrence per id."""
    r = _parse(docs, RESOLUTIONS, col, [_page(docs, page)]).select("_page", F.posexplode("doc").alias("p", "r"))
    r = r.filter(F.col("r.name") != "Closed").select(F.col("r.name").alias("status"),
                                                       F.col("r.id").cast("long").alias("id"), "_page", "p")
    return one_per_key(r, ["id"], ["_page", "p"]).select("status", "id", F.lit(False).alias("flag"))


def union_statuses(workflow: DataFrame, resolutions: DataFrame) -> DataFrame:
    """UNION ALL of S3 and S4."""
    return workflow.unionByName(resolutions)


def read_users(docs: DataFrame, col: str = "value", page: str | None = None) -> DataFrame:
    """Four user columns, the first row per key."""
    u = _parse(docs, USERS, col, [_page(docs, page)]).select("_page", F.posexplode("doc").alias("p", "u"))
    u = u.select(F.col("u.key").alias("user_id"), F.col("u.displayName").alias("user_name"),
                 F.col("u.emailAddress").alias("email_id"), F.col("u.active").alias("active"), "_page", "p")
    return one_per_key(u, ["user_id"], ["_page", "p"]).drop("_page", "p")


def read_products(docs: DataFrame, col: str = "value") -> DataFrame:
    """Allowed product values of issue types that have the product field; distinct."""
    p = _parse(docs, PRODUCTS, col).select(F.explode("doc.projects").alias("pr"))
    t = p.select(F.explode("pr.issuetypes").alias("it")).filter(F.col("it.fields.customfield_13609").isNotNull())
    v = t.select(F.explode("it.fields.customfield_13609.allowedValues").alias("v"))
    return v.select(F.col("v.value").alias("product_name"), F.col("v.id").alias("api_id")).distinct()


def read_projects(docs: DataFrame, col: str = "value") -> DataFrame:
    """Id (as int), key, name; distinct."""
    p = _parse(docs, PROJECTS, col).select(F.explode("doc").alias("p"))
    return p.select(F.col("p.id").cast("long").alias("project_id"), F.col("p.key").alias("project_key"),
                    F.col("p.name").alias("project_name")).distinct()


# ---------------------------------------------------------------- S8
def read_sprint_pages(pages: DataFrame, col: str = "value", page_pos: str | None = None,
                      keep: Sequence[str] = ()) -> DataFrame:
    """Sprint page values with their position (page order, then position in page);
    ``keep`` columns of the landed rows (such as the board id) are carried along."""
    page = F.col(page_pos) if page_pos else F.lit(0)
    v = pages.select(*keep, page.alias("_page"), F.posexplode(SPRINTS.read(F.col(col))["values"]).alias("_pos", "s"))
    return v.select(*keep, "_page", "_pos", F.col("s.id").alias("sprint_number"), F.col("s.name").alias("sprint_name"),
                    F.col("s.originBoardId").alias("originBoardId"), F.col("s.startDate").alias("sprint_start_date"),
                    F.col("s.endDate").alias("sprint_end_date"), F.col("s.completeDate").alias("sprint_complete_date"))


def number_sprints(sprints: DataFrame, order_by: Sequence[str], max_serial: int, board, team_dim_id) -> DataFrame:
    """Serial id = previous max + position over *all* listed sprints, then
    keep the board's own sprints (this order matters), distinct."""
    numbered = assign_keys(sprints, list(order_by), "sprint_serial_id", base=max_serial)
    return (numbered.filter(F.col("originBoardId") == F.lit(board))
            .withColumn("team_dim_id", F.lit(team_dim_id).cast("long"))
            .drop("originBoardId").distinct())


def number_board_sprints(listed: DataFrame, high_water: DataFrame) -> DataFrame:
    """S8 for many boards at once: serial = the board's high water (C1) + the
    position over *all* sprints listed for the board (earlier pages first).

    ``listed`` comes from :func:`read_sprint_pages` with ``board_id`` kept. The
    position is the count of entries on the board's earlier pages plus the
    position on the page; the running sum runs over one row per (board, page),
    never over the sprints, so a long board list is not gathered in one task.
    """
    page_sizes = listed.groupBy("board_id", "_page").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("board_id").orderBy("_page").rowsBetween(Window.unboundedPreceding, -1)
    offsets = page_sizes.select("board_id", "_page", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    hw = high_water.select(F.col("jira_rapid_view_id").alias("board_id"), F.col("sprint_number").alias("_hw"),
                           "team_dim_id")
    return (listed.join(offsets, ["board_id", "_page"]).join(hw, "board_id")
            .withColumn("sprint_serial_id", (F.col("_hw") + F.col("_before") + F.col("_pos") + 1).cast("long"))
            .drop("_before", "_hw"))


# ---------------------------------------------------------------- S10 / S10b / S11
def read_epics(docs: DataFrame, after_id: int | str = 0, col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Epic fields and ``is_closed``; ids above ``after_id`` (the request's
    lower bound: a number, or the name of a column of ``docs`` holding each
    page's bound). ``keep`` columns of ``docs`` are carried along."""
    bound = F.col(after_id) if isinstance(after_id, str) else F.lit(after_id)
    e = docs.select(*keep, bound.alias("_after"), F.explode(EPICS.read(F.col(col))["issues"]).alias("e"))
    out = e.select(*keep, "_after",
                   F.col("e.fields.customfield_10416").alias("epic_name"), F.col("e.id").cast("long").alias("epic_id"),
                   F.col("e.key").alias("epic_key"), F.col("e.fields.customfield_12741").alias("aha_score"),
                   F.col("e.fields.resolutiondate").isNotNull().alias("is_closed"),
                   F.col("e.fields.created").alias("date_created"), F.col("e.fields.updated").alias("date_updated"),
                   F.col("e.fields.resolutiondate").alias("date_resolved"),
                   F.col("e.fields.customfield_12740").alias("aha_reference"))
    return out.filter(F.col("epic_id") > F.col("_after")).drop("_after")


def read_boards(docs: DataFrame, col: str = "value") -> DataFrame:
    """Board id, name, owner id and owner name."""
    b = _parse(docs, BOARDS, col).select(F.explode("doc.views").alias("v"))
    return b.select(F.col("v.id").alias("rapidview_id"), F.col("v.name").alias("rapidview_name"),
                    F.col("v.filter.owner.userName").alias("owner_id"),
                    F.col("v.filter.owner.displayName").alias("owner_name"))


# ---------------------------------------------------------------- S12-S17
def read_department_csv(spark: SparkSession, path: str) -> DataFrame:
    """Display name, account name, department; '' is NULL."""
    return spark.read.schema(DEPARTMENT_CSV_T).csv(path, header=True, nullValue="", mode="FAILFAST")


def parse_department_lines(lines: DataFrame, sep: str = "|", col: str = "value") -> DataFrame:
    """S12/S13 on text already in a column: pipe-delimited lines, '' is NULL."""
    parsed = lines.select(F.from_csv(F.col(col), DEPARTMENT_CSV_T, {"sep": sep, "nullValue": ""}).alias("r"))
    return parsed.select("r.*")


def write_stage(df: DataFrame, root: str, run_id) -> str:
    """Each run writes a fresh snapshot folder; a stage is replaced
    by pointing at the new folder, never by overwriting the one being read."""
    path = f"{root.rstrip('/')}/run_id={run_id}"
    df.write.mode("errorifexists").parquet(path)
    return path


def append_history(history: DataFrame | None, stage: DataFrame, run_id, load_time) -> DataFrame:
    """Stage rows appended to history with run id and load time."""
    add = stage.withColumn("run_id", F.lit(run_id).cast("long")).withColumn(
        "load_time", F.lit(load_time).cast("timestamp_ntz"))
    return add if history is None else history.unionByName(add)


def read_table(spark: SparkSession, path_or_name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A warehouse table (parquet path or catalog name), pruned to ``columns``."""
    df = spark.read.parquet(path_or_name) if "/" in path_or_name else spark.table(path_or_name)
    return df.select(*columns) if columns else df
