"""Operators bound to the driver's tables.

Each binding maps a driver table onto an operator's inputs (orders as
tickets, events as change logs, customer as a user dimension, ...), runs the
operator over the whole table, and returns a DataFrame whose columns match
the DuckDB statement of the same name in :mod:`dimwright.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimwright.functions.intervals import pending_days
from dimwright.functions.text import clean_name, option_ids
from dimwright.operators import control, dims, facts, sprints, transitions
from dimwright.operators.keys import assign_keys
from dimwright.operators.patterns import insert_missing, update_from
from dimwright.operators.windows import lag_by_key
from dimwright.plans import jobs
from dimwright.sources import landed

# Fixed parameters of the bindings (the oracle uses the same literals).
AS_OF_ORDERS = "2002-01-01 00:00:00"
AS_OF_EVENTS = "2024-02-01 00:00:00"
FIRST_SHIFT_END = "2024-01-01 06:00:00"
FIRST_WEEK_END = "2024-01-08 00:00:00"
SPRINT_DAYS = 60
PENDING_CUTOFF = "1998-01-01 00:00:00"
SERIAL_BASE = 1000
WATERMARK = "1998-06-15 13:00:00"


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def _ts(x: str) -> Column:
    return F.lit(x).cast("timestamp_ntz")


def _customer_ref(custkey: str) -> Column:
    """The customer's natural key text as a ticket would carry it."""
    return F.concat(F.lit("Customer#"), F.lpad(F.col(custkey).cast("string"), 9, "0"))


def _user_key(c: str = "user_id") -> Column:
    return F.concat(F.lit("U-"), F.col(c).cast("string"))


def _name_dim(spark: SparkSession, source: DataFrame, col: Column, id_col: str, name_col: str) -> DataFrame:
    """A dimension grown from empty by D4 (distinct names, 'None' for null)."""
    empty = _empty(spark, f"{id_col} long, {name_col} string")
    return dims.insert_missing_names(empty, col, source, name_col, id_col)


def _type_dim(spark: SparkSession, ev: DataFrame) -> DataFrame:
    """Event types as a status dimension; every type but 'error' is a workflow status."""
    d = _name_dim(spark, ev, F.col("event_type"), "jira_status_dim_id", "jira_status")
    return d.withColumn("is_workflow_status", F.col("jira_status") != "error")


# ------------------------------------------------------------------ F2
def star_lookup(spark: SparkSession, d: str) -> DataFrame:
    o = _t(spark, d, "orders")
    cust = _t(spark, d, "customer").select(F.col("c_name").alias("accountid"),
                                             F.col("c_custkey").alias("customer_dim_id"))
    status = _name_dim(spark, o, F.col("o_orderstatus"), "jira_status_dim_id", "jira_status")
    prio = _name_dim(spark, o, F.col("o_orderpriority"), "jira_priority_dim_id", "jira_priority")
    dates = facts.date_key_frame(o, "o_orderdate")
    stage = o.select(F.col("o_orderkey").alias("jira_key"), _customer_ref("o_custkey").alias("crm_account"),
                     "o_orderstatus", "o_orderpriority", "o_orderdate")
    out = facts.star_lookup(stage, [
        facts.Lookup(cust, "crm_account", "accountid", "customer_dim_id", "account_dim_id", default_member=False),
        facts.Lookup(status, "o_orderstatus", "jira_status", "jira_status_dim_id", "status_dim_id"),
        facts.Lookup(prio, "o_orderpriority", "jira_priority", "jira_priority_dim_id", "priority_dim_id"),
        facts.Lookup(dates, "o_orderdate", "dt", "sk_date", "date_created_dim_id", on_date=True),
    ])
    return out.select("jira_key", "account_dim_id", "status_dim_id", "priority_dim_id", "date_created_dim_id")


# ------------------------------------------------------------------ F3
def _resolved_orders(spark: SparkSession, d: str) -> DataFrame:
    o = _t(spark, d, "orders")
    last_ship = _t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("resolution_date"))
    return o.join(last_ship, o["o_orderkey"] == last_ship["l_orderkey"], "left")


def close_measures(spark: SparkSession, d: str) -> DataFrame:
    o = _resolved_orders(spark, d)
    return o.select(F.col("o_orderkey").alias("jira_key"),
                    *facts.ticket_measures("o_orderdate", "resolution_date", AS_OF_ORDERS))


def open_age(spark: SparkSession, d: str) -> DataFrame:
    o = _t(spark, d, "orders")
    # finished orders count as closed on their own day, the others are open
    closed = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))
    return o.select(F.col("o_orderkey").alias("jira_key"), "o_orderdate",
                    pending_days("o_orderdate", closed, AS_OF_ORDERS).alias("pending_since_in_days"))


# ------------------------------------------------------------------ F4 / T14
def date_keys(spark: SparkSession, d: str) -> DataFrame:
    o = _t(spark, d, "orders")
    dd = facts.date_key_frame(_t(spark, d, "lineitem"), "l_shipdate")
    fact = o.select(F.col("o_orderkey").alias("jira_key"), (F.col("o_orderstatus") != "P").alias("is_active"),
                    F.lit(None).cast("long").alias("date_resolved_dim_id"),
                    F.lit(0).cast("long").alias("status_change_date_dim_id"),
                    F.col("o_orderdate").alias("status_change_date"))
    stage = o.select(F.col("o_orderkey").alias("key"), F.col("o_orderdate").alias("resolution_date"))
    src = (stage.join(dd, F.to_date("resolution_date") == dd["dt"], "left").select("key", "sk_date"))
    f4 = update_from(fact, src, [("jira_key", "key")], {"date_resolved_dim_id": F.col("s.sk_date")},
                     where=F.col("t.is_active"), source_order=["sk_date"])
    t14 = transitions.change_date_key(f4, stage, dd)
    return t14.select("jira_key", "is_active", "date_resolved_dim_id", "status_change_date_dim_id")


# ------------------------------------------------------------------ P-NEW
def new_members(spark: SparkSession, d: str) -> DataFrame:
    ev = _t(spark, d, "events")
    empty = _empty(spark, "user_dim_id long, user_id long")
    shift = ev.filter(F.col("ts") < _ts(FIRST_SHIFT_END)).select("user_id").distinct()
    dim = insert_missing(empty, shift, ["user_id"], "user_dim_id")
    return insert_missing(dim, ev.select("user_id").distinct(), ["user_id"], "user_dim_id")


def new_members_not_in(spark: SparkSession, d: str) -> DataFrame:
    p = _t(spark, d, "part")
    empty = _empty(spark, "department_dim_id long, department_name string")
    dim = dims.insert_missing_names(empty, F.col("p_brand"), p.filter(F.col("p_size") <= 2),
                                    "department_name", "department_dim_id")
    cand = F.when(F.col("p_size") <= 48, F.col("p_brand"))
    return dims.insert_missing_names(dim, cand, p, "department_name", "department_dim_id",
                                     null_aware=True, default_null=False)


# ------------------------------------------------------------------ D7
def changed_attributes(spark: SparkSession, d: str) -> DataFrame:
    c = _t(spark, d, "customer")
    s = _t(spark, d, "supplier")
    mail = F.concat(F.lower(F.col("c_name")), F.lit("@users.test"))
    dim = c.select((F.col("c_custkey") + 1).alias("jira_user_dim_id"), F.col("c_name").alias("jira_user_id"),
                   F.col("c_mktsegment").alias("jira_user_name"), F.lit("SERVICDESK").alias("jira_project"),
                   F.when(F.col("c_mktsegment") != "MACHINERY", mail).alias("email_id"),
                   (F.col("c_acctbal") >= 0).alias("is_active"))
    users = c.select(F.col("c_name").alias("user_id"),
                     F.when(F.col("c_acctbal") > 5000, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment"))
                     .alias("user_name"), mail.alias("email_id"), (F.col("c_acctbal") >= 0).alias("active"))
    users = users.unionByName(s.select(F.col("s_name").alias("user_id"), F.lit("SUPPLIER").alias("user_name"),
                                       F.concat(F.lower("s_name"), F.lit("@users.test")).alias("email_id"),
                                       (F.col("s_acctbal") >= 0).alias("active")))
    return dims.upsert_users(dim, users)


# ------------------------------------------------------------------ D12
def fuzzy_parent(spark: SparkSession, d: str) -> DataFrame:
    p = _t(spark, d, "part")
    names = (p.filter(F.col("p_size") > 45).select(F.col("p_name").alias("n"))
             .unionByName(p.select(F.split_part("p_name", F.lit(" "), F.lit(2)).alias("n"))).distinct())
    parent = assign_keys(names, ["n"], "jira_product_dim_id").withColumnRenamed("n", "jira_product_name")
    child = p.select(F.col("p_partkey").alias("project_dim_id"), F.col("p_name").alias("project_name"),
                     F.when(F.col("p_size") < 5, F.lit(0).cast("long")).alias("product_dim_id"))
    out = dims.fuzzy_assign(child, parent, "project_dim_id", "project_name", "product_dim_id",
                            "jira_product_dim_id", "jira_product_name")
    return out.select("project_dim_id", "product_dim_id")


# ------------------------------------------------------------------ D17
def priority_lookup(spark: SparkSession, d: str) -> DataFrame:
    s = _t(spark, d, "supplier")
    n = _t(spark, d, "nation")
    r = _t(spark, d, "region")
    users = s.select(F.col("s_suppkey").alias("jira_user_dim_id"), F.upper("s_name").alias("jira_user_id"),
                     F.concat(F.lit("Vendor "), F.col("s_suppkey").cast("string")).alias("jira_user_name"),
                     F.when(F.col("s_acctbal") > 9000, F.lit(99).cast("long")).alias("department_dim_id"))
    sn = s.join(n, s["s_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"])
    by_acct = sn.filter(F.col("s_acctbal") > 2000).select(
        F.lit(None).cast("string").alias("displayname"),
        F.concat(F.lit(" "), F.col("s_name"), F.lit(" ")).alias("samaccountname"),
        F.col("n_name").alias("department"))
    by_disp = sn.select(F.concat(F.lit("vendor "), F.col("s_suppkey").cast("string")).alias("displayname"),
                        F.lit(None).cast("string").alias("samaccountname"), F.col("r_name").alias("department"))
    mapping = by_acct.unionByName(by_disp)
    empty = _empty(spark, "department_dim_id long, department_name string")
    dept = dims.insert_missing_names(empty, F.col("department"), mapping, "department_name", "department_dim_id",
                                     null_aware=True, default_null=False)
    out = dims.assign_department(users, mapping, dept)
    return out.select("jira_user_dim_id", "department_dim_id")


# ------------------------------------------------------------------ F1 / P-SCD
def supersede_versions(spark: SparkSession, d: str) -> DataFrame:
    o = _t(spark, d, "orders")
    c = _t(spark, d, "customer")
    fact = o.select(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("jira_key"), "o_orderkey",
                    (F.col("o_orderstatus") != "F").alias("is_active"), F.col("o_orderdate").alias("date_updated"))
    stage = c.filter(F.col("c_mktsegment") == "AUTOMOBILE").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("key"))
    old = facts.supersede_tickets(fact, stage, AS_OF_ORDERS)
    new = stage.distinct().select(F.col("key").alias("jira_key"), F.lit(None).cast("long").alias("o_orderkey"),
                                  F.lit(True).alias("is_active"), _ts(AS_OF_ORDERS).alias("date_updated"))
    return old.unionByName(new)


# ------------------------------------------------------------------ F5 / F6
def _contact_frames(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    c = _t(spark, d, "customer")
    s = _t(spark, d, "supplier")
    contacts = s.select(F.col("s_suppkey").alias("contact_dim_id"), F.col("s_name").alias("contactid"),
                        F.when(F.col("s_acctbal") >= 0, F.concat(F.lower("s_name"), F.lit("@contacts.test")))
                        .alias("emailaddress"))
    sup_name = F.regexp_replace("c_name", "Customer", "Supplier")
    guid = (F.when(F.col("c_mktsegment") == "BUILDING", sup_name)
            .when(F.col("c_mktsegment") == "AUTOMOBILE", F.concat(F.lit(" "), sup_name, F.lit(" ")))
            .when(F.col("c_mktsegment") == "MACHINERY", F.lit("")))
    mail = F.when(F.col("c_mktsegment") != "HOUSEHOLD",
                  F.concat(F.lit("supplier#"), F.lpad(F.col("c_nationkey").cast("string"), 9, "0"),
                           F.lit("@contacts.test")))
    stage = c.select(F.col("c_custkey").cast("string").alias("key_stage"), guid.alias("crm_contact_stage"),
                     mail.alias("reporter_email_stage"))
    return stage, contacts


def match_codes(spark: SparkSession, d: str) -> DataFrame:
    stage, contacts = _contact_frames(spark, d)
    codes = facts.match_codes(stage, contacts)
    fact = stage.select(F.col("key_stage").alias("jira_key"), F.lit(True).alias("is_active"),
                        F.lit(None).cast("int").alias("jira_contact_guid_map_status_id"))
    out = facts.apply_match_code(fact, codes)
    return out.select("jira_key", F.col("jira_contact_guid_map_status_id").cast("long"))


# ------------------------------------------------------------------ F7 / F8
def deactivate(spark: SparkSession, d: str) -> DataFrame:
    o = _t(spark, d, "orders")
    c = _t(spark, d, "customer")
    fact = o.select(F.col("o_orderkey").alias("jira_key"), F.col("o_custkey").alias("account_dim_id"),
                    F.col("o_custkey").alias("contact_dim_id"), (F.col("o_orderstatus") != "P").alias("is_active"))
    out = facts.deactivate_by(fact, c, "account_dim_id", "c_custkey", F.col("c_name") == "Customer#000000007")
    out = facts.deactivate_by(out, c, "contact_dim_id", "c_custkey",
                              (F.trim("c_mktsegment") == "AUTOMOBILE") & (F.col("c_nationkey") == 3))
    return out.select("jira_key", "is_active")


# ------------------------------------------------------------------ F9 / F10
def fill_nulls(spark: SparkSession, d: str) -> DataFrame:
    o = _t(spark, d, "orders")
    c = _t(spark, d, "customer")
    fact = o.select(F.col("o_orderkey").alias("jira_key"), F.col("o_custkey").alias("assignee_dim_id"),
                    F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(0).cast("long")).alias("department_dim_id"),
                    F.lit(None).cast("long").alias("jira_origin_dim_id"),
                    (F.col("o_orderstatus") != "P").alias("is_active"), F.col("o_orderdate").alias("date_updated"))
    users = c.select(F.col("c_custkey").alias("jira_user_dim_id"), F.col("c_nationkey").cast("long").alias("department_dim_id"))
    out = facts.fill_from_dim(fact, users, "assignee_dim_id", "jira_user_dim_id", "department_dim_id",
                              "department_dim_id")
    incidents = c.select(F.col("c_name").alias("ticketnumber"),
                         F.when(F.col("c_mktsegment") != "FURNITURE", F.col("c_mktsegment")).alias("caseorigincodename"),
                         F.col("c_nationkey").alias("caseorigincode"))
    origin = dims.insert_missing_origins(
        _empty(spark, "jira_origin_dim_id long, jira_origin_name string, source_case_origin_id long"),
        incidents.filter(F.col("caseorigincode") < 20))
    stage = o.select(F.col("o_orderkey").alias("key"), _customer_ref("o_custkey").alias("jira_case"))
    out = facts.assign_origin(out, stage, incidents, origin, AS_OF_ORDERS)
    return out.select("jira_key", "department_dim_id", "jira_origin_dim_id", "is_active", "date_updated")


# ------------------------------------------------------------------ F11
def _product_stage(spark: SparkSession, d: str) -> DataFrame:
    li = _t(spark, d, "lineitem")
    p = _t(spark, d, "part")
    j = li.join(p, li["l_partkey"] == p["p_partkey"])
    text = F.concat(F.lit("[<JIRA CustomFieldOption: value='"), F.col("p_name"), F.lit("', id='"),
                    F.col("l_partkey").cast("string"),
                    F.lit("'>, <JIRA CustomFieldOption: value='Support = id's', id='"),
                    (F.col("l_suppkey") + 1000000).cast("string"), F.lit("'>]"))
    return j.select(F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
                    .alias("key"), "l_linenumber", "l_partkey", text.alias("product_name"))


def product_bridge(spark: SparkSession, d: str) -> DataFrame:
    stage = _product_stage(spark, d)
    p = _t(spark, d, "part")
    products = p.filter(F.col("p_size") <= 40).select(
        (F.col("p_partkey") + 1).alias("jira_product_dim_id"), F.col("p_name").alias("jira_product_name"),
        F.col("p_partkey").cast("string").alias("jira_product_api_id"))
    existing = (stage.filter(F.col("l_linenumber") == 1)
                .join(products, stage["l_partkey"].cast("string") == products["jira_product_api_id"])
                .select(F.col("key").alias("jira_key"), "jira_product_dim_id"))
    return facts.explode_products(stage, products, existing)


# ------------------------------------------------------------------ T1 / T2
def status_grid(spark: SparkSession, d: str) -> DataFrame:
    ev = _t(spark, d, "events")
    st = _type_dim(spark, ev)
    fact = ev.select(_user_key().alias("jira_key")).distinct().withColumn("is_active", F.lit(True))
    existing = (ev.filter(F.col("ts") < _ts(FIRST_WEEK_END))
                .join(st, ev["event_type"] == st["jira_status"])
                .select(_user_key().alias("jira_key"), F.col("jira_status_dim_id").alias("to_status_dim_id")))
    return transitions.status_grid(fact, st, existing)


# ------------------------------------------------------------------ T3 / T4 / D9
def _event_log(ev: DataFrame) -> DataFrame:
    """Events as flattened change-log rows (S2 shape, missing values '0')."""
    k = F.get_json_object("props", "$.k")
    view = F.col("event_type") == "view"
    handed_over = F.col("value") > 40
    user = F.concat(F.lit("user"), F.col("user_id").cast("string"))
    name = F.concat(F.lit("User "), F.col("user_id").cast("string"))
    return ev.select(
        "event_id", _user_key().alias("jira_key"), F.col("event_type").alias("to_status"),
        F.when(view, F.lit("Open")).otherwise(F.lit("0")).alias("from_status"), F.col("ts").alias("date"),
        k.alias("to_id"), F.when(view, k).otherwise(F.lit("0")).alias("from_id"),
        user.alias("to_user"), F.when(handed_over, user).otherwise(F.lit("0")).alias("from_user"),
        name.alias("to_user_name"), F.when(handed_over, name).otherwise(F.lit("0")).alias("from_user_name"))


def late_and_lookup(spark: SparkSession, d: str) -> DataFrame:
    ev = _t(spark, d, "events")
    log = _event_log(ev)
    shift = log.filter(F.col("date") < _ts(FIRST_SHIFT_END))
    st0 = dims.insert_if_absent(
        _empty(spark, "jira_status_dim_id long, jira_status string, is_workflow_status boolean, jira_api_id long"),
        shift.groupBy(F.col("to_id").cast("long").alias("jira_api_id"))
             .agg(F.min("to_status").alias("jira_status")).withColumn("is_workflow_status", F.lit(True)),
        ["jira_api_id"], "jira_status_dim_id")
    us0 = dims.insert_if_absent(
        _empty(spark, "jira_user_dim_id long, jira_user_id string, jira_user_name string, "
                      "jira_project string, is_active boolean"),
        shift.select(F.col("to_user").alias("jira_user_id"), F.col("to_user_name").alias("jira_user_name")).distinct(),
        ["jira_user_id"], "jira_user_dim_id")
    st = transitions.add_late_statuses(log, st0)
    us = transitions.add_late_users(log, us0)
    out = transitions.resolve_ids(log, st, us)
    return out.select("event_id", F.col("to_status_id").cast("long"), F.col("from_status_id").cast("long"),
                      F.col("to_assignee_dim_id").cast("long"), F.col("from_assignee_dim_id").cast("long"))


# ------------------------------------------------------------------ T5
def transition_upsert(spark: SparkSession, d: str) -> DataFrame:
    ev = _t(spark, d, "events")
    st = _type_dim(spark, ev)
    users = ev.select("user_id").distinct()
    fact = users.select(_user_key().alias("jira_key"), F.lit(True).alias("is_active"))
    grid = transitions.conform_map(transitions.status_grid(
        fact, st, _empty(spark, "jira_key string, to_status_dim_id long")))
    typed = ev.join(st, ev["event_type"] == st["jira_status"]).select(
        "event_id", "user_id", "ts", "jira_status_dim_id")
    typed = lag_by_key(typed, "user_id", ["ts", "event_id"], "jira_status_dim_id", "_prev")
    first = ev.groupBy("user_id").agg(F.min("ts").alias("issue_create_date"))
    log = typed.join(first, "user_id").select(
        "event_id", _user_key().alias("jira_key"), F.col("ts").alias("date"), "issue_create_date",
        F.col("jira_status_dim_id").alias("to_status_id"),
        F.coalesce(F.col("_prev"), F.lit(0)).alias("from_status_id"),
        (F.col("user_id") + 1).alias("to_assignee_dim_id"), F.lit(0).cast("long").alias("from_assignee_dim_id"))
    out = transitions.upsert_transitions(grid, log, ["date", "event_id"])
    return out.select("jira_key", "to_status_dim_id", "from_status_dim_id", "status_change_date",
                      "issue_created_date", "to_assignee_dim_id", "from_assignee_dim_id")


# ------------------------------------------------------------------ T6 / T7 / T10-T13
def _event_map(ev: DataFrame) -> DataFrame:
    """Events as transition-map rows (one per event, keyed by user)."""
    type_id = (F.when(F.col("event_type") == "click", 1).when(F.col("event_type") == "view", 0)
               .when(F.col("event_type") == "purchase", 3).when(F.col("event_type") == "signup", 4))
    first = ev.groupBy("user_id").agg(F.date_trunc("day", F.min("ts")).cast("timestamp_ntz").alias("issue_created_date"))
    m = ev.join(first, "user_id").select(
        "event_id", _user_key().alias("jira_key"), F.col("ts").alias("status_change_date"),
        type_id.cast("long").alias("from_status_dim_id"),
        F.when(F.col("event_type").isin("click", "purchase"), F.col("user_id")).alias("from_assignee_dim_id"),
        F.when(F.col("value") > 10, F.lit(1).cast("long")).alias("to_assignee_dim_id"), "issue_created_date")
    return transitions.conform_map(m, keep=["event_id"])


def current_flag(spark: SparkSession, d: str) -> DataFrame:
    m = _event_map(_t(spark, d, "events"))
    out = transitions.current_assignee_flag(transitions.current_status_flag(m))
    return out.select("event_id", "is_current_state", "is_current_assignee")


def _staged_users(ev: DataFrame) -> DataFrame:
    return ev.filter(F.col("event_type") == "signup").select(_user_key().alias("key")).distinct()


def time_between(spark: SparkSession, d: str) -> DataFrame:
    ev = _t(spark, d, "events")
    m = _event_map(ev)
    staged = _staged_users(ev)
    out = transitions.time_measures(m, staged, tie_break=["event_id"])
    return out.select("event_id", "time_spent_in_status_in_days", "time_spent_in_status_in_hours",
                      "time_spent_in_status_in_minutes", "time_spent_by_assignee_in_days",
                      "time_spent_by_assignee_in_hours", "time_spent_by_assignee_in_minutes")


def first_interval(spark: SparkSession, d: str) -> DataFrame:
    ev = _t(spark, d, "events")
    m = _event_map(ev)
    staged = _staged_users(ev)
    out = transitions.time_measures(m, staged, tie_break=["event_id"])
    out = transitions.first_status_interval(out, staged)
    out = transitions.first_assignee_interval(out, staged)
    return out.select("event_id", "time_spent_in_status_in_days", "time_spent_in_status_in_hours",
                      "time_spent_in_status_in_minutes", "time_spent_by_assignee_in_days",
                      "time_spent_by_assignee_in_hours", "time_spent_by_assignee_in_minutes")


# ------------------------------------------------------------------ T16
def dedup_rows(spark: SparkSession, d: str) -> DataFrame:
    ev = _t(spark, d, "events")
    rows = ev.select(_user_key().alias("jira_key"), F.col("event_type").alias("to_status"),
                     F.col("ts").alias("status_change_date"),
                     F.when(F.col("value") <= 40, F.col("value")).alias("value"))
    again = ev.filter(F.col("event_type") == "error").select(
        _user_key().alias("jira_key"), F.col("event_type").alias("to_status"),
        F.col("ts").alias("status_change_date"), F.when(F.col("value") <= 40, F.col("value")).alias("value"))
    return transitions.dedup_rows(rows.unionByName(again))


# ------------------------------------------------------------------ S1 / S2
ISSUES_PER_PAGE = 100


def _event_history(ev: DataFrame) -> Column:
    """One changelog history per event. Status items for click / purchase /
    signup (purchase carries two, the second wins), an assignee item when
    value > 25, no items for error."""
    k = F.get_json_object("props", "$.k")
    first_status = F.struct(F.lit("status").alias("field"), F.lit("1").alias("from"), k.alias("to"),
                            F.lit("Open").alias("fromString"), F.col("event_type").alias("toString"))
    second_status = F.struct(F.lit("status").alias("field"), k.alias("from"), F.lit("99").alias("to"),
                             F.col("event_type").alias("fromString"), F.lit("Done").alias("toString"))
    assignee = F.struct(F.lit("assignee").alias("field"), F.lit(None).cast("string").alias("from"),
                        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("to"),
                        F.lit(None).cast("string").alias("fromString"),
                        F.concat(F.lit("User "), F.col("user_id").cast("string")).alias("toString"))
    none = F.array().cast(f"array<{landed.ITEM_T}>")
    status_items = (F.when(F.col("event_type") == "purchase", F.array(first_status, second_status))
                    .when(F.col("event_type").isin("click", "signup"), F.array(first_status))
                    .otherwise(none))
    items = F.when(F.col("event_type") == "error", none).otherwise(
        F.concat(status_items, F.when(F.col("value") > 25, F.array(assignee)).otherwise(none)))
    created = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("-0500"))
    return F.struct(created.alias("created"), items.alias("items"))


def _render_issue_pages(ev: DataFrame) -> DataFrame:
    """Events landed as search pages of 100 issues (one event = one issue with
    one history), the shape the tracker's search returns."""
    issue = F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.concat(F.lit("EV-"), F.col("event_id").cast("string")).alias("key"),
        F.struct(F.date_format(F.date_trunc("day", "ts"), "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("created")).alias("fields"),
        F.struct(F.array(_event_history(ev)).alias("histories")).alias("changelog"))
    page = F.floor(F.col("event_id") / ISSUES_PER_PAGE)
    return (ev.groupBy(page.alias("_page"))
            .agg(F.sort_array(F.collect_list(F.struct(F.col("event_id").alias("_o"), issue.alias("i")))).alias("_is"))
            .select(F.to_json(F.struct((F.col("_page") * ISSUES_PER_PAGE).cast("int").alias("startAt"),
                                       F.size("_is").alias("total"),
                                       F.transform("_is", lambda x: x["i"]).alias("issues"))).alias("value")))


def _history(h: Column) -> Column:
    return F.struct(h["created"].alias("created"), h["items"].alias("items"))


def _render_sprint_issues(ev: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sprint issues as stored JSON: sprint = a block of 100 event ids; issue =
    (user, sprint) with that user's events of the block as its changelog (at
    most 100 histories); the sprint closes at its first purchase."""
    sprint_no = F.floor(F.col("event_id") / ISSUES_PER_PAGE).cast("long")
    items = (F.when(F.col("event_type") == "view",
                    F.array(F.struct(F.lit("comment").alias("field"), F.lit(None).cast("string").alias("fromString"),
                                     F.lit(None).cast("string").alias("toString"))))
             .when(F.col("event_type") == "error",
                   F.array().cast("array<struct<field:string, fromString:string, toString:string>>"))
             .otherwise(F.array(F.struct(F.lit("status").alias("field"), F.lit("Open").alias("fromString"),
                                         F.col("event_type").alias("toString")))))
    hist = F.struct(F.col("ts").alias("_ts"), F.col("event_id").alias("_id"),
                    F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("created"), items.alias("items"))
    issues = (ev.groupBy(sprint_no.alias("sprint_number"), F.col("user_id"))
              .agg(F.sort_array(F.collect_list(hist)).alias("_h"))
              .select(F.concat(F.lit("U"), F.col("user_id").cast("string"), F.lit("-"),
                               F.col("sprint_number").cast("string")).alias("jira_ticket_key"),
                      "sprint_number", F.lit(1).cast("long").alias("team_dim_id"),
                      F.to_json(F.struct(F.struct(F.transform("_h", _history).alias("histories"))
                                         .alias("changelog"))).alias("ticket_details"),
                      F.lit(True).alias("is_active"), F.lit(None).cast("string").alias("status_on_sprint_closure")))
    sprint = (ev.groupBy(sprint_no.alias("sprint_number"))
              .agg(F.min(F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("sprint_complete_date")))
    return issues, sprint


def changelog_flatten(spark: SparkSession, d: str) -> DataFrame:
    ev = _t(spark, d, "events")
    pages = _render_issue_pages(ev)
    issues = landed.read_issue_pages(pages)
    return landed.flatten_changelog(issues)


# ------------------------------------------------------------------ C8
def json_number(spark: SparkSession, d: str) -> DataFrame:
    ev = _t(spark, d, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    epics = assign_keys(ev.filter(F.col("ts") < _ts(FIRST_SHIFT_END)).select(k.alias("epic_id")).distinct(),
                        ["epic_id"], "epic_dim_id")
    issues = ev.select("event_id", "props", (F.col("event_type") != "error").alias("is_active"),
                       F.when(F.col("event_type") == "signup", F.lit(0).cast("long")).alias("epic_dim_id"))
    out = sprints.link_epics(issues, epics, epic_id=F.get_json_object(F.col("t.props"), "$.k"))
    return out.select("event_id", "epic_dim_id")


# ------------------------------------------------------------------ C1
def high_water(spark: SparkSession, d: str) -> DataFrame:
    n = _t(spark, d, "nation")
    c = _t(spark, d, "customer")
    team = n.select(F.col("n_nationkey").cast("long").alias("team_dim_id"), F.col("n_name").alias("team_name"),
                    F.col("n_regionkey").cast("long").alias("jira_rapid_view_id"),
                    (F.col("n_regionkey") != 4).alias("is_active"))
    sprint = c.select(F.col("c_custkey").alias("sprint_serial_id"), F.col("c_nationkey").cast("long").alias("team_dim_id"),
                      (F.col("c_acctbal") > 0).alias("is_issues_loaded"))
    return sprints.sprint_high_water(team, sprint)


# ------------------------------------------------------------------ C2
def pending(spark: SparkSession, d: str) -> DataFrame:
    o = _t(spark, d, "orders")
    sprint = o.select(F.col("o_orderkey").alias("sprint_number"), F.col("o_custkey").alias("team_dim_id"),
                      F.col("o_orderdate").alias("sprint_end_date"),
                      F.when(F.col("o_orderstatus") == "F", True).when(F.col("o_orderstatus") == "O", False)
                      .alias("is_issues_loaded"))
    return sprints.pending_sprints(sprint, PENDING_CUTOFF)


# ------------------------------------------------------------------ S8
def serial_then_filter(spark: SparkSession, d: str) -> DataFrame:
    ev = _t(spark, d, "events")
    sp = ev.select(F.col("event_id").alias("sprint_number"), "ts", "event_id",
                   F.concat(F.lit("Sprint "), F.col("event_id").cast("string")).alias("sprint_name"),
                   F.col("event_type").alias("originBoardId"))
    return landed.number_sprints(sp, ["ts", "event_id"], SERIAL_BASE, "click", team_dim_id=7).drop("ts", "event_id")


# ------------------------------------------------------------------ C5
def status_as_of(spark: SparkSession, d: str) -> DataFrame:
    ev = _t(spark, d, "events")
    issues, sprint = _render_sprint_issues(ev)
    out = sprints.status_as_of(issues, sprint)
    return out.select("jira_ticket_key", "sprint_number", "team_dim_id", "status_on_sprint_closure")


# ------------------------------------------------------------------ C6
def prefix_semi(spark: SparkSession, d: str) -> DataFrame:
    s = _t(spark, d, "supplier")
    n = _t(spark, d, "nation")
    stage = s.join(n, s["s_nationkey"] == n["n_nationkey"]).select(
        F.concat(F.col("n_name"), F.lit("-"), F.col("s_suppkey").cast("string")).alias("jira_ticket_key"))
    project = n.select(F.col("n_nationkey").cast("long").alias("project_dim_id"), F.col("n_name").alias("project_key"),
                       F.when(F.col("n_regionkey") != 0, F.col("n_regionkey").cast("long")).alias("product_dim_id"))
    return sprints.projects_in(stage, project)


# ------------------------------------------------------------------ Q1 / Q2
def completed_points(spark: SparkSession, d: str) -> DataFrame:
    o = _t(spark, d, "orders")
    li = _t(spark, d, "lineitem")
    sprint = o.select(F.col("o_orderkey").alias("sprint_number"), F.lit(1).cast("long").alias("team_dim_id"),
                      F.col("o_orderdate").alias("sprint_start_date"),
                      (F.col("o_orderdate") + F.expr(f"INTERVAL {SPRINT_DAYS} DAYS")).alias("sprint_end_date"))
    issues = li.select(F.col("l_orderkey").alias("sprint_number"), F.lit(1).cast("long").alias("team_dim_id"),
                       F.col("l_quantity").alias("points"), F.col("l_shipdate").alias("resolution_date"),
                       (F.col("l_linestatus") == "F").alias("is_active"), (F.col("l_returnflag") == "R").alias("is_maintenance"))
    out = sprints.completed_points(issues, sprint)
    return out.select("sprint_number", "team_dim_id", F.col("completed_points").cast("double"))


def headcount(spark: SparkSession, d: str) -> DataFrame:
    ev = _t(spark, d, "events")
    members = (ev.groupBy(F.col("user_id").alias("user_dim_id"), F.col("event_type").alias("team_dim_id"))
               .agg(F.min("ts").alias("team_entry_date"), F.max("ts").alias("_last"))
               .withColumn("team_exit_date", F.when(F.col("_last") < _ts("2024-01-25 00:00:00"), F.col("_last")))
               .drop("_last"))
    sprint = (ev.select(F.col("event_type").alias("team_dim_id"),
                        F.date_trunc("week", "ts").cast("timestamp_ntz").alias("sprint_start_date")).distinct()
              .withColumn("sprint_end_date", F.col("sprint_start_date") + F.expr("INTERVAL 7 DAYS"))
              .withColumn("sprint_number", F.date_format("sprint_start_date", "yyyyMMdd").cast("long")))
    return sprints.headcount(members, sprint, AS_OF_EVENTS)


# ------------------------------------------------------------------ Q3
def count_by_date(spark: SparkSession, d: str) -> DataFrame:
    o = _t(spark, d, "orders")
    dd = facts.date_key_frame(o, "o_orderdate")
    fact = o.select((F.col("o_orderstatus") != "P").alias("is_active"),
                    F.date_format("o_orderdate", "yyyyMMdd").cast("long").alias("date_created_dim_id"))
    j = fact.join(dd, fact["date_created_dim_id"] == dd["sk_date"], "left").filter(F.col("is_active"))
    return j.groupBy("dt").agg(F.count(F.lit(1)).alias("ticket_count"))


# ------------------------------------------------------------------ S10b / S11
def clean_names(spark: SparkSession, d: str) -> DataFrame:
    s = _t(spark, d, "supplier").select(F.lit("supplier").alias("source"), F.col("s_suppkey").alias("id"),
                                        F.col("s_name").alias("name"))
    p = _t(spark, d, "part").select(F.lit("part").alias("source"), F.col("p_partkey").alias("id"),
                                    F.concat(F.col("p_name"), F.lit(" ("), F.col("p_brand"), F.lit(")")).alias("name"))
    u = s.unionByName(p)
    return u.select("source", "id", clean_name("name").alias("clean_name"))


# ------------------------------------------------------------------ S12-S15
def csv_columns(spark: SparkSession, d: str) -> DataFrame:
    n = _t(spark, d, "nation")
    s = _t(spark, d, "supplier")
    lines = s.join(n, s["s_nationkey"] == n["n_nationkey"]).select(F.concat_ws(
        "|", F.col("s_name"), F.when(F.col("s_acctbal") >= 0, F.lower("s_name")).otherwise(F.lit("")),
        F.when(F.col("n_regionkey") != 0, F.col("n_name")).otherwise(F.lit(""))).alias("value"))
    return landed.parse_department_lines(lines)


# ------------------------------------------------------------------ S16
def append_history(spark: SparkSession, d: str) -> DataFrame:
    s = _t(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    hist = landed.append_history(None, s.filter(F.col("s_nationkey") < 12), 1, "2024-01-01 00:00:00")
    return landed.append_history(hist, s, 2, AS_OF_EVENTS)


# ------------------------------------------------------------------ A1
def run_state(spark: SparkSession, d: str) -> DataFrame:
    ev = _t(spark, d, "events")
    status = (F.when(F.col("event_type") == "error", control.FAILED)
              .when(F.col("event_type") == "view", control.IN_PROGRESS).otherwise(control.SUCCESS))
    log = ev.select(F.col("user_id").alias("audit_id"),
                    F.when(F.col("event_type") != "signup", F.col("value").cast("long")).alias("audit_details_id"),
                    F.col("event_type").alias("task_name"), status.alias("status"), F.col("ts").alias("event_time"))
    return control.run_state(log)


# ------------------------------------------------------------------ A3
def incremental(spark: SparkSession, d: str) -> DataFrame:
    o = _resolved_orders(spark, d)
    wm = spark.range(1).select(_ts(WATERMARK).alias("watermark"))
    out = control.incremental(o, wm, created="o_orderdate", updated="resolution_date")
    return out.select("o_orderkey")


# ------------------------------------------------------------------ A4
CHECKS = [
    control.Check("orders with an unknown customer",
                  "select count(*) from dw_orders o left anti join dw_customer c on o.o_custkey = c.c_custkey", 0),
    control.Check("open orders without lines",
                  "select count(*) from dw_orders o left anti join dw_lineitem l on o.o_orderkey = l.l_orderkey "
                  "where o.o_orderstatus = 'O'", 0),
    control.Check("orders beyond their keys", "select count(*) - count(distinct o_orderkey) from dw_orders", 0),
    control.Check("open orders expected none", "select count(*) from dw_orders where o_orderstatus = 'O'", 0),
    control.Check("no rows", "select c_custkey from dw_customer where c_custkey < 0", 0),
]


def checks(spark: SparkSession, d: str) -> DataFrame:
    for name in ("orders", "lineitem", "customer"):
        _t(spark, d, name).createOrReplaceTempView(f"dw_{name}")
    out = control.run_checks(spark, CHECKS, as_of=AS_OF_EVENTS, task_id=1)
    return out.select("condition", "expected_value", "actual_value", "status")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "star_lookup": star_lookup,
    "close_measures": close_measures,
    "open_age": open_age,
    "date_keys": date_keys,
    "new_members": new_members,
    "new_members_not_in": new_members_not_in,
    "changed_attributes": changed_attributes,
    "fuzzy_parent": fuzzy_parent,
    "priority_lookup": priority_lookup,
    "supersede_versions": supersede_versions,
    "match_codes": match_codes,
    "deactivate": deactivate,
    "fill_nulls": fill_nulls,
    "product_bridge": product_bridge,
    "status_grid": status_grid,
    "late_and_lookup": late_and_lookup,
    "transition_upsert": transition_upsert,
    "current_flag": current_flag,
    "time_between": time_between,
    "first_interval": first_interval,
    "dedup_rows": dedup_rows,
    "changelog_flatten": changelog_flatten,
    "json_number": json_number,
    "high_water": high_water,
    "pending": pending,
    "serial_then_filter": serial_then_filter,
    "status_as_of": status_as_of,
    "prefix_semi": prefix_semi,
    "completed_points": completed_points,
    "headcount": headcount,
    "count_by_date": count_by_date,
    "clean_name": clean_names,
    "csv_columns": csv_columns,
    "append_history": append_history,
    "run_state": run_state,
    "incremental": incremental,
    "checks": checks,
}


# ------------------------------------------------------------------ D1 / D2
def contact_update(spark: SparkSession, d: str) -> DataFrame:
    c = _t(spark, d, "customer")
    dim = c.filter(F.col("c_nationkey") < 20).select(
        (F.col("c_custkey") + 1).alias("contact_dim_id"), F.col("c_name").alias("contactid"),
        F.lit("Mx").alias("salutation"), F.col("c_mktsegment").alias("firstname"),
        F.col("c_nationkey").cast("string").alias("lastname"), F.col("c_name").alias("fullname"),
        F.lit(None).cast("string").alias("jobtitle"), F.lit(None).cast("string").alias("emailaddress"))
    source = c.select(F.col("c_name").alias("contactid"),
                      F.when(F.col("c_acctbal") >= 0, F.lit("Dr")).alias("salutation"),
                      F.lower("c_mktsegment").alias("firstname"),
                      F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("lastname"),
                      F.lower("c_name").alias("fullname"), F.col("c_mktsegment").alias("jobtitle"),
                      F.concat(F.lower("c_name"), F.lit("@crm.test")).alias("emailaddress1"))
    out = dims.insert_missing_contacts(dim, source)
    return dims.update_attributes(out, source, "contactid", "contactid",
                                  {"salutation": "salutation", "firstname": "firstname", "lastname": "lastname",
                                   "fullname": "fullname", "jobtitle": "jobtitle", "emailaddress": "emailaddress1"})


# ------------------------------------------------------------------ D10
def product_upsert(spark: SparkSession, d: str) -> DataFrame:
    p = _t(spark, d, "part")
    dim = p.filter(F.col("p_size") <= 30).select(
        (F.col("p_partkey") + 1).alias("jira_product_dim_id"), F.col("p_name").alias("jira_product_name"),
        F.col("p_partkey").cast("string").alias("jira_product_api_id"))
    src = p.select(F.when(F.col("p_size") > 20, F.concat(F.col("p_name"), F.lit(" v2"))).otherwise(F.col("p_name"))
                   .alias("product_name"), F.col("p_partkey").cast("string").alias("api_id"))
    return dims.upsert_products(dim, src)


# ------------------------------------------------------------------ T8 / T9 / T15
def transition_fill(spark: SparkSession, d: str) -> DataFrame:
    ev = _t(spark, d, "events")
    tmap = transitions.conform_map(ev.select(
        _user_key().alias("jira_key"), F.col("ts").alias("status_change_date"),
        F.when(F.col("value") > 10, F.col("user_id")).alias("to_assignee_dim_id"),
        F.when(F.col("event_type") == "click", F.col("user_id") + 1).alias("from_assignee_dim_id"),
        ((F.col("event_type") == "purchase") & (F.col("value") > 48)).alias("is_current_assignee")))
    per_user = ev.groupBy("user_id").agg(
        F.min("ts").alias("created"),
        F.when(F.max((F.col("event_type") == "error").cast("int")) == 1, F.max("ts")).alias("resolution_date"),
        F.max((F.col("event_type") == "signup").cast("int")).alias("_signup"))
    stage = per_user.select(_user_key().alias("key"), "created", "resolution_date")
    fact = per_user.select(_user_key().alias("jira_key"), (F.col("_signup") == 1).alias("is_active"),
                           F.col("user_id").alias("assignee_dim_id"))
    users = per_user.select(F.col("user_id").alias("jira_user_dim_id"),
                            F.floor(F.col("user_id") / 10).cast("long").alias("department_dim_id"))
    out = transitions.copy_resolution(tmap, stage)
    out = transitions.insert_unchanged_assignee(out, fact, stage)
    out = transitions.department_of_assignees(out, users)
    return out.select("jira_key", "status_change_date", "issue_created_date", "issue_resolved_date",
                      "to_assignee_dim_id", "from_assignee_dim_id", "to_department_dim_id", "from_department_dim_id",
                      "is_current_assignee")


# ------------------------------------------------------------------ C4
def sprint_issue_load(spark: SparkSession, d: str) -> DataFrame:
    li = _t(spark, d, "lineitem")
    p = _t(spark, d, "part")
    lp = li.join(p, li["l_partkey"] == p["p_partkey"])
    itype = (F.when(F.col("l_returnflag") == "R", F.lit("Sub-task")).when(F.col("l_returnflag") == "A", F.lit("Story")))
    details = F.concat(F.lit('{"fields":{"issuetype":'),
                       F.when(itype.isNull(), F.lit("{}")).otherwise(F.concat(F.lit('{"name":"'), itype, F.lit('"}'))),
                       F.lit("}}"))
    rows_ = lp.select(F.lit(1).cast("long").alias("team_dim_id"), F.col("l_orderkey").alias("sprint_number"),
                      F.col("l_partkey").alias("jira_ticket_id"),
                      F.concat(F.regexp_replace("p_brand", "#", ""), F.lit("-"), F.col("l_partkey").cast("string"))
                      .alias("jira_ticket_key"), details.alias("issues"), "l_shipdate", "l_linestatus")
    current = rows_.filter(F.col("l_shipdate") < _ts("1997-01-01 00:00:00")).select(
        "team_dim_id", "sprint_number", "jira_ticket_id", "jira_ticket_key", F.col("issues").alias("ticket_details"),
        F.lit(None).cast("long").alias("project_dim_id"), (F.col("l_linestatus") == "F").alias("is_active"),
        F.col("l_shipdate").alias("date_created"))
    stage = rows_.filter(F.col("l_shipdate") >= _ts("1996-06-01 00:00:00")).select(
        "team_dim_id", "sprint_number", "jira_ticket_id", "jira_ticket_key", "issues")
    project = _name_dim(spark, p, F.regexp_replace("p_brand", "#", ""), "project_dim_id", "project_key")
    out = sprints.load_sprint_issues(current, stage, project, AS_OF_ORDERS)
    return out.select("team_dim_id", "sprint_number", "jira_ticket_id", "jira_ticket_key", "project_dim_id",
                      "is_active", "date_created")


# ------------------------------------------------------------------ C3 / C7
def sprint_marks(spark: SparkSession, d: str) -> DataFrame:
    o = _t(spark, d, "orders")
    li = _t(spark, d, "lineitem")
    sprint = o.select(F.col("o_orderkey").alias("sprint_number"), F.lit(1).cast("long").alias("team_dim_id"),
                      F.when(F.col("o_orderstatus") == "F", True).alias("is_issues_loaded"))
    loaded = li.filter(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("sprint_number"),
                                                            F.lit(1).cast("long").alias("team_dim_id"))
    return sprints.mark_loaded(sprint, loaded)


def epic_high_water(spark: SparkSession, d: str) -> DataFrame:
    n = _t(spark, d, "nation")
    c = _t(spark, d, "customer")
    project = n.select(F.col("n_nationkey").cast("long").alias("project_dim_id"))
    epic = c.filter(F.col("c_mktsegment") == "MACHINERY").select(
        F.col("c_nationkey").cast("long").alias("project_dim_id"), F.col("c_custkey").alias("epic_id"))
    return sprints.epic_high_water(project, epic)


# ------------------------------------------------------------------ F12
def copy_measures(spark: SparkSession, d: str) -> DataFrame:
    o = _resolved_orders(spark, d)
    fact = o.select(F.col("o_orderkey").alias("jira_key"), (F.col("o_orderstatus") != "P").alias("is_active"),
                    *facts.ticket_measures("o_orderdate", "resolution_date", AS_OF_ORDERS)[:3])
    stage = o.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select(F.col("o_orderkey").alias("key"))
    bridge = _t(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("jira_key"), F.col("l_partkey").alias("jira_product_dim_id"),
        F.lit(None).cast("long").alias("time_to_close_in_days"), F.lit(None).cast("long").alias("time_to_close_in_hours"),
        F.lit(None).cast("long").alias("time_to_close_in_minutes"))
    return facts.copy_measures(bridge, stage, fact)


QUERIES.update({
    "contact_update": contact_update,
    "product_upsert": product_upsert,
    "transition_fill": transition_fill,
    "sprint_issue_load": sprint_issue_load,
    "sprint_marks": sprint_marks,
    "epic_high_water": epic_high_water,
    "copy_measures": copy_measures,
})


# ------------------------------------------------------------------ Q4 / Q5
def ticket_contact(spark: SparkSession, d: str) -> DataFrame:
    o = _t(spark, d, "orders")
    c = _t(spark, d, "customer")
    fact = o.select(F.col("o_orderkey").alias("jira_key"), F.col("o_custkey").alias("contact_dim_id"),
                    (F.col("o_orderstatus") != "P").alias("is_active"))
    contacts = c.select(F.col("c_custkey").alias("contact_dim_id"), F.col("c_name").alias("contactid"))
    return facts.ticket_contacts(fact, contacts)


def origin_reconcile(spark: SparkSession, d: str) -> DataFrame:
    o = _t(spark, d, "orders")
    c = _t(spark, d, "customer")
    incidents = c.select(F.col("c_name").alias("ticketnumber"),
                         F.when(F.col("c_mktsegment") != "FURNITURE", F.col("c_mktsegment")).alias("caseorigincodename"),
                         F.col("c_nationkey").alias("caseorigincode"))
    origin = dims.insert_missing_origins(
        _empty(spark, "jira_origin_dim_id long, jira_origin_name string, source_case_origin_id long"), incidents)
    fact = o.select(F.col("o_orderkey").alias("jira_key"), (F.col("o_orderstatus") != "P").alias("is_active"),
                    F.lit(None).cast("long").alias("jira_origin_dim_id"), F.col("o_orderdate").alias("date_updated"))
    stage = o.filter(F.col("o_orderpriority") != "5-LOW").select(
        F.col("o_orderkey").alias("key"), _customer_ref("o_custkey").alias("jira_case"))
    fact = facts.assign_origin(fact, stage, incidents, origin, AS_OF_ORDERS)
    all_stage = o.select(F.col("o_orderkey").alias("key"), _customer_ref("o_custkey").alias("jira_case"))
    return facts.reconcile_origin(fact, all_stage, incidents, origin)


QUERIES.update({"ticket_contact": ticket_contact, "origin_reconcile": origin_reconcile})


# ------------------------------------------------------------------ D6 / D8
FIRST_MINUTES_END = "2024-01-01 00:10:00"


def status_upsert(spark: SparkSession, d: str) -> DataFrame:
    ev = _t(spark, d, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    dim = (ev.filter(F.col("ts") < _ts(FIRST_MINUTES_END)).select(F.col("event_type").alias("jira_status")).distinct())
    dim = assign_keys(dim, ["jira_status"], "jira_status_dim_id").select(
        "jira_status_dim_id", "jira_status", F.lit(False).alias("is_workflow_status"),
        F.lit(None).cast("long").alias("jira_api_id"))
    workflow = ev.groupBy(F.col("event_type").alias("status")).agg(
        F.min(k).alias("id"), F.max(F.col("event_type") != "error").alias("flag"))
    return dims.upsert_statuses(dim, workflow)


def user_members(spark: SparkSession, d: str) -> DataFrame:
    ev = _t(spark, d, "events")
    users = (ev.filter(F.col("ts") < _ts(FIRST_SHIFT_END)).select("user_id").distinct()
             .select(F.col("user_id").alias("jira_user_dim_id"),
                     F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("jira_user_id"),
                     F.concat(F.lit("User "), F.col("user_id").cast("string")).alias("jira_user_name"),
                     F.lit("SERVICDESK").alias("jira_project"), F.lit(None).cast("string").alias("email_id"),
                     F.lit(True).alias("is_active")))
    stage = ev.select(
        F.when(F.col("event_type") != "view", F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("assignee"),
        F.when(F.col("event_type") != "view",
               F.concat(F.lit("User "), F.col("user_id").cast("string"),
                        F.when(F.col("event_type") == "error", F.lit(" [X]")).otherwise(F.lit(""))))
        .alias("assignee_name"))
    return dims.insert_missing_users(users, stage)


QUERIES.update({"status_upsert": status_upsert, "user_members": user_members})


# ------------------------------------------------------------------ S5
def landed_users(spark: SparkSession, d: str) -> DataFrame:
    """User-list pages (one per 100 events, users in event order) read back with
    S5: four columns, the first row per user key (page, position in it, then values)."""
    ev = _t(spark, d, "events")
    user = F.struct(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("key"),
                    F.concat(F.lit("User "), F.col("user_id").cast("string"), F.lit(" #"),
                             F.col("event_id").cast("string")).alias("displayName"),
                    F.when(F.col("value") > 20, F.concat(F.lit("u"), F.col("user_id").cast("string"),
                                                         F.lit("@mail.test"))).alias("emailAddress"),
                    (F.col("event_type") != "error").alias("active"))
    pages = (ev.groupBy(F.floor(F.col("event_id") / ISSUES_PER_PAGE).alias("_page"))
             .agg(F.sort_array(F.collect_list(F.struct(F.col("event_id").alias("_o"), user.alias("u")))).alias("_us"))
             .select("_page", F.to_json(F.transform("_us", lambda x: x["u"])).alias("value")))
    return landed.read_users(pages.withColumnRenamed("_page", "page"), page="page")


QUERIES.update({"landed_users": landed_users})


# ------------------------------------------------------------------ S3 / S4 / S4b
def _in_event_order(c: Column) -> Column:
    """The group's values of ``c`` as an array, in event-id order."""
    ordered = F.sort_array(F.collect_list(F.struct(F.col("event_id").alias("_o"), c.alias("s"))))
    return F.transform(ordered, lambda x: x["s"])


def landed_statuses(spark: SparkSession, d: str) -> DataFrame:
    """Workflow pages (per 100 events: one issue type whose statuses are the
    events' types, id = props.k) and resolution pages (error events land as
    'Closed'), read with S3 and S4 - first occurrence per id - and unioned."""
    ev = _t(spark, d, "events")
    k = F.get_json_object("props", "$.k")
    page = F.floor(F.col("event_id") / ISSUES_PER_PAGE).alias("_page")
    st = F.struct(F.col("event_type").alias("name"), k.alias("id"))
    res = F.struct(F.when(F.col("event_type") == "error", F.lit("Closed")).otherwise(F.col("event_type")).alias("name"),
                   (k.cast("long") + 1000).cast("string").alias("id"))
    wf = ev.groupBy(page).agg(_in_event_order(st).alias("_s")).select(
        F.col("_page").alias("page"), F.to_json(F.array(F.struct(F.concat(F.lit("type "), F.col("_page").cast("string")).alias("name"),
                                   F.col("_s").alias("statuses")))).alias("value"))
    rs = ev.groupBy(page).agg(_in_event_order(res).alias("_s")).select(
        F.col("_page").alias("page"), F.to_json("_s").alias("value"))
    return landed.union_statuses(landed.read_workflow_statuses(wf, page="page"), landed.read_resolutions(rs, page="page"))


QUERIES.update({"landed_statuses": landed_statuses})


# ------------------------------------------------------------------ S6 / S7
def landed_products(spark: SparkSession, d: str) -> DataFrame:
    """Product pages (per 100 parts: one project, an issue type with the product
    field listing the parts' names and an issue type without it) read with S6."""
    p = _t(spark, d, "part")
    val = F.struct(F.col("p_name").alias("value"), F.col("p_partkey").cast("string").alias("id"))
    with_field = F.to_json(F.struct(F.struct(F.struct(F.col("_v").alias("allowedValues")).alias("customfield_13609"))
                                    .alias("fields")))
    doc = (p.groupBy(F.floor(F.col("p_partkey") / ISSUES_PER_PAGE).alias("_g"))
           .agg(F.collect_list(val).alias("_v"))
           .select(F.concat(F.lit('{"projects": [{"issuetypes": ['), with_field,
                            F.lit(', {"fields": {"summary": {}}}]}]}')).alias("value")))
    return landed.read_products(doc)


def landed_projects(spark: SparkSession, d: str) -> DataFrame:
    """Project lists (per 100 suppliers, each listed twice) read with S7."""
    s = _t(spark, d, "supplier")
    proj = F.struct(F.col("s_suppkey").cast("string").alias("id"),
                    F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("key"), F.col("s_name").alias("name"))
    doc = (s.groupBy(F.floor(F.col("s_suppkey") / ISSUES_PER_PAGE).alias("_g"))
           .agg(F.collect_list(proj).alias("_p"))
           .select(F.to_json(F.concat("_p", "_p")).alias("value")))
    return landed.read_projects(doc)


QUERIES.update({"landed_products": landed_products, "landed_projects": landed_projects})


# ------------------------------------------------------------------ S9
def landed_sprint_issues(spark: SparkSession, d: str) -> DataFrame:
    """Sprint-issue pages (per 100 events) whose issues carry a field no schema
    lists (``fields.epic.id``); S9 keeps each issue whole, so it reads back."""
    ev = _t(spark, d, "events")
    issue = F.struct(F.col("event_id").cast("string").alias("id"),
                     F.concat(F.lit("EV-"), F.col("event_id").cast("string")).alias("key"),
                     F.struct(F.struct(F.col("event_type").alias("name")).alias("issuetype"),
                              F.struct(F.get_json_object("props", "$.k").alias("id")).alias("epic")).alias("fields"))
    pages = (ev.groupBy(F.floor(F.col("event_id") / ISSUES_PER_PAGE).alias("_page"))
             .agg(F.collect_list(issue).alias("_i"))
             .select(F.to_json(F.struct(F.size("_i").alias("total"), F.col("_i").alias("issues"))).alias("value")))
    out = landed.read_sprint_issue_pages(pages)
    return out.select(F.col("jira_ticket_id").cast("long").alias("jira_ticket_id"), "jira_ticket_key",
                      F.get_json_object("ticket_details", "$.fields.epic.id").cast("long").alias("epic_id"),
                      F.get_json_object("ticket_details", "$.fields.issuetype.name").alias("issue_type"))


# ------------------------------------------------------------------ S10 / S10b
EPIC_AFTER_ID = 100


def landed_epics(spark: SparkSession, d: str) -> DataFrame:
    """Epic pages (per 100 customers) read with S10 above a lower bound; names cleaned."""
    c = _t(spark, d, "customer")
    epic = F.struct(
        F.col("c_custkey").cast("string").alias("id"), F.concat(F.lit("EP-"), F.col("c_custkey").cast("string")).alias("key"),
        F.struct(F.concat(F.col("c_name"), F.lit(" ("), F.col("c_mktsegment"), F.lit(")!")).alias("customfield_10416"),
                 F.col("c_acctbal").alias("customfield_12741"), F.col("c_mktsegment").alias("customfield_12740"),
                 F.lit("2024-01-01T08:00:00.000-0500").alias("created"),
                 F.when(F.col("c_acctbal") < 0, F.lit("2024-02-01T08:00:00.000-0500")).alias("resolutiondate"))
        .alias("fields"))
    pages = (c.groupBy(F.floor(F.col("c_custkey") / ISSUES_PER_PAGE).alias("_g"))
             .agg(F.collect_list(epic).alias("_e")).select(F.to_json(F.struct(F.col("_e").alias("issues"))).alias("value")))
    e = landed.read_epics(pages, after_id=EPIC_AFTER_ID)
    return e.select(clean_name("epic_name").alias("epic_name"), "epic_id", "epic_key", "aha_score", "is_closed",
                    "aha_reference", "date_created", "date_updated", "date_resolved")


# ------------------------------------------------------------------ S11 / D16 / E3
def board_load(spark: SparkSession, d: str) -> DataFrame:
    """E3 on board pages rendered from nation (one page per region); boards of
    region 0 are already known."""
    n = _t(spark, d, "nation")
    view = F.struct(F.col("n_nationkey").cast("long").alias("id"),
                    F.concat(F.col("n_name"), F.lit(" board #"), F.col("n_regionkey").cast("string")).alias("name"),
                    F.struct(F.struct(F.concat(F.lit("owner"), F.col("n_regionkey").cast("string")).alias("userName"),
                                      F.concat(F.lit("Owner "), F.col("n_regionkey").cast("string")).alias("displayName"))
                             .alias("owner")).alias("filter"))
    pages = (n.groupBy("n_regionkey").agg(F.collect_list(view).alias("_v"))
             .select(F.to_json(F.struct(F.col("_v").alias("views"))).alias("value")))
    known = n.filter(F.col("n_regionkey") == 0).select(
        (F.col("n_nationkey") + 1).cast("long").alias("rapidview_dim_id"), F.col("n_nationkey").cast("long").alias("rapidview_id"),
        F.col("n_name").alias("rapidview_name"), F.lit("old").alias("owner_id"), F.lit("Old").alias("owner_name"),
        _ts("2023-01-01 00:00:00").alias("date_created"), F.lit(True).alias("is_active"))
    return jobs.board_load(known, pages, AS_OF_EVENTS)


QUERIES.update({"landed_sprint_issues": landed_sprint_issues, "landed_epics": landed_epics,
                "board_load": board_load})


# ------------------------------------------------------------------ S1b / F11 on option objects
def landed_options(spark: SparkSession, d: str) -> DataFrame:
    """Search pages (per 100 line items) whose custom fields hold option objects,
    read with S1 and S1b: channel and request type by value, one row per listed product id."""
    def option(value: Column, i: Column) -> Column:
        return F.struct(F.lit("https://tracker.test/option").alias("self"), value.alias("value"), i.cast("string").alias("id"))

    def issue(l: Column) -> Column:
        key = F.concat(F.lit("LI-"), l["l_orderkey"].cast("string"), F.lit("-"), l["l_linenumber"].cast("string"))
        products = F.array(option(F.lit("Support = id's [A]"), l["l_partkey"]), option(F.lit("B"), l["l_suppkey"] + 1000000))
        fields = F.struct(
            F.when(l["l_returnflag"] != "N", option(l["l_returnflag"], F.lit(1))).alias("customfield_11809"),
            option(l["l_linestatus"], F.lit(2)).alias("customfield_11813"),
            F.when(l["l_linenumber"] != 2, products).alias("customfield_13609"))
        return F.struct(key.alias("id"), key.alias("key"), fields.alias("fields"))

    # a page gathers its lines as they are and renders them in place: gathered as issues, they are many times the size
    line = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    pages = (_t(spark, d, "lineitem").groupBy(F.floor(F.col("l_orderkey") / ISSUES_PER_PAGE).alias("_page")).agg(F.collect_list(line).alias("lines"))
             .select(F.to_json(F.struct(F.transform("lines", issue).alias("issues"))).alias("value")))
    stage = landed.flatten_issues(landed.read_issue_pages(pages))
    return stage.select("key", "channel", "request_type", F.explode_outer(option_ids("product_name")).alias("product_id"))


QUERIES.update({"landed_options": landed_options})
