"""Run the ticket load (E1) on pages rendered from the driver's events table.

Usage: python tools/e1_scale.py [sf_dir]
Each event becomes one landed issue with one changelog history; reference
payloads (workflow, resolutions, users) are derived from the same table. The
run starts from an empty warehouse and writes its snapshot to a scratch
folder; prints row counts and seconds.
"""

from __future__ import annotations

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from dimwright.plans import jobs  # noqa: E402
from dimwright.session import get_spark  # noqa: E402
from dimwright.sources.landed import ITEM_T  # noqa: E402

PER_PAGE = 100


def _issue_pages(ev, type_ids):
    """One issue per event, one history: a status change into the event's type
    (status ids from the workflow list) and, for value > 25, an assignee item."""
    ev = ev.join(type_ids, "event_type")
    status = F.struct(F.lit("status").alias("field"), F.lit("1000").alias("from"), F.col("sid").alias("to"),
                      F.lit("click").alias("fromString"), F.col("event_type").alias("toString"))
    assignee = F.struct(F.lit("assignee").alias("field"), F.lit(None).cast("string").alias("from"),
                        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("to"),
                        F.lit(None).cast("string").alias("fromString"),
                        F.concat(F.lit("User "), F.col("user_id").cast("string")).alias("toString"))
    none = F.array().cast(f"array<{ITEM_T}>")
    items = F.concat(F.array(status), F.when(F.col("value") > 25, F.array(assignee)).otherwise(none))
    created = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("-0500"))
    issue = F.struct(F.col("event_id").cast("string").alias("id"),
                     F.concat(F.lit("EV-"), F.col("event_id").cast("string")).alias("key"),
                     F.struct(created.alias("created"), created.alias("updated"),
                              F.struct(F.col("event_type").alias("name")).alias("status")).alias("fields"),
                     F.struct(F.array(F.struct(created.alias("created"), items.alias("items"))).alias("histories"))
                     .alias("changelog"))
    page = F.floor(F.col("event_id") / PER_PAGE)
    return (ev.groupBy(page.alias("_p")).agg(F.collect_list(issue).alias("_i"))
            .select(F.to_json(F.struct(F.size("_i").alias("total"), F.col("_i").alias("issues"))).alias("value")))


def main() -> None:
    d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="e1-scale-")
    spark = get_spark("e1-scale", master="local[8]", shuffle_partitions=16, extra={"spark.driver.memory": "8g"})
    spark.sparkContext.setCheckpointDir(os.path.join(scratch, "ckpt"))
    ev = spark.read.parquet(f"{d}/events.parquet")
    cust = spark.read.parquet(f"{d}/customer.parquet")
    # one workflow status per event type, ids 1000, 1001, ... in name order
    names = F.sort_array(F.collect_set("event_type"))
    statuses = F.transform(names, lambda n, i: F.struct(n.alias("name"), (i + 1000).cast("string").alias("id")))
    type_ids = ev.agg(F.explode(statuses).alias("s")).select(F.col("s.name").alias("event_type"),
                                                            F.col("s.id").alias("sid"))
    pages = {
        "issues": _issue_pages(ev, type_ids),
        "workflow": ev.agg(F.to_json(F.array(F.struct(F.lit("All").alias("name"), statuses.alias("statuses"))))
                           .alias("value")),
        "resolutions": spark.createDataFrame([('[{"name": "Closed", "id": "90"}, {"name": "Fixed", "id": "91"}]',)],
                                             "value string"),
        "users": ev.select("user_id").distinct().agg(F.to_json(F.collect_list(F.struct(
            F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("key"),
            F.concat(F.lit("User "), F.col("user_id").cast("string")).alias("displayName"),
            F.lit(None).cast("string").alias("emailAddress"), F.lit(True).alias("active")))).alias("value")),
        "products": spark.createDataFrame([('{"projects": []}',)], "value string"),
        "contacts": cust.select(F.col("c_name").alias("contactid"), F.lit(None).cast("string").alias("salutation"),
                                F.col("c_mktsegment").alias("firstname"), F.lit("x").alias("lastname"),
                                F.col("c_name").alias("fullname"), F.lit(None).cast("string").alias("jobtitle"),
                                F.lower("c_name").alias("emailaddress1")),
        "incidents": cust.select(F.col("c_name").alias("ticketnumber"), F.col("c_nationkey").alias("caseorigincode"),
                                 F.col("c_mktsegment").alias("caseorigincodename")),
        "department_map": spark.createDataFrame([("User 1", "u1", "Support")],
                                                "displayname string, samaccountname string, department string"),
    }
    wh = jobs.empty_warehouse(spark)
    wh["date_dim"] = spark.sql("select cast(date_format(d, 'yyyyMMdd') as long) as sk_date, d as dt from "
                               "(select explode(sequence(date'2023-12-01', date'2024-03-01')) as d)")
    t0 = time.perf_counter()
    out = jobs.ticket_load(wh, pages, "2024-02-01 00:00:00", 1)
    paths = jobs.write_snapshot(out, os.path.join(scratch, "wh"), 1)
    secs = time.perf_counter() - t0
    shown = ("fact", "transition_map", "status_dim", "user_dim", "stage_history")
    counts = {n: spark.read.parquet(p).count() for n, p in paths.items() if n in shown}
    print({"run": 1, "sf_dir": d, "seconds": round(secs, 1), **counts})
    # second run on the same pages, from the written state: only fact versions change
    wh2 = {n: spark.read.parquet(p) for n, p in paths.items() if n != "stage_history"}
    t0 = time.perf_counter()
    out2 = jobs.ticket_load(wh2, pages, "2024-02-02 00:00:00", 2)
    paths2 = jobs.write_snapshot(out2, os.path.join(scratch, "wh"), 2)
    secs2 = time.perf_counter() - t0
    counts2 = {n: spark.read.parquet(p).count() for n, p in paths2.items() if n in shown}
    active = spark.read.parquet(paths2["fact"]).filter("is_active").count()
    same_map = (spark.read.parquet(paths2["transition_map"]).exceptAll(spark.read.parquet(paths["transition_map"]))
                .count() == 0 and counts2["transition_map"] == counts["transition_map"])
    print({"run": 2, "seconds": round(secs2, 1), **counts2, "active_facts": active, "transition_map_unchanged": same_map})
    # the same second run, incremental (flags and dedup only for the run's tickets)
    t0 = time.perf_counter()
    out3 = jobs.ticket_load(wh2, pages, "2024-02-02 00:00:00", 3, incremental=True)
    paths3 = jobs.write_snapshot(out3, os.path.join(scratch, "wh"), 3)
    secs3 = time.perf_counter() - t0
    m2, m3 = spark.read.parquet(paths2["transition_map"]), spark.read.parquet(paths3["transition_map"])
    same = m2.exceptAll(m3).count() == 0 and m3.exceptAll(m2).count() == 0
    print({"run": "2-incremental", "seconds": round(secs3, 1), "transition_map_equals_full_run": same})
    spark.stop()


if __name__ == "__main__":
    main()
