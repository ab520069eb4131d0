"""Run the sprint load (E2) on pages rendered from the driver's tables, twice.

Usage: python tools/e2_scale.py [sf_dir]
Boards are nations (one team each); sprints are orders (two weeks from the
order date, listed on the customer's nation board); sprint issues are the
order's line items (returned lines are sub-tasks), with the part's brand as
project key and the part as epic; epic pages list each brand's parts.
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

PAGE = 50


def main() -> None:
    d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="e2-scale-")
    spark = get_spark("e2-scale", master="local[8]", shuffle_partitions=16, extra={"spark.driver.memory": "8g"})
    spark.sparkContext.setCheckpointDir(os.path.join(scratch, "ckpt"))
    t = {n: spark.read.parquet(f"{d}/{n}.parquet") for n in ("orders", "customer", "lineitem", "part", "nation")}
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    o = t["orders"].join(t["customer"], t["orders"]["o_custkey"] == t["customer"]["c_custkey"])
    board = (F.col("c_nationkey") + 100).cast("long")
    sprint = F.struct(F.col("o_orderkey").alias("id"), F.concat(F.lit("S"), F.col("o_orderkey").cast("string")).alias("name"),
                      board.alias("originBoardId"), iso(F.col("o_orderdate")).alias("startDate"),
                      iso(F.col("o_orderdate") + F.expr("INTERVAL 14 DAYS")).alias("endDate"),
                      iso(F.col("o_orderdate") + F.expr("INTERVAL 14 DAYS 12 HOURS")).alias("completeDate"))
    sprints = (o.groupBy(board.alias("board_id"), F.floor(F.col("o_orderkey") / PAGE).alias("page"))
               .agg(F.sort_array(F.collect_list(F.struct(F.col("o_orderkey").alias("_o"), sprint.alias("s")))).alias("_s"))
               .select("board_id", "page", F.to_json(F.struct(F.lit(True).alias("isLast"),
                                                              F.transform("_s", lambda x: x["s"]).alias("values")))
                       .alias("value")))
    li = t["lineitem"].join(t["part"], t["lineitem"]["l_partkey"] == t["part"]["p_partkey"])
    brand = F.regexp_replace("p_brand", "#", "")
    issue = F.struct(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("id"),
        F.concat(brand, F.lit("-"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
        .alias("key"),
        F.struct(F.struct(F.when(F.col("l_returnflag") == "R", "Sub-task").otherwise("Story").alias("name"))
                 .alias("issuetype"),
                 F.struct(F.col("l_partkey").alias("id")).alias("epic"), F.col("l_quantity").alias("customfield_10411"),
                 iso(F.col("l_shipdate")).alias("resolutiondate")).alias("fields"),
        F.struct(F.array(F.struct(iso(F.col("l_shipdate")).alias("created"),
                                  F.array(F.struct(F.lit("status").alias("field"), F.lit("Open").alias("fromString"),
                                                   F.col("l_linestatus").alias("toString"))).alias("items")))
                 .alias("histories")).alias("changelog"))
    sprint_issues = (li.join(o.select("o_orderkey", F.col("c_nationkey")), li["l_orderkey"] == o["o_orderkey"])
                     .groupBy(F.col("l_orderkey").alias("sprint_number"), F.col("c_nationkey").cast("long").alias("team_dim_id"))
                     .agg(F.collect_list(issue).alias("_i"))
                     .select("sprint_number", "team_dim_id",
                             F.to_json(F.struct(F.size("_i").alias("total"), F.col("_i").alias("issues"))).alias("value")))
    p = t["part"].withColumn("project_key", F.regexp_replace("p_brand", "#", ""))
    epic = F.struct(F.col("p_partkey").cast("string").alias("id"), F.concat(F.lit("EP-"), F.col("p_partkey").cast("string")).alias("key"),
                    F.struct(F.col("p_name").alias("customfield_10416"), F.col("p_retailprice").alias("customfield_12741"),
                             F.col("p_type").alias("customfield_12740"), F.lit("1995-01-01T00:00:00.000Z").alias("created"))
                    .alias("fields"))
    epics = p.groupBy("project_key").agg(F.to_json(F.struct(F.collect_list(epic).alias("issues"))).alias("value"))
    projects = p.select("project_key").distinct().agg(F.to_json(F.collect_list(F.struct(
        F.regexp_extract("project_key", "([0-9]+)", 1).alias("id"), F.col("project_key").alias("key"),
        F.concat(F.lit("The "), F.col("project_key"), F.lit(" board")).alias("name")))).alias("value"))
    pages = {"projects": projects, "sprints": sprints, "sprint_issues": sprint_issues, "epics": epics}
    wh = jobs.empty_warehouse(spark, ["project_dim", "product_dim", "team_dim", "sprint_summary", "sprint_issues", "epic_dim"])
    wh["team_dim"] = t["nation"].select(F.col("n_nationkey").cast("long").alias("team_dim_id"), F.col("n_name").alias("team_name"),
                                        (F.col("n_nationkey") + 100).cast("long").alias("jira_rapid_view_id"),
                                        F.lit(True).alias("is_active"))
    shown = ("project_dim", "sprint_summary", "sprint_issues", "epic_dim")
    paths = None
    for run in (1, 2):
        state = wh if paths is None else {**wh, **{n: spark.read.parquet(p) for n, p in paths.items()
                                                     if n != "stage_history"}}
        t0 = time.perf_counter()
        out = jobs.sprint_load(state, pages, f"2024-02-0{run} 00:00:00", run, sprint_cutoff="1990-01-01 00:00:00",
                               seed_products=("Brand1 board",))
        new_paths = jobs.write_snapshot(out, os.path.join(scratch, "wh"), run)
        secs = time.perf_counter() - t0
        counts = {n: spark.read.parquet(new_paths[n]).count() for n in shown}
        extra = {}
        if paths is not None:
            extra = {n + "_unchanged": spark.read.parquet(new_paths[n]).exceptAll(spark.read.parquet(paths[n])).count() == 0
                     for n in shown}
        loaded = spark.read.parquet(new_paths["sprint_summary"]).filter("is_issues_loaded").count()
        print({"run": run, "seconds": round(secs, 1), **counts, "loaded_sprints": loaded, **extra})
        paths = new_paths
    spark.stop()


if __name__ == "__main__":
    main()
