import json
import os
import tempfile

from dimwright.sources import landed
from dimwright.streaming.landing import landed_pages, run_landed


def test_landed_pages_are_picked_up_once(spark):
    root = tempfile.mkdtemp(prefix="dw-landing-")
    landing = os.path.join(root, "in")
    os.makedirs(landing)
    seen = []

    def process(batch, batch_id):
        seen.append(sorted(r["key"] for r in landed.read_issue_pages(batch).select("key").collect()))

    def land(name, keys):
        with open(os.path.join(landing, name), "w") as f:
            f.write(json.dumps({"startAt": 0, "total": len(keys), "issues": [{"id": k, "key": k} for k in keys]}) + "\n")

    ckpt = os.path.join(root, "ckpt")
    land("p1.json", ["A-1", "A-2"])
    run_landed(landed_pages(spark, landing), process, ckpt).awaitTermination()
    land("p2.json", ["A-3"])
    run_landed(landed_pages(spark, landing), process, ckpt).awaitTermination()
    assert seen == [["A-1", "A-2"], ["A-3"]]


def test_ticket_batches_run_the_ticket_load(spark):
    from dimwright.streaming.landing import ticket_batches
    from tests.test_jobs import _pages, _warehouse

    root = tempfile.mkdtemp(prefix="dw-landing-")
    landing = os.path.join(root, "in")
    os.makedirs(landing)
    pages = _pages(spark)
    with open(os.path.join(landing, "page-0.json"), "w") as f:
        f.write(pages["issues"].first()["value"] + "\n")
    published = {}

    def publish(tables, batch_id):
        published[batch_id] = sorted((r["jira_key"], r["is_active"]) for r in tables["fact"].collect())

    process = ticket_batches(lambda: _warehouse(spark), lambda: {k: v for k, v in pages.items() if k != "issues"},
                             publish, lambda: "2024-01-10 00:00:00")
    run_landed(landed_pages(spark, landing), process, os.path.join(root, "ckpt")).awaitTermination()
    assert published == {0: [("SD-1", True), ("SD-2", True)]}
