import itertools

from pyspark.sql import functions as F

from dimwright.functions.intervals import duration_measures
from dimwright.operators import facts
from tests.conftest import rows


def test_interval_parts_rounding_and_sign(spark):
    df = spark.createDataFrame([
        ("2024-01-01 00:00:00", "2024-01-03 01:45:50"),   # 2d 01:45 -> hours 50 (rounded up)
        ("2024-01-01 00:00:00", "2024-01-01 05:29:59"),   # minute 29 -> no round
        ("2024-01-01 00:00:00", "2024-01-01 05:30:00"),   # minute 30 -> round up
        ("2024-01-03 01:45:50", "2024-01-01 00:00:00"),   # negative: all parts negative
        ("2024-01-01 00:00:00", None),
    ], "a string, b string").select(F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
    out = df.select(*duration_measures("a", "b", "x"))
    assert [tuple(r) for r in out.collect()] == [
        (2, 50, 2985), (0, 5, 329), (0, 6, 330), (-2, -49, -2985), (None, None, None)]


def test_timestamp_offset_keeps_wall_clock(spark):
    df = spark.createDataFrame([("2020-04-08T22:30:00.000-0500",)], "s string")
    got = df.select(F.col("s").cast("timestamp_ntz").cast("string")).first()[0]
    assert got == "2020-04-08 22:30:00"


def _brute_code(guid, mail, cid, addr):
    t = lambda x: None if x is None else x.strip(" ")
    ne = lambda a, b: None if a is None or b is None else a != b
    no_guid = guid is None or t(guid) == ""
    valid_guid = bool(t(guid) is not None and t(cid) is not None and t(guid) == t(cid))
    invalid_guid = guid is not None and bool(ne(t(guid), t(cid)) or cid is None or t(cid) == "")
    no_email = mail is None or t(mail) == ""
    invalid_email = mail is not None and bool(ne(t(mail), t(addr)) or addr is None or t(addr) == "")
    valid_email = mail is not None and t(addr) is not None and t(mail) == t(addr)
    for cond, code in ((valid_guid, 1), (no_guid and no_email, 2), (invalid_guid and no_email, 3),
                       (no_guid and invalid_email, 4), (invalid_guid and invalid_email, 5),
                       (no_guid and valid_email, 6), (invalid_guid and valid_email, 7)):
        if cond:
            return code
    return 0


def test_match_code_ladder_all_combinations(spark):
    vals = [None, "", " ", "a", "b"]
    combos = list(itertools.product(vals, repeat=4))
    df = spark.createDataFrame(combos, "crm_contact_stage string, reporter_email_stage string, "
                                       "contactid string, emailaddress string")
    got = [tuple(r) for r in df.select(*df.columns, facts.match_code().alias("c")).collect()]
    assert len(got) == 625
    for g, m, c, a, code in got:
        assert code == _brute_code(g, m, c, a), (g, m, c, a)
    assert all(code != 0 for *_, code in got)  # code 0 is unreachable


def test_match_codes_plan_has_no_nested_loop(spark):
    st = spark.createDataFrame([("k", "g", "m")], "key_stage string, crm_contact_stage string, reporter_email_stage string")
    ct = spark.createDataFrame([(1, "g", "x")], "contact_dim_id long, contactid string, emailaddress string")
    plan = facts.match_codes(st, ct)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_contact_matched_by_guid_and_email_to_different_contacts(spark):
    st = spark.createDataFrame([("k", "g1", "e2")], "key_stage string, crm_contact_stage string, reporter_email_stage string")
    ct = spark.createDataFrame([(1, "g1", "e1"), (2, "g2", "e2")], "contact_dim_id long, contactid string, emailaddress string")
    assert rows(facts.match_codes(st, ct), "key_stage", "contact_guid_map_status_id") == [("k", 1)]
    fact = spark.createDataFrame([("k", True, None)], "jira_key string, is_active boolean, jira_contact_guid_map_status_id int")
    assert rows(facts.apply_match_code(fact, facts.match_codes(st, ct)), "jira_contact_guid_map_status_id") == [(1,)]


def test_product_bridge_label_shapes(spark):
    opt = "<JIRA CustomFieldOption: value='{}', id='{}'>"
    stage = spark.createDataFrame([
        ("T1", "[" + ", ".join([opt.format("Id = value's", "10"), opt.format("Other", "99")]) + "]"),
        ("T2", "[]"),
        ("T3", None),
    ], "key string, product_name string")
    products = spark.createDataFrame([(5, "10")], "jira_product_dim_id long, jira_product_api_id string")
    existing = spark.createDataFrame([("T1", None)], "jira_key string, jira_product_dim_id long")
    out = facts.explode_products(stage, products, existing)
    # id 99 is unknown -> null key, which already exists for T1 (null-safe), so only (T1, 5)
    assert rows(out) == [("T1", 5)]


def test_star_lookup_default_member_and_no_row_growth(spark):
    stage = spark.createDataFrame([("A", " x "), ("B", None), ("C", "zz")], "k string, s string")
    dim = spark.createDataFrame([(1, "x"), (2, "None"), (3, "x")], "id long, name string")
    out = facts.star_lookup(stage, [facts.Lookup(dim, "s", "name", "id", "sid")])
    assert rows(out, "k", "sid") == [("A", 1), ("B", 2), ("C", None)]
    out2 = facts.star_lookup(stage, [facts.Lookup(dim, "s", "name", "id", "sid", default_member=False)])
    assert rows(out2, "k", "sid") == [("A", 1), ("B", None), ("C", None)]


def test_deactivate_and_fill(spark):
    fact = spark.createDataFrame([(1, 10, True, None), (2, 11, True, 5), (3, 10, False, None)],
                                 "jira_key long, fk long, is_active boolean, dep long")
    dim = spark.createDataFrame([(10, "Test Org", 7), (11, "Other", 8)], "id long, name string, dep long")
    out = facts.deactivate_by(fact, dim, "fk", "id", F.col("name") == "Test Org")
    assert rows(out, "jira_key", "is_active") == [(1, False), (2, True), (3, False)]
    out = facts.fill_from_dim(fact, dim, "fk", "id", "dep", "dep")
    assert rows(out, "jira_key", "dep") == [(1, 7), (2, 5), (3, 7)]


def test_rows_without_a_key_are_dealt_out(spark):
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in off}
    try:
        for k, v in off.items():
            spark.conf.set(k, v)
        target = spark.range(2000).selectExpr("id", "case when id < 100 then id % 4 end as who", "cast(null as long) as dept").repartition(8)
        users = spark.createDataFrame([(0, 10), (1, 11), (1, 12), (None, 13)], "user long, dept long")
        out = facts.fill_from_dim(target, users, "who", "user", "dept", "dept")
        assert out.columns == ["id", "who", "dept"]
        assert rows(out.filter("dept is not null").groupBy("who", "dept").count()) == [(0, 10, 25), (1, 11, 25)]
        # dept is counted too, or the join, unused, is left out
        sizes = [n for _, n, _ in rows(out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("id"), F.count("dept")))]
        assert sum(sizes) == 2000 and max(sizes) < 600
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
