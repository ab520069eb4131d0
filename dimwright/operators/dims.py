"""Dimension maintenance (D1-D17), built on the shared patterns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimwright.functions.text import DEFAULT_MEMBER, INACTIVE_USER_MARKER, or_default, trimmed
from dimwright.operators.keys import assign_keys, max_key
from dimwright.operators.patterns import anti_join, insert_missing, one_per_key, update_from

GRAM = 3   # characters of a piece that child names and LIKE patterns meet by


# ---------------------------------------------------------------- D1 / D2
def insert_missing_contacts(contacts: DataFrame, source: DataFrame) -> DataFrame:
    """Source contacts whose ``contactid`` is absent (a null id is always absent)."""
    cand = source.select("contactid", "salutation", "firstname", "lastname", "fullname", "jobtitle",
                         F.col("emailaddress1").alias("emailaddress"))
    return insert_missing(contacts, cand, ["contactid"], "contact_dim_id",
                          order_by=["contactid", "emailaddress", "fullname", "firstname", "lastname",
                                    "salutation", "jobtitle"])


def update_attributes(dim: DataFrame, source: DataFrame, dim_key: str, source_key: str,
                      mapping: dict[str, str]) -> DataFrame:
    """Overwrite attributes from the source on trimmed key equality.
    ``mapping`` is dim column -> source column."""
    src = source.select(trimmed(source_key).alias("_k"), *[F.col(s).alias(f"_v_{d}") for d, s in mapping.items()])
    return update_from(dim, src, [(trimmed(F.col(f"t.{dim_key}")), "_k")],
                       {d: F.col(f"s._v_{d}") for d in mapping}, source_order=[f"_v_{d}" for d in mapping])


# ---------------------------------------------------------------- D3 / D4 / D5 / D11 / D13-D16
def insert_missing_names(dim: DataFrame, names: Column, source: DataFrame, name_col: str, key_col: str,
                         null_aware: bool = False, default_null: bool = True) -> DataFrame:
    """Distinct names (``COALESCE(x, 'None')`` when ``default_null``) absent
    from the dimension. ``null_aware`` gives ``NOT IN`` semantics (D3: a null
    already in the dimension blocks every insert; a null name is absent only
    from an empty dimension, and is then inserted as 'None')."""
    n = F.coalesce(names, F.lit(DEFAULT_MEMBER)) if default_null else names
    cand = source.select(n.alias(name_col)).distinct()
    if null_aware:
        cand = anti_join(cand, dim, [name_col], null_aware=True).select(
            F.coalesce(name_col, F.lit(DEFAULT_MEMBER)).alias(name_col)).distinct()
    return insert_missing(dim, cand, [name_col], key_col, order_by=[name_col])


def insert_missing_origins(origin_dim: DataFrame, incidents: DataFrame) -> DataFrame:
    """(name, code) pairs whose name is absent; a name with two codes yields two members."""
    cand = (incidents.select(F.coalesce("caseorigincodename", F.lit(DEFAULT_MEMBER)).alias("jira_origin_name"),
                             F.coalesce("caseorigincode", F.lit(0)).cast("long").alias("source_case_origin_id"))
            .distinct())
    return insert_missing(origin_dim, cand, ["jira_origin_name"], "jira_origin_dim_id",
                          order_by=["jira_origin_name", "source_case_origin_id"])


def insert_if_absent(dim: DataFrame, rows: DataFrame, on: Sequence[str], key_col: str | None) -> DataFrame:
    """Conditional insert of rows whose ``on`` value is absent.
    Rows repeating one ``on`` value are inserted once (the first by all columns),
    as the row-at-a-time statements do."""
    first = one_per_key(rows, list(on))
    return insert_missing(dim, first, list(on), key_col, order_by=list(on))


# ---------------------------------------------------------------- D6 / D7 / D8
def upsert_statuses(status_dim: DataFrame, workflow: DataFrame) -> DataFrame:
    """Set flag and api id by trimmed name, then insert missing statuses."""
    src = workflow.select(or_default("status").alias("_k"), F.col("flag").alias("_flag"),
                          F.col("id").cast("long").alias("_id"))
    upd = update_from(status_dim, src, [(trimmed(F.col("t.jira_status")), "_k")],
                      {"is_workflow_status": F.col("s._flag"), "jira_api_id": F.col("s._id")},
                      source_order=["_id", "_flag"])
    # matched on the trimmed name, inserted with the name as given
    cand = workflow.select(F.coalesce(F.col("status"), F.lit(DEFAULT_MEMBER)).alias("jira_status"),
                           F.col("flag").alias("is_workflow_status"),
                           F.coalesce(F.col("id").cast("long"), F.lit(0)).alias("jira_api_id"),
                           or_default("status").alias("_k"))
    have = upd.select(trimmed("jira_status").alias("_k"))
    missing = anti_join(cand, have, ["_k"]).drop("_k")
    new = assign_keys(missing, ["jira_status", "jira_api_id", "is_workflow_status"], "jira_status_dim_id",
                      base=max_key(upd, "jira_status_dim_id"))
    return upd.unionByName(new, allowMissingColumns=True)


def upsert_users(user_dim: DataFrame, users: DataFrame, project: str = "SERVICDESK") -> DataFrame:
    """Update name/email/active where any differs (``!=``: a null never
    differs), then insert users whose id is absent."""
    src = users.select(or_default("user_id").alias("_k"), F.col("user_name").alias("_n"),
                       F.col("email_id").alias("_e"), F.col("active").alias("_a"))
    changed = ((F.col("t.jira_user_name") != F.col("s._n")) | (F.col("t.email_id") != F.col("s._e"))
               | (F.col("t.is_active") != F.col("s._a")))
    upd = update_from(user_dim, src, [(trimmed(F.col("t.jira_user_id")), "_k")],
                      {"jira_user_name": F.col("s._n"), "jira_project": F.lit(project),
                       "email_id": F.col("s._e"), "is_active": F.col("s._a")},
                      where=changed, source_order=["_n", "_e", "_a"])
    cand = users.select(F.coalesce("user_id", F.lit(DEFAULT_MEMBER)).alias("jira_user_id"),
                        F.col("user_name").alias("jira_user_name"), F.lit(project).alias("jira_project"),
                        F.col("email_id"), F.col("active").alias("is_active"))
    have = upd.select(trimmed("jira_user_id").alias("_k"))
    missing = cand.join(have, or_default(cand["jira_user_id"]) == have["_k"], "left_anti")
    new = assign_keys(missing, ["jira_user_id", "jira_user_name", "email_id", "is_active"], "jira_user_dim_id",
                      base=max_key(upd, "jira_user_dim_id"))
    return upd.unionByName(new, allowMissingColumns=True)


def insert_missing_users(user_dim: DataFrame, stage: DataFrame, project: str = "SERVICDESK") -> DataFrame:
    """Assignees seen on tickets but absent from the user dimension.
    A display name ending in '[X]' marks an inactive user; the marker is removed."""
    seen = stage.select(F.coalesce("assignee", F.lit(DEFAULT_MEMBER)).alias("jira_user_id"),
                        F.col("assignee_name").alias("_name"),
                        or_default("assignee").alias("_k")).distinct()
    have = user_dim.select(trimmed("jira_user_id").alias("_k"))
    missing = anti_join(seen, have, ["_k"])
    marker = F.lit(INACTIVE_USER_MARKER)
    rows = missing.select(
        "jira_user_id",
        F.trim(F.replace(F.col("_name"), marker, F.lit(""))).alias("jira_user_name"),
        F.lit(project).alias("jira_project"), F.lit(DEFAULT_MEMBER).alias("email_id"),
        # LIKE on a null name is null, so the CASE falls through to active
        F.when(F.col("_name").endswith(INACTIVE_USER_MARKER), False).otherwise(True).alias("is_active"))
    new = assign_keys(rows, ["jira_user_id", "jira_user_name", "is_active"], "jira_user_dim_id",
                      base=max_key(user_dim, "jira_user_dim_id"))
    return user_dim.unionByName(new, allowMissingColumns=True)


# ---------------------------------------------------------------- D10
def upsert_products(product_dim: DataFrame, products: DataFrame) -> DataFrame:
    """Outer merge on api id; new ids are inserted, known ids whose name
    changed are renamed."""
    src = one_per_key(products.select(F.col("api_id").cast("string").alias("_id"),
                                      F.col("product_name").alias("_name")), ["_id"], ["_name"])
    upd = update_from(product_dim, src, [(F.col("t.jira_product_api_id").cast("string"), "_id")],
                      {"jira_product_name": F.col("s._name")},
                      where=F.col("t.jira_product_name") != F.col("s._name"), source_unique=True)
    cand = src.select(F.col("_name").alias("jira_product_name"), F.col("_id").alias("jira_product_api_id"))
    have = upd.select(F.col("jira_product_api_id").cast("string").alias("jira_product_api_id"))
    missing = anti_join(cand, have, ["jira_product_api_id"])
    new = assign_keys(missing, ["jira_product_api_id"], "jira_product_dim_id",
                      base=max_key(upd, "jira_product_dim_id"))
    return upd.unionByName(new, allowMissingColumns=True)


# ---------------------------------------------------------------- D12
def _grams(x: str, n: int) -> Column:
    """Distinct substrings of length ``n`` of column ``x``, none for a shorter text."""
    return F.when(F.length(x) >= n, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(x) - (n - 1)),
                                                                 lambda i: F.substring(F.col(x), i, F.lit(n)))))


def fuzzy_assign(child: DataFrame, parent: DataFrame, child_key: str, child_name: str, child_fk: str,
                 parent_key: str, parent_name: str) -> DataFrame:
    """``lower(child_name) LIKE '%' || lower(replace(parent_name, ' ', '%')) || '%'``
    for children whose foreign key is null; several matching parents -> the
    smallest key.

    A LIKE condition has no equi key, so candidates are found first: a name can
    only match where it holds every stretch of the pattern between wildcards.
    Each pattern is looked up by one short substring of its longest stretch, the
    one that the fewest names hold (a pattern holding a substring that no name
    has matches nothing and goes); patterns of stretches below ``GRAM`` meet
    names by a single character, patterns of wildcards alone by the empty text.
    Candidates are verified with LIKE. Names and patterns are reduced to
    distinct ones before, so copies cost nothing.
    """
    pat = F.concat(F.lit("%"), F.lower(F.replace(F.col(parent_name), F.lit(" "), F.lit("%"))), F.lit("%"))
    # a backslash escapes a wildcard or itself; before anything else it is dropped
    pat = F.regexp_replace(pat, r"(\\\\|\\%|\\_)|\\", "$1")
    patterns = (parent.select(F.col(parent_key).alias("_pk"), pat.alias("_pat")).filter(F.col("_pat").isNotNull())
                .groupBy("_pat").agg(F.min("_pk").alias("_pk")))
    pieces = F.split("_pat", r"\\.|[%_]")
    longest = F.array_max(F.transform(pieces, lambda x: F.struct(F.length(x).alias("n"), x.alias("x"))))["x"]
    patterns = patterns.withColumn("_piece", longest)
    names = (child.filter(F.col(child_fk).isNull()).select(F.lower(F.col(child_name)).alias("_cn"))
             .filter(F.col("_cn").isNotNull()).distinct())

    def keys(x: str, of_pattern: bool) -> Column:
        one, many = _grams(x, 1), _grams(x, GRAM)
        empty = F.array(F.lit(""))
        if of_pattern:
            return F.coalesce(many, one, empty)
        return F.concat(empty, F.coalesce(one, F.array().cast("array<string>")), F.coalesce(many, F.array().cast("array<string>")))

    held = names.select("_cn", F.explode(keys("_cn", False)).alias("_g"))
    often = held.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"))
    asked = patterns.select("_pat", "_pk", F.explode(keys("_piece", True)).alias("_g"))
    rarest = (asked.join(often, "_g", "left")
              .groupBy("_pat", "_pk").agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("_n"), "_g")).alias("_r"))
              .filter("_r._n > 0").select("_pat", "_pk", F.col("_r._g").alias("_g")))
    matches = (held.join(rarest, "_g").filter(F.like(F.col("_cn"), F.col("_pat")))
               .groupBy("_cn").agg(F.min("_pk").alias("_pk")))
    return update_from(child, matches, [(F.lower(F.col(f"t.{child_name}")), "_cn")], {child_fk: F.col("s._pk")},
                       where=F.col(f"t.{child_fk}").isNull(), source_unique=True)


# ---------------------------------------------------------------- D17
def assign_department(user_dim: DataFrame, mapping: DataFrame, dept_dim: DataFrame) -> DataFrame:
    """Department by account name, else by display name (lower, trimmed),
    only for users still at 0/null; whatever stays null becomes 0."""
    dept = one_per_key(dept_dim.select(F.coalesce("department_name", F.lit(DEFAULT_MEMBER)).alias("_dn"),
                                       "department_dim_id"), ["_dn"], ["department_dim_id"])
    m = mapping.select(F.lower(F.trim("samaccountname")).alias("_acct"), F.lower(F.trim("displayname")).alias("_disp"),
                       F.coalesce(F.trim("department"), F.lit(DEFAULT_MEMBER)).alias("_dn"))
    m = m.join(dept, "_dn", "inner")
    by_acct = m.select("_acct", F.col("department_dim_id").alias("_d")).filter(F.col("_acct").isNotNull())
    by_disp = m.select("_disp", F.col("department_dim_id").alias("_d")).filter(F.col("_disp").isNotNull())
    unset = F.coalesce(F.col("t.department_dim_id"), F.lit(0)) == 0
    out = update_from(user_dim, by_acct, [(F.lower(F.col("t.jira_user_id")), "_acct")],
                      {"department_dim_id": F.col("s._d")}, where=unset, source_order=["_d"])
    out = update_from(out, by_disp, [(F.lower(F.col("t.jira_user_name")), "_disp")],
                      {"department_dim_id": F.col("s._d")}, where=unset, source_order=["_d"])
    return out.withColumn("department_dim_id", F.coalesce("department_dim_id", F.lit(0)).cast("long"))
