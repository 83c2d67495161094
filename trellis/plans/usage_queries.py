"""Usage-metrics queries (J1-J9, A8-A14, S15, S16) and the scalar function checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from trellis.functions import scalar as S
from trellis.operators import usage as U
from trellis.plans import fixtures as fx
from trellis.plans.oracle_sql import cte
from trellis.plans.registry import register
from trellis.session import scratch_path
from trellis.sources import sinks as K

LOOKBACK_DAYS = 7  # [choice] look-back window of the period roll-ups
ENGINE_VERSION_SQL = "'v4.20.1'"  # semver(ENGINE_MODULE_VERSION), spelled out for the oracle
EXPORT_TS = "2024-06-01T00:00:00+00:00"

_WIN = [
    """le AS (SELECT event_id, consumer_account_locator AS loc, event_type, consumer_email,
              json_extract_string(consumer_metadata, '$.first_name') AS first_name,
              json_extract_string(consumer_metadata, '$.last_name') AS last_name
       FROM usage_events WHERE listing_name LIKE '%GRAPH_APP%' AND event_type IN ('GET', 'TRIAL', 'PURCHASE'))""",
    """pr AS (SELECT *, CASE event_type WHEN 'PURCHASE' THEN 3 WHEN 'TRIAL' THEN 2 WHEN 'GET' THEN 1 ELSE 0 END AS p
       FROM le WHERE coalesce(loc, '') <> '')""",
    """win AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY loc ORDER BY p DESC, event_id) AS rn FROM pr)
       WHERE rn = 1)""",
    """fill AS (SELECT loc,
       arg_min(consumer_email, event_id) FILTER (WHERE coalesce(consumer_email, '') <> '') AS f_email,
       arg_min(first_name, event_id) FILTER (WHERE coalesce(first_name, '') <> '') AS f_first,
       arg_min(last_name, event_id) FILTER (WHERE coalesce(last_name, '') <> '') AS f_last FROM pr GROUP BY loc)""",
    """bw AS (SELECT w.loc, w.event_type, w.event_id,
       coalesce(nullif(w.consumer_email, ''), f.f_email, '') AS consumer_email,
       coalesce(nullif(w.first_name, ''), f.f_first, '') AS first_name,
       coalesce(nullif(w.last_name, ''), f.f_last, '') AS last_name FROM win w JOIN fill f USING (loc))""",
]


def _sub_cte(name: str, where: str = "TRUE", status: str | None = None) -> str:
    hs_status = f"'{status}'" if status else """CASE upper(coalesce(upgrade_state, '')) WHEN 'COMPLETE' THEN 'active'
       WHEN 'DISABLED' THEN 'canceled' WHEN 'PENDING' THEN 'scheduled' ELSE 'active' END"""
    return f"""{name} AS (SELECT c_custkey,
  CASE WHEN coalesce(r, '') = '' THEN '' WHEN strpos(r, '_') > 0
       THEN replace(lower(substr(r, strpos(r, '_') + 1)), '_', '-') ELSE lower(r) END AS cloud_region,
  coalesce(lower(split_part(r, '_', 1)), '') AS cloud_vendor,
  concat_ws('.', nullif(current_version, ''), nullif(nullif(CAST(current_patch AS VARCHAR), ''), '0')) AS cloud_version,
  'snowflake' AS cloud_provider, {ENGINE_VERSION_SQL} AS engine_version,
  coalesce(substr(CAST(created_on AS VARCHAR), 1, 10), '') AS hs_recurring_billing_start_date,
  {hs_status} AS hs_status,
  coalesce(consumer_account_name, '') AS db_name, coalesce(consumer_account_name, '') AS cloud_db_name,
  'instance-' || lower(consumer_account_locator) AS hs_name,
  'none' AS node_instance_type, '' AS subscription_id_omnistrate,
  CASE upper(coalesce(bw.event_type, '')) WHEN 'PURCHASE' THEN 'standalone' ELSE 'free' END AS deployment_type,
  coalesce(nullif(coalesce(substr(CAST(last_upgraded_on AS VARCHAR), 1, 10), ''), ''),
           coalesce(substr(CAST(created_on AS VARCHAR), 1, 10), '')) AS hs_last_modified_at,
  CASE upper(coalesce(bw.event_type, '')) WHEN 'PURCHASE' THEN 'graph_pro' ELSE 'graph_free' END AS subscription_plan,
  coalesce(bw.consumer_email, '') AS email, coalesce(bw.first_name, '') AS first_name,
  coalesce(bw.last_name, '') AS last_name
  FROM (SELECT *, consumer_snowflake_region AS r FROM usage_apps
        WHERE coalesce(consumer_account_locator, '') <> '' AND {where}) inst
  LEFT JOIN bw ON bw.loc = inst.consumer_account_locator)"""


def _usage_cte(*extra: str) -> str:
    return cte("usage_events", "usage_apps", extra=_WIN + list(extra))


def _events(spark, sf):
    return U.listing_events(fx.usage_events(spark, sf), fx.LISTING_FILTER)


def _apps(spark, sf):
    return fx.usage_apps(spark, sf).where(F.col("package_name").like(fx.LISTING_FILTER))


def _subs(spark, sf, apps=None):
    apps = _apps(spark, sf) if apps is None else apps
    return U.subscriptions(apps, _events(spark, sf), S.semver(F.lit(fx.ENGINE_MODULE_VERSION)), fx.PLAN_PREFIX)


def _period_start(ev):
    """Start of the look-back period: the last event time, a scalar subquery of the plan, minus LOOKBACK_DAYS."""
    return ev.agg(F.max("ts").alias("end")).scalar().cast("timestamp_ntz") - F.expr(f"INTERVAL {LOOKBACK_DAYS} DAYS")


# ------------------------------------------------------------------ J1-J5
@register("event_winner", ids="J2 J4", sql=_usage_cte() + """
SELECT loc AS consumer_account_locator, event_type, event_id FROM win""")
def event_winner(spark, sf):
    return U.event_winners(_events(spark, sf))


@register("event_backfill", ids="J3 F18", sql=_usage_cte() + """
SELECT loc AS consumer_account_locator, event_type, consumer_email, first_name, last_name FROM bw""")
def event_backfill(spark, sf):
    return U.backfilled_winners(_events(spark, sf)).drop("event_id")


@register("subscriptions", ids="J1 J5 F25 F26 F27 F28 F29 F30 F31 F32 F34", sql=_usage_cte(_sub_cte("sub")) + """
SELECT * EXCLUDE (c_custkey) FROM sub""")
def subscriptions(spark, sf):
    """One 18-field record per install with a locator (the export's build step)."""
    return _subs(spark, sf)


# ------------------------------------------------------------------ J6-J9
_HALF_OLD = "c_custkey % 3 <> 0"
_HALF_NEW = "(c_custkey % 2 = 0 OR c_custkey % 3 = 0)"


def _half_subs(spark, sf):
    apps = _apps(spark, sf)
    old = _subs(spark, sf, apps.where(_HALF_OLD)).withColumn("hs_status", F.lit("stale"))
    new = _subs(spark, sf, apps.where(_HALF_NEW))
    return old, new


@register("crm_subscriptions", ids="J6 J7", sql=_usage_cte(_sub_cte("s_old", _HALF_OLD, "stale"),
                                                           _sub_cte("s_new", _HALF_NEW)) + """
SELECT coalesce(n.hs_name, o.hs_name) AS hs_name, coalesce(n.hs_status, o.hs_status) AS hs_status,
       coalesce(n.cloud_version, o.cloud_version) AS cloud_version, coalesce(n.email, o.email) AS email
FROM s_old o FULL OUTER JOIN s_new n ON o.hs_name = n.hs_name""")
def crm_subscriptions(spark, sf):
    """Subscription upsert by hs_name: an earlier export (marked stale) updated by a later one."""
    old, new = _half_subs(spark, sf)
    t = U.upsert_subscriptions(U.managed_fields(old), new)
    return t.select("hs_name", "hs_status", "cloud_version", "email")


@register("crm_contacts", ids="J8", sql=_usage_cte(_sub_cte("s_old", _HALF_OLD), _sub_cte("s_new", _HALF_NEW)) + """
SELECT coalesce(n.email, o.email) AS email, coalesce(n.firstname, o.firstname) AS firstname,
       coalesce(n.lastname, o.lastname) AS lastname FROM
  (SELECT trim(email) AS email, 'old' AS firstname, CAST(NULL AS VARCHAR) AS lastname FROM s_old
   WHERE trim(email) <> '') o
FULL OUTER JOIN
  (SELECT trim(email) AS email, nullif(first_name, '') AS firstname, nullif(last_name, '') AS lastname FROM s_new
   WHERE trim(email) <> '') n ON o.email = n.email""")
def crm_contacts(spark, sf):
    """Contact upsert by trimmed e-mail; names only overwrite when the new record has them."""
    old, new = _half_subs(spark, sf)
    existing = U.contacts_from(old).select("email", F.lit("old").alias("firstname"),
                                           F.lit(None).cast("string").alias("lastname"))
    return U.upsert_contacts(existing, new).select("email", "firstname", "lastname")


@register("crm_links", ids="J9", sql=_usage_cte(_sub_cte("s_old", _HALF_OLD), _sub_cte("s_new", _HALF_NEW)) + """
SELECT DISTINCT hs_name, trim(email) AS email, 295 AS association_type FROM (
  SELECT hs_name, email FROM s_old UNION ALL SELECT hs_name, email FROM s_new) WHERE trim(email) <> ''""")
def crm_links(spark, sf):
    """Subscription-contact association (type 295); a link put twice is still one."""
    old, new = _half_subs(spark, sf)
    links = U.link_contacts(None, old, S.CONTACT_ASSOCIATION_TYPE)
    return U.link_contacts(links, new, S.CONTACT_ASSOCIATION_TYPE)


# ------------------------------------------------------------------ S15 S16 A14
@register("json_report", ids="S15 A14", sql=_usage_cte(_sub_cte("sub")) + """
SELECT '%GRAPH_APP%' AS listing_filter, count(*) AS subscription_count, 'graph_app' AS source, 'fixed-run' AS run_id FROM sub""")
def json_report(spark, sf):
    """The export report: header fields + the subscription records (written in parallel)."""
    path = scratch_path(spark, "report")
    head = K.write_report(spark, _subs(spark, sf), path,
                          {"export_timestamp": EXPORT_TS, "run_id": "fixed-run", "listing_filter": fx.LISTING_FILTER,
                           "source": "graph_app"})
    return head.select("listing_filter", "subscription_count", "source", "run_id")


@register("report_explode", ids="S16", sql=_usage_cte(_sub_cte("sub")) + """
SELECT hs_name, hs_status, email, subscription_plan FROM sub""")
def report_explode(spark, sf):
    """Read the report back and explode its subscriptions (the CRM push input)."""
    path = scratch_path(spark, "report")
    K.write_report(spark, _subs(spark, sf), path, {"listing_filter": fx.LISTING_FILTER})
    return K.read_report(spark, path).select("hs_name", "hs_status", "email", "subscription_plan")


# ------------------------------------------------------------------ A8-A13
@register("installs_total", ids="A8", sql=cte("usage_events") + """
SELECT listing_name, event_type, count(*) AS total_count FROM usage_events
WHERE listing_name LIKE '%GRAPH_APP%' AND event_type IN ('GET', 'TRIAL', 'PURCHASE') GROUP BY listing_name, event_type""")
def installs_total(spark, sf):
    ev = fx.usage_events(spark, sf).where(F.col("listing_name").like(fx.LISTING_FILTER)
                                          & F.col("event_type").isin(*U.EVENT_TYPES))
    return ev.groupBy("listing_name", "event_type").agg(F.count("*").alias("total_count"))


@register("installs_daily", ids="A9", sql=cte("usage_events") + f"""
SELECT CAST(ts AS DATE) AS event_date, event_type, count(*) AS daily_count FROM usage_events
WHERE listing_name LIKE '%GRAPH_APP%' AND event_type IN ('GET', 'TRIAL', 'PURCHASE')
  AND ts >= (SELECT max(ts) FROM events) - INTERVAL {LOOKBACK_DAYS} DAY
GROUP BY 1, 2""")
def installs_daily(spark, sf):
    ev = fx.usage_events(spark, sf)
    # the period end is one number read from the data
    since = _period_start(ev)
    ev = ev.where(F.col("listing_name").like(fx.LISTING_FILTER) & F.col("event_type").isin(*U.EVENT_TYPES)
                  & (F.col("ts") >= since))
    return ev.groupBy(F.to_date("ts").alias("event_date"), "event_type").agg(F.count("*").alias("daily_count"))


@register("active_installs", ids="A10", sql=cte("usage_apps") + """
SELECT consumer_account_name,
       concat_ws('.', nullif(current_version, ''), nullif(CAST(current_patch AS VARCHAR), '0')) AS current_version,
       upgrade_state AS last_health_status
FROM usage_apps WHERE consumer_account_locator <> '' AND upgrade_state <> 'DISABLED'""")
def active_installs(spark, sf):
    """Latest state per install (max_by over the last change), without cancelled ones."""
    apps = _apps(spark, sf).where(F.col("consumer_account_locator") != "")
    latest = apps.groupBy("consumer_account_locator").agg(F.max_by(
        F.struct("consumer_account_name", "current_version", "current_patch", "upgrade_state"),
        F.coalesce("last_upgraded_on", "created_on")).alias("s")).select("s.*")
    return latest.where(S.status("upgrade_state") != "canceled").select(
        "consumer_account_name", S.version_text("current_version", "current_patch").alias("current_version"),
        F.col("upgrade_state").alias("last_health_status"))


@register("activity_1_7_28", ids="A11", sql="""
WITH ud AS (SELECT DISTINCT CAST(ts AS DATE) AS d, user_id FROM events),
days AS (SELECT CAST(ts AS DATE) AS event_date, count(*) AS jobs FROM events GROUP BY 1)
SELECT event_date, jobs,
  (SELECT count(DISTINCT user_id) FROM ud WHERE d = event_date) AS unique_users_1d,
  (SELECT count(DISTINCT user_id) FROM ud WHERE d > event_date - 7 AND d <= event_date) AS unique_users_7d,
  (SELECT count(DISTINCT user_id) FROM ud WHERE d > event_date - 28 AND d <= event_date) AS unique_users_28d
FROM days""")
def activity_1_7_28(spark, sf):
    """Jobs per day and distinct users over 1, 7 and 28 days (exact)."""
    ev = fx.table(spark, sf, "events").select(F.to_date("ts").alias("d"), "user_id")
    jobs = ev.groupBy(F.col("d").alias("event_date")).agg(F.count("*").alias("jobs"),
                                                          F.countDistinct("user_id").alias("unique_users_1d"))
    ud = ev.distinct()
    out = jobs
    for n in (7, 28):
        out = out.join(U.distinct_in_window(ud, "user_id", "d", n).withColumnRenamed("d", "event_date")
                       .withColumnRenamed("n_distinct", f"unique_users_{n}d"), "event_date", "left")
    return out.select("event_date", "jobs", "unique_users_1d",
                      F.coalesce("unique_users_7d", F.lit(0)).cast("bigint").alias("unique_users_7d"),
                      F.coalesce("unique_users_28d", F.lit(0)).cast("bigint").alias("unique_users_28d"))


@register("engagement_ctr", ids="A12", sql="""
WITH t AS (SELECT CAST(ts AS DATE) AS event_date,
  CASE event_type WHEN 'view' THEN 'LISTING VIEW' WHEN 'click' THEN 'LISTING CLICK' END AS kind FROM events)
SELECT event_date, count(*) FILTER (WHERE kind = 'LISTING VIEW') AS views,
       count(*) FILTER (WHERE kind = 'LISTING CLICK') AS clicks,
       round(CASE WHEN count(*) FILTER (WHERE kind = 'LISTING VIEW') = 0 THEN NULL ELSE
         count(*) FILTER (WHERE kind = 'LISTING CLICK') * 1.0 / count(*) FILTER (WHERE kind = 'LISTING VIEW') END, 6)
         AS ctr
FROM t WHERE kind IS NOT NULL GROUP BY event_date""")
def engagement_ctr(spark, sf):
    ev = fx.table(spark, sf, "events")
    kind = (F.when(F.col("event_type") == "view", "LISTING VIEW")
            .when(F.col("event_type") == "click", "LISTING CLICK"))
    t = ev.select(F.to_date("ts").alias("event_date"), kind.alias("kind")).where(F.col("kind").isNotNull())
    agg = t.groupBy("event_date").agg(F.count_if(F.col("kind") == "LISTING VIEW").alias("views"),
                                      F.count_if(F.col("kind") == "LISTING CLICK").alias("clicks"))
    return agg.withColumn("ctr", F.round(F.try_divide(F.col("clicks").cast("double"), F.col("views")), 6))


@register("usage_summary", ids="A13", sql=cte("usage_apps") + f"""
SELECT (SELECT count(*) FROM usage_apps WHERE consumer_account_locator <> '') AS total_installs_all_time,
       (SELECT count(*) FROM usage_apps WHERE consumer_account_locator <> ''
          AND upper(upgrade_state) NOT IN ('DISABLED', 'PENDING')) AS active_installs_now,
       (SELECT count(*) FROM usage_apps WHERE consumer_account_locator <> ''
          AND upgrade_state = 'COMPLETE') AS healthy_installs,
       (SELECT count(*) FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL {LOOKBACK_DAYS} DAY)
          AS total_jobs_in_period,
       (SELECT count(DISTINCT user_id) FROM events
          WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL {LOOKBACK_DAYS} DAY) AS unique_consumers_in_period""")
def usage_summary(spark, sf):
    """One aggregate per source; the one-row results are put side by side."""
    apps = fx.usage_apps(spark, sf).where(F.col("consumer_account_locator") != "")
    a = apps.agg(F.count("*").alias("total_installs_all_time"),
                 F.count_if(S.status("upgrade_state") == "active").alias("active_installs_now"),
                 F.count_if(F.col("upgrade_state") == "COMPLETE").alias("healthy_installs"))
    ev = fx.table(spark, sf, "events")
    recent = ev.where(F.col("ts") >= _period_start(ev))
    b = recent.agg(F.count("*").alias("total_jobs_in_period"),
                   F.countDistinct("user_id").alias("unique_consumers_in_period"))
    return a.crossJoin(F.broadcast(b))


# ------------------------------------------------------------------ scalar functions
@register("scalar_names", ids="F12 F14 F15 F25 F26 F32", sql=cte("usage_apps") + """
SELECT c_custkey,
  CASE WHEN coalesce(consumer_snowflake_region, '') = '' THEN '' WHEN strpos(consumer_snowflake_region, '_') > 0
       THEN replace(lower(substr(consumer_snowflake_region, strpos(consumer_snowflake_region, '_') + 1)), '_', '-')
       ELSE lower(consumer_snowflake_region) END AS region,
  coalesce(lower(split_part(consumer_snowflake_region, '_', 1)), '') AS vendor,
  CASE WHEN consumer_account_locator = '' THEN '' ELSE 'instance-' || lower(consumer_account_locator) END AS hs_name,
  upper(consumer_account_name) AS upper_name,
  'consumer_data_' || consumer_account_locator AS folder,
  true AS uuid_ok
FROM usage_apps""")
def scalar_names(spark, sf):
    apps = fx.usage_apps(spark, sf)
    u = S.unique_name("")
    return apps.select("c_custkey", S.region_name("consumer_snowflake_region").alias("region"),
                       S.region_vendor("consumer_snowflake_region").alias("vendor"),
                       S.instance_name("consumer_account_locator").alias("hs_name"),
                       F.upper("consumer_account_name").alias("upper_name"),
                       F.concat(F.lit("consumer_data_"), F.col("consumer_account_locator")).alias("folder"),
                       ((F.length(u) == 36) & (F.instr(u, "-") == 0)).alias("uuid_ok"))


@register("scalar_version", ids="F27 F33", sql=cte("usage_apps") + """
SELECT c_custkey,
  concat_ws('.', nullif(current_version, ''), nullif(nullif(CAST(current_patch AS VARCHAR), ''), '0')) AS cloud_version,
  'v' || CAST((40000 + c_custkey * 7) // 10000 AS VARCHAR) || '.' || CAST(((40000 + c_custkey * 7) // 100) % 100 AS VARCHAR)
      || '.' || CAST((40000 + c_custkey * 7) % 100 AS VARCHAR) AS semver
FROM usage_apps""")
def scalar_version(spark, sf):
    apps = fx.usage_apps(spark, sf)
    return apps.select("c_custkey", S.version_text("current_version", "current_patch").alias("cloud_version"),
                       S.semver(F.lit(40000) + F.col("c_custkey") * 7).alias("semver"))


@register("scalar_maps", ids="F28 F29 F30", sql=cte("usage_events", "usage_apps") + """
SELECT 'status' AS map, upgrade_state AS k,
  CASE upper(coalesce(upgrade_state, '')) WHEN 'COMPLETE' THEN 'active' WHEN 'DISABLED' THEN 'canceled'
       WHEN 'PENDING' THEN 'scheduled' ELSE 'active' END AS v, count(*) AS n FROM usage_apps GROUP BY 1, 2, 3
UNION ALL
SELECT 'deployment', event_type, CASE upper(event_type) WHEN 'PURCHASE' THEN 'standalone' ELSE 'free' END, count(*)
FROM usage_events GROUP BY 1, 2, 3
UNION ALL
SELECT 'plan', event_type, CASE upper(event_type) WHEN 'PURCHASE' THEN 'graph_pro' ELSE 'graph_free' END, count(*)
FROM usage_events GROUP BY 1, 2, 3""")
def scalar_maps(spark, sf):
    apps, ev = fx.usage_apps(spark, sf), fx.usage_events(spark, sf)
    a = apps.groupBy(F.lit("status").alias("map"), F.col("upgrade_state").alias("k"),
                     S.status("upgrade_state").alias("v")).agg(F.count("*").alias("n"))
    b = ev.groupBy(F.lit("deployment").alias("map"), F.col("event_type").alias("k"),
                   S.deployment_type("event_type").alias("v")).agg(F.count("*").alias("n"))
    c = ev.groupBy(F.lit("plan").alias("map"), F.col("event_type").alias("k"),
                   S.subscription_plan("event_type", fx.PLAN_PREFIX).alias("v")).agg(F.count("*").alias("n"))
    return a.unionByName(b).unionByName(c)


@register("scalar_dates", ids="F31 F34 F35", sql=cte("usage_apps") + """
SELECT c_custkey, coalesce(substr(CAST(created_on AS VARCHAR), 1, 10), '') AS billing_start,
  coalesce(nullif(coalesce(substr(CAST(last_upgraded_on AS VARCHAR), 1, 10), ''), ''),
           substr(CAST(created_on AS VARCHAR), 1, 10)) AS last_modified,
  strftime(created_on, '%Y-%m-%dT%H:%M:%S') AS created_iso FROM usage_apps""")
def scalar_dates(spark, sf):
    apps = fx.usage_apps(spark, sf)
    return apps.select("c_custkey", S.date_part_text("created_on").alias("billing_start"),
                       S.first_non_empty(S.date_part_text("last_upgraded_on"),
                                         S.date_part_text("created_on")).alias("last_modified"),
                       S.iso_text("created_on").alias("created_iso"))


@register("strip_fence", ids="F21", sql="""
SELECT conv_id, turn, coalesce(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), '') AS query FROM conversations""")
def strip_fence(spark, sf):
    """Model output wrapped in a code fence with a language tag → the bare query text."""
    c = fx.table(spark, sf, "conversations")
    wrapped = F.concat(F.lit("  ```cypher\n"), F.col("text"), F.lit("\n```\n "))
    return c.select("conv_id", "turn", S.strip_code_fence(wrapped).alias("query"))


@register("default_blank", ids="F23", sql="""
SELECT conv_id, turn, coalesce(nullif(regexp_replace(CASE WHEN turn % 3 = 0 THEN ' ' || chr(10) ELSE role END,
                                                     '^\\s+|\\s+$', '', 'g'), ''), 'assistant') AS role
FROM conversations""")
def default_blank(spark, sf):
    """A blank value falls back to a default."""
    c = fx.table(spark, sf, "conversations")
    v = F.when(F.col("turn") % 3 == 0, F.lit(" \n")).otherwise(F.col("role"))
    return c.select("conv_id", "turn", S.blank_default(v, "assistant").alias("role"))


@register("name_check", ids="F13 F22 S12", sql="""
SELECT c_custkey, regexp_full_match(c_name, '[A-Za-z_][A-Za-z0-9_$]*') AS name_ok,
  regexp_full_match(c_mktsegment, '[A-Za-z_][A-Za-z0-9_$]*') AS segment_ok,
  regexp_full_match('DB.' || c_mktsegment || '.T',
                    '[A-Za-z_][A-Za-z0-9_$]*[.][A-Za-z_][A-Za-z0-9_$]*[.][A-Za-z_][A-Za-z0-9_$]*') AS table_ok,
  lower(c_name) || '.csv' AS base
FROM customer""")
def name_check(spark, sf):
    """Whole-string name checks (REGEXP_LIKE), the output-table name rule and a file basename."""
    c = fx.table(spark, sf, "customer")
    path = F.concat(F.lit("stage/consumer_data_x/"), F.lower("c_name"), F.lit(".csv"))
    ident = "[A-Za-z_][A-Za-z0-9_$]*"
    return c.select("c_custkey", S.full_match("c_name", ident).alias("name_ok"),
                    S.full_match("c_mktsegment", ident).alias("segment_ok"),
                    F.concat(F.lit("DB."), F.col("c_mktsegment"), F.lit(".T")).rlike(K.TABLE_NAME.pattern).alias("table_ok"),
                    S.basename_after(path, "consumer_data_x").alias("base"))
