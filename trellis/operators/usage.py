"""Usage metrics: one subscription record per consumer account, roll-ups and
CRM-shaped keyed upserts (J1-J9, A8-A14).

Everything is one declarative plan: the per-account winner and the back-fill
are partial aggregates (``max_by`` / ``min_by``), so an account holding a third
of all events is reduced map-side before it is shuffled; the install ↔ event
join is an equi join on the locator (AQE picks broadcast when the winner
table is small at run time).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trellis.functions import scalar as S
from trellis.operators.merge import upsert, upsert_table

EVENT_TYPES = ("GET", "TRIAL", "PURCHASE")

# Fixed values of the subscription record (they must equal the reference's).
CLOUD_PROVIDER = "snowflake"
NODE_INSTANCE_TYPE = "none"
SUBSCRIPTION_ID = ""

SUBSCRIPTION_FIELDS = [
    "cloud_region", "cloud_vendor", "cloud_version", "cloud_provider", "engine_version",
    "hs_recurring_billing_start_date", "hs_status", "db_name", "cloud_db_name", "hs_name",
    "node_instance_type", "subscription_id_omnistrate", "deployment_type", "hs_last_modified_at",
    "subscription_plan", "email",
]


def listing_events(events: DataFrame, listing_filter: str) -> DataFrame:
    """S20 scan of the events view: listing-name LIKE, event type IN, names from the metadata."""
    ev = events.where(F.col("listing_name").like(listing_filter) & F.col("event_type").isin(*EVENT_TYPES))
    return ev.select("event_id", "consumer_account_locator", "consumer_account_name", "event_type",
                     "consumer_email",
                     S.json_field("consumer_metadata", "$.first_name").alias("first_name"),
                     S.json_field("consumer_metadata", "$.last_name").alias("last_name"))


def event_winners(events: DataFrame) -> DataFrame:
    """Per non-empty locator the event of highest priority PURCHASE > TRIAL > GET;
    a tie keeps the first seen (smallest ``event_id``)."""
    ev = events.where(F.coalesce(F.col("consumer_account_locator"), F.lit("")) != "")
    rank = F.struct(S.priority("event_type").alias("p"), (-F.col("event_id")).alias("o"))
    w = ev.groupBy("consumer_account_locator").agg(
        F.max_by(F.struct("event_type", "event_id"), rank).alias("w"))
    return w.select("consumer_account_locator", "w.event_type", "w.event_id")


def backfilled_winners(events: DataFrame) -> DataFrame:
    """The winner's e-mail and names; an empty one is filled from the first row (by
    ``event_id``) of the same account that has it.  Order-free, unlike the original loop."""
    ev = events.where(F.coalesce(F.col("consumer_account_locator"), F.lit("")) != "")
    rank = F.struct(S.priority("event_type").alias("p"), (-F.col("event_id")).alias("o"))
    fields = ["consumer_email", "first_name", "last_name"]

    def first_present(c):
        present = F.coalesce(F.col(c), F.lit("")) != ""
        return F.min_by(F.col(c), F.when(present, F.col("event_id")))

    agg = ev.groupBy("consumer_account_locator").agg(
        F.max_by(F.struct("event_type", "event_id", *fields), rank).alias("w"),
        *[first_present(c).alias(f"first_{c}") for c in fields])
    return agg.select("consumer_account_locator", "w.event_type", "w.event_id",
                      *[F.coalesce(F.nullif(F.col(f"w.{c}"), F.lit("")), F.col(f"first_{c}"), F.lit("")).alias(c)
                        for c in fields])


def subscriptions(apps: DataFrame, events: DataFrame, engine_version: str | Column, plan_prefix: str) -> DataFrame:
    """Installs (non-empty locator) left join the account's winning event → 18 string fields."""
    inst = apps.where(F.coalesce(F.col("consumer_account_locator"), F.lit("")) != "")
    win = backfilled_winners(events)
    j = inst.join(win, "consumer_account_locator", "left")
    region = F.col("consumer_snowflake_region")
    et = F.coalesce(F.col("event_type"), F.lit(""))
    return j.select(
        S.region_name(region).alias("cloud_region"),
        S.region_vendor(region).alias("cloud_vendor"),
        S.version_text("current_version", "current_patch").alias("cloud_version"),
        F.lit(CLOUD_PROVIDER).alias("cloud_provider"),
        F.lit(engine_version).alias("engine_version"),
        S.date_part_text("created_on").alias("hs_recurring_billing_start_date"),
        S.status("upgrade_state").alias("hs_status"),
        F.coalesce(F.col("consumer_account_name"), F.lit("")).alias("db_name"),
        F.coalesce(F.col("consumer_account_name"), F.lit("")).alias("cloud_db_name"),
        S.instance_name("consumer_account_locator").alias("hs_name"),
        F.lit(NODE_INSTANCE_TYPE).alias("node_instance_type"),
        F.lit(SUBSCRIPTION_ID).alias("subscription_id_omnistrate"),
        S.deployment_type(et).alias("deployment_type"),
        S.first_non_empty(S.date_part_text("last_upgraded_on"), S.date_part_text("created_on")).alias("hs_last_modified_at"),
        S.subscription_plan(et, plan_prefix).alias("subscription_plan"),
        F.coalesce(F.col("consumer_email"), F.lit("")).alias("email"),
        F.coalesce(F.col("first_name"), F.lit("")).alias("first_name"),
        F.coalesce(F.col("last_name"), F.lit("")).alias("last_name"))


# ---------------------------------------------------------------- CRM-shaped upserts
def managed_fields(subs: DataFrame) -> DataFrame:
    """The managed fields as strings; records without ``hs_name`` are skipped."""
    keep = subs.where(F.coalesce(F.col("hs_name"), F.lit("")) != "")
    return keep.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in SUBSCRIPTION_FIELDS])


def upsert_subscriptions(existing: DataFrame, subs: DataFrame) -> DataFrame:
    """Create or update the subscription keyed by ``hs_name``."""
    return upsert_table(existing, managed_fields(subs), ["hs_name"])


def contacts_from(subs: DataFrame) -> DataFrame:
    """Contact rows: trimmed e-mail as key, names only where present."""
    email = S.strip_ws(F.col("email"))
    return subs.where(F.coalesce(email, F.lit("")) != "").select(
        email.alias("email"), F.nullif(F.col("first_name"), F.lit("")).alias("firstname"),
        F.nullif(F.col("last_name"), F.lit("")).alias("lastname"), F.col("hs_name"))


def upsert_contacts(existing: DataFrame, subs: DataFrame) -> DataFrame:
    """Contact upsert by trimmed e-mail; a name overwrites only when the record has one."""
    new = contacts_from(subs)
    names = {c: F.col(c) for c in ("firstname", "lastname")}
    keep_old = {c: (F.col(c), lambda n, o: F.coalesce(n, o)) for c in names}
    table, _ = upsert(existing, new, ["email"], names, keep_old, order_by=[F.col("hs_name")])
    return table


def link_contacts(existing: DataFrame | None, subs: DataFrame, association_type: int) -> DataFrame:
    """(subscription, contact, type) links; putting a link twice keeps one."""
    new = contacts_from(subs).select("hs_name", "email", F.lit(association_type).alias("association_type"))
    both = new if existing is None else existing.unionByName(new)
    return both.dropDuplicates(["hs_name", "email", "association_type"])


def distinct_in_window(active: DataFrame, who: str, day: str, n: int) -> DataFrame:
    """Per day D, the number of distinct ``who`` active on some day in ``[D-n+1, D]``.

    Each active (who, day) covers the days ``[day, day+n-1]``; a person's covered
    days are merged into disjoint intervals (a window over that person's active
    days: bounded by the calendar, not by the data), then a +1/-1 sweep over the
    interval ends counts the people covering each day.  Exact, and no row is
    copied n times."""
    a = active.select(F.col(who).alias("w"), F.col(day).alias("d")).distinct()
    per = Window.partitionBy("w").orderBy("d")
    # a new interval starts when the previous active day is n or more days back
    gap = F.coalesce(F.datediff("d", F.lag("d").over(per)), F.lit(n)) >= n
    runs = a.withColumn("start", gap.cast("int")).withColumn(
        "run", F.sum("start").over(per.rowsBetween(Window.unboundedPreceding, 0)))
    iv = runs.groupBy("w", "run").agg(F.min("d").alias("lo"), F.date_add(F.max("d"), n - 1).alias("hi"))
    days = active.select(F.col(day).alias("d")).distinct()
    marks = (iv.select(F.col("lo").alias("d"), F.lit(1).alias("x"))
             .unionAll(iv.select(F.date_add("hi", 1).alias("d"), F.lit(-1).alias("x")))
             .unionAll(days.select("d", F.lit(0).alias("x"))))  # every asked day gets a total
    # one row per calendar day from here on: the running sum is over days, not people
    per_day = marks.groupBy("d").agg(F.sum("x").alias("x"))
    running = per_day.withColumn("n_distinct", F.sum("x").over(Window.orderBy("d").rowsBetween(
        Window.unboundedPreceding, 0)))
    return days.join(running.select("d", "n_distinct"), "d", "left").select(
        "d", F.coalesce("n_distinct", F.lit(0)).cast("bigint").alias("n_distinct"))
