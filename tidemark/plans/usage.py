"""Devices, members, forms and the adoption report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.calendar import within_days
from tidemark.functions.scalars import sum_if, yes_no
from tidemark.operators.joins import latest_join, role_join


def devices(registered: DataFrame, syncs: DataFrame, users: DataFrame, accounts: DataFrame,
            excluded: Sequence[str] = (), tie: str | None = None) -> DataFrame:
    """Devices with their latest sync, their user and the account that synced.

    registered(id, user_id, identifier, ...), syncs(identifier, organization_id, loaded_at),
    users(user_id, ...), accounts(id, app_customer_key, ...).  Devices that never synced are left
    out.  `tie` names a column of syncs that decides between syncs of the same moment.
    """
    order = [F.desc("loaded_at"), *([F.desc(tie)] if tie else [])]
    newest = syncs.select("identifier", "organization_id", "loaded_at", *([tie] if tie else []))
    synced = latest_join(registered, newest, "identifier", order).withColumnRenamed("loaded_at", "last_synced_at")
    holders = accounts.filter(F.col("app_customer_key").isNotNull())
    if excluded:
        holders = holders.filter(~F.col("id").isin(*excluded))
    holders = holders.drop("id").withColumnRenamed("app_customer_key", "organization_id")
    full = synced.join(users, "user_id", "left").join(holders, "organization_id", "left")
    return full.drop(tie) if tie else full


def members(users: DataFrame, memberships: DataFrame, orgs: DataFrame, roles: DataFrame,
            accounts: DataFrame) -> DataFrame:
    """One row per membership with user, organisation, role and account.

    users(user_id, ...), memberships(user_id, organization_id, role_id), orgs(id, resource_id),
    roles(id, name), accounts(app_customer_key, account_key).
    """
    places = orgs.select(F.col("id").alias("organization_id"), F.col("resource_id").alias("org_resource_id"))
    kinds = roles.select(F.col("id").alias("role_id"), F.col("name").alias("role_name"))
    holders = accounts.select(F.col("app_customer_key").alias("org_resource_id"), "account_key")
    joined = (memberships.select("user_id", "organization_id", "role_id").join(users, "user_id")
              .join(places, "organization_id").join(kinds, "role_id", "left").join(holders, "org_resource_id", "left"))
    others = [c for c in users.columns if c != "user_id"]
    return joined.select("user_id", "org_resource_id", F.col("organization_id").alias("org_id"), "account_key",
                         *others, "role_name")


def forms(form_table: DataFrame, orgs: DataFrame, users: DataFrame) -> DataFrame:
    """Forms with their organisation and the full names of creator and last editor.

    form_table(form_id, owner_id, created_by_id, updated_by_id, ...), orgs(id, name, resource_id),
    users(user_id, first_name, last_name).
    """
    places = orgs.select(F.col("id").alias("owner_id"), F.col("name").alias("owner_name"),
                         F.col("resource_id").alias("org_resource_id"))
    named = users.select("user_id", F.concat("first_name", F.lit(" "), "last_name").alias("by_name"))
    owned = form_table.join(places, "owner_id")
    roles = role_join(owned, named, {"created": "created_by_id", "updated": "updated_by_id"}, "user_id", ["by_name"])
    return roles.select("org_resource_id", "form_id", "owner_id", "owner_name",
                        *[c for c in form_table.columns if c not in ("form_id", "owner_id")],
                        F.col("created_by_name"), F.col("updated_by_name"))


# -- adoption -----------------------------------------------------------------------------------

@dataclass(frozen=True)
class Activity:
    """What a table of activities tells about its owners.

    key        column of the activity table that holds the owner
    owner_key  column of the owners table it refers to
    measures   aggregates per owner, by name
    where      rows that count
    """

    key: str
    owner_key: str
    measures: Mapping[str, Column]
    where: Column | None = None


def present() -> Column:
    """A measure that says that the owner has any rows at all."""
    return F.count(F.lit(1)) > 0


def recent_count(column: str, as_of, days: int = 30) -> Column:
    """How many rows are from the last `days` days."""
    return sum_if(within_days(column, days, as_of))


def positive(value: Column) -> Column:
    """yes/no for counters above zero; unknown counts as no."""
    return yes_no(value > 0)


def adoption(owners: DataFrame, activities: Sequence[tuple[DataFrame, Activity]],
             flags: Mapping[str, Column], accounts: DataFrame | None = None, account_key: str | None = None) -> DataFrame:
    """One row per owner with activity measures and yes/no flags, and the owner's account.

    Each activity table is reduced to one row per owner before it is joined.  Activities that refer
    to the same owner column are joined one after the other, so the owners are shuffled once per column.
    """
    full = owners
    for table, activity in sorted(activities, key=lambda pair: pair[1].owner_key):
        rows = table if activity.where is None else table.filter(activity.where)
        measured = rows.groupBy(F.col(activity.key).alias("_owner")).agg(
            *[value.alias(name) for name, value in activity.measures.items()])
        full = full.join(measured, full[activity.owner_key] == F.col("_owner"), "left").drop("_owner")
    flagged = full.withColumns(dict(flags))
    if accounts is None:
        return flagged
    return flagged.join(accounts, flagged[account_key] == accounts[account_key], "left").drop(accounts[account_key])


# -- the standard report ------------------------------------------------------------------------

def standard_activities(tables: Mapping[str, DataFrame], as_of, days: int = 30) -> list[tuple[DataFrame, Activity]]:
    """What the standard adoption report counts, for the tables that are given.

    Tables by name: form_stats(resource_id), projects(owner_id), groups(org_id), forms(owner_id,
    status_field), flows(user_org_id, user_flag_feature_service_layers_enabled),
    form_report(org_resource_id, record_changed_at), member_report(org_resource_id, last_sign_in_at),
    registrations(owner_id, device_id, user_id, updated_at), memberships(user_id),
    workflows(owner_id), geometry(organization_id, line, multi_line, polygon, multi_polygon),
    app_subscriptions(owner_id, shared_views_enabled).
    """
    def recent(column: str) -> Column:
        return within_days(column, days, as_of)

    plan = {
        "form_stats": Activity("resource_id", "resource_id", {"_has_stats": present()}),
        "groups": Activity("org_id", "resource_id", {"_groups": F.count(F.lit(1))}),
        "flows": Activity("user_org_id", "resource_id", {
            "_features": sum_if(F.col("user_flag_feature_service_layers_enabled"))}),
        "form_report": Activity("org_resource_id", "resource_id", {
            "forms_activity_last_30_days": recent_count("record_changed_at", as_of, days), "forms_count": F.count(F.lit(1))}),
        "member_report": Activity("org_resource_id", "resource_id", {
            "members_sign_in_last_30_days": F.count(F.lit(1))}, recent("last_sign_in_at")),
        "geometry": Activity("organization_id", "resource_id", {
            f"_{shape}": F.max(shape) for shape in ("line", "multi_line", "polygon", "multi_polygon")}),
        "projects": Activity("owner_id", "id", {"_has_projects": present()}),
        "forms": Activity("owner_id", "id", {"_has_empty_status": present()}, F.col("status_field") == "{}"),
        "registrations": Activity("owner_id", "id", {
            "devices_sync_last_30_days": F.count_distinct("device_id")}, recent("updated_at")),
        "workflows": Activity("owner_id", "id", {"_workflows": F.count(F.lit(1))}),
        "app_subscriptions": Activity("owner_id", "id", {"_shared_views": F.max("shared_views_enabled")}),
    }
    found = [(tables[name], activity) for name, activity in plan.items() if name in tables]
    if "registrations" in tables and "memberships" in tables:
        # Of a device's registrations and a user's memberships only the distinct pairs matter.
        pairs = tables["registrations"].filter(recent("updated_at")).select("owner_id", "user_id").distinct()
        members_of = pairs.join(tables["memberships"].select("user_id").distinct(), "user_id", "left_semi")
        found.append((members_of, Activity("owner_id", "id", {"members_sync_last_30_days": F.count_distinct("user_id")})))
    return found


def standard_flags(columns: Sequence[str]) -> dict[str, Column]:
    """yes/no columns of the standard report, for owners and measures that are among `columns`."""
    def some(*names: str) -> Column:
        return yes_no(F.coalesce(F.greatest(*[F.col(n) for n in names]) if len(names) > 1 else F.col(names[0]), F.lit(0)) > 0)

    shapes = ("_line", "_multi_line", "_polygon", "_multi_polygon")
    flags = {
        "api_tokens": (some, ("api_token_count",)), "data_events": (some, ("data_event_count",)),
        "repeatables": (some, ("repeatable_count",)), "reports": (some, ("report_count",)),
        "record_assignments": (some, ("record_link_field_count",)), "workflows": (some, ("_workflows",)),
        "lines": (some, ("_line",)), "lines_polygons": (some, shapes), "groups": (some, ("_groups",)),
        "feature_services": (some, ("_features",)),
        "data_views": (lambda c: yes_no(F.col(c)), ("_shared_views",)),
        "issues_tasks": (lambda c: yes_no(F.col(c).isNotNull()), ("_has_stats",)),
        "projects": (lambda c: yes_no(F.col(c).isNotNull()), ("_has_projects",)),
        "status_field": (lambda c: yes_no(F.col(c).isNotNull()), ("_has_empty_status",)),
    }
    return {name: make(*needs) for name, (make, needs) in flags.items() if set(needs) <= set(columns)}


def adoption_report(orgs: DataFrame, accounts: DataFrame, tables: Mapping[str, DataFrame], as_of,
                    days: int = 30) -> DataFrame:
    """The standard adoption report: activity measures, yes/no flags and the account of each organisation.

    orgs(id, resource_id, counters), accounts(app_customer_key, ...).
    """
    activities = standard_activities(tables, as_of, days)
    measured = [name for _, activity in activities for name in activity.measures]
    owned = accounts.withColumnRenamed("app_customer_key", "resource_id")
    full = adoption(orgs, activities, standard_flags([*orgs.columns, *measured]), owned, "resource_id")
    return full.drop(*[c for c in full.columns if c.startswith("_")])
