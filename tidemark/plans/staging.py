"""Staging views as data: what is renamed, converted and left out of each source.

A view keeps the columns that `COLUMNS` names for it, and fails if its source lacks one; the views of the widest
sources keep all columns of theirs.  Nothing that is not read is scanned, for the plans name what they need.  A site
adds its own columns, renames and exclusions, for example from a JSON file.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import DataFrame

from tidemark.operators.select import StageSpec, stage
from tidemark.sources.lifecycle import latest_snapshot

# The columns of staging views, in their order.
COLUMNS: dict[str, tuple[str, ...]] = {view: tuple(names.split()) for view, names in {
    "billing_prices": """
        id object active billing_scheme currency custom_unit_amount livemode lookup_key metadata_itemcode metadata_taxcode
        metadata_netsuite_service_sale_item_id metadata_netsuite_service_sale_item_link nickname product
        recurring_aggregate_usage recurring_interval recurring_interval_count recurring_trial_period_days
        recurring_usage_type tax_behavior tiers_mode transform_quantity type unit_amount unit_amount_decimal metadata
        recurring metadata_nickname created""",
    "billing_products": """
        id object active attributes created default_price description images livemode metadata name package_dimensions
        shippable statement_descriptor tax_code type unit_label updated url metadata_plan_slug metadata_product_type""",
    "app_customers_bridge": "id organization_id customer_id",
    "app_roles": """
        id resource_id name description is_system is_default can_manage_subscription can_update_organization
        can_manage_members can_manage_roles can_manage_apps can_manage_projects can_manage_choice_lists
        can_manage_classification_sets can_create_records can_update_records can_delete_records can_change_status
        can_change_project can_assign_records can_import_records can_export_records can_run_reports owner_id
        created_by_id updated_by_id created_at updated_at can_manage_layers can_manage_authorizations
        can_access_issues_and_tasks can_configure_issues_and_tasks can_access_all_projects is_hidden""",
    "app_projects": """
        id resource_id bounding_box name description status record_count created_by_id owner_id created_at updated_at
        customer external_job_id project_manager_id start_date end_date form_count record_changed_at""",
    "app_workflows": """
        id resource_id created_by_id updated_by_id created_at updated_at owner_id object_type object_resource_id active
        description name system_type""",
    "app_form_stats": "run_date resource_id name plan_id record_count owner_id system_type",
    "app_devices": """
        id resource_id owner_id identifier platform platform_version manufacturer model application_version
        application_build ip_address created_at updated_at""",
    "app_device_registrations": "id resource_id owner_id device_id user_id created_at updated_at",
}.items()}
# Fixed value: customers that were made for tests.
TEST_CUSTOMERS = ("cus_BKVLldGgX7vDXk",)

# Renamed and epoch columns, by staging view.
STAGING: dict[str, StageSpec] = {
    # billing
    "billing_subscriptions": StageSpec(epochs=(
        "items_data_0_created", "trial_end", "trial_start", "billing_cycle_anchor", "cancel_at", "created",
        "current_period_end", "current_period_start", "ended_at")),
    "billing_customers": StageSpec(where=f"id NOT IN ({', '.join(map(repr, TEST_CUSTOMERS))})"),
    "billing_prices": StageSpec(COLUMNS["billing_prices"], epochs=("created",)),
    "billing_products": StageSpec(COLUMNS["billing_products"]),
    # application
    "app_customers_bridge": StageSpec(COLUMNS["app_customers_bridge"]),
    "app_organizations": StageSpec(),
    "app_subscriptions": StageSpec(renames={"stripe_customer_token": "customer_token"}),
    "app_users": StageSpec(renames={"id": "user_id"}),
    "app_memberships": StageSpec(),
    "app_roles": StageSpec(COLUMNS["app_roles"]),
    "app_projects": StageSpec(COLUMNS["app_projects"]),
    "app_workflows": StageSpec(COLUMNS["app_workflows"]),
    "app_forms": StageSpec(renames={"id": "form_id"}),
    "app_form_stats": StageSpec(COLUMNS["app_form_stats"]),
    "app_form_updates": StageSpec(),
    "app_groups": StageSpec(),
    "app_flows_completed": StageSpec(),
    "app_devices": StageSpec(COLUMNS["app_devices"], renames={"owner_id": "user_id", "created_at": "device_created_at"}),
    "app_device_registrations": StageSpec(COLUMNS["app_device_registrations"]),
    "app_device_syncs": StageSpec(),
    # CRM
    "crm_accounts": StageSpec(renames={
        "Id": "id", "OwnerId": "owner_id", "Name": "name", "Top_Parent_Account_ID__c": "top_parent_id",
        "X18_Digit_Account_ID__c": "account_key", "Owner_s_Manager__c": "owners_manager", "AccountTier__c": "account_tier",
        "ZoomInfo_Industry__c": "industry", "Account_Type__c": "account_type", "Billing_Country__c": "billing_country",
        "CreatedDate": "created_date"}),
    "crm_account_history": StageSpec(renames={
        "AccountId": "account_id", "Field": "field", "OldValue": "old_value", "NewValue": "new_value",
        "CreatedDate": "created_date"}),
    "crm_leads": StageSpec(renames={
        "Id": "id", "OwnerId": "owner_id", "ConvertedOpportunityId": "converted_opportunity_id",
        "ConvertedDate": "converted_date", "GBQ_Reporting_Lead__c": "reporting", "CreatedDate": "created_date"}),
    "crm_opportunities": StageSpec(renames={
        "Id": "id", "AccountId": "account_id", "OwnerId": "owner_id", "RecordTypeId": "record_type_id",
        "Name": "name", "Subscription_End_Date__c": "subscription_end_date", "Opportunity_Term__c": "subscription_term",
        "IsCreatedByStripe__c": "created_by_billing", "Self_Serve__c": "self_serve", "CreatedDate": "created_date"}),
    "crm_users": StageSpec(renames={
        "Id": "id", "Name": "name", "FirstName": "first_name", "LastName": "last_name", "ManagerId": "manager_id"}),
}

# Raw daily copies that are staged as their newest day, whole.
LATEST_COPIES = ("raw_subscriptions", "raw_subscription_items")


def only(spec: StageSpec, columns) -> StageSpec:
    """The same view with these source columns alone."""
    return replace(spec, columns=tuple(columns))


def renaming(spec: StageSpec, **names: str) -> StageSpec:
    """The same view with more source columns renamed (source name = name in the view)."""
    return replace(spec, renames={**spec.renames, **names})


def excluding(spec: StageSpec, column: str, values) -> StageSpec:
    """The same view without the rows whose column has one of the values, such as customers made for tests."""
    listed = ", ".join("'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)
    rule = f"`{column}` NOT IN ({listed})"
    return replace(spec, where=f"({spec.where}) AND {rule}" if spec.where else rule)


def read_config(path: str) -> dict[str, StageSpec]:
    """Staging views from a JSON file: {view: {columns, renames, casts, epochs, where}}."""
    with open(path, encoding="utf-8") as file:
        entries = json.load(file)
    return {view: StageSpec(tuple(e["columns"]) if "columns" in e else None, e.get("renames", {}), e.get("casts", {}),
                            tuple(e.get("epochs", ())), e.get("where")) for view, e in entries.items()}


def stage_all(sources: Mapping[str, DataFrame], specs: Mapping[str, StageSpec] = STAGING) -> dict[str, DataFrame]:
    """Staging views of all given sources, by view name."""
    views = {}
    for view, source in sources.items():
        views[view] = latest_snapshot(source) if view in LATEST_COPIES else stage(source, specs[view])
    return views
