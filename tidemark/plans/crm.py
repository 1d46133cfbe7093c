"""Accounts, leads and opportunities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.calendar import DEFAULT_ZONE, local_date
from tidemark.operators.select import top_parent_flag


# Columns the reports show as they are.
ACCOUNT_COLUMNS = (
    "account_key", "Top_Parent_Account_Name__c", "owners_manager", "ZoomInfo_Company_Revenue__c",
    "Zoominfo_Employee_Count_Number__c", "industry", "Market__c", "Monthly_Revenue__c")
LEAD_COLUMNS = (
    "ConvertedAccountId", "ConvertedContactId", "converted_opportunity_id", "IsConverted", "converted_date", "FirstName",
    "LastName", "Email", "Company", "Status", "MQL_Reason__c", "Account_Tier__c", "Buyer_Persona__c", "Industry", "LeadSource",
    "FT_Lead_Source__c", "FT_Lead_Source_Channel__c", "FT_Lead_Source_Detail__c", "LT_Lead_Source__c",
    "LT_Lead_Source_Channel__c", "LT_Lead_Source_Detail__c", "reporting", "SDR_Assisted__c", "Lead_Source_Category__c")
OPPORTUNITY_COLUMNS = (
    "Invoice_Id__c", "Partner_Name__c", "Partner_Type__c", "type", "Sales_Cycle_Days__c", "LeadSource",
    "FT_Lead_Source_Channel__c", "FT_Lead_Source_Detail__c", "Persona__c", "SDR_Assisted__c", "Lead_Source_Category__c",
    "CloseDate", "StageName", "MRR__c", "Overall_Sales_Duration__c", "Opportunity_Category__c")
OPPORTUNITY_ACCOUNT_COLUMNS = (
    "Top_Parent_Account_Name__c", "ZoomInfo_Company_Revenue__c", "Zoominfo_Employee_Count_Number__c", "industry", "Market__c")


def accounts(acc: DataFrame, users: DataFrame, zone: str = DEFAULT_ZONE, columns: Sequence[str] = ACCOUNT_COLUMNS) -> DataFrame:
    """Accounts with the name of their owner, a top-parent flag and the local day of creation.

    acc(id, owner_id, name, top_parent_id, created_date UTC, further `columns`), users(id, name).
    """
    owners = users.select(F.col("id").alias("owner_id"), F.col("name").alias("account_owner"))
    return acc.join(owners, "owner_id").select(
        F.col("id").alias("account_id"), "top_parent_id", F.col("name").alias("account_name"), "account_owner",
        *columns, top_parent_flag("id", "top_parent_id").alias("is_top_parent"),
        local_date("created_date", zone).alias("created_date"))


def leads(lead: DataFrame, users: DataFrame, zone: str = DEFAULT_ZONE, columns: Sequence[str] = LEAD_COLUMNS) -> DataFrame:
    """Leads flagged for reporting, with their owner and the local day of creation.

    lead(id, owner_id, reporting boolean, created_date UTC, further `columns`).
    """
    owners = users.select(F.col("id").alias("owner_id"), F.col("name").alias("owner_name"))
    return lead.filter(F.col("reporting")).join(owners, "owner_id").select(
        F.col("id").alias("lead_id"), "owner_name", *columns,
        local_date("created_date", zone).alias("created_date"))


def first_touch(lead: DataFrame) -> DataFrame:
    """The lead of the earliest conversion of each opportunity; the largest id on that day.

    One aggregation: the smallest (date, largest id first) is found without joining back.
    """
    converted = lead.filter(F.col("converted_opportunity_id").isNotNull() & F.col("converted_date").isNotNull())
    per_day = converted.groupBy("converted_opportunity_id", "converted_date").agg(F.max("id").alias("lead_id"))
    return per_day.groupBy(F.col("converted_opportunity_id").alias("opportunity_id")).agg(
        F.min_by("lead_id", "converted_date").alias("lead_id"))


def opportunities(opps: DataFrame, lead: DataFrame, acc: DataFrame, users: DataFrame, record_types: DataFrame,
                  zone: str = DEFAULT_ZONE, columns: Sequence[str] = OPPORTUNITY_COLUMNS,
                  account_columns: Sequence[str] = OPPORTUNITY_ACCOUNT_COLUMNS) -> DataFrame:
    """Opportunities with account, owner, the owner's manager, record type and first-touch lead.

    opps(id, account_id, record_type_id, owner_id, name, created_date, further `columns`), acc(id,
    name, top_parent_id, `account_columns`), users(id, name, manager_id), record_types(id, name).
    """
    holders = acc.select(F.col("id").alias("account_id"), F.col("name").alias("account_name"), "top_parent_id",
                         *account_columns)
    kinds = record_types.select(F.col("id").alias("record_type_id"), F.col("name").alias("record_type_name"))
    owners = users.select(F.col("id").alias("owner_id"), F.col("name").alias("opportunity_owner"), "manager_id")
    managers = users.select(F.col("id").alias("manager_id"), F.col("name").alias("opportunity_owner_manager"))
    touches = first_touch(lead).select(F.col("opportunity_id").alias("id"),
                                       F.col("lead_id").alias("lead_id_from_converted_lead"))
    full = (opps.join(holders, "account_id").join(kinds, "record_type_id").join(touches, "id", "left")
            .join(owners, "owner_id", "left").join(managers, "manager_id", "left"))
    return full.select(
        F.col("id").alias("opportunity_id"), "account_id", "account_name", "top_parent_id",
        F.col("name").alias("opportunity_name"), *columns, *account_columns, "opportunity_owner_manager", "opportunity_owner",
        "record_type_name", "lead_id_from_converted_lead",
        top_parent_flag("account_id", "top_parent_id").alias("is_top_parent"),
        local_date("created_date", zone).alias("opportunity_created_date"))
