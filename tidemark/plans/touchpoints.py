"""Marketing touchpoints and campaigns: typed columns out of the newest raw copies."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.calendar import DEFAULT_ZONE, convert_timezone
from tidemark.functions.common import quoted
from tidemark.functions.documents import parsed, scalar_at
from tidemark.sources.lifecycle import RUN_DATE, latest_snapshot


def _listed(text: str) -> dict[str, tuple[str, str]]:
    """{name: (path, kind)} of entries `name`, `name:kind` or `name=path:kind`; the kind is text by default."""
    found = {}
    for entry in text.split():
        left, _, kind = entry.partition(":")
        name, _, path = left.partition("=")
        found[name] = (path or name, kind or "string")
    return found


# Output columns of an attribution touchpoint, in order.
TOUCHPOINT_FIELDS = _listed("""
bizible2__Attribution_Custom_Model_2__c:double
bizible2__Attribution_Custom_Model__c:double
bizible2__Attribution_First_Touch__c:double
bizible2__Attribution_Lead_Conversion_Touch__c:double
bizible2__Attribution_U_Shaped__c:double
bizible2__Attribution_W_Shaped__c:double
bizible2__Count_Custom_Model_2__c:double
bizible2__Count_Custom_Model__c:double
bizible2__Count_First_Touch__c:bigint
bizible2__Count_Lead_Creation_Touch__c:bigint
bizible2__Count_U_Shaped__c:double
bizible2__Count_W_Shaped__c:double
bizible2__Revenue_Custom_Model_2__c:double
bizible2__Revenue_Custom_Model__c:double
bizible2__Revenue_First_Touch__c:double
bizible2__Revenue_Lead_Conversion__c:double
bizible2__Revenue_U_Shaped__c:double
bizible2__Revenue_W_Shaped__c:double
Id
OwnerId
IsDeleted
Name_c=Name
Createddate=CreatedDate:moment
CreatedById
LastModifieddate=LastModifiedDate:moment
LastModifiedById
SystemModstamp:moment
bizible2__Account__c
bizible2__Ad_Campaign_Id__c
bizible2__Ad_Campaign_Name__c
bizible2__Ad_Content__c
bizible2__Ad_Destination_URL__c
bizible2__Ad_Group_Id__c
bizible2__Ad_Group_Name__c
bizible2__Ad_Id__c
bizible2__Browser__c
bizible2__Contact__c
bizible2__Form_URL_Raw__c
bizible2__Form_URL__c
bizible2__Geo_City__c
bizible2__Geo_Country__c
bizible2__Geo_Region__c
bizible2__Keyword_Id__c
bizible2__Keyword_MatchType__c
bizible2__Keyword_Text__c
bizible2__Landing_Page_Raw__c
bizible2__Landing_Page__c
bizible2__Marketing_Channel_Path__c
bizible2__Marketing_Channel__c
bizible2__Medium__c
bizible2__Opportunity__c
bizible2__Placement_Id__c
bizible2__Placement_Name__c
bizible2__Platform__c
bizible2__Referrer_Page_Raw__c
bizible2__Referrer_Page__c
bizible2__SF_Campaign__c
bizible2__Search_Phrase__c
bizible2__Segment__c
bizible2__Site_Id__c
bizible2__Site_Name__c
bizible2__Touchpoint_date__c=bizible2__Touchpoint_Date__c:moment
bizible2__Touchpoint_Position__c
bizible2__Touchpoint_Source__c
bizible2__Touchpoint_Type__c
bizible2__UniqueId__c
bizible2__Form_Name__c
bizible2__User_Touchpoint_Id__c
""")

# Output columns of a campaign, in order.
CAMPAIGN_FIELDS = _listed("""
Id
ActualCost
AmountAllOpportunities
AmountWonOpportunities
BudgetedCost
CampaignMemberRecordTypeId
CreatedById
CreatedDate
Description
EndDate
ExpectedResponse
ExpectedRevenue
HierarchyActualCost
HierarchyAmountAllOpportunities
HierarchyAmountWonOpportunities
HierarchyBudgetedCost
HierarchyExpectedRevenue
HierarchyNumberOfContacts
HierarchyNumberOfConvertedLeads
HierarchyNumberOfLeads
HierarchyNumberOfOpportunities
HierarchyNumberOfResponses
HierarchyNumberOfWonOpportunities
HierarchyNumberSent
IsActive
IsDeleted
LastActivityDate
LastModifiedById
LastModifiedDate
LastReferencedDate
LastViewedDate
LeanData__Back_Dated__c
LeanData__Rep_LT_Attribution__c
LeanData__Rep_LT_Bookings_Attribution__c
LeanData__Rep_LT_Generated_Attribution__c
LeanData__Rep_LT_Generated_Bookings_Attribution__c
LeanData__Rep_MT_Accelerated_Attribution__c
LeanData__Rep_MT_Accelerated_Bookings_Attr__c
LeanData__Rep_MT_Generated_Attribution__c
LeanData__Rep_MT_Generated_Bookings_Attribution__c
LeanData__Reporting_Average_Days_To_Close__c
LeanData__Reporting_Bookings_Attribution__c
LeanData__Reporting_Campaign_Member_Totals__c
LeanData__Reporting_Cost__c
LeanData__Reporting_FT_Attribution_Amount__c
LeanData__Reporting_FT_Bookings_Attribution__c
LeanData__Reporting_Lift__c
LeanData__Reporting_MT_Attribution_Amount__c
LeanData__Reporting_Num_Target_Campaign_Members__c
LeanData__Reporting_Number_Of_Campaign_Members__c
LeanData__Reporting_Number_Of_Opportunities__c
LeanData__Reporting_Number_Of_Touches__c
LeanData__Reporting_On_Target__c
LeanData__Reporting_Opportunity_Close_Rate__c
CampaignName=Name
NumberOfContacts
NumberOfConvertedLeads
NumberOfLeads
NumberOfOpportunities
NumberOfResponses
NumberOfWonOpportunities
NumberSent
OwnerId
ParentId
StartDate
CampaignStatus=Status
SystemModstamp
CampaignType=Type
bizible2__Bizible_Attribution_SyncType__c
bizible2__Touchpoint_End_Date__c
bizible2__Touchpoint_Start_Date__c
bizible2__UniqueId__c
""")


def touchpoints(raw: DataFrame, fields: Mapping[str, str | tuple[str, str]] = TOUCHPOINT_FIELDS,
                zone: str = DEFAULT_ZONE, column: str = "json_data", run_column: str = RUN_DATE) -> DataFrame:
    """Newest copy of raw documents as columns, in the order of `fields`.

    `fields` maps a name to a path or to (path, type).  The type `moment` stands for a UTC time: it
    gives `date_<name>`, the UTC day, and `<name>`, the wall-clock time in `zone`.  JSON keys are
    case-sensitive.
    """
    staged = latest_snapshot(raw, run_column).select(parsed(quoted(column)).alias("_document"),
                                                     F.substring(quoted(run_column), 1, 8).alias("run_date"))
    outputs = []
    for name, spec in fields.items():
        path, kind = (spec, "string") if isinstance(spec, str) else spec
        text = scalar_at(F.col("_document"), path)
        if kind == "moment":
            utc = text.try_cast("timestamp")
            outputs += [convert_timezone(utc, "UTC").cast("date").alias(f"date_{name}"), convert_timezone(utc, zone).alias(name)]
        else:
            outputs.append((text if kind == "string" else text.try_cast(kind)).alias(name))
    return staged.select(*outputs, "run_date")


def campaigns(raw: DataFrame, fields: Mapping[str, str | tuple[str, str]] = CAMPAIGN_FIELDS, column: str = "json_data",
              run_column: str = RUN_DATE) -> DataFrame:
    """Newest copy of raw documents with the named fields as text."""
    return touchpoints(raw, fields, column=column, run_column=run_column)
