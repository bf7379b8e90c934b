"""The 20 metric views: 13 for bankers and, cut from them, 7 for customers."""

from __future__ import annotations

from ledgerstone.operators.metrics import MetricJoin, MetricView

CUSTOMER, BANKER = "customer", "banker"


def _fields(names: str, **expressions: str) -> dict[str, str]:
    """Display names to columns: the snake-case of the name unless an expression is given."""
    listed = [n.strip() for n in names.split(",")]
    overrides = {k.replace("_", " "): v for k, v in expressions.items()}
    return {n: overrides.get(n.replace("-", " "), n.lower().replace(" ", "_")) for n in listed}


def _measures(**expressions: str) -> dict[str, str]:
    return {k.replace("_", " "): v for k, v in expressions.items()}


def _context(subject: str, kind: str) -> MetricJoin:
    return MetricJoin(
        "ctx", "fact_subject_context_snapshot", ((subject, "entity_id"),), f"entity_type = '{kind}'"
    )


_CONTEXT_SUMS = {
    name: f"SUM(ctx.{name.lower().replace(' ', '_')})"
    for name in (
        "Open Case Count",
        "SLA Breached Case Count",
        "Open Application Count",
        "Missing Document Count",
        "Active Arrangement Count",
    )
}
_POLICY = MetricJoin(
    "policy",
    "dim_stage_action_policy",
    (("current_stage", "stage"), ("pending_action_party", "pending_action_party")),
    "effective_from <= {today} AND (effective_to IS NULL OR effective_to >= {today})",
    {"pending_action_party": "UNASSIGNED"},
)

_BANKER = (
    MetricView(
        "mv_customer_overview",
        "dim_customer",
        _fields(
            "Customer ID, Age Band, State, Preferred Contact Channel, Preferred Language, Marketing Opt In,"
            " Satisfaction Score, Latest Application Status, Latest Application Stage,"
            " Latest Pending Action Party, Latest Assigned Team, Top Case Type 90 Days, Verification Status",
            Latest_Application_Status="ctx.latest_application_status",
            Latest_Application_Stage="ctx.latest_application_stage",
            Latest_Pending_Action_Party="ctx.latest_pending_action_party",
            Latest_Assigned_Team="ctx.latest_assigned_team",
            Top_Case_Type_90_Days="ctx.top_case_type_90d",
            Verification_Status="ctx.verification_status",
        ),
        _CONTEXT_SUMS
        | {"Recent Support Interactions 30d": "SUM(ctx.recent_support_interaction_count_30d)"},
        (_context("customer_id", "CUSTOMER"),),
    ),
    MetricView(
        "mv_application_status",
        "fact_application_current",
        _fields(
            "Application ID, Customer ID, Is Business Application, Loan Goal, Application Type,"
            " Application Month, Current Stage, Previous Stage, Latest Status, Final Outcome,"
            " Pending Action Party, Assigned Team, Status Last Changed At, Stage Entered At,"
            " Is Stage SLA Breached, Is Inactive Over 14 Days, Customer Action Required,"
            " Internal Action Required, Recorded Reason",
            Application_Month="DATE_TRUNC('MONTH', submitted_at)",
            Stage_Entered_At="current_stage_entered_at",
            Customer_Action_Required="customer_action_required_flag",
            Internal_Action_Required="internal_action_required_flag",
        ),
        _measures(
            Application_Count="COUNT(1)",
            Avg_Days_in_Stage="AVG(days_in_current_stage)",
            Missing_Document_Count="SUM(missing_document_count)",
            Expired_Document_Count="SUM(expired_document_count)",
            Total_Reminders_Sent="SUM(total_reminders_sent)",
            SLA_Breached_Count="COUNT_IF(is_stage_sla_breached)",
            Inactive_Application_Count="COUNT_IF(is_inactive_over_14_days)",
        ),
    ),
    MetricView(
        "mv_application_documents",
        "fact_application_document",
        _fields(
            "Application ID, Customer ID, Document Type, Document Status, Is Missing, Is Received, Is Rejected,"
            " Is Expired, Is Invalid or Expired, Rejection Reason, Requested At, Received At, Expiry Date"
        ),
        _measures(
            Total_Documents="COUNT(1)",
            Missing_Count="COUNT_IF(is_missing)",
            Received_Count="COUNT_IF(is_received)",
            Rejected_Count="COUNT_IF(is_rejected)",
            Expired_Count="COUNT_IF(is_expired)",
            Total_Reminders_Sent="SUM(reminders_sent)",
        ),
    ),
    MetricView(
        "mv_application_timeline",
        "fact_application_timeline_event",
        _fields(
            "Application ID, Customer ID, Event Day, Event Sequence, Event Family, Event Type, From Value,"
            " To Value, Stage, Status, Event Origin, Assigned Team, Pending Action Party, Recorded Reason",
            Event_Day="DATE_TRUNC('DAY', event_timestamp)",
        ),
        _measures(
            Event_Count="COUNT(1)",
            Avg_Days_Since_Event="AVG(datediff({today}, CAST(event_timestamp AS DATE)))",
        ),
    ),
    MetricView(
        "mv_service_cases",
        "fact_service_case_current",
        _fields(
            "Case ID, Customer ID, Organisation ID, Application ID, Case Type, Case Status, Priority,"
            " Assigned Team, Is Open, Is SLA Breached, Is Business Case, Application Related, Created Month,"
            " Resolved At",
            Application_Related="application_related_flag",
            Created_Month="DATE_TRUNC('MONTH', created_at)",
        ),
        _measures(
            Total_Cases="COUNT(1)",
            Open_Cases="COUNT_IF(is_open)",
            Resolved_Cases="COUNT_IF(resolved_at IS NOT NULL)",
            SLA_Breached_Cases="COUNT_IF(is_sla_breached)",
            Avg_Case_Age_Days="AVG(case_age_days)",
        ),
    ),
    MetricView(
        "mv_service_activity",
        "fact_service_activity",
        _fields(
            "Customer ID, Case ID, Application ID, Activity Month, Activity Type, Channel, Topic,"
            " Case Event Type, Is Customer Contact, Is Internal Activity, Follow Up Required, Escalated",
            Activity_Month="DATE_TRUNC('MONTH', activity_timestamp)",
            Follow_Up_Required="follow_up_required_flag",
            Escalated="escalated_flag",
        ),
        _measures(
            Total_Interactions="COUNT(1)",
            Customer_Contact_Count="COUNT_IF(is_customer_contact)",
            Total_Duration_Minutes="SUM(duration_minutes)",
        ),
    ),
    MetricView(
        "mv_application_next_action",
        "fact_application_current",
        _fields(
            "Application ID, Customer ID, Current Stage, Pending Action Party, Assigned Team, Is Terminal Stage,"
            " Next Action Code, Banker Action Text, Customer Safe Action Text, Default SLA Days,"
            " Customer Action Required",
            Is_Terminal_Stage="policy.is_terminal_stage",
            Next_Action_Code="policy.next_action_code",
            Banker_Action_Text="policy.banker_action_text",
            Customer_Safe_Action_Text="policy.customer_safe_action_text",
            Default_SLA_Days="policy.default_sla_days",
            Customer_Action_Required="customer_action_required_flag",
        ),
        _measures(Application_Count="COUNT(1)"),
        (_POLICY,),
    ),
    MetricView(
        "mv_organisation_overview",
        "dim_organisation",
        _fields(
            "Organisation ID, Business Name, Legal Name, Organisation Type, Industry Code,"
            " Industry Code Version, Establishment Year, Profile Last Updated, Latest Application Status,"
            " Latest Application Stage, Verification Status",
            Establishment_Year="DATE_TRUNC('YEAR', establishment_date)",
            Profile_Last_Updated="profile_last_updated_at",
            Latest_Application_Status="ctx.latest_application_status",
            Latest_Application_Stage="ctx.latest_application_stage",
            Verification_Status="ctx.verification_status",
        ),
        _CONTEXT_SUMS
        | {
            "Active Authorised Representatives": "SUM(ctx.active_authorised_representative_count)",
            "Active Directors": "SUM(ctx.active_director_count)",
        },
        (_context("organisation_id", "ORGANISATION"),),
    ),
    MetricView(
        "mv_arrangement_portfolio",
        "fact_arrangement_current",
        _fields(
            "Arrangement ID, Customer ID, Organisation ID, Arrangement Type, Arrangement Subtype,"
            " Arrangement Status, Is Active, Is Business Arrangement, Interest Type, Repayment Frequency,"
            " Currency, Start Year, Maturity Date",
            Start_Year="DATE_TRUNC('YEAR', start_date)",
        ),
        _measures(
            Total_Arrangements="COUNT(1)",
            Active_Arrangements="COUNT_IF(is_active)",
            Avg_Days_to_Maturity="AVG(days_to_maturity)",
        ),
    ),
    MetricView(
        "mv_party_relationships",
        "bridge_organisation_party_role",
        _fields(
            "Customer ID, Organisation ID, Party Role, Authority Level, Is Active, Start Date, End Date"
        ),
        _measures(
            Total_Roles="COUNT(1)",
            Active_Roles="COUNT_IF(is_active)",
            Inactive_Roles="COUNT_IF(NOT is_active)",
            Active_Director_Count="COUNT_IF(is_active AND party_role = 'DIRECTOR')",
            Active_Authorised_Rep_Count="COUNT_IF(is_active AND party_role = 'AUTHORISED_REPRESENTATIVE')",
        ),
    ),
    MetricView(
        "mv_organisation_relationships",
        "bridge_organisation_relationship",
        _fields(
            "Source Organisation ID, Source Organisation Name, Target Organisation ID,"
            " Target Organisation Name, Relationship Type, Is Active, Start Date",
            Source_Organisation_Name="source_org.business_name",
            Target_Organisation_Name="target_org.business_name",
        ),
        _measures(Total_Relationships="COUNT(1)", Active_Relationships="COUNT_IF(is_active)"),
        (
            MetricJoin("source_org", "dim_organisation", (("source_organisation_id", "organisation_id"),)),
            MetricJoin("target_org", "dim_organisation", (("target_organisation_id", "organisation_id"),)),
        ),
    ),
    MetricView(
        "mv_application_authority",
        "bridge_application_party_authority",
        _fields(
            "Application ID, Organisation ID, Customer ID, Party Role, Authority Level, Is Active,"
            " Derivation Method, Limitation Code"
        ),
        _measures(Total_Authority_Records="COUNT(1)", Active_Authority_Count="COUNT_IF(is_active)"),
    ),
    MetricView(
        "mv_verification_status",
        "fact_verification_current",
        _fields(
            "Customer ID, Organisation ID, Record Type, Verification Status, Verification Method,"
            " Verification Month, Last Review Date, Next Review Date, Review Overdue, Document Types,"
            " Document Type Count, ABN Verified, ASIC Check Status, Beneficial Ownership Verified",
            Verification_Month="DATE_TRUNC('MONTH', verification_date)",
            Document_Type_Count="size(split(document_types, ','))",
            Review_Overdue="review_overdue_flag",
        ),
        _measures(
            Total_Records="COUNT(1)",
            Verified_Count="COUNT_IF(verification_status = 'VERIFIED')",
            Pending_Count="COUNT_IF(verification_status = 'PENDING')",
            Failed_Count="COUNT_IF(verification_status = 'FAILED')",
            Overdue_Review_Count="COUNT_IF(review_overdue_flag)",
            Verified_Record_Count="COUNT_IF(verification_status IS NOT NULL)",
        ),
    ),
)

_BY_NAME = {v.name: v for v in _BANKER}


def _self(name: str, base: str, dimensions: str, measures: str) -> MetricView:
    """A customer's own cut of a banker view; every field it may show is listed."""
    return _BY_NAME[base].limited_to(
        name,
        CUSTOMER,
        "customer_id",
        [d.strip() for d in dimensions.split(",")],
        [m.strip() for m in measures.split(",") if m.strip()],
    )


_PROFILE = MetricView(
    "mv_self_profile",
    "dim_customer",
    _fields("Customer ID, Preferred Contact Channel, Preferred Language, Marketing Opt In"),
    _measures(Record_Count="COUNT(1)"),
    audience=CUSTOMER,
    owner="customer_id",
)

_CUSTOMER = (
    _PROFILE,
    _self(
        "mv_self_application_status",
        "mv_application_status",
        "Application ID, Customer ID, Loan Goal, Application Type, Application Month, Current Stage,"
        " Previous Stage, Latest Status, Final Outcome, Status Last Changed At, Stage Entered At,"
        " Customer Action Required, Is Inactive Over 14 Days",
        "Application Count, Avg Days in Stage, Missing Document Count, Total Reminders Sent",
    ),
    _self(
        "mv_self_application_documents",
        "mv_application_documents",
        "Application ID, Customer ID, Document Type, Document Status, Is Missing, Is Received, Is Rejected,"
        " Is Expired, Is Invalid or Expired, Requested At, Received At, Expiry Date",
        "Total Documents, Missing Count, Received Count, Expired Count, Total Reminders Sent",
    ),
    _self(
        "mv_self_application_timeline",
        "mv_application_timeline",
        "Application ID, Customer ID, Event Day, Event Sequence, Event Family, Event Type, From Value,"
        " To Value, Stage, Status",
        "Event Count, Avg Days Since Event",
    ),
    _self(
        "mv_self_service_cases",
        "mv_service_cases",
        "Case ID, Customer ID, Case Type, Case Status, Priority, Is Open, Application Related,"
        " Created Month, Resolved At",
        "Total Cases, Open Cases, Resolved Cases, Avg Case Age Days",
    ),
    _self(
        "mv_self_service_activity",
        "mv_service_activity",
        "Customer ID, Activity Month, Activity Type, Channel, Topic, Is Customer Contact",
        "Customer Contact Count, Total Duration Minutes",
    ),
    _self(
        "mv_self_application_next_action",
        "mv_application_next_action",
        "Application ID, Customer ID, Current Stage, Customer Action Required, Is Terminal Stage,"
        " Customer Safe Action Text",
        "Application Count",
    ),
)

METRIC_VIEWS: dict[str, MetricView] = {v.name: v for v in (*_BANKER, *_CUSTOMER)}
