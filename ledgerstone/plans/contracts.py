"""The rule sets of the 19 governed entities and the required fields of the 32 sources.

Fixed values: rule ids, severities, accepted lists and patterns decide which
rows are kept, so they are stated here in full. Rules that only repeat a shape
(not null, not blank, a format) are built from their column by a helper.
"""

from __future__ import annotations

from ledgerstone.operators.quality import ERROR, WARNING, Contract, Rule

UUID = "[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
FORMATS = {
    "UUID_FORMAT": f"^{UUID}$",
    "APPLICATION": "^(Application_[0-9]{9}|SIM-[0-9]{14}-[0-9a-f]{8})$",
    "ORGANISATION": "^ORG-[0-9]{5}$",
    "EVENT": f"^({UUID}|[0-9a-f]{{64}})$",
}


def _rule(rule_id: str, expression: str, dimension: str = "conformity", severity: str = ERROR) -> Rule:
    return Rule(rule_id, severity, dimension, expression)


def _warn(rule_id: str, expression: str, dimension: str = "conformity") -> Rule:
    return _rule(rule_id, expression, dimension, WARNING)


def _present(*columns: str, severity: str = ERROR, **renamed: str) -> list[Rule]:
    pairs = [(f"{c.upper()}_NULL", c) for c in columns] + [(k, c) for k, c in renamed.items()]
    return [_rule(name, f"{c} IS NOT NULL", "completeness", severity) for name, c in pairs]


def _matches(rule_id: str, column: str, form: str) -> Rule:
    return _rule(rule_id, f"{column} IS NULL OR {column} RLIKE '{FORMATS[form]}'")


def _uuids(*columns: str) -> list[Rule]:
    return [_matches(f"{c.upper()}_UUID_FORMAT", c, "UUID_FORMAT") for c in columns]


def _application() -> Rule:
    return _matches("APPLICATION_ID_FORMAT", "application_id", "APPLICATION")


def _organisation(column: str = "organisation_id") -> Rule:
    return _matches(f"{column.upper()}_FORMAT", column, "ORGANISATION")


def _filled(*columns: str) -> list[Rule]:
    return [
        _rule(f"{c.upper()}_NOT_BLANK", f"{c} IS NULL OR length(trim({c})) > 0", "completeness")
        for c in columns
    ]


def _one_of(rule_id: str, column: str, values: str) -> Rule:
    return _rule(rule_id, f"{column} IN ({_listed(values)})")


def _listed(values: str) -> str:
    return ", ".join(f"'{v}'" for v in values.split())


def _fresh(rule_id: str, column: str, days: int) -> Rule:
    return _warn(rule_id, f"{column} >= date_sub({{today}}, {days})", "timeliness")


SILVER_CONTRACTS: dict[str, Contract] = {
    name: Contract(name, (key,), tuple(rules))
    for name, key, rules in [
        (
            "app_accepted_loan",
            "loan_id",
            [*_present("loan_id", "global_id", "loan_status"), *_uuids("loan_id", "global_id")],
        ),
        (
            "app_application",
            "application_id",
            [
                *_present("application_id", "global_id", "application_type", "loan_goal", "submitted_at"),
                _rule(
                    "FINAL_OUTCOME_INVALID",
                    "final_outcome IS NULL OR final_outcome IN ("
                    + _listed("ACCEPTED DENIED CANCELLED INCOMPLETE PENDING")
                    + ")",
                ),
                _rule("DATE_ORDER_INVALID", "last_updated_at >= submitted_at"),
                _application(),
                *_uuids("global_id"),
                _organisation(),
                *_filled("loan_goal"),
                _fresh("APPLICATION_STALE", "last_updated_at", 30),
            ],
        ),
        (
            "app_lifecycle_event",
            "event_id",
            [
                *_present("event_id", "application_id", "global_id", "lifecycle_transition", "event_timestamp"),
                _matches("EVENT_ID_FORMAT", "event_id", "EVENT"),
                _application(),
                *_uuids("global_id"),
                _warn(
                    "EVENT_ORIGIN_INVALID",
                    f"event_origin IS NULL OR event_origin IN ({_listed('SYSTEM CUSTOMER BANKER')})",
                ),
            ],
        ),
        (
            "app_missing_document",
            "document_id",
            [
                *_present("document_id", "application_id", "global_id", "document_type"),
                _one_of("DOCUMENT_STATUS_INVALID", "status", "VERIFIED RECEIVED REQUIRED INVALID EXPIRED"),
                *_uuids("document_id"),
                _application(),
                *_uuids("global_id"),
                _warn(
                    "RECEIVED_DATE_ORDER",
                    "received_at IS NULL OR requested_at IS NULL OR received_at >= requested_at",
                ),
                _warn("DOCUMENT_EXPIRED", "expiry_date IS NULL OR expiry_date >= {today}", "timeliness"),
            ],
        ),
        (
            "app_rejected_application",
            "loan_id",
            [*_present("loan_id", "global_id"), *_uuids("loan_id", "global_id")],
        ),
        (
            "app_stage_history",
            "history_id",
            [
                *_present("history_id", "application_id", "global_id", "stage", "entered_at"),
                _rule("STAGE_DATE_ORDER", "exited_at IS NULL OR exited_at >= entered_at"),
                *_uuids("history_id"),
                _application(),
                *_uuids("global_id"),
                *_filled("stage"),
                _warn("SLA_OVERDUE", "sla_deadline IS NULL OR is_sla_breached = false", "timeliness"),
                _warn(
                    "PENDING_ACTION_PARTY_INVALID",
                    "pending_action_party IS NULL OR pending_action_party IN ("
                    + _listed(
                        "CUSTOMER ORGANISATION AUTHORISED_REPRESENTATIVE DIRECTOR GUARANTOR"
                        " THIRD_PARTY INTERNAL_TEAM"
                    )
                    + ")",
                ),
            ],
        ),
        (
            "app_status_change",
            "change_id",
            [
                *_present(
                    "change_id", "application_id", "global_id", "old_status", "new_status", "changed_at"
                ),
                _rule("STATUS_SAME", "old_status != new_status"),
                *_uuids("change_id"),
                _application(),
                *_uuids("global_id"),
                *_filled("old_status", "new_status"),
            ],
        ),
        (
            "arr_banking_arrangement",
            "account_id",
            [
                *_present("account_id", "global_id", "account_type"),
                *_uuids("account_id", "global_id"),
                _organisation(),
                _warn(
                    "BALANCE_NEGATIVE",
                    "current_balance_masked IS NULL OR current_balance_masked != 'NEGATIVE'",
                ),
            ],
        ),
        (
            "arr_credit_card",
            "credit_card_id",
            [
                *_present("credit_card_id", "global_id", "card_type", "status", "card_number_masked"),
                *_uuids("credit_card_id", "global_id"),
                _organisation(),
            ],
        ),
        (
            "arr_loan",
            "loan_id",
            [
                *_present("loan_id", "global_id", "loan_type", "status"),
                _rule(
                    "MATURITY_DATE_ORDER",
                    "maturity_date IS NULL OR start_date IS NULL OR maturity_date >= start_date",
                ),
                *_uuids("loan_id", "global_id", "account_id"),
                _warn("TERM_MONTHS_RANGE", "term_months IS NULL OR (term_months > 0 AND term_months <= 600)"),
            ],
        ),
        (
            "arr_mortgage",
            "mortgage_id",
            [
                *_present("mortgage_id", "global_id"),
                *_uuids("mortgage_id", "global_id", "account_id"),
                _warn(
                    "LVR_RANGE",
                    "lvr_percent IS NULL OR (try_cast(lvr_percent AS DOUBLE) >= 0"
                    " AND try_cast(lvr_percent AS DOUBLE) <= 100)",
                ),
            ],
        ),
        (
            "evt_case_event",
            "event_id",
            [
                *_present("event_id", "case_id", "global_id"),
                _one_of(
                    "EVENT_TYPE_INVALID",
                    "event_type",
                    "NOTE_ADDED STATUS_CHANGED ASSIGNED ESCALATED DOCUMENT_ATTACHED CUSTOMER_CONTACTED",
                ),
                *_present("event_timestamp"),
                *_uuids("event_id", "case_id", "global_id"),
            ],
        ),
        (
            "evt_service_case",
            "case_id",
            [
                *_present("case_id", "global_id", "case_type", "status", "created_at"),
                _rule("RESOLVED_DATE_ORDER", "resolved_at IS NULL OR resolved_at >= created_at"),
                *_uuids("case_id", "global_id"),
                _organisation(),
                *_filled("subject"),
                _warn("SLA_BREACHED", "is_sla_breached IS NULL OR is_sla_breached = false", "timeliness"),
                _fresh("CASE_STALE", "created_at", 90),
            ],
        ),
        (
            "evt_support_interaction",
            "interaction_id",
            [
                *_present("interaction_id", "global_id", "channel", "interaction_timestamp"),
                *_uuids("interaction_id", "global_id"),
                *_filled("channel"),
                _warn(
                    "DURATION_RANGE",
                    "duration_minutes IS NULL OR (duration_minutes >= 0 AND duration_minutes <= 480)",
                ),
            ],
        ),
        (
            "ip_individual",
            "global_id",
            [
                *_present("global_id", "customer_id", "full_name"),
                _one_of("CUSTOMER_TYPE_INVALID", "customer_type", "INDIVIDUAL BUSINESS SOLE_TRADER"),
                _rule("AGE_MINIMUM", "age IS NULL OR age >= 18"),
                *_uuids("global_id"),
                *_filled("full_name"),
                _fresh("CUSTOMER_SNAPSHOT_STALE", "last_updated_at", 30),
                _warn(
                    "EMAIL_FORMAT_REVIEW",
                    "email_masked IS NULL OR email_masked RLIKE '^[^@]+@[^@]+[.][^@]+$'",
                ),
                _warn("PHONE_FORMAT_REVIEW", "phone_masked IS NULL OR length(phone_masked) >= 8"),
                *_present("email_masked", "phone_masked", severity=WARNING),
            ],
        ),
        (
            "ip_kyc",
            "kyc_id",
            [
                *_present("kyc_id", "global_id"),
                _one_of("VERIFICATION_STATUS_INVALID", "verification_status", "VERIFIED PENDING FAILED EXPIRED"),
                _one_of("RISK_RATING_INVALID", "risk_rating", "LOW MEDIUM HIGH VERY_HIGH"),
                _one_of("SANCTIONS_CHECK_INVALID", "sanctions_check", "CLEAR MATCH PENDING"),
                _one_of("RECORD_TYPE_INVALID", "record_type", "KYC KYB"),
                *_uuids("kyc_id", "global_id"),
                _organisation(),
                _warn(
                    "KYC_REVIEW_OVERDUE",
                    "next_review_date IS NULL OR next_review_date >= {today}",
                    "timeliness",
                ),
                _warn(
                    "REVIEW_DATE_ORDER",
                    "next_review_date IS NULL OR last_review_date IS NULL"
                    " OR next_review_date > last_review_date",
                ),
            ],
        ),
        (
            "ip_org_relationship",
            "relationship_id",
            [
                *_present("relationship_id", "source_org_id", "target_org_id"),
                _one_of(
                    "RELATIONSHIP_TYPE_INVALID",
                    "relationship_type",
                    "PARENT_SUBSIDIARY TRUST_TRUSTEE PARTNERSHIP FRANCHISE JOINT_VENTURE",
                ),
                _rule("SELF_RELATIONSHIP", "source_org_id != target_org_id"),
                *_uuids("relationship_id"),
                _organisation("source_org_id"),
                _organisation("target_org_id"),
            ],
        ),
        (
            "ip_organisation",
            "organisation_id",
            [
                *_present("organisation_id", "global_id", "business_name", ORG_TYPE_NULL="organisation_type"),
                _organisation(),
                *_uuids("global_id"),
                *_filled("business_name"),
                _fresh("ORG_SNAPSHOT_STALE", "last_updated_at", 30),
                _warn("ABN_FORMAT_CHECK", "abn_masked IS NULL OR length(abn_masked) >= 3"),
            ],
        ),
        (
            "ip_party_relationship",
            "relationship_id",
            [
                *_present("relationship_id", "global_id", "organisation_id"),
                _one_of(
                    "PARTY_ROLE_INVALID",
                    "party_role",
                    "DIRECTOR AUTHORISED_REPRESENTATIVE BENEFICIAL_OWNER SIGNATORY GUARANTOR SECRETARY",
                ),
                _one_of("AUTHORITY_LEVEL_INVALID", "authority_level", "FULL LIMITED VIEW_ONLY"),
                *_uuids("relationship_id", "global_id"),
                _organisation(),
                _warn("END_DATE_ORDER", "end_date IS NULL OR end_date >= start_date"),
            ],
        ),
    ]
}


def _source(name: str, keys: str, required: str) -> Contract:
    return Contract(name, tuple(keys.split()), (), tuple(required.split()))


# Primary key and required fields of each source data set.
SOURCE_CONTRACTS: dict[str, Contract] = {
    c.name: c
    for c in (
        _source("energy_accounts", "energyAccountId", "energyAccountId accountNumber displayName openStatus"),
        _source("energy_invoices", "invoiceNumber", "invoiceNumber paymentStatus"),
        _source(
            "energy_service_points",
            "servicePointId",
            "servicePointId jurisdictionCode servicePointClassification servicePointStatus isGenerator",
        ),
        _source(
            "insurance_policies",
            "policyId",
            "policyId policyType provider premiumFrequency excessAmount status autoRenewal",
        ),
        _source(
            "banking_accounts",
            "accountId",
            "accountId accountType isOwner isActive productCategory accountOwnership openStatus isOwned",
        ),
        _source("banking_balances", "accountId", "currency"),
        _source("banking_direct_debits", "directDebitId", "directDebitId"),
        _source("banking_payees", "payeeId", "payeeId type"),
        _source("banking_scheduled_payments", "scheduledPaymentId", "scheduledPaymentId status frequency"),
        _source(
            "banking_transactions",
            "transactionId",
            "transactionId transactionType type category status isDetailAvailable currency",
        ),
        _source("credit_cards", "creditCardId", "creditCardId cardType annualFee rewardProgram status"),
        _source(
            "customer_preferences", "global_id", "preferredContactChannel preferredLanguage marketingOptIn"
        ),
        _source(
            "customers",
            "global_id",
            "global_id customerId gender state prefix occupationCodeVersion customerType",
        ),
        _source(
            "kyc_records",
            "kycId",
            "kycId verificationStatus verificationMethod riskRating pepStatus sanctionsCheck",
        ),
        _source(
            "organisation_party_relationships",
            "relationshipId",
            "relationshipId partyRole isActive authorityLevel",
        ),
        _source("organisation_relationships", "relationshipId", "relationshipId relationshipType isActive"),
        _source(
            "organisations",
            "organisationId",
            "organisationId organisationType industryCodeVersion registeredCountry isACNCRegistered agentRole",
        ),
        _source("physical_addresses", "addressId", "addressId purpose addressUType state country"),
        _source("service_cases", "caseId", "caseId caseType status priority assignedTeam"),
        _source("loan_accounts", "loanId", "loanId loanType termMonths repaymentFrequency status"),
        _source(
            "loan_applications",
            "applicationId",
            "applicationId loanGoal applicationType creditScore finalOutcome numOffers",
        ),
        _source("missing_documents", "documentId", "documentId documentType status remindersSent"),
        _source("mortgage_accounts", "mortgageId", "mortgageId interestType loanTerm repaymentFrequency"),
        _source("application_stage_history", "historyId", "historyId"),
        _source(
            "loan_application_events",
            "eventId",
            "eventId conceptName lifecycleTransition action eventOrigin",
        ),
        _source("service_case_events", "eventId", "eventId eventType description"),
        _source("status_change_history", "changeId", "changeId"),
        _source("support_interactions", "interactionId", "interactionId channel topic resolution"),
        _source(
            "accepted_loans",
            "loanId",
            "loanId memberId term grade empLength homeOwnership verification_status"
            " application_type loanStatus hardship_flag debt_settlement_flag",
        ),
        _source(
            "banking_products",
            "productId",
            "productId name productCategory brand brandName applicationUri isTailored",
        ),
        _source("energy_plans", "planId", "planId brand brandName displayName fuelType type customerType"),
        _source(
            "rejected_applications",
            "loanId",
            "loanId rejectionReason state employmentLength policyCode",
        ),
    )
}
