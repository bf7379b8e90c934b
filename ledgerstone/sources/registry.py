"""The 32 source data sets and where each one lands."""

from __future__ import annotations

# Landing directory prefix (source system and schema) of each change data set.
CDC_SYSTEMS = {
    "banking_core": "banking_accounts banking_balances banking_direct_debits banking_payees"
    " banking_scheduled_payments banking_transactions credit_cards",
    "customer_master": "customer_preferences customers kyc_records physical_addresses",
    "energy_core": "energy_accounts energy_invoices energy_service_points",
    "insurance_core": "insurance_policies",
    "lending_servicing": "loan_accounts mortgage_accounts",
    "lending_origination": "loan_applications missing_documents",
    "organisation_master": "organisation_party_relationships organisation_relationships organisations",
    "case_management": "service_cases",
}
CDC_DATASETS = {name: f"{system}__{name}" for system, names in CDC_SYSTEMS.items() for name in names.split()}
EVENT_DATASETS = (
    "application_stage_history loan_application_events service_case_events status_change_history support_interactions"
).split()
FILE_DATASETS = "accepted_loans banking_products energy_plans rejected_applications".split()


def bronze_tables() -> list[str]:
    return (
        [f"cdc_{n}" for n in CDC_DATASETS] + [f"event_{n}" for n in EVENT_DATASETS] + [f"file_{n}" for n in FILE_DATASETS]
    )


def landing_path(root: str, kind: str, dataset: str) -> str:
    directory = CDC_DATASETS[dataset] if kind == "cdc" else dataset
    return f"{root}/{kind}/{directory}"
