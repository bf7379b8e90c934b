"""Key and required fields of each source, stated apart from the package so that a wrong list shows."""

REQUIRED = {
    "energy_accounts": ("energyAccountId", "energyAccountId accountNumber displayName openStatus"),
    "energy_invoices": ("invoiceNumber", "invoiceNumber paymentStatus"),
    "energy_service_points": ("servicePointId", "servicePointId jurisdictionCode servicePointClassification servicePointStatus isGenerator"),
    "insurance_policies": ("policyId", "policyId policyType provider premiumFrequency excessAmount status autoRenewal"),
    "banking_accounts": ("accountId", "accountId accountType isOwner isActive productCategory accountOwnership openStatus isOwned"),
    "banking_balances": ("accountId", "currency"),
    "banking_direct_debits": ("directDebitId", "directDebitId"),
    "banking_payees": ("payeeId", "payeeId type"),
    "banking_scheduled_payments": ("scheduledPaymentId", "scheduledPaymentId status frequency"),
    "banking_transactions": ("transactionId", "transactionId transactionType type category status isDetailAvailable currency"),
    "credit_cards": ("creditCardId", "creditCardId cardType annualFee rewardProgram status"),
    "customer_preferences": ("global_id", "preferredContactChannel preferredLanguage marketingOptIn"),
    "customers": ("global_id", "global_id customerId gender state prefix occupationCodeVersion customerType"),
    "kyc_records": ("kycId", "kycId verificationStatus verificationMethod riskRating pepStatus sanctionsCheck"),
    "organisation_party_relationships": ("relationshipId", "relationshipId partyRole isActive authorityLevel"),
    "organisation_relationships": ("relationshipId", "relationshipId relationshipType isActive"),
    "organisations": ("organisationId", "organisationId organisationType industryCodeVersion registeredCountry isACNCRegistered agentRole"),
    "physical_addresses": ("addressId", "addressId purpose addressUType state country"),
    "service_cases": ("caseId", "caseId caseType status priority assignedTeam"),
    "loan_accounts": ("loanId", "loanId loanType termMonths repaymentFrequency status"),
    "loan_applications": ("applicationId", "applicationId loanGoal applicationType creditScore finalOutcome numOffers"),
    "missing_documents": ("documentId", "documentId documentType status remindersSent"),
    "mortgage_accounts": ("mortgageId", "mortgageId interestType loanTerm repaymentFrequency"),
    "application_stage_history": ("historyId", "historyId"),
    "loan_application_events": ("eventId", "eventId conceptName lifecycleTransition action eventOrigin"),
    "service_case_events": ("eventId", "eventId eventType description"),
    "status_change_history": ("changeId", "changeId"),
    "support_interactions": ("interactionId", "interactionId channel topic resolution"),
    "accepted_loans": ("loanId", "loanId memberId term grade empLength homeOwnership verification_status application_type loanStatus hardship_flag debt_settlement_flag"),
    "banking_products": ("productId", "productId name productCategory brand brandName applicationUri isTailored"),
    "energy_plans": ("planId", "planId brand brandName displayName fuelType type customerType"),
    "rejected_applications": ("loanId", "loanId rejectionReason state employmentLength policyCode"),
}
