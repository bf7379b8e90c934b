"""The check tables seen as the 20 source data sets that the governed entities read.

Customers are parties, suppliers organisations, orders applications, line items
changes and documents of an order, events the stage, status and support logs,
conversations the service cases. Only this reshaping of input is plain SQL that
both engines read; everything after it is written twice, independently.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
    " labels conversations"
).split()

AS_OF = datetime(2024, 2, 1)
# A public key for checks only. Real runs take theirs from the environment.
CHECK_KEY = b"published-check-key"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text(x: str) -> str:
    return f"CAST({x} AS STRING)"


def uuid(kind: str, k: str) -> str:
    """An id of the required format: eight digits name the kind, the last twelve hold the key."""
    tag = format(sum(ord(c) * 31**i for i, c in enumerate(kind)) % 16**8, "08x")
    return f"'{tag}-0000-4000-8000-' || lpad({text(k)}, 12, '0')"


def party(k: str) -> str:
    return uuid("party", k)


def account(k: str) -> str:
    return uuid("account", k)


def padded(prefix: str, k: str, width: int) -> str:
    return f"'{prefix}' || lpad({text(k)}, CAST(greatest({width}, length({text(k)})) AS INT), '0')"


def application(k: str) -> str:
    return padded("Application_", k, 9)


def organisation(k: str) -> str:
    return padded("ORG-", k, 5)


def business_of(custkey: str) -> str:
    return organisation(f"CAST(floor({custkey} / 15.0) AS BIGINT)")


def second(ts: str) -> str:
    return text(f"date_trunc('second', {ts})")


def day(ts: str) -> str:
    return text(f"CAST({ts} AS DATE)")


def money(x: str) -> str:
    return text(f"CAST({x} AS DECIMAL(18,2))")


def cents(x: str) -> str:
    return f"CAST(round({x} * 100) AS BIGINT)"


def later(ts: str, amount: str, unit: str = "DAY") -> str:
    return f"({ts} + INTERVAL '1' {unit} * CAST({amount} AS INT))"


def loaded(ts: str) -> str:
    return f"{ts} AS _ingested_at, 'batch-' || {day(ts)} AS _batch_id"


def change(op: str, ts: str, lsn: str = "0", offset: str = "0") -> str:
    return (
        f"{op} AS _operation, CAST({lsn} AS BIGINT) AS _source_lsn, {ts} AS _commit_ts,"
        f" {ts} AS _captured_at, CAST({offset} AS BIGINT) AS _kafka_offset, {loaded(ts)}"
    )


def _applications(ts: str, outcome: str, control: str) -> str:
    return f"""
    SELECT {party('o_custkey')} AS global_id, {application('o_orderkey')} AS applicationId,
      'CUST-' || {text('o_custkey')} AS customerId,
      CASE WHEN o_orderpriority = '1-URGENT' THEN {business_of('o_custkey')} END AS organisationId,
      CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN '  '
           ELSE ' ' || o_orderpriority END AS loanGoal,
      CASE WHEN o_orderstatus = 'O' THEN ' new credit ' ELSE 'limit raise' END AS applicationType,
      {outcome} AS finalOutcome,
      CASE WHEN o_totalprice < 3000 THEN 'unknown' ELSE {second('o_orderdate')} END AS submittedAt,
      {second(ts)} AS lastUpdatedAt, '$' || {money('o_totalprice')} AS requestedAmount,
      CAST(300 + o_custkey % 550 AS INT) AS creditScore, {text('o_custkey % 5')} AS numOffers, {control}"""


def _customers(ts: str, prefix: str, control: str) -> str:
    return f"""
    SELECT {party('c_custkey')} AS global_id, 'CUST-' || {text('c_custkey')} AS customerId,
      ' ' || substr(c_name, 1, 8) AS firstName, substr(c_name, 10) AS lastName,
      CASE WHEN c_acctbal < 0 THEN c_name ELSE replace(c_name, '#', '.') || '@Example.com' END AS email,
      CASE WHEN c_acctbal > 9900 THEN '1'
           ELSE '04-' || {text('10000000 + c_custkey')} END AS phoneNumber,
      'f' AS gender, CASE WHEN c_custkey % 7 <> 3 THEN CAST(16 + c_nationkey * 2 AS INT) END AS age, 'st' || {text('c_nationkey')} AS state,
      '2015-01-01 00:00:00' AS createdAt, {second(ts)} AS lastUpdateTime,
      CAST(NULL AS STRING) AS middleNames, {prefix} AS prefix, {text('c_nationkey')} AS occupationCode,
      '1' AS occupationCodeVersion,
      CASE c_mktsegment WHEN 'MACHINERY' THEN 'BUSINESS' WHEN 'BUILDING' THEN 'sole_trader'
           WHEN 'FURNITURE' THEN CASE WHEN c_acctbal < 0 THEN 'RETAIL' ELSE 'INDIVIDUAL' END
           ELSE ' individual' END AS customerType, {control}"""


def _documents() -> str:
    op = "CASE WHEN l_discount >= 0.1 THEN 'DELETE' ELSE 'UPDATE' END"
    return f"""
    SELECT {uuid('document', 'l_orderkey * 100 + l_linenumber')} AS documentId, {application('l_orderkey')} AS applicationId,
      {party('o_custkey')} AS global_id, 'CUST-' || {text('o_custkey')} AS customerId,
      CASE l_returnflag WHEN 'A' THEN 'PAYSLIP' WHEN 'R' THEN 'IDENTITY' ELSE 'STATEMENT' END AS documentType,
      CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'VERIFIED' WHEN 'NF' THEN 'received'
           WHEN 'RF' THEN 'INVALID' WHEN 'NO' THEN ' required' WHEN 'AO' THEN 'EXPIRED'
           ELSE CASE WHEN l_tax > 0.06 THEN 'LOST' ELSE 'INVALID' END END AS status,
      {second('l_shipdate')} AS requestedAt,
      CASE WHEN l_returnflag = 'A' THEN {second(later('l_shipdate', '5'))}
           WHEN l_returnflag = 'N' AND l_tax > 0.07 THEN {second(later('l_shipdate', '-1'))} END AS receivedAt,
      {day(later('l_shipdate', 'CAST(l_quantity AS INT) * 200'))} AS expiryDate,
      l_linenumber AS remindersSent,
      CASE WHEN l_linenumber > 3 THEN {second(later('l_shipdate', 'l_linenumber'))} END AS lastReminderAt,
      CASE WHEN l_returnflag = 'R' THEN ' illegible ' END AS rejectionReason,
      {change(op, 'l_shipdate', 'l_partkey', cents('l_extendedprice'))}
    FROM {{lineitem}} l JOIN {{orders}} o ON l_orderkey = o_orderkey"""


def _cases() -> str:
    opened = later("TIMESTAMP '2024-01-01 00:00:00'", "conv_id % 700", "HOUR")
    ts = later(opened, "turn", "HOUR")
    return f"""
    SELECT {uuid('case', 'conv_id')} AS caseId, {party('conv_id')} AS global_id,
      CASE WHEN conv_id % 4 = 0 THEN {organisation('conv_id')} END AS organisationId,
      CASE WHEN conv_id % 3 = 0 THEN {application('conv_id')} END AS applicationId,
      {second(later(opened, '3', 'HOUR'))} AS slaDeadline,
      CASE conv_id % 3 WHEN 0 THEN 'card' WHEN 1 THEN 'loan' ELSE 'account' END AS caseType,
      text AS subject,
      CASE role WHEN 'user' THEN 'OPEN' WHEN 'assistant' THEN ' In_Progress' ELSE 'resolved' END AS status,
      CASE WHEN turn > 3 THEN 'high' ELSE 'low' END AS priority, 'team-' || {text('conv_id % 7')} AS assignedTeam,
      {second(opened)} AS createdAt,
      CASE WHEN role = 'assistant' AND turn >= 3 THEN {second(ts)} END AS resolvedAt,
      CASE WHEN role = 'assistant' AND turn >= 3 THEN 'done' END AS resolutionSummary,
      {change("'UPDATE'", ts, 'turn', 'conv_id')}
    FROM {{conversations}}"""


def _case_events() -> str:
    ts = later("TIMESTAMP '2024-01-01 00:00:00'", "conv_id % 700 + turn", "HOUR")
    return f"""
    SELECT {uuid('case-event', "conv_id * 100 + turn")} AS eventId,
      {uuid('case', 'conv_id')} AS caseId, {party('conv_id')} AS global_id,
      CASE role WHEN 'user' THEN 'CUSTOMER_CONTACTED' WHEN 'assistant' THEN 'note_added'
           ELSE CASE WHEN turn = 0 THEN 'ESCALATED' ELSE 'SYSTEM' END END AS eventType,
      {second(ts)} AS eventTimestamp, text AS description, {loaded(ts)}
    FROM {{conversations}}"""


def _stages() -> str:
    out = later("ts", "floor(value * 10)", "MINUTE")
    return f"""
    SELECT {uuid('stage', 'event_id')} AS historyId, {application('user_id')} AS applicationId,
      {party('user_id')} AS global_id,
      CASE event_type WHEN 'signup' THEN 'submitted' WHEN 'view' THEN 'document_verification'
           WHEN 'click' THEN ' assessment' WHEN 'purchase' THEN 'APPROVED' ELSE 'denied' END AS stage,
      CASE WHEN event_type = 'error' AND value < 1 THEN 'not-a-time' ELSE {second('ts')} END AS enteredAt,
      CASE WHEN value > 100 THEN CAST(NULL AS STRING)
           WHEN value < 0.2 THEN {second(later('ts', '-60', 'MINUTE'))} ELSE {second(out)} END AS exitedAt,
      ' team-' || {text('event_id % 5')} AS assignedTeam, {second(later('ts', '120', 'MINUTE'))} AS slaDeadline,
      CASE event_type WHEN 'signup' THEN 'customer' WHEN 'view' THEN 'INTERNAL_TEAM'
           WHEN 'click' THEN 'director' WHEN 'purchase' THEN CAST(NULL AS STRING) ELSE 'robot' END AS pendingActionParty,
      {loaded('ts')}
    FROM {{events}}"""


def _statuses() -> str:
    return f"""
    SELECT {uuid('status', 'event_id')} AS changeId, {application('user_id')} AS applicationId,
      {party('user_id')} AS global_id, event_type AS oldStatus,
      CASE WHEN value < 5 THEN 'view' WHEN value < 20 THEN 'click' WHEN value < 60 THEN 'accepted' ELSE ' ' END AS newStatus,
      {second('ts')} AS changedAt, CASE WHEN value > 10 THEN ' by rule ' END AS reason, {loaded('ts')}
    FROM {{events}}"""


def _lifecycle() -> str:
    return f"""
    SELECT {uuid('life', 'event_id')} AS eventId, {application('user_id')} AS applicationId,
      {party('user_id')} AS global_id, 'A_' || event_type AS conceptName, 'complete' AS lifecycleTransition,
      {second('ts')} AS timestamp, CASE WHEN value < 2 THEN 'robot' ELSE 'system' END AS eventOrigin,
      'created' AS action, {loaded('ts')}
    FROM {{events}}"""


def _support() -> str:
    return f"""
    SELECT {uuid('support', 'event_id')} AS interactionId, {party('user_id')} AS global_id,
      CASE event_type WHEN 'view' THEN 'phone' WHEN 'click' THEN ' chat ' WHEN 'signup' THEN 'EMAIL'
           WHEN 'purchase' THEN 'branch' ELSE ' ' END AS channel,
      {second('ts')} AS timestamp, 'about ' || event_type AS topic,
      CASE WHEN value < 5 THEN 'Follow-up booked' WHEN value < 10 THEN 'escalated' ELSE 'closed' END AS resolution,
      CAST(floor(value * 3) AS INT) AS durationMinutes, {loaded('ts')}
    FROM {{events}}"""


def _organisations(ts: str, code: str, control: str) -> str:
    return f"""
    SELECT {party('s_suppkey')} AS global_id, CASE WHEN s_suppkey % 13 <> 5 THEN {organisation('s_suppkey')} END AS organisationId,
      s_name AS businessName, s_name || ' Ltd' AS legalName, CAST(NULL AS STRING) AS shortName,
      'company' AS organisationType, {code} AS industryCode, '2006' AS industryCodeVersion, 'au' AS registeredCountry,
      s_acctbal > 5000 AS isACNCRegistered, 'owner' AS agentRole,
      '51 ' || {text('100000000 + s_suppkey')} AS abn, CASE WHEN s_acctbal < 0 THEN '1' ELSE {text('1000 + s_suppkey')} END AS acn,
      '1990-05-17' AS establishmentDate, {second(ts)} AS lastUpdateTime, {control}"""


START = "TIMESTAMP '1995-01-01 00:00:00'"
KYC_AT = "TIMESTAMP '2023-12-01 00:00:00'"


def _kyc(kind: str, key: str, owner: str, balance: str, nation: str) -> str:
    return f"""
    SELECT {party(key)} AS global_id, {uuid(kind, key)} AS kycId, {owner} AS organisationId,
      CASE WHEN {balance} < 0 THEN 'failed' WHEN {balance} < 1000 THEN 'PENDING' WHEN {balance} > 9990 THEN 'LOST' ELSE 'verified' END AS verificationStatus,
      '2023-06-01' AS verificationDate, 'document' AS verificationMethod,
      CASE WHEN {nation} < 5 THEN 'low' WHEN {nation} < 20 THEN 'MEDIUM' ELSE 'HIGH' END AS riskRating,
      {balance} > 9000 AS pepStatus, 'CLEAR' AS sanctionsCheck, '2023-06-02' AS lastReviewDate,
      CASE WHEN {nation} < 8 THEN '2024-01-15' WHEN {nation} < 20 THEN '2025-01-15' ELSE 'soon' END AS nextReviewDate,
      'passport,licence' AS documentTypes, {balance} > 100 AS abnVerified, 'registered' AS asicCheckStatus,
      {nation} > 3 AS beneficialOwnershipVerified, {change("'SNAPSHOT'", KYC_AT, key)}"""


def _role(role: str, custkey: str, level: str, start: str, active: str) -> str:
    rid = uuid(role, 's_suppkey')
    return f"""
    SELECT {rid} AS relationshipId, {party(custkey)} AS global_id, {organisation('s_suppkey')} AS organisationId,
      '{role}' AS partyRole, {level} AS authorityLevel, {active} AS isActive, '{start}' AS startDate,
      CASE WHEN {active} THEN CAST(NULL AS STRING) ELSE '2019-01-01' END AS endDate,
      {change("'SNAPSHOT'", START, 's_suppkey')}
    FROM {{supplier}}"""


_SNAP = "'SNAPSHOT'"
_ORDER_OP = "CASE WHEN o_orderstatus = 'P' AND o_totalprice < 5000 THEN 'DELETE' ELSE 'UPDATE' END"
_ORDER_PREFIX = "CASE WHEN o_orderstatus = 'P' AND o_totalprice < 20000 THEN CAST(NULL AS STRING) ELSE 'Dr' END"
_LINE_OP = "CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' AND l_quantity >= 49 THEN 'DELETE' ELSE 'UPDATE' END"
_LINE_OUTCOME = """CASE WHEN l_linestatus = 'O' THEN ' pending' WHEN l_returnflag = 'A' THEN 'accepted'
           WHEN l_returnflag = 'R' THEN 'DENIED' ELSE CASE WHEN l_tax > 0.07 THEN 'LOST' ELSE 'CANCELLED' END END"""

SOURCES: dict[str, str] = {
    "loan_applications": _applications("o_orderdate", "'PENDING'", change(_SNAP, "o_orderdate"))
    + " FROM {orders} UNION ALL "
    + _applications("l_shipdate", _LINE_OUTCOME, change(_LINE_OP, "l_shipdate", "l_partkey", cents("l_extendedprice")))
    + " FROM {lineitem} l JOIN {orders} o ON l_orderkey = o_orderkey",
    "customers": _customers(START, "'Mr '", change(_SNAP, START))
    + " FROM {customer} UNION ALL "
    + _customers("o_orderdate", _ORDER_PREFIX, change(_ORDER_OP, "o_orderdate", "o_orderkey + 1", "o_orderkey"))
    + " FROM {orders} o JOIN {customer} c ON o_custkey = c_custkey",
    "customer_preferences": f"""
    SELECT {party('c_custkey')} AS global_id, 'CUST-' || {text('c_custkey')} AS customerId,
      CASE c_mktsegment WHEN 'MACHINERY' THEN 'email' WHEN 'BUILDING' THEN ' Phone' ELSE 'SMS' END AS preferredContactChannel,
      'en' AS preferredLanguage, c_acctbal > 5000 AS marketingOptIn, {text('c_nationkey % 10')} AS satisfactionScore,
      {change(_SNAP, START, 'c_custkey')}
    FROM {{customer}} WHERE c_acctbal >= 500""",
    "physical_addresses": f"""
    SELECT {party('c_custkey')} AS global_id, {uuid('home', 'c_custkey')} AS addressId, 'home' AS purpose,
      'simple' AS addressUType, 'Suburb ' || {text('c_nationkey')} AS suburb, 'nsw' AS state,
      {text('2000 + c_nationkey')} AS postcode, 'AU' AS country, {change(_SNAP, START, 'c_custkey')}
    FROM {{customer}} WHERE c_nationkey < 20
    UNION ALL
    SELECT {party('c_custkey')} AS global_id, {uuid('mail', 'c_custkey')} AS addressId, 'MAILING' AS purpose,
      'simple' AS addressUType, ' ' AS suburb, 'vic' AS state,
      {text('3000 + c_nationkey')} AS postcode, 'AU' AS country, {change(_SNAP, KYC_AT, 'c_custkey')}
    FROM {{customer}} WHERE c_acctbal > 0""",
    "organisations": _organisations(START, "'0'", change(_SNAP, START))
    + " FROM {supplier} UNION ALL "
    + _organisations("ts", text("CAST(floor(value / 50) AS INT)"), change("'UPDATE'", "ts", "event_id"))
    + " FROM {events} e JOIN {supplier} s ON user_id = s_suppkey WHERE event_type = 'signup'",
    "kyc_records": _kyc("kyc", "c_custkey", "CAST(NULL AS STRING)", "c_acctbal", "c_nationkey")
    + " FROM {customer} UNION ALL "
    + _kyc("kyb", "s_suppkey", organisation("s_suppkey"), "s_acctbal", "s_nationkey")
    + " FROM {supplier}",
    "organisation_party_relationships": " UNION ALL ".join(
        [
            _role("DIRECTOR", "s_suppkey", "'full'", "2010-01-01", "s_acctbal > 0"),
            _role("AUTHORISED_REPRESENTATIVE", "s_suppkey + 7", "'LIMITED'", "2012-01-01", "s_nationkey > 4"),
            _role(
                "SIGNATORY",
                "s_suppkey + s_nationkey",
                "CASE WHEN s_acctbal < 0 THEN 'NONE' ELSE 'view_only' END",
                "2018-01-01",
                "s_nationkey > 12",
            ),
        ]
    ),
    "organisation_relationships": f"""
    SELECT {uuid('link', 's_suppkey')} AS relationshipId, {organisation('s_suppkey')} AS sourceOrgId,
      CASE WHEN s_nationkey = 0 THEN {organisation('s_suppkey')} ELSE {organisation('s_suppkey + 1')} END AS targetOrgId,
      CASE WHEN s_nationkey < 9 THEN 'parent_subsidiary' WHEN s_nationkey < 20 THEN 'PARTNERSHIP' ELSE 'rival' END AS relationshipType,
      s_acctbal > 1000 AS isActive, '2011-02-03' AS startDate, {change(_SNAP, START, 's_suppkey')}
    FROM {{supplier}}""",
    "banking_accounts": f"""
    SELECT {party('c_custkey')} AS global_id, {account('c_custkey')} AS accountId,
      CASE WHEN c_mktsegment = 'MACHINERY' THEN {business_of('c_custkey')} END AS organisationId,
      CASE WHEN c_acctbal > 9950 THEN ' ' ELSE 'savings' END AS accountType, c_acctbal > 0 AS isActive, true AS isOwner,
      '2015-03-01' AS openDate, 'TRANS' AS productCategory, 'ONE_PARTY' AS accountOwnership, 'OPEN' AS openStatus,
      true AS isOwned, {change(_SNAP, START, 'c_custkey')}
    FROM {{customer}}""",
    "banking_balances": f"""
    SELECT {account('c_custkey')} AS accountId, {money('c_acctbal')} AS currentBalance,
      '$' || {money('c_acctbal * 12')} AS availableBalance,
      CASE WHEN c_nationkey < 4 THEN 'usd' WHEN c_nationkey < 24 THEN 'aud' END AS currency,
      {change(_SNAP, KYC_AT, 'c_custkey')}
    FROM {{customer}} WHERE c_acctbal > -500""",
    "loan_accounts": f"""
    SELECT {party('o_custkey')} AS global_id, {uuid('loan', 'o_orderkey')} AS loanId,
      {account('o_custkey')} AS accountId, 'personal' AS loanType,
      CASE WHEN o_totalprice < 5000 THEN ' ' WHEN o_orderpriority = '1-URGENT' THEN 'active' ELSE 'CLOSED' END AS status,
      'monthly' AS repaymentFrequency, CAST(o_custkey % 640 AS INT) AS termMonths, {day('o_orderdate')} AS startDate,
      {day(later('o_orderdate', "CASE WHEN o_totalprice > 490000 THEN -10 ELSE 12000 END"))} AS maturityDate,
      {money('o_totalprice')} AS originalAmount, {money('o_totalprice / 4')} AS currentBalance,
      {change(_SNAP, 'o_orderdate', 'o_orderkey')}
    FROM {{orders}} WHERE o_orderstatus = 'F'""",
    "mortgage_accounts": f"""
    SELECT {party('o_custkey')} AS global_id, {uuid('mortgage', 'o_orderkey')} AS mortgageId,
      {account('o_custkey + 700')} AS accountId, 'fixed' AS interestType, 'MONTHLY' AS repaymentFrequency,
      CAST(5 + o_custkey % 26 AS INT) AS loanTerm, {day('o_orderdate')} AS startDate,
      CASE WHEN o_totalprice < 2000 THEN 'high' ELSE {text('o_custkey % 120')} END AS lvrPercent,
      {money('o_totalprice * 2')} AS loanAmount, {change(_SNAP, 'o_orderdate', 'o_orderkey')}
    FROM {{orders}} WHERE o_orderpriority = '1-URGENT'""",
    "credit_cards": f"""
    SELECT {party('c_custkey')} AS global_id, {uuid('card', 'c_custkey')} AS creditCardId,
      CASE WHEN c_mktsegment = 'MACHINERY' THEN {business_of('c_custkey')} END AS organisationId,
      'gold' AS cardType, CASE WHEN c_acctbal > 100 THEN 'active' ELSE 'BLOCKED' END AS status, ' Points' AS rewardProgram,
      '95' AS annualFee, '2019-09-09' AS issuedDate,
      CASE WHEN c_acctbal < -900 THEN '12' ELSE '4111-1111-' || {text('10000000 + c_custkey')} END AS cardNumber,
      {money('c_acctbal * 3')} AS creditLimit, {change(_SNAP, START, 'c_custkey')}
    FROM {{customer}}""",
    "missing_documents": _documents(),
    "service_cases": _cases(),
    "service_case_events": _case_events(),
    "application_stage_history": _stages(),
    "status_change_history": _statuses(),
    "loan_application_events": _lifecycle(),
    "support_interactions": _support(),
    "accepted_loans": f"""
    SELECT {party('l_suppkey')} AS global_id,
      {uuid('accepted', "l_orderkey * 100 + l_linenumber")} AS loanId,
      CASE WHEN l_tax < 0.001 THEN ' ' ELSE 'current' END AS loanStatus, l_returnflag AS purpose, ' 36 months' AS term, 'A' AS grade,
      {day('l_shipdate')} AS issuedAt, {money('l_extendedprice')} AS loanAmount, 'member' AS memberId, '1' AS empLength,
      'OWN' AS homeOwnership, CASE WHEN l_partkey % 3 = 0 THEN '1' END AS annualIncome, 'ok' AS verification_status, 'one' AS application_type,
      CASE WHEN l_partkey % 5 = 0 THEN '700' END AS fico_range_low, 'N' AS hardship_flag, 'N' AS debt_settlement_flag, {loaded('l_shipdate')}
    FROM {{lineitem}} WHERE l_linestatus = 'F'""",
    "rejected_applications": f"""
    SELECT CASE WHEN o_totalprice < 2000 THEN 'none' ELSE {party('o_custkey')} END AS global_id,
      {uuid('rejected', 'o_orderkey')} AS loanId, ' ' || o_orderpriority AS applicationTitle,
      CASE WHEN o_totalprice > 490000 THEN 'never' ELSE {day('o_orderdate')} END AS applicationDate,
      ' too high ' AS rejectionReason, 'ST' AS state, '1' AS employmentLength, '0' AS policyCode, {loaded('o_orderdate')}
    FROM {{orders}} WHERE o_orderstatus = 'P'""",
}


def spark_source(spark: SparkSession, sf_dir: str) -> Callable[[str], DataFrame]:
    """Source rows by data set name, from the check tables."""

    def source(name: str) -> DataFrame:
        used = {t: read(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in SOURCES[name]}
        return spark.sql(SOURCES[name], **used)

    return source


def oracle_source(name: str) -> str:
    return SOURCES[name].format(**{t: t for t in TABLES})
