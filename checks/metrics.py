"""One query per metric view: the listed dimensions with all of the view's measures."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from checks.catalogue import register
from checks.estate import AS_OF
from checks.oracle import TODAY, compose
from checks.products import SHARED, warehouse
from ledgerstone.operators.metrics import metric_query
from ledgerstone.plans.metric_views import METRIC_VIEWS
from ledgerstone.session import settle

GROUPS = {
    "mv_customer_overview": "Age Band, State, Latest Application Status, Verification Status",
    "mv_application_status": "Application Month, Current Stage, Latest Status, Customer Action Required",
    "mv_application_documents": "Document Type, Document Status, Is Invalid or Expired",
    "mv_application_timeline": "Event Day, Event Family, Event Type",
    "mv_service_cases": "Case Type, Case Status, Created Month",
    "mv_service_activity": "Activity Month, Activity Type, Channel, Escalated",
    "mv_application_next_action": "Current Stage, Is Terminal Stage, Next Action Code",
    "mv_organisation_overview": "Establishment Year, Industry Code, Latest Application Status",
    "mv_arrangement_portfolio": "Arrangement Type, Arrangement Status, Start Year",
    "mv_party_relationships": "Party Role, Authority Level",
    "mv_organisation_relationships": "Source Organisation Name, Target Organisation Name, Relationship Type",
    "mv_application_authority": "Party Role, Authority Level",
    "mv_verification_status": "Record Type, Verification Month, Document Type Count, Review Overdue",
    "mv_self_profile": "Customer ID, Preferred Contact Channel",
    "mv_self_application_status": "Customer ID, Current Stage, Latest Status",
    "mv_self_application_documents": "Customer ID, Document Type",
    "mv_self_application_timeline": "Customer ID, Event Family, Stage",
    "mv_self_service_cases": "Customer ID, Case Status",
    "mv_self_service_activity": "Customer ID, Activity Month, Channel",
    "mv_self_application_next_action": "Customer ID, Current Stage, Is Terminal Stage",
}


def _duck(expression: str) -> str:
    sql = re.sub(r"datediff\(\{today\}, (CAST\(\w+ AS DATE\))\)", rf"date_diff('day', \1, {TODAY})", expression)
    sql = re.sub(r"size\(split\((\w+), ','\)\)", r"CAST(len(string_split(\1, ',')) AS INTEGER)", sql)
    sql = re.sub(r"COUNT_IF\((.*)\)$", r"count(*) FILTER (WHERE \1)", sql)
    return re.sub(r"(DATE_TRUNC\('\w+', [\w.]+\))", r"CAST(\1 AS TIMESTAMP)", sql)


def _sql(view, dimensions) -> str:
    picks = [f'{_duck(view.dimensions[d])} AS "{d}"' for d in dimensions]
    picks += [f'{_duck(e)} AS "{m}"' for m, e in view.measures.items()]
    joins = ""
    for j in view.joins:
        rows = f"SELECT * FROM gold_{j.table} WHERE {j.where.replace('{today}', TODAY) or 'true'}"
        pairs = []
        for left, right in j.on:
            a, b = f"s.{left}", f"{j.alias}.{right}"
            if right in j.filled:
                a, b = (f"coalesce({x}, '{j.filled[right]}')" for x in (a, b))
            pairs.append(f"{a} = {b}")
        joins += f" LEFT JOIN ({rows}) {j.alias} ON {' AND '.join(pairs)}"
    bare = re.compile(r"(?<![\w.'])(verification_status|current_stage|pending_action_party|is_active|customer_id|organisation_id)\b(?!\.)")
    if view.joins:
        picks = [bare.sub(r"s.\1", p.rsplit(" AS ", 1)[0]) + " AS " + p.rsplit(" AS ", 1)[1] for p in picks]
    return compose(f"SELECT {', '.join(picks)} FROM gold_{view.source} s{joins}{_owned(view)} GROUP BY {', '.join(str(i + 1) for i in range(len(dimensions)))}")


def _owned(view) -> str:
    return f" WHERE s.{view.owner} = (SELECT min({view.owner}) FROM gold_{view.source})" if view.owner else ""


# Views of a customer whose source is computed once for the principal and the rows, as it costs more to build than to store.
STORED_SOURCE = frozenset({"mv_self_application_timeline"})


def _query(view, dimensions):
    shared = SHARED if any(j.alias == "ctx" for j in view.joins) else frozenset()

    def run(spark, sf_dir):
        house = warehouse(spark, sf_dir, shared)
        gold = house.gold
        if view.name in STORED_SOURCE:
            asked = " ".join([view.owner, *[view.dimensions[d] for d in dimensions], *view.measures.values()])
            house.keep("gold", view.source, settle(gold(view.source).select(*[c for c in gold(view.source).columns if re.search(rf"\b{c}\b", asked)])))
        # a customer's view needs a customer: the first one of the data
        principal = gold(view.source).agg(F.min(view.owner)).first()[0] if view.owner else None
        return metric_query(view, gold, dimensions, list(view.measures), AS_OF, principal=principal)

    return run


for _name, _view in METRIC_VIEWS.items():
    _dims = [d.strip() for d in GROUPS[_name].split(",")]
    register(_name, _query(_view, _dims), _sql(_view, _dims))
