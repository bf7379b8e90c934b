"""The declared source rules, by family: rows, groups, references, populations, files."""

from ledgerstone.operators.rules.rows import ROW_RULES, row_rule, violations  # noqa: F401
from ledgerstone.operators.rules.groups import GROUP_RULES  # noqa: F401
from ledgerstone.operators.rules.references import REFERENCE_RULES, Reference, judged  # noqa: F401
from ledgerstone.operators.rules.populations import POPULATION_RULES  # noqa: F401
from ledgerstone.operators.rules.files import FILE_RULES, SCHEMA_RULES  # noqa: F401
