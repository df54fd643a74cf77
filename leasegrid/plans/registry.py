"""All registered queries and their SQL, collected from the modules of this package."""

from __future__ import annotations

from leasegrid.plans import analytics, extracting, more, outcome_queries, page_queries, payload_queries, property_api, records, rules, scalars, state, store_queries, template_queries, whole_rules

FLAGSHIP = "q_a08_stats"
MODULES = (property_api, analytics, state, scalars, extracting, more, payload_queries, template_queries, page_queries, store_queries, outcome_queries, rules, records, whole_rules)


def merged(modules) -> dict:
    """name -> (query, SQL) of all modules. No name may be in two of them, as one query would silently replace the other."""
    found: dict = {}
    for m in modules:
        if twice := sorted(found.keys() & m.ALL.keys()):
            raise ValueError(f"{m.__name__} registers again: {', '.join(twice)}")
        found |= m.ALL
    return found


def queries() -> dict:
    return {name: query for name, (query, _) in merged(MODULES).items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in merged(MODULES).items() if sql}
