"""Named queries and their SQL."""

from tamarind.plans import dealt, records, reference  # noqa: F401  (records adds its queries to those of reference)


def queries() -> dict:
    return {**reference.QUERIES, **dealt.queries()}


def oracle_sql() -> dict:
    return {**reference.SQL, **dealt.oracle_sql()}
