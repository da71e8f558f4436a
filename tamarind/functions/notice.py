"""The text of an award notice as typed fields, in plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The labels of a notice, and for each field its label and the labels that may follow it.
BLOCKS = {
    "official_name": ("Official name:", ["Postal address:", "SECTION "]),
    "postal_address": ("Postal address:", ["SECTION "]),
    "title": ("TITLE:", ["Tender Reference Number:"]),
    "name_of_contractor": ("Name of contractor (1)", ["PPC Category Code and Titles"]),
    "ppc_category_code_and_title": ("PPC Category Code and Titles (1)", ["CPV codes (1)"]),
    "cpv_codes": ("CPV codes (1)", ["Contract price (1)"]),
    "contract_price_raw": ("Contract price (1)", ["Level of Competition"]),
    "principal_site_of_performance": ("Principal site of performance", ["Commencement date", "Contract award date", "SECTION ", "DATE OF DISPATCH"]),
    "justification": ("Specify the Emergency or Extreme urgency of the award", ["DATE OF DISPATCH OF THIS NOTICE:"]),
}
# Fields of one line, with the label in front of it.
LINES = {
    "funding_source": "Funding Source:", "level_of_competition": "Level of Competition\n", "funding_providers": "Funding Providers:\n",
    "duration": "Duration\n",
}
# Dates, which end with their line or a bracket.
DATES = {
    "contract_award_date": "Contract award date\nDate:", "commencement_date": "Commencement date\nDate:",
    "date_of_dispatch_of_notice": "DATE OF DISPATCH OF THIS NOTICE:",
}
LISTS = ("ppc_category_code_and_title", "cpv_codes")
#: What a blank line's place is taken by: the number of the page, or the next label.
_NO_VALUE = {"level_of_competition": r"^\d+\s*/\s*\d+$|^(?:Funding Source:|Funding Providers:|Contract award|Contract Award|SECTION\b|DATE OF)", "funding_providers": "^Contract award date\\b", "duration": r"^SECTION\b"}


def _quoted(label: str) -> str:
    return "".join(r"\s*\n" if c == "\n" else rf"\{c}" if c in "().:" else c for c in label)


def _filled(c: Column) -> Column:
    return F.nullif(F.regexp_replace(c, r"^\s+|\s+$", ""), F.lit(""))


def notice_fields(text: Column) -> dict[str, Column]:
    """Each field of a notice by name; null where the label is missing or nothing stands behind it.

    Lists are arrays of their lines without blank ones. A field ends with a label that may follow it, or with the text; a field
    whose place is taken by another label or by a page number is null.
    """
    t = F.regexp_replace(text, "\r\n", "\n")
    out: dict[str, Column] = {}
    for name, (label, stops) in BLOCKS.items():
        ends = "|".join(_quoted(s) for s in stops)
        got = _filled(F.regexp_extract(t, rf"(?s){_quoted(label)}\s*(.*?)(?=\n(?:{ends})|\z)", 1))
        # the label of the next field right behind this one's: nothing was filled in
        got = F.when(~got.rlike(rf"^(?:{ends})"), got)
        out[name] = F.filter(F.transform(F.split(got, "\n"), lambda x: F.trim(x)), lambda x: x != "") if name in LISTS else got
    for name, label in LINES.items():
        got = _filled(F.regexp_extract(t, rf"{_quoted(label)}[ \t]*([^\n]*)", 1))
        out[name] = F.when(~got.rlike(_NO_VALUE[name]), got) if name in _NO_VALUE else got
    for name, label in DATES.items():
        out[name] = _filled(F.regexp_extract(t, rf"{_quoted(label)}\s*([^\n(]*)", 1))
    out["tender_reference_number"] = _filled(F.regexp_extract(t, r"Tender Reference Number:\s*(\S+)", 1))
    out["contract_award_criteria"] = _filled(F.regexp_extract(t, r"Contract Award Criteria\s+([A-Z][A-Z0-9/\-]+)", 1))
    priced = r"([\d,]+\.?\d*)\s*Currency:\s*(\w+)"
    out["contract_price_amount"] = _filled(F.regexp_replace(F.regexp_extract(out["contract_price_raw"], priced, 1), ",", ""))
    out["contract_price_currency"] = _filled(F.regexp_extract(out["contract_price_raw"], priced, 2))
    return out
