"""Ordered removal rules: their default values, and their form for the JVM's patterns."""

from __future__ import annotations

import re

MONTHS = "january|february|march|april|may|june|july|august|september|october|november|december"
# The default rules, category after category in the order in which they run; (category, enabled, patterns).
DEFAULT_RULES: tuple[tuple[str, bool, tuple[str, ...]], ...] = (
    ("formatting_artifacts", True, (
        r"(?:\.\s+){3,}\.", r"(?:–\s+){3,}–", r"(?:•\s+){3,}•", r"(?:—\s+){3,}—", r"(?:-\s+){3,}-", r"(?:\d\s+){3,}\d", r"(?:[a-z]\s+){4,}[a-z]\s+[a-z]", r"(?:and,\s+){3,}and,?",
    )),
    ("administrative_metadata", True, (
        r"status:\s*in\s+progress\s+priority:\s*(?:high|medium|low)\s+target\s+date:.*?(?:quarter|\d{4})",
        r"(?:agreed|disagrees?)\s+with\s+the\s+board[''']?s\s+recommendation\s+that.*?(?=\.|\n)",
        r"expenditure\s+appropriation\s+adjustments\s+mandates\s+other\s+total\s+percentage\s+recosting\)?",
        rf"as\s+at\s+\d{{1,2}}\s+(?:{MONTHS})\s+\d{{4}}\s*\(thousands\s+of\s+united\s+states\s+dollars\)",
        r"statement\s+of\s+income\s+and\s+expenditure\s+and\s+changes\s+in\s+reserves\s+and\s+fund\s+balances",
        r"\(thousands\s+of\s+united\s+states\s+dollars\)",
        r"financial\s+resources\s+by\s+main\s+category\s+of\s+expenditure",
        r"(?:before\s+)?expenditure\s+appropriation\s+adjustments",
    )),
    ("procedural_references", True, (
        r"(?:the\s+)?advisory\s+committee\s+on\s+administrative\s+and\s+budgetary\s+(?:questions|matters)",
        r"report\s+of\s+the\s+secretary-general\s+on\s+the\s+work\s+of\s+the\s+organization",
        r"official\s+records\s+of\s+the\s+(?:general\s+assembly|economic\s+and\s+social\s+council),?\s*(?:thirty-first|thirty-second|thirty-third|[a-z\-]+)?\s*(?:session)?",
        r"by\s+the\s+general\s+assembly\s+in\s+its\s+resolution\s*(?:\d+)?",
        r"upon\s+enquiry,\s+the\s+advisory\s+committee\s+was\s+informed\s+that",
        rf"for\s+the\s+biennium\s+ended\s+\d{{1,2}}\s+(?:{MONTHS})\s+\d{{4}}",
        r"records\s+of\s+the\s+general\s+assembly,\s*(?:thirty-first|thirty-second|[a-z\-]+)?\s*session",
        r"progress\s+towards\s+the\s+attainment\s+of\s+the\s+objective,\s+and\s+performance\s+measure",
    )),
    ("standard_entity_names", False, (
        r"united\s+kingdom\s+of\s+great\s+britain\s+and\s+northern\s+ireland",
        r"economic\s+and\s+social\s+development\s+in\s+latin\s+america\s+and\s+the\s+caribbean",
        r"office\s+of\s+the\s+united\s+nations\s+high\s+commissioner\s+for\s+(?:refugees|human\s+rights)",
        r"least\s+developed\s+countries,\s+landlocked\s+developing\s+countries\s+and\s+small\s+island\s+developing",
        r"department\s+of\s+(?:peacekeeping\s+operations|economic\s+and\s+social\s+affairs)",
        r"general\s+assembly\s+and\s+economic\s+and\s+social\s+council\s+affairs\s+and\s+conference\s+management",
        r"office\s+for\s+the\s+coordination\s+of\s+humanitarian\s+affairs",
    )),
    ("opening_ceremonials", False, (
        r"(?:On behalf of the General Assembly|I have the honour to welcome)[^.!?]{0,250}[.!?]",
        r"(?:Allow me|I would like to|We would like to)\s+(?:at the outset|at the beginning)\s+to[^.!?]{0,250}congratulate[^.!?]{0,150}[.!?]",
        r"I would like to congratulate[^.!?]{0,250}[.!?]",
    )),
    ("procedural_markers", True, (
        r"(?:The\s+)?(?:President|Chair|Chairperson):\s+[^\n]{0,300}(?=\n)", r"(?:The President|The Chair):\s+[^\n]{0,300}(?=\n)",
    )),
    ("gratitude_sections", False, (
        r"I would like to thank[^.!?]{0,200}Secretary-General[^.!?]{0,150}[.!?]", r"I would also like to (?:congratulate|thank)[^.!?]{0,250}[.!?]", r"Thank you[^.!?]{0,100}(?:for your|for the)[^.!?]{0,150}[.!?]",
    )),
    ("document_references", True, (
        r"\((?:A|S|E)/[A-Z0-9/\.]+\)", r"\(see\s+(?:A|S|E)/[A-Z0-9/\.]+\)", r"\[.*?document.*?\]",
        r"\(\s*para(?:graph|\.)?s?\.?\s*\d+(?:\s*(?:and|to|\-|,)\s*\d+)*\s*(?:above|below|thereof)?\s*\)",
    )),
    ("speaker_attribution_lines", True, (
        r"^\s*(?:Mr\.|Mrs\.|Ms\.|Dr\.|Prof\.|His\s+Excellency|Her\s+Excellency|The\s+(?:President|Chair(?:person)?|Secretary(?:-General)?|Rapporteur|Observer|Representative))\s+[A-Z][A-Za-z\-']{1,30}(?:\s+[A-Z][A-Za-z\-']{1,30}){0,4}\s*(?:\([^)]{2,60}\))?\s*:\s*$",
        r"^\s*(?:The\s+)?(?:PRESIDENT|CHAIR|CHAIRPERSON|VICE-PRESIDENT|SECRETARY-GENERAL|RAPPORTEUR|REPRESENTATIVE|OBSERVER)(?:\s+\([^)]{2,60}\))?\s*:\s*$",
    )),
    ("document_bracket_refs", True, (
        r"\[(?:A|S|E|C|ST|DP)(?:\/[A-Z0-9\.\-]+){1,6}\]", r"\b(?:A|S|E|C)\/(?:RES|DEC|INF|AC|C|CONF|HRC|CN)\.?\s*\d+[A-Z]?(?:\/[A-Z0-9\.]+){0,4}\b",
    )),
    ("cross_reference_parentheticals", True, (
        r"\(\s*see\s+(?:para(?:graph|\.)?s?\.?|ann?ex(?:es)?|appendix|figure|table|section|chapter)\s+[A-Z0-9][A-Za-z0-9\.\-\s]{0,30}\)",
        r"\(\s*see\s+(?:above|below)\s*\)", r"\(\s*(?:ibid|id\.|op\.\s*cit\.|loc\.\s*cit\.)\s*(?:,\s*[^)]{0,30})?\)",
        r"\(\s*(?:spoke|speaking|statement|intervention)\s+(?:in|was\s+(?:made|delivered)\s+in)\s+(?:English|French|Spanish|Arabic|Russian|Chinese)\s*(?:;[^)]{0,30})?\)",
        r"\(\s*(?:The\s+)?(?:original|text)\s+(?:was\s+)?(?:in|is)\s+(?:English|French|Spanish|Arabic|Russian|Chinese)\s*\)",
        r"\(\s*(?:translation|interpreted|interpretation)\s+(?:from|by)[^)]{0,60}\)",
    )),
    ("allcaps_document_headers", False, (
        r"^\s*[A-Z][A-Z\s\-\/\.]{4,60}[A-Z]\s*$", r"^\s*(?:ANNEX|APPENDIX|SCHEDULE|ADDENDUM|CORRIGENDUM)\s+[IVX\d]+[\s\S]{0,80}?$",
    )),
    ("closing_statements", False, (
        r"In conclusion,[^.!?]{0,300}[.!?]", r"(?:Confidence and hope|All of us, as in a marriage)[^.!?]{0,300}[.!?]", r"The world's problems could be solved peacefully[^.!?]{0,300}[.!?]",
    )),
    ("ceremonial_phrases", True, (
        r"\*+[^*]{0,200}\*+", r"\n\s+[^\n]{0,200}\(spoke in (?:English|French|Spanish|Arabic)\)[^\n]{0,100}\n", r"Address/Statement recorded in .*?\)",
    )),
)
FLAGS = "(?ismUd)"


def survivable(pattern: str) -> str:
    r"""The same rule without recursion for each repetition, which overflows the JVM's stack on long leaders.

    (?:X\s+){n,}X becomes X(?:\s++X){n,}+ where X and white space have no
    character in common; other rules stay.
    """
    if pattern == r"(?:and,\s+){3,}and,?":
        return r"and,(?:(?:\s++and,){3,}+(?:\s+and)?|(?:\s++and,){2}\s+and)"
    m = re.fullmatch(r"\(\?:(\\?.|\\d|\[[^\]]+\])\\s\+\)\{(\d+),\}(.*)", pattern)
    if m:
        item, least, tail = m[1], int(m[2]), m[3]
        more = tail.count(item)
        if tail == r"\s+".join([item] * more):
            return rf"{item}(?:\s++{item}){{{least + more - 1},}}+"
    return pattern


def java(pattern: str) -> str:
    """A rule for the JVM: Unicode classes, any case, only line feeds end lines, no overflow."""
    return FLAGS + survivable(pattern)
