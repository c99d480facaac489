"""Heading scores of lines: a sum of rule weights in one projection."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomdoc.functions.text import WS, strip

# Rules, weights and bounds of the heading score. (?d): only \n ends a line, as in Python.
LEAST_CHARS, MOST_CHARS, THRESHOLD = 3, 220, 2.5
NOISE_FRACTION, NOISE_COUNT = 0.12, 40
_NUMBER = r"(\d+|[IVXLCDM]+)"
CSI = r"(?d)^\s*(SECTION|Section)\s+((?:\d{2}\s\d{2}\s\d{2})|(?:\d{6}))\b"
SECTION = r"(?d)^\s*(SECTION|Section)\s+\S+"
PART = rf"(?d)^\s*(PART|Part)\s+{_NUMBER}\s*[-–—]\s*(.+)$"
PART_ALONE = rf"(?d)^\s*(PART|Part)\s+{_NUMBER}\s*$"
DIVISION = rf"(?d)^\s*(DIVISION|Division)\s+{_NUMBER}\b"
OUTLINE = r"(?d)^\s*(\d{1,2}\.\d+(?:\.\d+)?)\s+(\S.{0,200})$"
OUTLINE_ALONE = r"(?d)^\s*(\d{1,2}\.\d+(?:\.\d+)?)\s*$"
ARTICLE = r"(?d)^\s*(ARTICLE|Article)\s+\d+"
#: How lines begin for which a rule other than caps can hold; caps alone stays below the threshold.
LEAD = rf"^{WS}*(?:SECTION|Section|PART|Part|DIVISION|Division|ARTICLE|Article|\d)"
WEIGHTS = {"csi": 6.0, "section": 3.5, "part": 5.5, "part_alone": 3.0, "division": 4.5, "outline": 3.5, "outline_alone": 2.0, "article": 4.0, "caps": 1.5}
REASONS = {
    "csi": "Matches CSI-style SECTION line (e.g. SECTION 09 65 00).",
    "section": "SECTION keyword with identifier (non-CSI).",
    "part": "Matches PART N - TITLE pattern.",
    "part_alone": "PART N without inline title (short line).",
    "division": "Matches DIVISION heading pattern.",
    "outline_alone": "Short numbered outline line (e.g. 1.0 / 1.1).",
    "article": "Matches ARTICLE N pattern.",
    "caps": "Short ALL CAPS line (weak heading signal).",
}


def _rules(s: Column) -> list[tuple[str, Column]]:
    n = F.length(s)
    csi, part, outline = s.rlike(CSI), s.rlike(PART), s.rlike(OUTLINE)
    caps = (n < 100) & (n > 6) & (F.upper(s) == s) & s.rlike(r"\A\p{ASCII}*\z") & s.rlike("[A-Z]") & ~s.endswith(".")
    return [
        ("csi", csi), ("section", ~csi & s.rlike(SECTION) & (n < 120)),
        ("part", part), ("part_alone", ~part & s.rlike(PART_ALONE)),
        ("division", s.rlike(DIVISION)),
        ("outline", outline), ("outline_alone", ~outline & s.rlike(OUTLINE_ALONE) & (n < 40)),
        ("article", s.rlike(ARTICLE)), ("caps", caps),
    ]


def heading_score(line: Column) -> Column:
    """The line's score, null where no rule holds or the line can't be a heading."""
    s = strip(line)
    total = sum((F.when(hit, WEIGHTS[name]).otherwise(0.0) for name, hit in _rules(s)), F.lit(0.0))
    able = F.length(s).between(LEAST_CHARS, MOST_CHARS) & ~s.contains("...")
    return F.when(able, F.nullif(total, F.lit(0.0)))


def heading_reasons(line: Column) -> Column:
    """The reasons of the rules that hold, in the rules' order; empty without a score."""
    s = strip(line)
    text = lambda name: F.concat(F.lit('Numbered outline with title ("'), F.regexp_extract(s, OUTLINE, 1), F.lit(' …").')) if name == "outline" else F.lit(REASONS[name])
    every = F.array_compact(F.array(*(F.when(hit, text(name)) for name, hit in _rules(s))))
    return F.when(heading_score(line).isNull(), F.array().cast("array<string>")).otherwise(every)


def is_heading(line: Column) -> Column:
    return F.coalesce(heading_score(line) >= THRESHOLD, F.lit(False))


def may_be_heading(line: Column) -> Column:
    """False for no line that is a heading; one short look instead of all rules."""
    return line.rlike(LEAD)
