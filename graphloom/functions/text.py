"""Text expressions: tags, record fields, cleaning.  All stay on the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The labels of the vote codes.
VOTE_TYPES = {
    2: "UpVote",
    3: "DownVote",
    4: "Favorite",
    5: "Close",
    6: "Reopen",
    7: "BountyStart",
    8: "BountyClose",
    9: "Deletion",
    10: "Undeletion",
    11: "Spam",
    12: "InformModerator",
}
UNKNOWN_VOTE = "Unknown"

# Where each field of a paper record starts and what it holds.
# (?d) makes only \n end a line and (?U) lets \s cover Unicode spaces.
RECORD_PATTERNS = {
    "paper": r"Paper:\s*(.*)",
    "from": r"From:\s*([^<]*)<",
    "date": r"Date:\s*(.*)(\s*)(\(\d+kb\))",
    "title": r"Title:\s*(.*)",
    "authors": r"Authors:\s*(.*)",
    "comments": r"Comments:\s*(.*)",
    "report_no": r"Report-no:\s*(.*)",
    "journal_ref": r"Journal-ref:\s*(.*)",
    "abstract": r"(?s)Journal-ref:[^\\\\]*\\\\[\n\s]*(.*?)(?=\\\\)",
}
_TRIMMED = ("from", "date", "abstract")


def vote_type(code: str) -> Column:
    """Label of a vote code; a code outside the table is Unknown."""
    table = F.create_map(*[F.lit(x) for pair in VOTE_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.col(code).cast("int")), F.lit(UNKNOWN_VOTE))


def split_pipe_tags(col: str) -> Column:
    """``|a|b|`` to [a, b].  NULL stays NULL and '' becomes ['']."""
    return F.split(F.regexp_replace(F.col(col), r"^\||\|$", ""), r"\|")


def angle_tags(col: str) -> Column:
    """``<a><b>`` to [a, b]; NULL or '' gives an empty list."""
    return F.coalesce(F.regexp_extract_all(F.col(col), F.lit("<([^>]+)>"), F.lit(1)), F.array().cast("array<string>"))


def record_field(record: str, field: str) -> Column:
    """One field of a free-text record: NULL where absent, '' where present but empty."""
    pattern = "(?d)(?U)" + RECORD_PATTERNS[field]
    found = F.regexp_extract(F.col(record), pattern, 1)
    if field == "abstract":
        found = F.replace(F.replace(found, F.lit("\n"), F.lit(" ")), F.lit("  "), F.lit(" "))
    if field in _TRIMMED:
        found = F.regexp_replace(found, r"(?U)^\s+|\s+$", "")
    return F.when(F.col(record).rlike(pattern), found)


def paper_id(paper: str) -> Column:
    """Integer after the last slash; NULL when it is no integer."""
    return F.substring_index(F.col(paper), "/", -1).try_cast("bigint")


def letters_only(col: str) -> Column:
    """Keep letters and full stops, then drop the last character."""
    kept = F.trim(F.regexp_replace(F.col(col), "[^a-zA-Z.]", ""))
    return F.substring(kept, F.lit(1), F.greatest(F.length(kept) - 1, F.lit(0)))


def zero_if_blank(col: str) -> Column:
    """Blank or NULL text to 0, else the integer."""
    return F.coalesce(F.nullif(F.col(col), F.lit("")).cast("bigint"), F.lit(0))


def is_blank(col: str) -> Column:
    """NULL or nothing but white space."""
    return F.coalesce(F.col(col).rlike(r"^\s*$"), F.lit(True))


def missing_to_zero(col: str) -> Column:
    """NULL, 'null' and '' all count as missing and become '0'."""
    return F.when(F.col(col).isNull() | F.col(col).isin("null", ""), F.lit("0")).otherwise(F.col(col))
