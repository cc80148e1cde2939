"""Text expressions. All run inside the JVM."""

from __future__ import annotations

import string
from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# The characters that Python's str.strip() removes. Spark's trim() alone
# removes U+0020 only.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    """Unicode whitespace removed from both ends; null stays null."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def or_empty(c: str | Column) -> Column:
    return F.coalesce(_col(c), F.lit(""))


def is_nonempty(c: str | Column) -> Column:
    """Neither null nor ''; blanks count as text."""
    return or_empty(c) != ""


def is_nonblank(c: str | Column) -> Column:
    """Something is left after stripping."""
    return strip(or_empty(c)) != ""


def count_tokens(c: str | Column) -> Column:
    """Default token count: runs of characters other than ASCII whitespace.

    Any Column may take its place, e.g. a pandas UDF around the tokenizer of a model.
    """
    return F.regexp_count(or_empty(c), F.lit("\\S+")).cast("bigint")


def join_code(query: str | Column, document: str | Column) -> Column:
    """A code sample: the query, a blank line, the document."""
    return strip(F.concat(or_empty(query), F.lit("\n\n"), or_empty(document)))


def math_record(problem: str | Column, solution: str | Column) -> Column:
    """A tagged problem followed by its solution; null if either is blank."""
    p, s = strip(or_empty(problem)), strip(or_empty(solution))
    return F.when(
        (p != "") & (s != ""),
        F.concat(F.lit("<problem>"), p, F.lit("</problem>\n"), s),
    )


def fill_template(template: str, fields: Mapping[str, str | Column]) -> Column:
    """A `{field}` template as one concat(); unknown fields are an error."""
    pieces: list[Column] = []
    for literal, field, spec, conversion in string.Formatter().parse(template):
        if literal:
            pieces.append(F.lit(literal))
        if field is None:
            continue
        if spec or conversion:
            raise ValueError(f"format options are not supported in {template!r}")
        if field not in fields:
            raise KeyError(f"unknown template field {field!r}")
        pieces.append(or_empty(fields[field]))
    return F.concat(*pieces) if pieces else F.lit("")


def fill_one_of(templates: list[str], pick: Column, fields: Mapping[str, str | Column]) -> Column:
    """The template with number `pick`, filled."""
    if not templates:
        raise ValueError("no templates given")
    if len(templates) == 1:
        return fill_template(templates[0], fields)
    filled = F.when(pick == 0, fill_template(templates[0], fields))
    for i, template in enumerate(templates[1:], 1):
        filled = filled.when(pick == i, fill_template(template, fields))
    return filled
