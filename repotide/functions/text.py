"""Line measures of whole texts as regular expressions inside the JVM.

Counting rules. A line ends at a newline; a newline at the very end opens no
further line, and the empty text has no line. A line is

* code, if anything but blanks stands outside its comments;
* a comment, if it is no code and a comment covers any part of it, so a blank
  line inside a block comment is a comment;
* blank otherwise.

A line comment starts only where its marker is the first thing on a line that
does not begin inside a block comment. An unclosed block runs to the end.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repotide.schemas import MEASURES


@dataclass(frozen=True)
class CommentRule:
    line: tuple[str, ...] = ()
    block: tuple[tuple[str, str], ...] = ()


C_LIKE = CommentRule(line=("//",), block=(("/*", "*/"),))
HASH = CommentRule(line=("#",))
MARKUP = CommentRule(block=(("<!--", "-->"),))
PLAIN = CommentRule()

RULES = {
    "c": C_LIKE,
    "c++": C_LIKE,
    "go": C_LIKE,
    "html": MARKUP,
    "java": C_LIKE,
    "javascript": C_LIKE,
    "markdown": MARKUP,
    "php": CommentRule(line=("//", "#"), block=(("/*", "*/"),)),
    "plain text": PLAIN,
    "python": HASH,
    "ruby": HASH,
    "rust": C_LIKE,
    "shell": HASH,
    "sql": CommentRule(line=("--",), block=(("/*", "*/"),)),
    "typescript": C_LIKE,
    "xml": MARKUP,
    "yaml": HASH,
}

_BLANK = r" \t\r\f\x0B"
_MARK = "\u0001"
_CODE_LINE = rf"(?md)^[{_BLANK}\x01]*[^{_BLANK}\x01\n]"
_COMMENT_LINE = rf"(?md)^[{_BLANK}]*\x01[{_BLANK}\x01]*$"


def _comment_pattern(rule: CommentRule) -> str | None:
    """All comments of a rule; a block's first inner newline is its group."""
    branches = []
    if rule.line:
        markers = "|".join(rf"\Q{marker}\E" for marker in rule.line)
        branches.append(rf"^[{_BLANK}]*(?:{markers})[^\n]*")
    for opening, closing in rule.block:
        end = rf"(?:\Q{closing}\E|\z)"
        branches.append(rf"\Q{opening}\E[^\n]*?(?:{end}|(\n).*?{end})")
    return f"(?msd)(?:{'|'.join(branches)})" if branches else None


def _mask(body: Column, rule: CommentRule) -> Column:
    """Replace each comment by a mark, and by two marked lines if it spans lines."""
    pattern = _comment_pattern(rule)
    clean = F.replace(body, F.lit(_MARK), F.lit("x"))
    if pattern is None:
        return clean
    kept = "".join(f"${i + 1}" for i in range(len(rule.block)))
    return F.regexp_replace(clean, pattern, f"{_MARK}{kept}{_MARK}")


def _newlines(text: Column) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))


def measure_texts(
    df: DataFrame,
    text: str,
    rule: CommentRule | None = None,
    language: str | None = None,
) -> DataFrame:
    """Add the five measures of the ``text`` column.

    Either one ``rule`` holds for all rows, or ``language`` names the column
    that picks it from ``RULES`` (unknown languages have no comments).
    """
    whole = F.col(text)
    body = F.when(
        whole.endswith("\n"), whole.substr(F.lit(1), F.length(whole) - 1)
    ).otherwise(whole)
    if language is None:
        masked = _mask(body, rule or PLAIN)
    else:
        name = F.lower(F.col(language))
        by_rule: dict[CommentRule, list[str]] = {}
        for known, its_rule in RULES.items():
            by_rule.setdefault(its_rule, []).append(known)
        masked = None
        for its_rule, names in by_rule.items():
            branch = (name.isin(names), _mask(body, its_rule))
            masked = F.when(*branch) if masked is None else masked.when(*branch)
        masked = masked.otherwise(_mask(body, PLAIN))

    open_end = F.when((whole == "") | whole.endswith("\n"), 0).otherwise(1)
    staged = df.select(
        "*",
        body.alias("_body"),
        masked.alias("_masked"),
        (_newlines(whole) + open_end).cast("long").alias("_lines"),
    )
    counted = staged.select(
        "*",
        F.regexp_count("_masked", F.lit(_CODE_LINE)).cast("long").alias("_code"),
        (
            F.regexp_count("_masked", F.lit(_COMMENT_LINE))
            + _newlines(F.col("_body"))
            - _newlines(F.col("_masked"))
        )
        .cast("long")
        .alias("_comments"),
    )
    measures = {
        "lines": F.col("_lines"),
        "code": F.col("_code"),
        "comments": F.col("_comments"),
        "blanks": F.col("_lines") - F.col("_code") - F.col("_comments"),
        "bytes": F.octet_length(whole).cast("long"),
    }
    return counted.select(
        *[F.col(name) for name in df.columns],
        *[measures[name].alias(name) for name in MEASURES],
    )
