"""Line measures against a character-by-character count."""

from __future__ import annotations

import random

import pytest

from repotide.functions.text import C_LIKE, HASH, MARKUP, PLAIN, RULES, CommentRule, measure_texts
from repotide.schemas import MEASURES

BLANK = " \t\r\f\x0b"


def count(text, rule):
    """Walk the text once; remember for each line whether code or comment was seen."""
    lines = text.split("\n")
    if lines[-1] == "":
        lines.pop()
    closing, totals = None, {"code": 0, "comments": 0, "blanks": 0}
    for line in lines:
        code, comment, at = False, closing is not None, 0
        stripped = line.lstrip(BLANK)
        if closing is None and rule.line and stripped.startswith(rule.line):
            comment, at = True, len(line)
        while at < len(line):
            if closing is not None:
                end = line.find(closing, at)
                if end < 0:
                    break
                at, closing = end + len(closing), None
                continue
            opened = next((pair for pair in rule.block if line.startswith(pair[0], at)), None)
            if opened:
                comment, closing, at = True, opened[1], at + len(opened[0])
                continue
            code = code or line[at] not in BLANK
            at += 1
        totals["code" if code else "comments" if comment else "blanks"] += 1
    return (len(lines), totals["code"], totals["comments"], totals["blanks"], len(text.encode()))


def measured(spark, texts, **how):
    df = spark.createDataFrame(list(enumerate(texts)), "k long, body string")
    rows = measure_texts(df, "body", **how).orderBy("k").collect()
    return [tuple(r[m] for m in MEASURES) for r in rows]


def test_worked_examples(spark):
    texts = ["<p>\n<!-- a\n\nb -->\n\nx <!-- c --> y\n", "", "<!-- one -->\n  \ncode"]
    assert [row[:4] for row in measured(spark, texts, rule=MARKUP)] == [(6, 2, 3, 1), (0, 0, 0, 0), (3, 1, 1, 1)]


FIXED = [
    "\n", "\n\n", " \t\r\n", "a\r\n\r\nb\r\n", "äöü\n€", "\x01\n", "/* a\n", "/* a\n\n", "// x /* y\nz */ w\n",
    "a /* b */ // c /* d\ne */ f", "/**/\n/* /* */ x */\n", "#!x\n # y\n\x0b#z\n//w", "-->\n<!--\n-->", "/*\n*/",
    " \n\u0085x\n", "no newline",
]


@pytest.mark.parametrize("rule", [C_LIKE, HASH, MARKUP, PLAIN, RULES["php"], CommentRule(("--",), (("/*", "*/"), ("{", "}")))])
def test_random_texts(spark, rule):
    rng = random.Random(11)
    pieces = ["\n", "\n", "\r\n", " ", "\t", "x", "ä", "//", "#", "--", "/*", "*/", "<!--", "-->", "{", "}", "*", "/", "\x0b"]
    texts = FIXED + ["".join(rng.choices(pieces, k=rng.randrange(40))) for _ in range(1500)]
    got = measured(spark, texts, rule=rule)
    wrong = [(t, g, count(t, rule)) for t, g in zip(texts, got) if g != count(t, rule)]
    assert wrong[:3] == []


def test_language_column_picks_the_rule(spark):
    text = "# a\n// b\n<!-- c -->\n"
    names = ["Python", "Java", "HTML", "unheard of", None]
    df = spark.createDataFrame([(n, text) for n in names], "lang string, body string")
    rows = measure_texts(df, "body", language="lang").collect()
    assert [(r.lang, r.code, r.comments) for r in rows] == [
        ("Python", 2, 1), ("Java", 2, 1), ("HTML", 2, 1), ("unheard of", 3, 0), (None, 3, 0),
    ]


def test_long_lines_and_long_comments(spark):
    texts = ["x" * 2_000_000, "<!--" + "a\n" * 500_000 + "-->", " " * 300_000 + "\n" + "<!-- " * 100_000]
    assert measured(spark, texts, rule=MARKUP) == [count(t, MARKUP) for t in texts]
