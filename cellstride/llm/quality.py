"""Quality rules on lines first, then on documents, in built-in functions only."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import common

# Symbols the contract counts, marks that running prose seldom holds, separators of menus,
# marks that end or part sentences, words that menus begin with, phrases of notices.
SYMBOLS = r"[#*$%&|<>]"
ODD_MARKS = r"[!#$%&*+/<=>@^_{|}~]"
SEPARATORS = r"[|»›•·→]"
SENTENCE_MARKS = r"[.!?…:;,。！？、，：；।؟]"
MENU = (r"(?i)^[\x20\x09-\x0D]*(home|menu|log ?in|log ?out|sign (in|up)|register|next|previous|skip to|back to top|"
        r"share|tweet|print|read more|click here|search|contact us|about us|sitemap)\b")
NOTICE = (r"(?i)(?:^|\P{L})(cookies? (policy|settings)|uses cookies|privacy policy|terms of (use|service)|all rights reserved|"
          r"\(c\) [0-9]{4}|copyright|©|licensed under|released under the|enable javascript|lorem ipsum|powered by|"
          r"subscribe to|sign up for)")

RULES = ("punctuation", "navigation", "boilerplate")


@dataclass(frozen=True)
class Rules:
    """Thresholds of the line rules (a line needs ``least`` words for shares) and of the documents'.

    A line fails by *punctuation* if more than ``odd_percent`` of its characters in words are odd marks, or if it
    has ``unmarked`` words or more and no sentence mark; by *navigation* if separators stand between its words (two
    or more, at least one to ``words_per_separator`` words), or if it has at most ``menu_words`` words, begins like
    a menu and has no sentence mark; by *boilerplate* if it has at most ``notice_words`` words and a phrase of
    notices, or if it equals an earlier line.  A document is rejected if the failed lines hold more than ``lost_percent`` of
    its characters in words.
    """

    least: int = 4
    odd_percent: int = 15
    unmarked: int = 30
    words_per_separator: int = 4
    menu_words: int = 8
    notice_words: int = 30
    lost_percent: int = 40
    min_words: int = 50
    repeat_percent: int = 50


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body's lambdas refer to it."""
    return F.transform(F.array(value), body)[0]


def _words(text: Column) -> Column:
    return F.filter(F.split(text, common.SPACE, -1), lambda w: w != "")


def _count_marks(text: Column, marks: str) -> Column:
    return F.regexp_count(text, F.lit(marks))


def _sum(items: Column, value: Callable[[Column], Column]) -> Column:
    return F.aggregate(items, F.lit(0).cast("long"), lambda total, item: total + value(item))


def repeated_words(words: Column) -> Column:
    """How many words stand in a three-word window that the list holds twice or more.

    The windows are sorted with their positions, so equal ones are neighbours; no window is compared with all others.
    Texts whose windows all differ in their hashes, which is most of them, are told by the hashes alone.
    """
    def hashes(w: Column) -> Column:
        return F.transform(F.slice(w, 1, F.size(w) - 2), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))

    def windows(w: Column) -> Column:
        return F.transform(F.slice(w, 1, F.size(w) - 2), lambda x, i: F.struct(
            F.concat_ws(" ", x, F.get(w, i + 1), F.get(w, i + 2)).alias("window"), i.alias("at")))

    def positions(s: Column) -> Column:
        pairs = F.zip_with(F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s) - 1), lambda a, b: F.when(
            a["window"] == b["window"], F.array(a["at"], b["at"])).otherwise(F.array().cast("array<int>")))
        return F.sort_array(F.array_distinct(F.flatten(pairs)))

    def covered(p: Column) -> Column:
        steps = F.zip_with(F.slice(p, 1, F.size(p) - 1), F.slice(p, 2, F.size(p) - 1),
                           lambda a, b: F.least(b - a, F.lit(3)))
        return F.when(F.size(p) > 0, _sum(steps, lambda n: n) + 3).otherwise(F.lit(0).cast("long"))

    def counted(w: Column) -> Column:
        some = _let(hashes(w), lambda h: F.size(F.array_distinct(h)) < F.size(h))
        return F.when((F.size(w) >= 3) & some, _let(F.sort_array(windows(w)), lambda s: _let(positions(s), covered)))

    return F.coalesce(_let(words, counted), F.lit(0).cast("long"))


def _checked_lines(text: Column, rules: Rules) -> Column:
    """Every line with a word, sorted by content: at, line, chars, and the rule it fails (null: none)."""
    numbered = F.filter(F.transform(F.split(text, "\n", -1), lambda line, i: F.struct(
        line.alias("line"), i.alias("at"))), lambda x: x["line"].rlike(common.WORD))

    def judged(x: Column, before: Column) -> Column:
        line = x["line"]

        def verdict(c: Column) -> Column:
            n, chars, sentence = c["n"], c["chars"], line.rlike(SENTENCE_MARKS)
            repeated = F.coalesce(before["line"] == line, F.lit(False))
            failed = (
                F.when((n >= rules.least) & (100 * _count_marks(line, ODD_MARKS) > rules.odd_percent * chars), "punctuation")
                .when((n >= rules.unmarked) & ~sentence, "punctuation")
                .when(_let(_count_marks(line, SEPARATORS), lambda k: (k >= 2) & (rules.words_per_separator * k >= n)), "navigation")
                .when((n <= rules.menu_words) & ~sentence & line.rlike(MENU), "navigation")
                .when(repeated | ((n <= rules.notice_words) & line.rlike(NOTICE)), "boilerplate"))
            return F.struct(x["at"].alias("at"), line.alias("line"), chars.alias("chars"), repeated.alias("repeated"),
                            failed.alias("failed"))

        counts = F.struct(F.size(_words(line)).alias("n"),
                          F.length(F.regexp_replace(line, common.SPACE, "")).alias("chars"))
        return _let(counts, verdict)

    def with_neighbour(s: Column) -> Column:
        # The neighbour before a line in sorted order: its equal that comes earlier in the text, if there is one.
        return F.transform(s, lambda x, i: judged(x, F.when(i > 0, F.get(s, i - 1))))

    return _let(F.sort_array(numbered), with_neighbour)


def _failing(bad: Column, rule: str) -> Column:
    return F.size(F.filter(bad, lambda x: x["failed"] == rule))


def assess(df: DataFrame, text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """``df`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_failed_lines, lost_chars,
    failures (rule to number of lines), clean_text, base_failed and kept.

    Lines come first: each is judged alone and the failing ones leave ``clean_text``; a document is rejected
    if it fails a base rule (too few words, too many of them in repeated windows) or if its failed lines hold too much of it.
    All of it is arithmetic on one row, so nothing is shuffled and no document waits for another.

    A null text counts as empty: no words, base_failed, not kept, clean_text empty.  Texts of white space likewise.
    Repeated rows are judged alike; ties do not arise.  Other columns of ``df`` stay; those with the names above are replaced.
    A text is held by one task in full, several times its size.  An empty table gives an empty result.
    """
    own = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_failed_lines",
           "lost_chars", "failures", "clean_text", "base_failed", "kept"]
    text = F.col("text")
    rest = common.without(df, *own).columns
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row") if rest else F.lit(None).alias("row"),
                     F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    split = rows.select("row", "text", _words(text).alias("words"),
                        _checked_lines(text, rules).alias("lines"))
    long = lambda c: c.cast("long")
    failed = F.filter("lines", lambda x: x["failed"].isNotNull())
    good = F.sort_array(F.transform(F.filter("lines", lambda x: x["failed"].isNull()),
                                    lambda x: F.struct(x["at"], x["line"])))
    counted = split.select(
        "row", long(F.size("words")).alias("n_words"),
        long(F.length(F.regexp_replace("text", common.SPACE, ""))).alias("word_chars"),
        long(_count_marks(text, SYMBOLS)).alias("n_symbols"),
        long(F.size(F.filter("lines", lambda x: x["repeated"]))).alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        long(F.size("lines")).alias("n_lines"), failed.alias("bad"),
        F.array_join(F.transform(good, lambda x: x["line"]), "\n").alias("clean_text"))
    told = counted.select(
        "*", long(F.size("bad")).alias("n_failed_lines"), _sum(F.col("bad"), lambda x: x["chars"]).alias("lost_chars"),
        F.map_from_arrays(F.array(*[F.lit(r) for r in RULES]), F.array(*[_failing(F.col("bad"), r) for r in RULES])).alias("failures"),
        ((F.col("n_words") < rules.min_words)
         | (100 * F.col("n_repeat_words") > rules.repeat_percent * F.col("n_words"))).alias("base_failed"))
    kept = ~F.col("base_failed") & (100 * F.col("lost_chars") <= rules.lost_percent * F.col("word_chars"))
    return told.select(*[F.col("row")[c].alias(c) for c in rest], *own[:-1], kept.alias("kept"))


def clean(df: DataFrame, text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """The documents that pass, their text without its failed lines; the columns of ``df``, rules for cases as in ``assess``."""
    found = assess(df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("whole"),
                             F.col(f"`{text_col}`").alias("text")), "text", rules).where("kept")
    return found.select(*[F.col("clean_text").alias(c) if c == text_col else F.col("whole")[c].alias(c) for c in df.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = assess(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                        "kept", "n_lines", "n_failed_lines", "lost_chars")


def _sql(rules: Rules = Rules()) -> str:
    space, word = common.SPACE, common.WORD

    def marks(x: str, which: str) -> str:
        return f"len(regexp_extract_all({x}, '{which}'))"

    return rf"""
WITH t AS (SELECT row_number() OVER () AS mark, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT mark, regexp_extract_all(text, '{word}') AS words FROM t),
p AS (SELECT mark, unnest(words) AS word, unnest(range(len(words))) AS pos FROM w),
tri AS (SELECT mark, pos, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o AS win
        FROM p WINDOW o AS (PARTITION BY mark ORDER BY pos)),
rep AS (SELECT mark, pos FROM (SELECT mark, pos, win, count(*) OVER (PARTITION BY mark, win) AS n FROM tri) WHERE win IS NOT NULL AND n > 1),
cov AS (SELECT mark, count(DISTINCT pos + k) AS n_repeat_words FROM rep, (SELECT unnest([0, 1, 2]) AS k) GROUP BY mark),
l AS (SELECT mark, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM (SELECT mark, string_split(text, chr(10)) AS lines FROM t)),
c AS (SELECT mark, line, len(regexp_extract_all(line, '{word}')) AS n, length(regexp_replace(line, '{space}', '', 'g')) AS chars,
        regexp_matches(line, '{SENTENCE_MARKS}') AS sentence, {marks('line', ODD_MARKS)} AS odd, {marks('line', SEPARATORS)} AS seps,
        row_number() OVER (PARTITION BY mark, line ORDER BY pos) > 1 AS repeated
      FROM l WHERE regexp_matches(line, '{word}')),
j AS (SELECT mark, chars, repeated, (n >= {rules.least} AND 100 * odd > {rules.odd_percent} * chars) OR (n >= {rules.unmarked} AND NOT sentence)
        OR (seps >= 2 AND {rules.words_per_separator} * seps >= n)
        OR (n <= {rules.menu_words} AND NOT sentence AND regexp_matches(line, '{MENU}'))
        OR repeated OR (n <= {rules.notice_words} AND regexp_matches(line, '{NOTICE}')) AS failed FROM c),
f AS (SELECT mark, count(*) AS n_lines, count(*) FILTER (failed) AS n_failed_lines, count(*) FILTER (repeated) AS n_dup_lines,
        coalesce(sum(chars) FILTER (failed), 0)::BIGINT AS lost_chars FROM j GROUP BY mark),
b AS (SELECT doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(text, '{space}', '', 'g'))::BIGINT AS word_chars,
        {marks('text', SYMBOLS)}::BIGINT AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, coalesce(n_failed_lines, 0) AS n_failed_lines,
        coalesce(lost_chars, 0) AS lost_chars
      FROM t JOIN w USING (mark) LEFT JOIN cov USING (mark) LEFT JOIN f USING (mark))
SELECT *, n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.repeat_percent} * n_words AS base_failed,
  NOT (n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.repeat_percent} * n_words)
    AND 100 * lost_chars <= {rules.lost_percent} * word_chars AS kept FROM b
"""


SQL = _sql()
