"""Quality rules: a threshold table compiled into one projection of built-in functions.

``measures`` holds the counts of a text as column expressions and ``RULES`` the bounds on
their ratios. A rule reads ``least * denominator <= 100 * numerator <= most * denominator``
in whole numbers, so no rounding decides. Rules that need a usual amount of text name it
in ``words``; shorter texts pass them.

A null or empty text has no words and no lines: all counts are 0 and the length rule fails
it. Texts of any length are counted whole, row by row, with no shuffle, so repeated rows
and hot keys make no difference. Input columns that have the name of an output are replaced.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tristrata.llm.blocks import renamed, restored

WORD_GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"
#: Frequent function words of the four languages, in lower case.
STOP_WORDS = tuple(
    "the of and to in is that it for was on are be with as by at this or an "
    "le la les de des et en un une du que pour dans par sur est qui au avec pas "
    "der die das und zu den mit von ist nicht ein eine auf sich dem auch es im für "
    "el los las y una que con por para del se lo al su como más no".split()
)


@dataclass(frozen=True)
class Rule:
    """Bounds, in hundredths, on ``numerator / denominator`` for texts of ``words`` words."""

    name: str
    numerator: str
    denominator: str
    least: int | None = None
    most: int | None = None
    words: int = 0

    def fails(self, counts: dict[str, Column]) -> Column:
        scaled, whole = 100 * counts[self.numerator], counts[self.denominator]
        bad = F.lit(False)
        if self.least is not None:
            bad = bad | (scaled < self.least * whole)
        if self.most is not None:
            bad = bad | (scaled > self.most * whole)
        return bad & (counts["n_words"] >= self.words)


#: Fails whatever the other rules say.
BASE_RULES = (
    Rule("too_few_words", "n_words", "one", least=1000),
    Rule("repeats_words", "n_repeat_words", "n_words", most=20),
)
RULES = (
    Rule("word_length", "word_chars", "n_words", least=200, most=2000),
    Rule("symbols", "n_symbols", "n_words", most=25),
    Rule("repeated_lines", "n_dup_lines", "n_lines", most=30),
    Rule("stop_words", "n_stop_words", "n_words", least=3, words=40),
    Rule("marked_words", "n_marked_words", "n_words", most=50, words=20),
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once for each row."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column, window: int = 5) -> Column:
    """Words covered by windows of ``window`` words that a text has twice or more.

    Windows are sorted with their places, so equal ones are neighbours; sorting the places
    of those again shows how far each reaches before the next begins.
    """

    def counted(w: Column) -> Column:
        places = F.transform(
            F.sequence(F.lit(1), F.size(w) - (window - 1)),
            lambda i: F.struct(F.array_join(F.slice(w, i, window), " ").alias("w"), i.alias("i")),
        )
        return let(F.sort_array(places), covered)

    def covered(s: Column) -> Column:
        same = F.transform(
            s,
            lambda x, k: F.when(
                ((k > 0) & (x["w"] == F.get(s, k - 1)["w"]))
                | F.coalesce(x["w"] == F.get(s, k + 1)["w"], F.lit(False)),
                x["i"],
            ),
        )
        return let(F.sort_array(F.array_compact(same)), reach)

    def reach(p: Column) -> Column:
        gaps = F.transform(
            p, lambda x, k: F.least(F.lit(window), F.coalesce(F.get(p, k + 1) - x, F.lit(window)))
        )
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

    return F.when(F.size(words) > window, counted(words)).otherwise(F.lit(0)).cast("long")


MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_stop_words",
    "n_marked_words",
)


def measures(text: Column, words: Column, lines: Column) -> dict[str, Column]:
    """Counts of a text: ``words`` its words and ``lines`` its lines that have a word."""
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": repeated_words(words),
        "n_lines": F.size(lines).cast("long"),
        "n_stop_words": F.size(
            F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS))
        ).cast("long"),
        "n_marked_words": F.size(F.filter(words, lambda w: w.rlike("[|!#*<>{}]"))).cast("long"),
    }


def judge(
    df: DataFrame,
    text: str = "text",
    base: tuple[Rule, ...] = BASE_RULES,
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """``df`` with the counts, ``base_failed``, the names of ``failed`` rules and ``kept``."""
    outputs = (*MEASURES, "base_failed", "failed", "kept")
    others = [c for c in df.columns if c not in outputs]
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    words = F.array_remove(F.split(whole, WORD_GAP), "")
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    parts = F.struct(whole.alias("text"), words.alias("words"), lines.alias("lines"))
    split = renamed(df, others, parts=parts)
    found = measures(F.col("parts.text"), F.col("parts.words"), F.col("parts.lines"))
    counted = split.withColumns(found)
    counts = {"one": F.lit(1)} | {name: F.col(name) for name in found}
    failed = F.array_compact(
        F.array(*(F.when(r.fails(counts), F.lit(r.name)) for r in (*base, *rules)))
    )
    base_failed = F.lit(False)
    for rule in base:
        base_failed = base_failed | rule.fails(counts)
    judged = counted.withColumns(
        {"base_failed": base_failed, "failed": failed, "kept": F.size(failed) == 0}
    )
    return restored(judged, others, *outputs)


def judged_sql(table: str, text: str = "text") -> str:
    """The same for DuckDB, with ``doc_id`` and the counts, for comparison in tests."""
    conditions = {r.name: sql_condition(r) for r in (*BASE_RULES, *RULES)}
    base = " OR ".join(conditions[r.name] for r in BASE_RULES)
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce({text}, '') AS t,
    list_filter(regexp_split_to_array(coalesce({text}, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce({text}, ''), chr(10)),
                lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM {table}),
places AS (
  SELECT doc_id, len(w) AS n, unnest(range(1, len(w) - 3)) AS i, w FROM d WHERE len(w) > 5),
wins AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS s FROM places),
twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM wins),
gaps AS (
  SELECT doc_id, least(5, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 5)) AS g
  FROM twice WHERE c > 1),
repeated AS (SELECT doc_id, sum(g) AS r FROM gaps GROUP BY doc_id),
m AS (
  SELECT d.doc_id, 1 AS one, len(w)::BIGINT AS n_words,
    length(array_to_string(w, ''))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    coalesce(r, 0)::BIGINT AS n_repeat_words,
    len(l)::BIGINT AS n_lines,
    len(list_filter(w, lambda x: lower(x) IN ({stop})))::BIGINT AS n_stop_words,
    len(list_filter(w, lambda x: regexp_matches(x, '[|!#*<>{{}}]')))::BIGINT AS n_marked_words
  FROM d LEFT JOIN repeated USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_stop_words, n_marked_words, ({base}) AS base_failed,
  NOT ({" OR ".join(conditions.values())}) AS kept
FROM m"""


def sql_condition(rule: Rule) -> str:
    bounds = []
    if rule.least is not None:
        bounds.append(f"100 * {rule.numerator} < {rule.least} * {rule.denominator}")
    if rule.most is not None:
        bounds.append(f"100 * {rule.numerator} > {rule.most} * {rule.denominator}")
    return f"(({' OR '.join(bounds)}) AND n_words >= {rule.words})"
