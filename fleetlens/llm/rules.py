"""Quality rules: a table of thresholds, compiled into one projection of column expressions.

A rule bounds the quotient of two measures of a text, as cross products of whole numbers, so no
division and no rounding decides. Measures count words, characters, symbols, stop words and lines. Everything
is SQL expressions over the row; nothing is shuffled, and no function of the user runs.

`bound` binds an expression to a lambda variable, so a value that is used several times (the words, the
sorted windows) is computed once wherever the optimiser moves the projection.

Defined results: a null text has no words and fails the base rules, as do an empty text and one of spaces.
Repeated rows are judged each for itself; rows without an id too; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
MARKS = ".,;:!?"

# Frequent function words of four languages.
STOP_WORDS = (
    "a and are as at be by for from he in is it of on or that the this to was were which with "
    "aber als auch auf aus bei das dem den der des die ein eine er für im ist mit nicht sich sie und von zu "
    "au avec ce dans de des du elle en est et il la le les ne ou par pas pour que qui sur un une "
    "al como con del el ella en es la las lo los más no para pero por que se su un una y"
).split()


@dataclass(frozen=True)
class Rule:
    """Fails a text where measure / by lies below `least` or above `most` (whole parts of `of`)."""

    name: str
    measure: str
    by: str | None = None
    least: int | None = None
    most: int | None = None
    of: int = 100


#: The base rules decide `base_failed`.
BASE_RULES = (
    Rule("few_words", "n_words", least=50, of=1),
    Rule("repeated_windows", "n_repeat_words", "n_words", most=50),
)

RULES = (
    Rule("short_words", "word_chars", "n_words", least=200),
    Rule("long_words", "word_chars", "n_words", most=1500),
    Rule("symbols", "n_symbols", "n_words", most=10),
    Rule("repeated_lines", "n_dup_lines", "n_lines", most=50),
    Rule("marked_lines", "n_marked_lines", "n_lines", most=90),
    Rule("no_stop_words", "n_stop_words", "n_words", least=1),
    Rule("few_letters", "n_letter_words", "n_words", least=60),
)

BASE_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MEASURES = (*BASE_MEASURES, "n_lines", "n_marked_lines", "n_stop_words", "n_letter_words")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, SPACES[1:], " " * (len(SPACES) - 1)), " "), "")


def lines_of(text: Column) -> Column:
    """The lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda line: F.trim(line, F.lit(SPACES)) != "")


def _count(column: Column) -> Column:
    return F.size(column).cast("long")


def _pairs(sorted_windows: Column) -> Column:
    """Places of equal neighbours among sorted (window, place)."""
    following = F.slice(sorted_windows, F.lit(2), F.size(sorted_windows))
    pairs = F.zip_with(sorted_windows, following, lambda a, b: F.when(a["gram"] == b["gram"], F.array(a["place"], b["place"])))
    return F.flatten(F.filter(pairs, lambda p: p.isNotNull()))


def _covered(starts: Column, width: int) -> Column:
    """Number of places under windows of `width` that begin at ascending `starts`."""
    following = F.slice(starts, F.lit(2), F.size(starts))
    steps = F.zip_with(starts, following, lambda a, b: F.least(F.lit(width), F.coalesce(b - a, F.lit(width))))
    return F.aggregate(steps, F.lit(0), lambda total, step: total + step).cast("long")


def repeated_words(words: Column, width: int = 3) -> Column:
    """Number of words inside windows of `width` words that occur more than once in `words`."""
    grams = words
    for k in range(1, width):
        rest = F.slice(words, F.lit(k + 1), F.greatest(F.size(words), F.lit(1)))
        grams = F.zip_with(grams, rest, lambda a, b: F.concat(a, F.lit(" "), b))
    placed = F.transform(grams, lambda gram, i: F.struct(gram.alias("gram"), i.alias("place")))
    whole = F.sort_array(F.filter(placed, lambda x: x["gram"].isNotNull()))
    return bound(whole, lambda s: bound(F.array_sort(F.array_distinct(_pairs(s))), lambda starts: _covered(starts, width)))


def measures(text: Column) -> Column:
    """A struct of `MEASURES` of a text."""
    text = F.coalesce(text.cast("string"), F.lit(""))

    def of_words(words: Column) -> Column:
        bare = lambda word: F.trim(F.lower(word), F.lit(MARKS))
        return F.struct(
            _count(words).alias("n_words"),
            repeated_words(words).alias("n_repeat_words"),
            _count(F.filter(words, lambda word: bare(word).isin(STOP_WORDS))).alias("n_stop_words"),
            _count(F.filter(words, lambda word: word.rlike(r"\p{L}"))).alias("n_letter_words"),
        )

    def of_lines(lines: Column) -> Column:
        marked = F.filter(lines, lambda line: F.ltrim(line, F.lit(SPACES)).rlike(r"^[-*•]") | F.rtrim(line, F.lit(SPACES)).endswith("..."))
        return F.struct(
            _count(lines).alias("n_lines"), (_count(lines) - _count(F.array_distinct(lines))).alias("n_dup_lines"),
            _count(marked).alias("n_marked_lines"),
        )

    def without(characters: str) -> Column:
        return F.length(F.translate(text, characters, "")).cast("long")

    symbols = (F.length(text) - without(SYMBOLS)).cast("long")
    return bound(
        F.struct(bound(words_of(text), of_words).alias("w"), bound(lines_of(text), of_lines).alias("l")),
        lambda m: F.struct(
            m["w"]["n_words"].alias("n_words"), without(SPACES).alias("word_chars"), symbols.alias("n_symbols"),
            m["l"]["n_dup_lines"].alias("n_dup_lines"), m["w"]["n_repeat_words"].alias("n_repeat_words"),
            *[m["l"][c].alias(c) for c in ("n_lines", "n_marked_lines")], *[m["w"][c].alias(c) for c in ("n_stop_words", "n_letter_words")],
        ),
    )


def broken(rule: Rule, measure: Callable[[str], Column]) -> Column:
    """Whether a rule fails; a quotient by zero fails no rule."""
    by = F.lit(1) if rule.by is None else measure(rule.by)
    value, out = measure(rule.measure) * rule.of, F.lit(False)
    if rule.least is not None:
        out = out | (value < by * rule.least)
    if rule.most is not None:
        out = out | (value > by * rule.most)
    return out


def judge(
    docs: DataFrame, base: tuple[Rule, ...] = BASE_RULES, rules: tuple[Rule, ...] = RULES,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per row of `docs`: id, the measures, base_failed, kept, failed (names of all rules that fail)."""
    def verdict(m: Column) -> Column:
        names = F.array(*[F.when(broken(r, m.getField), F.lit(r.name)) for r in (*base, *rules)])
        failed = F.filter(names, lambda name: name.isNotNull())
        any_base = F.lit(False)
        for rule in base:
            any_base = any_base | broken(rule, m.getField)
        return F.struct(m.alias("m"), any_base.alias("base_failed"), failed.alias("failed"))

    found = docs.select(docs[id_col].alias("id"), bound(measures(docs[text_col]), verdict).alias("v"))
    return found.select("id", "v.m.*", "v.base_failed", (F.size("v.failed") == 0).alias("kept"), "v.failed")


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        F.col("id").alias("doc_id"), *MEASURES, "base_failed", "kept", F.array_join("failed", ",").alias("failed"),
    )


def _sql_broken(rule: Rule) -> str:
    by, parts = rule.by or "1", []
    if rule.least is not None:
        parts.append(f"{rule.measure} * {rule.of} < {by} * {rule.least}")
    if rule.most is not None:
        parts.append(f"{rule.measure} * {rule.of} > {by} * {rule.most}")
    return "(" + " or ".join(parts) + ")"


def sql(base: tuple[Rule, ...] = BASE_RULES, rules: tuple[Rule, ...] = RULES) -> str:
    space, word = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]+"
    stops = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
    names = ", ".join(f"case when {_sql_broken(r)} then '{r.name}' end" for r in (*base, *rules))
    return rf"""
with t as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
w as (select *, regexp_extract_all(text, '{word}') as words, string_split(text, chr(10)) as lines from t),
g as (select r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as gram from (select r, words, unnest(range(1, len(words) - 1)) as i from w)),
twice as (select r, i from (select *, count(*) over (partition by r, gram) as n from g) where n > 1),
places as (select r, count(distinct i + d) as n from twice, (values (0), (1), (2)) as o(d) group by r),
l as (select r, line from (select r, unnest(lines) as line from w) where regexp_matches(line, '{word}')),
lc as (select r, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines,
  count(*) filter (where regexp_matches(line, '^{space}*[-*•]') or regexp_matches(line, '\.\.\.{space}*$')) as n_marked_lines from l group by r),
x as (select r, unnest(words) as word from w),
xc as (select r, count(*) filter (where trim(lower(word), '{MARKS}') in ({stops})) as n_stop_words,
  count(*) filter (where regexp_matches(word, '\p{{L}}')) as n_letter_words from x group by r),
m as (select doc_id, cast(len(words) as bigint) as n_words, length(regexp_replace(text, '{space}', '', 'g')) as word_chars,
  length(text) - length(translate(text, '{SYMBOLS}', '')) as n_symbols, coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(places.n, 0) as n_repeat_words,
  coalesce(n_lines, 0) as n_lines, coalesce(n_marked_lines, 0) as n_marked_lines, coalesce(n_stop_words, 0) as n_stop_words, coalesce(n_letter_words, 0) as n_letter_words
  from w left join places using (r) left join lc using (r) left join xc using (r)),
v as (select *, list_filter([{names}], lambda f: f is not null) as broken from m)
select doc_id, {", ".join(MEASURES)}, {" or ".join(_sql_broken(r) for r in base)} as base_failed, len(broken) = 0 as kept,
  array_to_string(broken, ',') as failed from v"""
