"""Quality rules as a cascade that stops at the first rejection.

Each rule is a boolean expression over a text. On a bounded sample, the time of
every rule and the share of rows it rejects are measured, and the rules are
ordered by rejections per second. In that order they become one conditional
expression, which evaluates a rule only for rows that no rule before it has
rejected. The order changes what a scan costs, never which rows are kept.

Everything is SQL expressions.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlift.llm.texts import SPACE, keeps_names
from offerlift.sources.workspace import materialize

#: Rows that costs and shares are measured on.
SAMPLE = 2_000
WINDOW = 8
_TEXT = "__text"


def _let(value: str, name: str, body: str) -> str:
    """SQL that evaluates ``value`` once and uses it as ``name`` in ``body``."""
    return f"transform(array({value}), {name} -> {body})[0]"


def words(text: str = _TEXT) -> str:
    return rf"regexp_extract_all({text}, '[^{SPACE}]+', 0)".replace("\\", "\\\\")


def _written_lines(text: str) -> str:
    pattern = rf"[^{SPACE}]".replace("\\", "\\\\")
    return rf"filter(split({text}, '\\n'), l -> l rlike '{pattern}')"


def word_chars(text: str = _TEXT) -> str:
    space = rf"[{SPACE}]+".replace("\\", "\\\\")
    return f"length(regexp_replace({text}, '{space}', ''))"


def symbols(text: str = _TEXT) -> str:
    """Number of characters that prose has few of."""
    return f"length(regexp_replace({text}, '[^#*$%&|<>]+', ''))"


def duplicate_lines(text: str = _TEXT) -> str:
    """Number of lines with a word that equal an earlier line."""
    return _let(_written_lines(text), "l", "size(l) - size(array_distinct(l))")


def repeated_words(found: str) -> str:
    """Number of words inside windows of eight words that occur twice or more."""
    hashes = f"transform({found}, w -> xxhash64(w))"
    windows = f"transform(sequence(1, size(h) - {WINDOW - 1}), i -> xxhash64(slice(h, i, {WINDOW})))"
    # Equal windows are neighbours once sorted; their places are sorted again to be united.
    ranked = "array_sort(transform(x, (v, i) -> struct(v as v, i as i)))"
    places = (
        "array_sort(transform(filter(transform(s, (e, k) -> struct(e.i as i,"
        " e.v <=> get(s, k - 1).v or e.v <=> get(s, k + 1).v as again)), e -> e.again), e -> e.i))"
    )
    covered = (
        f"aggregate({places}, struct(-{WINDOW} as last, 0 as n), (a, p) ->"
        f" struct(p as last, a.n + least({WINDOW}, p - a.last) as n), a -> a.n)"
    )
    counted = f"if(size(array_distinct(x)) = size(x), 0, {_let(ranked, 's', covered)})"
    inner = f"if(size(h) < {WINDOW}, 0, {_let(windows, 'x', counted)})"
    return _let(hashes, "h", inner)


@dataclass(frozen=True)
class Rule:
    """Rejects the rows where the SQL expression ``reject`` over ``__text`` is true."""

    name: str
    reject: str


RULES = (
    Rule("symbols", f"10 * {symbols()} > 3 * size({words()})"),
    Rule(
        "lines",
        _let(_written_lines(_TEXT), "l", "2 * (size(l) - size(array_distinct(l))) > size(l)"),
    ),
    Rule(
        "stutter",
        _let(words(), "w", "10 * size(filter(w, (x, i) -> x <=> get(w, i - 1))) > 3 * size(w)"),
    ),
    Rule("letters", _let(words(), "w", r"2 * size(filter(w, x -> x rlike '\\p{L}')) < size(w)")),
    Rule("word_length", f"{word_chars()} not between 2 * size({words()}) and 15 * size({words()})"),
)


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    seconds: float
    rejected: float

    @property
    def worth(self) -> float:
        return self.rejected / max(self.seconds, 1e-6)


def estimate(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> list[Estimate]:
    """Rules with measured cost and selectivity, the most rejections per second first.

    The sample has at most ``SAMPLE`` rows, drawn from all of ``docs``. Rules
    that reject nothing in it are ordered by cost.
    """
    n = docs.count()
    rows = docs.select(F.coalesce(F.col(text), F.lit("")).alias(_TEXT))
    rows = materialize(rows.sample(min(1.0, 1.5 * SAMPLE / max(n, 1)), seed=1).limit(SAMPLE), "sample")

    def timed(*columns: Column) -> tuple[float, tuple]:
        best, found = float("inf"), ()
        for _ in range(2):
            start = time.perf_counter()
            found = tuple(rows.agg(F.count("*"), *columns).first())
            best = min(best, time.perf_counter() - start)
        return best, found

    reading, _ = timed(F.sum(F.length(_TEXT)))
    made = []
    for rule in rules:
        seconds, (total, hits) = timed(F.count_if(F.expr(rule.reject)))
        made.append(Estimate(rule, max(seconds - reading, 1e-3), (hits or 0) / max(total, 1)))
    return sorted(made, key=lambda e: (-e.worth, e.seconds))


def rejected_by(rules: Sequence[Rule]) -> Column:
    """Name of the first rule that rejects ``__text``, null if none does."""
    cases = "".join(f" when {r.reject} then '{r.name}'" for r in rules)
    return F.expr(f"case{cases} end") if rules else F.lit(None).cast("string")


@keeps_names
def filter_quality(
    docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", name: str = "rejected_by"
) -> DataFrame:
    """``docs`` with the rule, first in the estimated order, that rejects each row, or null.

    A null text is judged as an empty one; repeated rows get equal verdicts, an
    empty table gives an empty one. A column ``name`` of ``docs`` is replaced.
    """
    order = [e.rule for e in estimate(docs, rules, text)]
    marked = docs.withColumn(_TEXT, F.coalesce(F.col(text), F.lit("")))
    return marked.withColumn(name, rejected_by(order)).drop(_TEXT)


def measure(
    docs: DataFrame, rules: Sequence[Rule] = RULES, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Counts, base verdict and cascade verdict of every row of ``docs``.

    ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines`` and
    ``n_repeat_words`` are counted over whole texts. ``base_failed`` rows are
    not given to the cascade. A null or empty text has no word and fails.
    Repeated rows and null keys are kept, other columns are ignored, an empty
    table gives an empty one.
    """
    order = [e.rule for e in estimate(docs, rules, text)]
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias(_TEXT))
    # One array of words per text, used for two counts.
    counted = f"struct(size(w) as n_words, {repeated_words('w')} as n_repeat_words)"
    rows = rows.select(
        "key",
        _TEXT,
        F.expr(_let(words(), "w", counted)).alias("of_words"),
        F.expr(word_chars()).cast("long").alias("word_chars"),
        F.expr(symbols()).cast("long").alias("n_symbols"),
        F.expr(duplicate_lines()).cast("long").alias("n_dup_lines"),
    )
    n, repeated = F.col("of_words.n_words"), F.col("of_words.n_repeat_words")
    failed = (n < 20) | (100 * repeated.cast("long") > 30 * n.cast("long"))
    return rows.select(
        F.col("key").alias(key),
        n.cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        repeated.cast("long").alias("n_repeat_words"),
        failed.alias("base_failed"),
        F.when(failed, False).otherwise(rejected_by(order).isNull()).alias("kept"),
    )
