"""Quality rules as a cascade: the rule that rejects most for its cost is asked first."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearkin.functions.binding import let, with_computed
from nearkin.llm.columns import free_name, text_or_empty
from nearkin.session import stored

#: Rows, about, on which rules are timed and counted; they decide the order, not the verdict.
SAMPLE_ROWS = 4_000
#: Files that the sample is written to, so that timed jobs use several cores.
SAMPLE_FILES = 16
#: How often a job is timed; the quickest counts, as the first also compiles its code.
TIMES = 2

# Limits of the rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOLS_PER_100_WORDS = 30
MAX_DUP_LINE_PERCENT = 35
MIN_WORD_CHARS, MAX_WORD_CHARS = 2.5, 12.0
MAX_CAPITAL_PERCENT = 60

_SPACE = " \\t\\n\\x0B\\f\\r"


@dataclass(frozen=True)
class Rule:
    """A rule's name, the feature it is about, when it rejects, and the parts of a text it reads."""

    name: str
    feature: str
    rejects: str
    parts: tuple[str, ...] = ("words",)


#: ``base`` rules first; any order gives the same verdict.
RULES = (
    Rule("few_words", "n_words", f"n_words < {MIN_WORDS}"),
    Rule("repeated_words", "n_repeat_words", f"100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"),
    Rule("symbols", "n_symbols", f"100 * n_symbols > {MAX_SYMBOLS_PER_100_WORDS} * n_words"),
    Rule("dup_lines", "n_dup_lines", f"100 * n_dup_lines > {MAX_DUP_LINE_PERCENT} * n_lines", ("lines",)),
    Rule(
        "word_length", "word_chars",
        f"word_chars < {MIN_WORD_CHARS} * n_words or word_chars > {MAX_WORD_CHARS} * n_words", ("words", "word_chars"),
    ),
    Rule("capitals", "n_capitals", f"100 * n_capitals > {MAX_CAPITAL_PERCENT} * word_chars", ("words", "word_chars")),
)
BASE = ("few_words", "repeated_words")


def words_of(text: Column) -> Column:
    """Runs of characters other than space, tab, line feed, vertical tab, form feed and return."""
    return F.filter(F.split(text, f"[{_SPACE}]+"), lambda w: w != "")


def repeated_words(words: Column) -> Column:
    """How many words stand in a window of three that occurs twice or more.

    Windows are 64-bit hashes. Where all are distinct nothing repeats, which most texts show
    without a sort; else windows are sorted with their places, and equal neighbours cover the
    words from their place on.
    """

    def windows(w: Column) -> Column:
        return F.zip_with(
            F.zip_with(w, F.slice(w, 2, F.greatest(F.size(w), F.lit(1))), lambda a, b: F.xxhash64(a, b)),
            F.slice(w, 3, F.greatest(F.size(w), F.lit(1))),
            lambda ab, c: F.when(c.isNotNull(), F.xxhash64(ab, c)),
        )

    def covered(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        pairs = let(
            placed,
            lambda p: F.zip_with(
                p, F.slice(p, 2, F.greatest(F.size(p), F.lit(1))), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"]))
            ),
        )
        places = F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda x: x.isNotNull()))))
        return let(
            places,
            lambda p: F.aggregate(
                F.zip_with(p, F.slice(p, 2, F.greatest(F.size(p), F.lit(1))), lambda a, b: F.coalesce(F.least(b - a, F.lit(3)), F.lit(3))),
                F.lit(0).cast("long"),
                lambda total, x: total + x,
            ),
        )

    found = F.filter(windows(words), lambda x: x.isNotNull())
    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(
        let(found, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h)))
    )


def _lines_of(text: Column) -> Column:
    """How many lines hold a word, and how many different ones."""
    spoken = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{_SPACE}]"))
    return let(spoken, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("distinct")))


#: What several features, or a rule twice, read of a text; each is computed once, the later ones from the earlier.
_PARTS: dict[str, Callable[[dict[str, Column]], Column]] = {
    "words": lambda p: words_of(p["text"]),
    "lines": lambda p: _lines_of(p["text"]),
    "word_chars": lambda p: F.char_length(F.array_join(p["words"], "")).cast("long"),
}

_FEATURES: dict[str, tuple[str, Callable[[dict[str, Column]], Column]]] = {
    "n_words": ("words", lambda p: F.size(p["words"]).cast("long")),
    "word_chars": ("word_chars", lambda p: p["word_chars"]),
    "n_symbols": ("text", lambda p: F.regexp_count(p["text"], F.lit("[#*$%&|<>]")).cast("long")),
    "n_lines": ("lines", lambda p: p["lines"]["n"].cast("long")),
    "n_dup_lines": ("lines", lambda p: (p["lines"]["n"] - p["lines"]["distinct"]).cast("long")),
    "n_repeat_words": ("words", lambda p: repeated_words(p["words"])),
    "n_capitals": ("text", lambda p: F.regexp_count(p["text"], F.lit("[A-Z]")).cast("long")),
}


def features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with what the rules look at; the words are computed once.

    A null text has no words. Lines are the parts between line feeds that hold a word.
    """
    rows, parts = docs, {"text": text_or_empty(text_col)}
    for part in ("words", "lines"):
        name = free_name(docs, part)
        rows = with_computed(rows, name, _PARTS[part](parts))
        parts[part] = F.col(name)
    parts["word_chars"] = _PARTS["word_chars"](parts)
    return rows.select(
        *[F.col(f"`{c}`") for c in docs.columns], *[of(parts).alias(name) for name, (_, of) in _FEATURES.items()]
    )


def _having(rows: DataFrame, parts: Iterable[str], text: str = "text") -> DataFrame:
    """``rows`` with the ``parts`` of their ``text``, of which no row has a column yet."""
    for part in parts:
        if part not in rows.columns:
            rows = with_computed(rows, part, _PARTS[part]({"text": F.col(text), **{p: F.col(p) for p in _PARTS}}))
    return rows


def _passing(rows: DataFrame, rule: Rule) -> DataFrame:
    """The rows that ``rule`` does not reject; only they are asked for the parts of a later rule."""
    rows = _having(rows, rule.parts)
    seen = {part: F.col(part) for part in (*rule.parts, "text")}
    known = [F.col(c) for c in rows.columns]
    own = [of(seen).alias(name) for name, (part, of) in _FEATURES.items() if part in seen and name not in rows.columns]
    return rows.select(*known, *own).filter(f"not ({rule.rejects})").select(*known)


def _seconds(rows: DataFrame) -> float:
    """How long it takes to go through ``rows`` and count them."""
    start = time.perf_counter()
    rows.count()
    return time.perf_counter() - start


def costs(sample: DataFrame, rules: Iterable[Rule] = RULES) -> tuple[dict[str, float], dict[str, float]]:
    """Seconds that each part of a text, and each rule that has its parts, take on the ``text`` of ``sample``.

    Every job runs TIMES times, of which the quickest counts; the time of a job that looks at
    nothing is taken off.
    """
    def timed(job: Callable[[DataFrame], DataFrame]) -> float:
        return min(_seconds(job(sample)) for _ in range(TIMES))

    rules = list(rules)
    nothing = timed(lambda rows: rows.filter("text is null"))
    least = nothing / 100
    part_costs: dict[str, float] = {}
    for part in _PARTS:
        before = ("words",) if part == "word_chars" else ()
        spent = timed(lambda rows, part=part, before=before: _having(rows, (*before, part)).filter(F.col(part).isNull()))
        part_costs[part] = max(least, spent - nothing - sum(part_costs[p] for p in before))
    rule_costs = {
        rule.name: max(least, timed(lambda rows, rule=rule: _passing(rows, rule)) - nothing - sum(part_costs[p] for p in rule.parts))
        for rule in rules
    }
    return part_costs, rule_costs


def order_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by what they reject of a sample per second that they take on it.

    About ``rows`` rows are drawn from all of the table and stored in SAMPLE_FILES files. The rule to ask next is the one that rejects
    most of the rows that the rules before it leave, for its own time and that of the parts of a text
    that no rule before it reads. The order changes how much is computed, never which documents are kept.
    """
    total = docs.count()
    if not total:
        return list(rules)
    drawn = docs.select(text_or_empty("text").alias("text")).sample(fraction=min(1.0, rows / total), seed=7)
    sample = stored(drawn.repartition(SAMPLE_FILES), "quality-sample")
    part_costs, rule_costs = costs(sample, rules)
    # At most one row for every set of rules that can reject a text together.
    rejected = features(sample).select(*[F.expr(r.rejects).alias(r.name) for r in rules])
    together = [(row.asDict(), row["n"]) for row in rejected.groupBy(*[r.name for r in rules]).agg(F.count("*").alias("n")).collect()]
    order, left, paid = [], list(rules), set()
    while left:
        def worth(rule: Rule) -> float:
            seconds = rule_costs[rule.name] + sum(part_costs[p] for p in rule.parts if p not in paid)
            return (sum(n for by, n in together if by[rule.name]) + 0.5) / seconds

        rule = max(left, key=worth)
        order.append(rule)
        left.remove(rule)
        paid.update(rule.parts)
        together = [(by, n) for by, n in together if not by[rule.name]]
    return order


def verdict(rules: list[Rule]) -> Column:
    """The name of the first rule that rejects, null if none does; later rules are not asked."""
    found = F.when(F.expr(rules[0].rejects), F.lit(rules[0].name))
    for rule in rules[1:]:
        found = found.when(F.expr(rule.rejects), F.lit(rule.name))
    return found


def judged(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """``docs`` with all features, ``base_failed``, ``rejected_by`` and ``kept``.

    Repeated rows are judged alike; a null or empty text has too few words; an empty table gives an
    empty one. Columns of the features' names are replaced.
    """
    rules = rules or order_rules(docs)
    made = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals")
    rows = features(docs.drop(*made, "base_failed", "rejected_by", "kept"))
    base = F.expr(" or ".join(f"({r.rejects})" for r in RULES if r.name in BASE))
    return rows.select("*", base.alias("base_failed"), verdict(rules).alias("rejected_by")).withColumn(
        "kept", F.col("rejected_by").isNull()
    )


def kept(docs: DataFrame) -> DataFrame:
    """The documents that no rule rejects, as they came.

    The rules are filters one after the other, and a rule's parts of a text are computed above the
    filters of the rules before it: a rejected document costs nothing more. Columns named like a
    feature stay as they are; null and empty texts have too few words; long texts are one row each;
    repeated rows stay or go together; an empty table gives an empty one.
    """
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(own.alias("own"), text_or_empty("text").alias("text"))
    for rule in order_rules(docs):
        rows = _passing(rows, rule)
    return rows.select("own.*")
