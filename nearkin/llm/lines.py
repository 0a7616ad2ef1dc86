"""Lines that recur across documents, found in a tree of log templates of fixed depth."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nearkin.functions.binding import let
from nearkin.llm.columns import free_name, text_or_empty
from nearkin.session import stored

#: Leading tokens that choose a leaf, after the token count.
LEADING = 4
#: Lines of fewer tokens are left alone.
MIN_TOKENS = 4
#: Lines of fewer tokens are compared as a whole, not with a template that has variable fields.
MIN_TEMPLATE_TOKENS = 8
#: The least share of a line's tokens that its leaf's template holds as constants, in percent.
MIN_CONSTANT_PERCENT = 75
#: Groups of a leaf's families in which a line left over has a vote, at most.
VOTES = 4
#: What tells lines apart: two hashes, 128 bits.
WHOLE = ["whole", "whole_b"]
#: A token with a digit is a variable field from the start.
FIELD = r"[^ \t\x0B\f\r\n]*[0-9][^ \t\x0B\f\r\n]*"
_SPACE = r" \t\x0B\f\r"


class Unit(NamedTuple):
    """What recurs: the pieces that a text is split into, and the least tokens of one looked at."""

    ends: str
    min_tokens: int


LINE = Unit("\n", MIN_TOKENS)
#: Within a line, between a full stop with closing quotes and white space, and what follows it. The
#: short look back comes first, as it rules out most places.
_WITHIN = r"""(?<=[ \t])(?=[^ \t\n])(?<=[.!?]["')\]]{0,2}[ \t]{1,4})"""
#: Sentences end there or at a line's end. Short ones ("Thank you very much.") recur by chance and stay.
SENTENCE = Unit(f"\n|{_WITHIN}", 8)


def _row_of(id_col: str, text_col: str) -> Column:
    """What the tables of lines call a row beside its id; rows of equal id and text are one document."""
    return F.xxhash64(F.col(f"`{id_col}`").cast("string"), text_or_empty(text_col))


def _tokens_of(line: Column) -> Column:
    return F.filter(F.split(line, f"[{_SPACE}]+"), lambda t: t != "")


def _masked(text: Column, unit: Unit) -> Column:
    if unit is LINE:
        return F.split(F.regexp_replace(text, FIELD, "<*>"), "\n")
    # A masked number would take the full stop after it along, so the text is split first.
    return F.transform(F.split(text, unit.ends), lambda u: F.regexp_replace(u, FIELD, "<*>"))


def _whole(tokens: Column) -> list[Column]:
    return [F.xxhash64(tokens).alias("whole"), F.xxhash64(F.lit(1), tokens).alias("whole_b")]


def _leaf(tokens: Column) -> Column:
    return F.xxhash64(F.size(tokens), F.slice(tokens, 1, LEADING))


def line_keys(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: Unit = LINE
) -> DataFrame:
    """``id, row, line, n_tokens, leaf, whole, whole_b`` of every line, or other unit, of enough tokens.

    The first level of the tree is the token count, the next are the leading tokens; ``leaf``
    hashes the way to a leaf; ``whole`` and ``whole_b`` all tokens; variable fields are masked in all.
    Leaves of one hash would only vote together, and lines that then share a template agree in half of
    their places or more, so a leaf needs no second hash.
    """
    keys = F.transform(
        _masked(text_or_empty(text_col), unit),
        lambda line: let(
            _tokens_of(line),
            lambda t: F.struct(F.size(t).alias("n_tokens"), _leaf(t).alias("leaf"), *_whole(t)),
        ),
    )
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), _row_of(id_col, text_col).alias("row"), F.posexplode(keys).alias("line", "key")
    )
    return rows.filter(F.col("key.n_tokens") >= unit.min_tokens).select("id", "row", "line", "key.*")


def _votes(lines: DataFrame) -> DataFrame:
    """A row for each ``place`` and ``token`` of every line."""
    return lines.select("template", "n_lines", "n_tokens", *WHOLE, F.posexplode("tokens").alias("place", "token"))


def _of_templates(lines: DataFrame) -> DataFrame:
    """``whole, whole_b, template`` of the lines that have enough of the constants of a group's template.

    A place has one constant at most, so a template is no longer than its lines.
    """
    constants = (
        _votes(lines).groupBy("template", "place", "token").agg(F.count("*").alias("n"), F.first("n_lines").alias("n_lines"))
        .filter("2 * n > n_lines")
        .groupBy("template").agg(F.collect_list(F.struct("place", "token")).alias("constants"))
    )
    held = F.size(F.filter("constants", lambda c: F.get("tokens", c["place"]) == c["token"]))
    return (
        lines.join(constants, "template")
        .filter(100 * held >= MIN_CONSTANT_PERCENT * F.col("n_tokens"))
        .select(*WHOLE, "template")
    )


def _groups(left: DataFrame) -> DataFrame:
    """``whole, whole_b, template, n_members``: the groups of lines that share a block of places, a row a block.

    The places after the leading ones are dealt into one block more than two lines may differ in,
    so lines of a leaf that are similar enough have a block in common. Groups of the same lines are one.
    """
    blocks = (
        _votes(left).filter(F.col("place") >= LEADING)
        .withColumn("block", F.expr(f"place % (n_tokens * (100 - {MIN_CONSTANT_PERCENT}) div 100 + 1)"))
        .groupBy("template", *WHOLE, "block")
        .agg(F.bit_xor(F.xxhash64("place", "token")).alias("key"))
    )
    groups = (
        blocks.groupBy("template", "block", "key")
        .agg(F.count("*").alias("n_members"), F.bit_xor(F.xxhash64(*WHOLE)).alias("members"))
        .filter("n_members > 1")
    )
    return blocks.join(groups, ["template", "block", "key"]).select(
        *WHOLE, F.xxhash64("template", "n_members", "members").alias("template"), "n_members"
    )


def _families(left: DataFrame) -> DataFrame:
    """``whole, whole_b, template`` of lines that the template of their leaf does not take, a row for each template.

    Every line names the middle one of its groups by size: larger ones may hold several families,
    smaller ones are what edits leave of one. It then votes in the VOTES groups named most, so lines
    of a family meet though no block is free of edits in all of them, and no line's tokens are
    written more than VOTES times.
    """
    groups = stored(_groups(left), "line-groups")
    own = Window.partitionBy(*WHOLE)
    middle = (
        groups.withColumn("nth", F.row_number().over(own.orderBy("n_members", "template")))
        .withColumn("n", F.count("*").over(own))
        .filter("nth = (n + 1) div 2")
    )
    named = middle.groupBy("template").agg(F.count("*").alias("n_named"))
    votes = stored(
        groups.select(*WHOLE, "template").distinct().join(named, "template", "left")
        .withColumn("nth", F.row_number().over(own.orderBy(F.desc_nulls_last("n_named"), "template")))
        .filter(f"nth <= {VOTES}").select(*WHOLE, "template"),
        "line-votes",
    )
    sizes = votes.groupBy("template").agg(F.count("*").alias("n_lines")).filter("n_lines > 1")
    voters = left.drop("template", "n_lines").join(votes.join(sizes, "template"), WHOLE)
    return _of_templates(stored(voters, "line-family-tokens"))


def _generalised(
    wholes: DataFrame, docs: DataFrame, id_col: str, text_col: str, unit: Unit, families: bool
) -> DataFrame:
    """``whole, whole_b, template`` of the lines that share their leaf's template with another line.

    Of every leaf with several different lines, each different line votes once for its token at
    every place. Tokens with more than half of the votes are the template's constants, the other
    places its variable fields. A line belongs to it that has enough of its tokens constant. With
    ``families`` the lines left over are looked at again, and may have several templates.
    """
    mixed = (
        wholes.filter(F.col("n_tokens") >= MIN_TEMPLATE_TOKENS)
        .groupBy("leaf").agg(F.count("*").alias("n_lines")).filter("n_lines > 1")
    )
    known = ["leaf", "n_lines", "n_tokens", *WHOLE]
    chosen = wholes.join(mixed, "leaf").select(*known, "sample.id", "sample.row", "sample.line")
    per_row = chosen.groupBy("id", "row").agg(F.collect_list(F.struct(*known, "line")).alias("chosen"))
    texts = docs.select(
        F.col(f"`{id_col}`").alias("_id"), _row_of(id_col, text_col).alias("_row"), text_or_empty(text_col).alias("text")
    ).join(per_row, (F.col("_row") == F.col("row")) & F.col("_id").eqNullSafe(F.col("id")))
    lines = texts.select(
        F.explode(
            let(_masked(F.col("text"), unit), lambda all_lines: F.transform(
                "chosen",
                lambda c: F.struct(*[c[k].alias(k) for k in known], F.get(all_lines, c["line"]).alias("masked")),
            ))
        ).alias("c")
    ).select("c.*").dropDuplicates(WHOLE)
    hashed = F.transform(_tokens_of(F.col("masked")), lambda t: F.xxhash64(t))
    mixed_lines = stored(
        lines.select(F.col("leaf").alias("template"), "n_lines", "n_tokens", *WHOLE, hashed.alias("tokens")), "line-tokens"
    )
    general = _of_templates(mixed_lines)
    if not families:
        return general
    general = stored(general, "line-leaf-templates")
    left = stored(mixed_lines.join(general, WHOLE, "left_anti").select(mixed_lines.columns), "line-left")
    return general.union(_families(left))


def recurring_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: Unit = LINE, families: bool = False
) -> DataFrame:
    """``id, row, line`` of the lines, or other units, whose template an earlier document has, in order of id."""
    keys = stored(line_keys(docs, id_col, text_col, unit), "line-keys")
    wholes = stored(
        keys.groupBy(*WHOLE).agg(
            F.first("leaf").alias("leaf"),
            F.first("n_tokens").alias("n_tokens"),
            F.max(F.struct("id", "row")).alias("last"),
            F.min(F.struct("id", "row", "line")).alias("sample"),
        ).withColumn("first", F.struct("sample.id", "sample.row")),
        "line-wholes",
    )
    general = stored(_generalised(wholes, docs, id_col, text_col, unit, families), "line-templates")
    own = wholes.join(general, WHOLE, "left")
    # A line without a template needs no further look; the others take the first of all their lines.
    alone = own.filter(F.col("template").isNull()).select(*WHOLE, "first", "last")
    several = own.filter(F.col("template").isNotNull())
    ends = several.groupBy("template").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    merged = several.select(*WHOLE, "template").join(ends, "template").select(*WHOLE, "first", "last")
    recurring = alone.union(merged).filter("first != last").select(*WHOLE, "first")
    return keys.join(recurring, WHOLE).filter(F.struct("id", "row") != F.col("first")).select("id", "row", "line")


def _without(text: Column, gone: Column, unit: Unit) -> Column:
    """``text`` without the units at the places ``gone``; a line that has none left goes, too."""
    def left(n: Column) -> Column:
        return F.array_except(F.sequence(F.lit(0), n - 1), gone)

    if unit is LINE:
        return let(
            F.split(text, "\n"),
            lambda lines: F.array_join(F.transform(left(F.size(lines)), lambda i: F.get(lines, i)), "\n"),
        )
    pieces = F.flatten(
        F.transform(
            F.split(text, "\n"),
            lambda line, i: F.transform(F.split(line, _WITHIN), lambda u: F.struct(i.alias("line"), u.alias("piece"))),
        )
    )
    kept = let(pieces, lambda every: F.transform(left(F.size(every)), lambda i: F.get(every, i)))
    return let(
        kept,
        lambda own: F.array_join(
            F.transform(
                own,
                lambda u, i: F.when((i > 0) & (F.get(own, i - 1)["line"] != u["line"]), F.concat(F.lit("\n"), u["piece"]))
                .otherwise(u["piece"]),
            ),
            "",
        ),
    )


def drop_recurring(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: Unit = LINE, families: bool = False
) -> DataFrame:
    """``docs`` without the lines whose template an earlier document has; with ``n_lines, n_dropped``.

    A line is its tokens between white space; tokens with a digit are variable fields, and so are
    the places at which the lines of a leaf differ. Templates that occur in two documents or
    more are dropped from all but the first by id (then by a hash), so one copy stays. Lines
    of fewer than MIN_TOKENS tokens stay. Rows of equal id and text are one document and lose the
    same lines; null ids come first; a null text stays null; an empty table gives an empty one.
    Columns named ``n_lines`` or ``n_dropped`` are replaced.

    With SENTENCE as ``unit`` the same holds for the sentences within lines, which both counts
    then count; what is left of a line stays on a line of its own. A leaf has one template, or with
    ``families`` more: one for each group of its lines that are similar and outvoted there.
    """
    dropped = recurring_lines(docs, id_col, text_col, unit, families).groupBy("id", "row").agg(F.collect_set("line").alias("lines"))
    row, gone, own_id, own_row = (free_name(docs, name) for name in ("row", "gone", "own_id", "own_row"))
    dropped = dropped.select(F.col("id").alias(own_id), F.col("row").alias(own_row), F.col("lines").alias(gone))
    columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    kept = docs.select(*[f"`{c}`" for c in columns], _row_of(id_col, text_col).alias(row))
    kept = kept.join(dropped, (F.col(row) == F.col(own_row)) & F.col(f"`{id_col}`").eqNullSafe(F.col(own_id)), "left")
    text = F.col(f"`{text_col}`")
    rest = _without(text, F.col(gone), unit)
    return kept.select(
        *[
            F.when(F.col(gone).isNull(), text).otherwise(rest).alias(c) if c == text_col else F.col(f"`{c}`")
            for c in columns
        ],
        F.when(text.isNull(), 0).otherwise(F.size(F.split(text, unit.ends))).cast("long").alias("n_lines"),
        F.coalesce(F.size(gone), F.lit(0)).cast("long").alias("n_dropped"),
    )
