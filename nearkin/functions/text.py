"""Column functions on document text: identifiers, cleaning, tokens and counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from nearkin.functions.binding import let
from nearkin.functions.stopwords import ENGLISH_STOP_WORDS

# Code points that Python's str.split() takes as white space, as the inside
# of a character class that Java and RE2 both read.
SPACE_CHARS = (
    r"\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
# Line ends that Python's str.splitlines() knows.
LINE_END = r"\r\n|[\x{0A}-\x{0D}\x{1C}-\x{1E}\x{85}\x{2028}\x{2029}]"

# Line beginnings (upper case) that open and close the text proper.
START_MARKERS = ("*** START OF", "***START OF", "*** START PROJECT")
END_MARKERS = (
    "*** END OF",
    "***END OF",
    "*** END PROJECT",
    "END OF THE PROJECT",
    "END OF PROJECT",
)
# The start marker lies among the first 600 lines, the end marker at line index
# 100 or later.
START_WITHIN_LINES = 600
END_FROM_LINE = 100

# Typographic marks and what replaces each.
TYPOGRAPHIC_MARKS = "“”‘’—"
TYPOGRAPHIC_REPLACEMENTS = "  '' "

FILE_ID_PATTERN = r"(pg\d+)\.txt"


def file_id(path: Column) -> Column:
    """``.../pg10007.txt`` -> ``pg10007``; ``""`` when the path has another form."""
    return F.regexp_extract(path, FILE_ID_PATTERN, 1)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def file_number(path: Column) -> Column:
    """``.../pg10007.txt`` -> ``10007``, the id without its prefix."""
    return F.replace(F.replace(file_name(path), F.lit("pg"), F.lit("")), F.lit(".txt"), F.lit(""))


def text_lines(content: Column) -> Column:
    """Lines without their ends; a final line end opens no further line."""
    return let(
        F.split(content, LINE_END, -1),
        lambda parts: F.when(
            F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)
        ).otherwise(parts),
    )


def begins_with_any(line: Column, markers: Sequence[str]) -> Column:
    """Whether a line's first visible text is one of ``markers``, in either case."""
    literal = "|".join(m.replace("*", r"\*") for m in markers)
    return F.upper(line).rlike(f"^[{SPACE_CHARS}]*(?:{literal})")


def _first_match(lines: Column, markers: Sequence[str]) -> Column:
    """1-based position of the first line that begins with a marker, 0 if there is none."""
    hits = F.transform(lines, lambda line: begins_with_any(line, markers))
    return F.array_position(hits, True).cast("int")


def strip_boilerplate(content: Column) -> Column:
    """The lines between the start and the end marker, joined by ``\\n``.

    A missing start marker keeps the beginning, a missing end marker keeps the end.
    """

    def between(lines: Column) -> Column:
        skipped = _first_match(F.slice(lines, 1, START_WITHIN_LINES), START_MARKERS)

        def cut(start: Column) -> Column:
            searched_from = F.greatest(start, F.lit(END_FROM_LINE))
            rest = F.slice(lines, searched_from + 1, F.size(lines))
            return let(
                _first_match(rest, END_MARKERS),
                lambda hit: F.slice(
                    lines,
                    start + 1,
                    F.when(hit > 0, searched_from + hit - 1).otherwise(F.size(lines)) - start,
                ),
            )

        return F.array_join(let(skipped, cut), "\n")

    return let(text_lines(content), between)


def remove_escapes(content: Column) -> Column:
    return F.translate(content, "\n\r\t", "   ")


def plain_punctuation(content: Column) -> Column:
    return F.translate(content, TYPOGRAPHIC_MARKS, TYPOGRAPHIC_REPLACEMENTS)


def normalize_whitespace(content: Column) -> Column:
    return F.trim(F.regexp_replace(content, f"[{SPACE_CHARS}]+", " "))


def clean_text(content: Column) -> Column:
    """Boilerplate, escapes, typographic marks and repeated white space removed."""
    return normalize_whitespace(plain_punctuation(remove_escapes(strip_boilerplate(content))))


def alphabet_only(content: Column) -> Column:
    """Lower case with everything but a-z and white space deleted (not replaced by a space)."""
    return F.regexp_replace(F.lower(content), r"[^a-z\s]", "")


def split_words(content: Column) -> Column:
    """Words between white space, none of them empty."""
    return F.filter(F.split(content, r"\s+"), lambda word: word != "")


def drop_stop_words(words: Column, stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> Column:
    """Words longer than one character and not in the list, in order, repeats kept."""

    def kept(word: Column) -> Column:
        longer = F.length(word) > 1
        return longer & ~word.isin(*stop_words) if stop_words else longer

    return F.filter(F.coalesce(words, F.array().cast("array<string>")), kept)


def index_tokens(content: Column, stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> Column:
    """Tokens as the index sees them: lower case, letters only, stop words removed."""
    return drop_stop_words(F.split(alphabet_only(content), r"\s+"), stop_words)


def raw_words(content: Column) -> Column:
    """Lower-case words between white space, nothing removed."""
    return F.filter(
        F.split(F.lower(content), f"[{SPACE_CHARS}]+"), lambda word: word != ""
    )


def line_count(content: Column) -> Column:
    return F.size(F.split(content, "\n"))


def word_count(content: Column) -> Column:
    """Number of words between white space; 0 for null."""
    return F.coalesce(F.regexp_count(content, F.lit(f"[^{SPACE_CHARS}]+")), F.lit(0))
