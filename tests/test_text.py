import random
import re

import pytest
from pyspark.sql import functions as F

from nearkin.functions import text
from nearkin.functions.stopwords import ENGLISH_STOP_WORDS
from nearkin.operators.documents import preprocess_books

def apply(spark, function, *values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    out = rows.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()
    return [r["out"] for r in out]


def preprocess(spark, *contents, stop_words=ENGLISH_STOP_WORDS):
    """Tokens of each content, by the number in its file's name."""
    files = [(f"file:///shelf/pg{i}.txt", c) for i, c in enumerate(contents)]
    rows = preprocess_books(spark.createDataFrame(files, "path string, content string"), stop_words)
    return {r.book_id: r.tokens for r in rows.collect()}


def marked(before, body, after=()):
    """A text whose body stands between the two markers, as a book file has it."""
    return "\n".join([*before, "*** START OF VOLUME 9 ***", *body, "*** END OF VOLUME 9 ***", *after])


BODY = [f"line {i}" for i in range(700)]
HEAD = BODY[:100]


@pytest.mark.parametrize("n_before, n_body, ends", [(0, 3, False), (5, 93, False), (5, 94, True), (120, 2, True)])
def test_markers_count_by_where_they_stand(spark, n_before, n_body, ends):
    # The end marker is looked for from line 100 on, or from the start marker if that is later.
    (out,) = apply(spark, text.strip_boilerplate, marked(BODY[:n_before], BODY[:n_body], ["licence"]))
    kept = BODY[:n_body] if ends else [*BODY[:n_body], "*** END OF VOLUME 9 ***", "licence"]
    assert out == "\n".join(kept)



@pytest.mark.parametrize(
    "lines, expected",
    [
        (["one", "two"], ["one", "two"]),
        ([*BODY[:10], "  *** start of this", *BODY[:9]], BODY[:9]),
        ([*BODY[:599], "***START OF", *BODY], BODY),
        ([*BODY[:600], "*** START OF", "x"], [*BODY[:600], "*** START OF", "x"]),
        ([*BODY[:99], "*** END OF", "x"], [*BODY[:99], "*** END OF", "x"]),
        ([*HEAD, "*** END OF", "x"], HEAD),
        ([*HEAD, "End of the Project", "*** END OF"], HEAD),
        ([*HEAD, " \x1f end of PROJECT y", "x"], HEAD),
        ([*HEAD, "not the *** END OF", "x"], [*HEAD, "not the *** END OF", "x"]),
        ([*BODY[:300], "*** START PROJECT", "***END OF it", "x"], []),
        ([*BODY[:300], "*** START PROJECT", "x", "***END OF it"], ["x"]),
        (["*** END OF", "*** START OF", "x"], ["x"]),
        (["*** START OF a", "*** START OF b", "x"], ["*** START OF b", "x"]),
    ],
)
def test_text_between_markers(spark, lines, expected):
    assert apply(spark, text.strip_boilerplate, "\n".join(lines)) == ["\n".join(expected)]


def test_line_ends(spark):
    samples = ["", "\n", "a", "a\n", "a\n\n", "a\r\nb\rc\x0bd\x0ce\x1cf\x1dg\x1eh\x85i\u2028j\u2029k"]
    assert apply(spark, text.text_lines, *samples) == [s.splitlines() for s in samples]


def test_null_text_stays_null(spark):
    assert apply(spark, text.clean_text, None) == [None]
    assert apply(spark, text.word_count, None) == [0]


def test_cleaning_steps(spark):
    assert apply(spark, text.remove_escapes, "a\nb\rc\td") == ["a b c d"]
    assert apply(spark, text.plain_punctuation, "“a” ‘b’—c") == [" a  'b' c"]
    spaces = "\x1f a　 b \n c \x85"
    assert apply(spark, text.normalize_whitespace, spaces, "") == [" ".join(spaces.split()), ""]
    assert apply(spark, text.clean_text, "\n“It’s”\t x—y \n") == ["It's x y"]


def test_alphabet_filter_deletes(spark):
    assert apply(spark, text.alphabet_only, "Test-Case don't für 42") == ["testcase dont fr "]


def test_ids(spark):
    path = "file:///data/sample/pg12345.txt"
    assert apply(spark, text.file_id, path, "/data/other.txt") == ["pg12345", ""]
    assert apply(spark, text.file_number, path) == ["12345"]
    assert apply(spark, text.file_name, path) == ["pg12345.txt"]


def test_counts(spark):
    sample = "a b\n\nc d \n"
    assert apply(spark, text.line_count, sample, "") == [len(sample.split("\n")), 1]
    assert apply(spark, text.word_count, sample, "", " ") == [len(sample.split()), 0, 0]
    assert apply(spark, text.raw_words, " A b　C ", "") == [["a", "b", "c"], []]


@pytest.mark.parametrize("number", [0, 7, 40_321, 10**12])
def test_file_names_give_ids(spark, number):
    path = f"s3://shelf-{number % 3}/pg{number}.txt"
    assert apply(spark, text.file_id, path, path.upper(), f"{path}.gz.old") == [f"pg{number}", "", f"pg{number}"]


def index_tokens(content, stop_words):
    """The definition: letters and white space only, lower case, long enough, no stop word."""
    letters = re.sub(r"[^a-z \t\n\x0b\f\r]", "", content.lower())
    return [t for t in re.split(r"[ \t\n\x0b\f\r]+", letters) if len(t) > 1 and t not in stop_words]


def mixed_text(seed, n=60):
    """Words in any case, stop words, single letters, numbers and marks, in any order."""
    rng = random.Random(seed)
    makers = [
        lambda: "".join(rng.choices("bcdfglmnrstaeiou", k=rng.randint(2, 9))),
        lambda: rng.choice(ENGLISH_STOP_WORDS).title(),
        lambda: rng.choice("xyzI"),
        lambda: str(rng.randint(0, 9999)),
        lambda: "".join(rng.choices("aéZ-'’7", k=4)),
    ]
    return "".join(rng.choice(makers)() + rng.choice([" ", "  ", "\n", "\t", ", "]) for _ in range(n))


def test_tokens_match_the_definition(spark):
    contents = [mixed_text(seed) for seed in range(12)]
    got = preprocess(spark, *contents)
    assert got == {f"pg{i}": index_tokens(c, set(ENGLISH_STOP_WORDS)) for i, c in enumerate(contents)}


@pytest.mark.parametrize("n_stop", [0, 1, 3])
def test_stop_words_are_those_given(spark, n_stop):
    stop_words = ["barge", "quay", "the"][:n_stop]
    content = "the quay: a barge at the quay"
    assert preprocess(spark, content, stop_words=stop_words)["pg0"] == index_tokens(content, stop_words)


def test_body_of_a_marked_file_is_tokenised(spark):
    got = preprocess(spark, marked(["cover"], ["barge"] * 120, ["licence"]), marked(BODY[:1], ["quay"]))
    assert got == {"pg0": ["barge"] * 120, "pg1": ["quay", "end", "volume"]}


def test_files_without_tokens_give_no_row(spark):
    some_stop_words = " ".join([w for w in ENGLISH_STOP_WORDS if w.isalpha()][::9])
    assert preprocess(spark, some_stop_words, None, "", "1 2 3 - x") == {}


def test_cleaning_effect_counts_what_clean_text_leaves(spark):
    """Counted in one Arrow pass, and equal to the column functions on odd texts."""
    from nearkin.plans import explore

    many_lines = "\n".join(["line %d" % i for i in range(120)])
    odd = [
        None, "", " \t ", "a\r\nb\x0bc\x1cd\x85e f", "  *** start of it\nbody “x”—‘y’\n" + many_lines + "\n End of the Projeﬀ\nend of the project\nz",
        many_lines + "\n***ſtart of\n***end of it", "\n" * 601 + "*** START OF\nx", "*** START PROJECT\n" + "\r" * 99 + "END OF PROJECT\r\ntail",
        "ß　Σ퟿ 𝒳𝒴 ​ z",
    ]
    books = spark.createDataFrame([(i, t) for i, t in enumerate(odd)], "book_id int, content string")
    found = explore.cleaning_effect(books)
    assert "regexp" not in found._jdf.queryExecution().executedPlan().toString()
    cleaned = text.clean_text(F.col("content"))
    wanted = books.select(
        "book_id", F.length("content").alias("raw_chars"), F.length(cleaned).alias("cleaned_chars"),
        text.word_count(F.col("content")).alias("raw_words"), text.word_count(cleaned).alias("cleaned_words"),
    )
    assert sorted(map(tuple, found.drop("reduction_pct").collect()), key=str) == sorted(map(tuple, wanted.collect()), key=str)
