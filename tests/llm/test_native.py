"""Conversations, quality rules and recurring lines: built from DataFrame functions only."""

import inspect
import re

import pytest
from pyspark.sql import functions as F

from nearkin.llm import chat, lines, quality

from . import definitions
from .conftest import prose


@pytest.mark.parametrize("module", [chat, lines, quality])
def test_main_path_is_native(module):
    assert not re.search(r"mapIn|applyIn|udf|\.rdd|toPandas|pyarrow|pandas", inspect.getsource(module))


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def talk(conv_id, *texts, first=0):
    return [(conv_id, first + i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(texts)]


def test_snapshots_collapse_into_the_longest(spark):
    rows = (
        talk(1, "hi", "hello") + talk(2, "hi", "hello", "and then") + talk(3, "hi", "hello", "or else")
        + talk(4, "hi", "hello", "and then") + talk(5, "hi") + talk(6, "other") + talk(7, "hello", "hi")
    )
    got = {r.conv_id: r.rendered for r in chat.rendered(conversations(spark, rows)).collect()}
    assert got.keys() == {2, 3, 6, 7}
    assert got[2] == "<|user|>\nhi\n<|assistant|>\nhello\n<|user|>\nand then\n"


def test_roles_turn_numbers_and_nulls_count(spark):
    rows = [
        (1, 0, "user", "a"), (2, 0, "system", "a"), (2, 1, "user", "b"), (3, 5, "user", "a"),
        (4, 0, "user", None), (5, 0, "user", ""), (5, 1, None, "x"), (6, None, "user", "q"), (6, 0, "user", "r"),
        (7, 0, "user", "twice"), (7, 0, "user", "twice"), (None, 0, "user", "nobody"),
    ]
    frame = conversations(spark, rows).withColumn("lane0", F.lit("clash")).withColumn("chunk", F.lit(1))
    got = {r.conv_id: (r.n_turns, r.rendered) for r in chat.rendered(frame).collect()}
    assert got.keys() == {1, 2, 3, 4, 5, 6, 7, None}
    assert got[6] == (2, "<|user|>\nq\n<|user|>\nr\n")
    assert got[7][0] == 2


def test_prefixes_roll_on_across_chunks(spark, monkeypatch):
    monkeypatch.setattr(chat, "CHUNK_TURNS", 3)
    long = [f"t{i}" for i in range(20)]
    rows = talk(1, *long) + talk(2, *long[:10]) + talk(3, *long[:9], "different") + talk(4, *long[:3])
    assert {r.conv_id for r in chat.maximal(conversations(spark, rows)).collect()} == {1, 3}


def test_many_snapshots_of_one_greeting(spark):
    rows = [r for i in range(300) for r in talk(i, "hi")] + talk(999, "hi", "hello")
    assert [r.conv_id for r in chat.maximal(conversations(spark, rows)).collect()] == [999]
    assert chat.rendered(conversations(spark, [])).count() == 0


FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def quality_texts(awkward_rows):
    repeats = "a b c d a b c e f f f f f\n" * 3 + prose(60, 4)
    return [t for _, t in awkward_rows] + [
        repeats, "x y z", "x y z x y z", "a a a a", "# * $ % & | < > " * 20, prose(200, 7).upper(),
        "\x0bvertical\x0ctab\xa0joined", "same line here\n" * 40 + prose(80, 9),
    ]


def test_quality_features_match_the_definition(docs_of, awkward_rows):
    texts = quality_texts(awkward_rows)
    docs = docs_of(texts).withColumn("n_words", F.lit("clash")).withColumn("_words", F.lit("clash"))
    got = {r.doc_id: {c: r[c] for c in FEATURES} for r in quality.judged(docs).collect()}
    assert got == {i: definitions.quality(t) for i, t in enumerate(texts)}


def test_order_of_rules_never_changes_the_verdict(docs_of, awkward_rows):
    docs = docs_of(quality_texts(awkward_rows))
    verdicts = [
        sorted((r.doc_id, r.kept) for r in quality.judged(docs, list(rules)).select("doc_id", "kept").collect())
        for rules in (quality.RULES, quality.RULES[::-1])
    ]
    assert verdicts[0] == verdicts[1]
    kept = quality.kept(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, k in verdicts[0] if k]
    assert 0 in [r.doc_id for r in kept.collect()]


def test_cascade_asks_the_most_rejecting_rule_per_cost_first(docs_of):
    docs = docs_of(["* " * 60 + prose(70, s) for s in range(60)])
    order = quality.order_rules(docs, rows=60)
    assert {r.name for r in order} == {r.name for r in quality.RULES}
    assert order.index(next(r for r in order if r.name == "symbols")) <= 2


def test_costs_leave_out_what_starting_a_job_takes(docs_of):
    docs = docs_of(["* " * 60 + prose(900, s) for s in range(100)]).repartition(2).select("text")
    parts, rules = quality.costs(docs)
    assert set(parts) == {"words", "lines", "word_chars"} and set(rules) == {r.name for r in quality.RULES}
    # Words are there already when a rule asks how many: finding repeats among them is the work.
    assert rules["few_words"] < rules["repeated_words"]
    assert rules["few_words"] < parts["words"] + rules["repeated_words"]


def test_order_follows_rejections_per_cost_of_what_is_left(docs_of, monkeypatch):
    short, symbols = ["* few words"] * 30, ["* " * 60 + prose(70, s) for s in range(20)]
    docs = docs_of(short + symbols + [prose(90, s) for s in range(20)])
    parts = {"words": 4.0, "lines": 1.0, "word_chars": 2.0}
    monkeypatch.setattr(quality, "costs", lambda sample, rules: (parts, {r.name: 1.0 for r in rules}))
    # Both short and symbol rows hold too many symbols, so nothing is left for few_words to reject,
    # and of the rules that reject nothing the one of the cheapest parts comes first.
    order = [r.name for r in quality.order_rules(docs, rows=1000)]
    assert order[0] == "symbols"
    assert order.index("few_words") < order.index("word_length")
    assert order.index("dup_lines") < order.index("word_length")


def test_rejected_documents_are_not_asked_for_later_parts(docs_of):
    rows = docs_of([prose(90, 1)]).select("text")
    by_name = {r.name: r for r in quality.RULES}
    plan = quality._passing(quality._passing(rows, by_name["dup_lines"]), by_name["few_words"])
    steps = plan._jdf.queryExecution().optimizedPlan().toString().split("\n")
    words = next(i for i, step in enumerate(steps) if "Generate" in step and "[words" in step)
    lines_filter = next(i for i, step in enumerate(steps) if "Filter" in step and ".distinct" in step)
    assert words < lines_filter  # plans print their last step first


def test_quality_of_nothing(empty):
    assert quality.judged(empty).count() == 0
    assert quality.kept(empty).columns == empty.columns


def test_lines_match_the_definition(docs_of):
    notice = "This page was made on {} by the tool of the house and stands under number {} there"
    texts = [
        "\n".join([notice.format(i, i * 7), prose(27, i), "only here in document " + "abc"[i % 3] * 3])
        for i in range(6)
    ]
    varied = "a constant start of line that many share with {} in the middle and a long end"
    texts += [varied.format(w) + "\n" + prose(18, 20 + i) for i, w in enumerate(["apples", "pears", "plums"])]
    texts += [None, "", texts[0], "short one\nshort one", "short one", "\t a  b   c d \n" + prose(9, 40)]
    got = {r.doc_id: r.text for r in lines.drop_recurring(docs_of(texts)).collect()}
    assert got == definitions.without_recurring_lines(list(enumerate(texts)))
    assert got[0] == texts[0] and got[11] == ""
    assert "constant start" in got[6] and "constant start" not in got[7] + got[8]


def test_lines_of_awkward_rows(awkward, awkward_rows):
    frame = lines.drop_recurring(awkward.withColumn("n_lines", F.lit("clash")))
    assert set(frame.columns) == {*awkward.columns, "n_lines", "n_dropped"}
    got = frame.collect()
    assert len(got) == len(awkward_rows)
    by_id = {r.doc_id: r.text for r in got}
    assert by_id[0] == awkward_rows[0][1] and by_id[4] == "" and by_id[1] is None
    assert by_id[3] == awkward_rows[3][1]


def test_repeated_rows_are_one_document(docs_of):
    text = "\n".join(["four words in one line"] * 3 + [prose(18, 1)])
    got = lines.drop_recurring(docs_of([text, text, text], [1, 1, 2])).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [(1, text), (1, text), (2, "")]
    null_ids = lines.drop_recurring(docs_of([text, text], [None, 3])).collect()
    assert {r.doc_id: r.n_dropped for r in null_ids} == {None: 0, 3: len(text.split("\n"))}


def test_lines_of_nothing(empty):
    assert lines.drop_recurring(empty).count() == 0


def test_sentences_recur_within_edited_lines(docs_of):
    one = "The first sentence of the passage has quite a few words in it."
    two = 'And so "the whole second one, with number 12." comes right after it in every copy of it.'
    three = "Does a third one, which ends the passage of the text, stay as well?"
    texts = [
        f"{one} {two} {three}\nAn own line stands here. ",
        f"Well, then. {one} {two} {three}",
        f"{one} An edit put in. {two.replace('12', '345')}\n\n{three}  Short one stays. Short one stays.\nlast",
        f"{two}\n{three}\nNothing else",
        None,
        "",
    ]
    docs = docs_of(texts)
    by_lines = {r.doc_id: r.text for r in lines.drop_recurring(docs).collect()}
    assert by_lines[1] == texts[1] and one in by_lines[2]
    got = {r.doc_id: r for r in lines.drop_recurring(docs, unit=lines.SENTENCE).collect()}
    assert got[0].text == texts[0] and got[4].text is None and got[5].text == ""
    assert got[1].text == "Well, then. "
    assert got[2].text == "An edit put in. \n\nShort one stays. Short one stays.\nlast"
    assert got[3].text == "Nothing else"
    assert [got[i].n_dropped for i in range(6)] == [0, 4, 4, 3, 0, 0]


def test_sentences_put_together_give_the_text(spark):
    texts = ["", "\n", "a. b", "a.  b.\n", "\n\n x. \n y? z", "a.\tb!\r\nc. d\x0b.", "end. \n", "3. 4. 5.", '("a.") b ... c']
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    none = F.array().cast("array<int>")
    back = frame.select("text", lines._without(F.col("text"), none, lines.SENTENCE).alias("back"), F.size(F.split("text", lines.SENTENCE.ends)).alias("n"))
    for r in back.collect():
        assert r.back == r.text


@pytest.mark.parametrize("unit", [lines.LINE, lines.SENTENCE])
def test_families_of_one_leaf_have_templates_of_their_own(docs_of, unit):
    """Four outvoted families of lines that begin alike, each with a word that changes at another place."""
    def family(f, changed):
        words = ["all", "lines", "begin", "alike", *[f"f{'abcd'[f]}w{'klmnopqr'[i]}" for i in range(8)]]
        return [" ".join([*words[: 4 + at], w, *words[5 + at :]]) for at, w in changed]

    texts = [t for f in range(4) for t in family(f, [(f, "one"), (f + 2, "two"), (f, "other")])]
    texts += ["all lines begin alike " + " ".join(f"alone{'abcdefgh'[i]}" for i in range(8))]
    docs = docs_of(texts)
    one = {r.doc_id for r in lines.drop_recurring(docs, unit=unit).filter("n_dropped > 0").collect()}
    assert not one
    got = {r.doc_id for r in lines.drop_recurring(docs, unit=unit, families=True).filter("n_dropped > 0").collect()}
    assert got == {i for i in range(12) if i % 3}


def test_families_do_not_change_what_one_template_takes(docs_of):
    notice = "this notice stands in all {} of the pages that the {} has made so far today"
    texts = [notice.format(a, b) for a, b in [("ten", "house"), ("few", "tool"), ("old", "man"), ("new", "maid")]]
    texts += ["this notice stands in quite another line that has nothing of the others in it"]
    docs = docs_of(texts)
    kept = [{r.doc_id: r.text for r in lines.drop_recurring(docs, families=f).collect()} for f in (False, True)]
    assert kept[0] == kept[1] == definitions.without_recurring_lines(list(enumerate(texts)))


def test_lines_of_one_hash_are_told_apart_by_the_other(docs_of, monkeypatch):
    notice = "this notice stands in all {} of the pages that the {} has made so far today"
    texts = [prose(54, s) for s in range(6)] + [notice.format(a, b) for a, b in [("ten", "house"), ("few", "tool"), ("old", "man")]]
    texts += [texts[0] + "\n" + prose(18, 9)]
    docs = docs_of(texts)
    expected = {r.doc_id: r.text for r in lines.drop_recurring(docs, families=True).collect()}
    real = lines._whole
    monkeypatch.setattr(lines, "_whole", lambda tokens: [F.lit(7).cast("long").alias("whole"), real(tokens)[1]])
    assert {r.doc_id: r.text for r in lines.drop_recurring(docs, families=True).collect()} == expected
    assert expected[9] == prose(18, 9)


def test_tokens_of_families_are_written_a_bounded_number_of_times(docs_of, monkeypatch):
    """Three families in one leaf whose copies each have two changed words, 10 to 40 copies of 200 words."""
    rows = {}
    real = lines.stored

    def counted(df, name):
        out = real(df, name)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(lines, "stored", counted)
    for copies in (10, 40):
        texts = []
        for f in "abc":
            words = ["all", "lines", "begin", "alike", *[f"{f}{'klmnopqrst'[i // 20]}{chr(97 + i % 20)}" for i in range(196)]]
            for c in range(copies):
                own = list(words)
                for at in (4 + c * 7 % 196, 4 + c * 31 % 196):
                    own[at] = f"{f}edit{chr(97 + c // 20)}{chr(97 + c % 20)}"
                texts.append(" ".join(own))
        got = {r.doc_id for r in lines.drop_recurring(docs_of(texts), families=True).filter("n_dropped > 0").collect()}
        assert got == {i for i in range(3 * copies) if i % copies}
        assert rows["line-tokens"] == rows["line-left"] == 3 * copies
        assert rows["line-family-tokens"] <= lines.VOTES * rows["line-tokens"]
