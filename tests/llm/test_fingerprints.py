import hashlib
import random
from collections import Counter

import pytest

from nearkin.llm import fingerprints as fp

from . import definitions
from .conftest import prose


def expected(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r))
    for place, (doc_id, text) in enumerate(rows):
        after = rows[(place + 1) % len(rows)][1]
        quarter = len(text) // 4
        yield doc_id, text, text[: len(text) - quarter] + after[:quarter], after


@pytest.mark.parametrize("rows_per_range", [2, 500])
def test_edited_texts_follow_the_next_document(awkward, awkward_rows, rows_per_range, monkeypatch):
    monkeypatch.setattr(fp, "ROWS_PER_RANGE", rows_per_range)
    got = sorted((r.doc_id, r.n_chars, hashlib.sha256(r.edited.encode()).hexdigest()) for r in fp.with_next(awkward).collect())
    want = sorted((i, len(t), hashlib.sha256(e.encode()).hexdigest()) for i, t, e, _ in expected(awkward_rows))
    assert got == want


def test_null_ids_come_first_and_all_rows_stay(docs_of, monkeypatch):
    monkeypatch.setattr(fp, "ROWS_PER_RANGE", 2)
    texts = [prose(40, s) for s in range(9)]
    docs = docs_of(texts, [None, 3, 1, 2, 9, 7, 8, 4, 5])
    got = {r.doc_id: r.edited for r in fp.with_next(docs).collect()}
    assert got == {i: e for i, _, e, _ in expected(list(zip([None, 3, 1, 2, 9, 7, 8, 4, 5], texts, strict=True)))}


def test_equal_texts_and_only_they_have_equal_fingerprints(awkward, awkward_rows):
    found = fp.fingerprint(awkward).collect()
    assert len(found) == len(awkward_rows)
    by_id = {r.doc_id: r.fingerprint for r in found}
    assert by_id[0] == by_id[4] and by_id[1] == by_id[2]
    assert len(set(by_id.values())) == len({t or "" for _, t in awkward_rows})


def test_sums_do_not_depend_on_order_and_can_be_taken_back():
    paragraphs = [prose(12, s).replace("\n", " ") for s in range(8)] + [prose(12, 3).replace("\n", " ")]
    shuffled = random.Random(5).sample(paragraphs, len(paragraphs))
    whole = fp.of_paragraphs(paragraphs)
    assert whole.to_text() == fp.of_paragraphs(shuffled).to_text()
    assert (whole - fp.of_paragraphs(paragraphs[:1])).to_text() == fp.of_paragraphs(paragraphs[1:]).to_text()
    assert (fp.of_paragraphs(paragraphs[:4]) + fp.of_paragraphs(paragraphs[4:])).to_text() == whole.to_text()
    assert fp.of_paragraphs(set(paragraphs)).to_text() != whole.to_text()
    assert fp.Fingerprint.from_text(whole.to_text()).to_text() == whole.to_text()


def test_likeness_is_near_the_exact_jaccard():
    paragraphs = [prose(27, s) for s in range(40)]
    for kept in (40, 30, 20, 10, 0):
        one = fp.of_paragraphs("\n".join(paragraphs).split("\n"))
        two = fp.of_paragraphs("\n".join(paragraphs[:kept] + [prose(27, 50 + s) for s in range(40 - kept)]).split("\n"))
        assert abs(one.near(two) - kept / (80 - kept)) < 0.12


def pieces(text):
    """The multiset of word pieces: three words in a row of a paragraph, or a shorter paragraph's words."""
    found = Counter()
    for line in text.split("\n"):
        words = definitions.spaced_words(line)
        found.update(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        found.update([tuple(words)] if 0 < len(words) < 3 else [])
    return found


def exact_likeness(one, two):
    if one == two:
        return 1.0
    one, two = pieces(one), pieces(two)
    both = (one | two).total()
    return (one & two).total() / both if both else 0.0


def test_likeness_counts_repeats_as_often_as_they_are():
    line, other = prose(9, 1), prose(9, 2)
    texts = [
        "\n".join([line] * 30), "\n".join([line] * 10), "\n".join([line] * 30 + [other] * 30), "\n".join([other] * 60),
        " ".join([line] * 20), " ".join([line] * 40), line, "a b a b a b a b a b a b", "a b a b a b", "",
    ]
    for one in texts:
        for two in texts:
            got = fp.of_paragraphs(one.split("\n")).near(fp.of_paragraphs(two.split("\n")))
            assert abs(got - exact_likeness(one, two)) < 0.15, (one[:30], two[:30])


def test_likeness_of_given_documents_and_their_edits(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sorted((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect())
    texts = {i: (t, e, n) for i, t, e, n in expected(rows)}
    worst = 0.0
    for r in fp.with_next(docs).collect():
        own, edited, after = texts[r.doc_id]
        worst = max(worst, abs(r.near_edited - exact_likeness(own, edited)), abs(r.near_next - exact_likeness(own, after)))
    assert worst < 0.15


def test_merged_fingerprint_is_that_of_all_paragraphs(spark, docs_of):
    texts = [prose(30, s) for s in range(6)]
    parts = fp.fingerprint(docs_of(texts)).selectExpr("doc_id % 2 as k", "fingerprint")
    got = {r.k: r.fingerprint for r in fp.merged(parts, "k").collect()}
    for k in (0, 1):
        lines = [line for t in texts[k::2] for line in t.split("\n")]
        assert got[k] == fp.of_paragraphs(lines).to_text()


def test_empty_table(empty):
    assert fp.with_next(empty).count() == 0
    assert fp.fingerprint(empty).count() == 0
