import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline
from nearkin.llm import queries
from nearkin.session import stored

from . import definitions
from .conftest import prose

SMALL = "/root/testdata/sf0.001"


def near(text):
    return text.replace(" ", " x", 1)


@pytest.fixture
def docs(docs_of):
    texts = [prose(117, s) for s in range(10)]
    long = prose(400, 30).replace("\n", " ")
    texts += [long, near(long), None, "", "too short", "* # " * 100, texts[3]]
    texts += [prose(80, 40) + " password=hunter2hunter2 end"]
    return docs_of(texts)


def test_stages_return_the_columns_of_documents(spark, docs):
    kept, seen = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stored(stage(spark, kept, SMALL), name)
        assert kept.columns == corpus_pipeline.COLUMNS
        seen.append({r.doc_id: r for r in kept.collect()})
    rules, lines, groups, scanned = seen
    assert set(rules) == {*range(12), 16, 17}
    assert set(lines) == {*range(12), 17}
    want = definitions.without_recurring_lines([(i, r.text) for i, r in rules.items()])
    assert all(lines[i].text == want[i] for i in lines)
    assert set(groups) == {*range(11), 17}
    assert "hunter2" not in scanned[17].text and scanned[17].n_chars == len(scanned[17].text)
    assert all(scanned[i].text == groups[i].text for i in groups if i != 17)
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, SMALL).collect()
    assert {p.doc_id for p in pieces} == set(scanned)


def test_every_stage_takes_awkward_and_empty_tables(spark, awkward, empty):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).count() == 0, name
        assert stage(spark, awkward, SMALL).count() >= 0, name


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_registered_query_matches_its_sql(spark, name):
    found = queries.QUERIES[name](spark, SMALL).toPandas()
    assert len(found)
    if name not in queries.SQL:
        return
    con = duckdb.connect()
    for table in ("documents", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    want = con.sql(queries.SQL[name]).df()
    columns = sorted(found.columns)
    assert columns == sorted(want.columns)
    one, two = (f[columns].astype(str).sort_values(columns).reset_index(drop=True) for f in (found, want))
    assert one.equals(two)


def test_pipeline_runs_over_the_given_table(spark):
    pieces = corpus_pipeline.run(spark, SMALL).collect()
    assert pieces and len({p.sequence_id for p in pieces}) == max(p.sequence_id for p in pieces) + 1


def test_line_stage_drops_sentences_of_edited_paragraphs(spark, docs_of):
    passage = [f"{prose(12, s)}.".replace("\n", " ") for s in range(5)]
    docs = docs_of([" ".join(passage), " ".join(["Put in.", *passage]), " ".join(passage[1:])])
    stage = dict(corpus_pipeline.STAGES)["line_dedup"]
    assert {r.doc_id: r.text for r in stage(spark, docs, SMALL).collect()} == {0: " ".join(passage), 1: "Put in. "}
