"""Every stage of the pipeline on hard rows, and the near duplicates against comparing all pairs."""

import subprocess
import sys

import pytest
import corpus_pipeline as P

from .conftest import key

FOLDER = "/root/testdata/sf0.001"


def shingles(text):
    words = (text or "").translate({i: i + 32 for i in range(65, 91)}).encode().split()
    width = min(5, len(words))
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)} if words else set()


def kept_by_plain(rows):
    """Numbers of the rows that stay: the first of every group in the order of ids, missing ones last."""
    sets, group = [shingles(t) for _, t in rows], list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            linked = sets[i] and 100 * both >= 75 * len(sets[i] | sets[j])
            if linked or not sets[i] and rows[i][0] is not None and rows[i] == rows[j]:
                group[root(i)] = root(j)
    best = {}
    for i, (doc, _) in enumerate(rows):
        rank = (doc is None, doc or 0)
        if root(i) not in best or rank < best[root(i)][0]:
            best[root(i)] = (rank, i)
    return sorted(((rows[i][0], rows[i][1]) for _, i in best.values()), key=key)


def test_one_row_of_each_group_stays(spark):
    base = " ".join(f"w{i}" for i in range(80))
    rows = [(1, base), (3, base + " end"), (3, "something else entirely is written here today"), (3, base), (2, base.upper()), (None, base), (4, ""), (4, ""), (5, None),
            (5, "  "), (None, ""), (None, ""), (6, "one two"), (7, "one two"), (8, "one two three"), (9, "something else entirely is written here today"),
            (10, " ".join(f"v{i}" for i in range(20_000)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "text AS _text", "doc_id AS _nth", "'x' AS row_number", "doc_id AS component_id", "doc_id AS at", "text AS id").repartition(4)
    found = P.keep_one_of_each(spark, docs, FOLDER)
    assert found.columns == docs.columns
    out = found.collect()
    assert sorted(((r.doc_id, r.text) for r in out), key=key) == kept_by_plain(rows)
    assert all(r._text == r.text and r._nth == r.doc_id and r.row_number == "x" and r.id == r.text for r in out)
    assert P.keep_one_of_each(spark, docs.limit(0), FOLDER).count() == 0


@pytest.mark.parametrize("name, stage", P.STAGES[:-1])
def test_stages_keep_columns_and_take_hard_rows(spark, hard_documents, monkeypatch, name, stage):
    fit = P.toxicity.fit_toxicity
    monkeypatch.setattr(P.toxicity, "fit_toxicity", lambda texts, marks: fit(texts, marks, epochs=2, steps=2))
    out = stage(spark, hard_documents, FOLDER)
    assert out.columns == hard_documents.columns
    kept = {tuple(r) for r in out.collect()}
    assert kept <= {tuple(r) for r in hard_documents.collect()}
    assert stage(spark, hard_documents.limit(0), FOLDER).count() == 0


def test_packing_places_every_row(spark, hard_documents):
    out = P.pack(spark, hard_documents, FOLDER).collect()
    assert {r.doc_id for r in out} == {r.doc_id for r in hard_documents.collect()}
    assert P.pack(spark, hard_documents.limit(0), FOLDER).count() == 0


def test_entry_imports_without_the_subpackage():
    code = ("import sys\n"
            "import importlib.machinery as m\n"
            "plain = m.PathFinder.find_spec\n"
            "m.PathFinder.find_spec = classmethod(lambda c, n, p=None, t=None: None if n.startswith('tabloom.llm') else plain(n, p, t))\n"
            "import __spark_entry__ as e\n"
            "q = e.queries()\n"
            "assert 'pipeline' not in q and not any(k.startswith('op1_') for k in q) and 'describe' in q\n")
    assert subprocess.run([sys.executable, "-c", code], cwd=P.__file__.rpartition("/")[0]).returncode == 0
