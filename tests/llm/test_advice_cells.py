"""Cells that a shared passage strings together: few sets travel, and the groups are those of brute force."""

import random

import pytest
from conftest import words

from tessera.llm import sigtree


@pytest.fixture
def strung(spark):
    rng = random.Random(11)
    passage = words(rng, 60, 90000)
    rows = []
    for k in range(40):  # pairs of near copies, all with the passage
        own = words(rng, rng.randrange(200, 216), 90000)
        rows += [(2 * k, f"{own} {passage}"), (2 * k + 1, f"{own} {passage} end{k}")]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def sent_to_tasks(monkeypatch):
    sent, run = [], sigtree._run_tasks

    def counted(tasks, *rest):
        sent.append(tasks.count())
        return run(tasks, *rest)

    monkeypatch.setattr(sigtree, "_run_tasks", counted)
    return sent


def test_a_passage_strings_no_documents_together(strung, monkeypatch):
    monkeypatch.setattr(sigtree, "BLOCK_BYTES", 1)  # a document a block: no word counts as frequent
    monkeypatch.setattr(sigtree, "PAGE", 1000)
    sent = sent_to_tasks(monkeypatch)
    groups = {r.doc_id: r.component_id for r in sigtree.jaccard_groups(strung).collect()}
    assert groups == {k: k // 2 * 2 for k in range(80)}
    assert sum(sent) <= 160


def test_stragglers_of_a_large_cell_meet_each_page_once(spark, monkeypatch):
    rng = random.Random(3)
    base = words(rng, 300, 90000).split()
    rows = []
    for k in range(60):  # near copies; every tenth only shares two thirds, and links with its neighbour
        own = list(base)
        if k % 10 > 7:
            own[200:] = words(random.Random(k // 10), 100, 90000).split()
        own[k] = f"x{k}"
        rows.append((k, " ".join(own)))
    monkeypatch.setattr(sigtree, "PAGE", 1500)
    sent = sent_to_tasks(monkeypatch)
    groups = {r.doc_id: r.component_id for r in sigtree.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert groups == {k: k - k % 10 + 8 if k % 10 > 7 else 0 for k in range(60)}
    assert sum(sent) <= 60 * 12
