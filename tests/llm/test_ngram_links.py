"""Every link between different sets, those inside a component too, against all pairs."""

import pytest
from test_ngram_join import gram_set, near_copies

from patronlens.llm import ngram_join as nj


def check_links(spark, rows, similar=(90, 100), n=3):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    pairs, membership = nj.links(docs, similar, n)
    classes = {r.doc_id: r["class"] for r in membership.collect()}
    sets = {i: gram_set(t) for i, t in rows}
    assert len(classes) == len(rows)
    ids, expected = sorted(sets), set()
    for i in ids:
        for j in ids:
            if i < j and sets[i] and sets[j]:
                assert (classes[i] == classes[j]) == (sets[i] == sets[j])
                both = len(sets[i] & sets[j])
                if sets[i] != sets[j] and similar[1] * both >= similar[0] * (len(sets[i]) + len(sets[j]) - both):
                    expected.add((min(classes[i], classes[j]), max(classes[i], classes[j])))
    found = [(r.a, r.b) for r in pairs.collect()]
    assert len(found) == len(set(found)) and set(found) == expected
    assert all(classes[i] is None for i in ids if not sets[i])
    return found


@pytest.mark.parametrize("words,size", [(60, 20), (160, 30)])
def test_links_equal_brute_force(spark, words, size):
    check_links(spark, near_copies(words, 3, size, words))


def test_links_inside_components_are_given(spark):
    found = check_links(spark, near_copies(3, 3, 20, 400))
    assert len(found) > 3 * 20  # more than the trees that hold the components together


def test_blocks(spark, monkeypatch):
    monkeypatch.setattr(nj, "BLOCK", 5)
    check_links(spark, near_copies(4, 2, 40, 160))


def test_other_similarity_and_odd_rows(spark):
    rows = near_copies(9, 2, 20, 80)
    rows += [(1000, None), (1001, ""), (1002, "one two"), (1003, "ONE two")]
    check_links(spark, rows, (80, 100))


def test_empty_table(spark):
    pairs, membership = nj.links(spark.createDataFrame([], "doc_id long, text string"))
    assert pairs.count() == membership.count() == 0
