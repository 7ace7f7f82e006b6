"""Documents that hold nothing are set aside by a few runs of words."""

import pytest
from pyspark.sql import functions as F

from cuadra.llm import decontaminate as D

WORDS = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrst"]


def _frame(spark, rows, key):
    return spark.createDataFrame(rows, f"{key} long, text string")


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 7, 8, 11])
def test_no_place_of_an_item_is_lost(spark, size):
    item = " ".join(WORDS[:size])
    filler = WORDS[20:60]
    docs = [(k, " ".join([*filler[:k], item, *filler[k:k + 9]])) for k in range(13)]
    docs += [(100, " ".join(filler)), (101, ""), (102, None), (103, item), (104, " ".join(WORDS[1:size]) or "x")]
    found = D.find_items(_frame(spark, docs, "doc_id"), _frame(spark, [(1, item)], "item_id"), min_share=1.0)
    assert sorted(r.doc_id for r in found.collect()) == [*range(13), 103]


def test_every_window_holds_an_anchor_wherever_it_lies():
    for w in range(1, 40):
        stride, length = D._anchor(w)
        for at in range(3 * w):
            assert any(at <= p and p + length <= at + w for p in range(0, at + w, stride))


def test_only_near_documents_are_cut_into_windows(spark):
    item = "Anna Miller sold 12 km of rope to the old mill in March"
    docs = [(k, " ".join(WORDS[k:k + 30])) for k in range(40)]
    docs += [(50, " ".join(WORDS[:6]) + " " + item.replace("Anna Miller", "Berta Moore").replace("12", "77"))]
    items = D._item_windows(_frame(spark, [(1, item), (2, None)], "item_id"), D.WINDOW)
    near = D._with_anchors(D._worded(_frame(spark, docs, "doc_id"), "doc_id"), [D.WINDOW], items.select(F.explode("_inner").alias("_hash")))
    assert [r.doc_id for r in near.collect()] == [50]


def test_gaps_become_one_space(spark):
    texts = ["a  b", " a", "a -b", "a- b", "a\tb", "a\n\nb", "a\u2014b \u2013 c", "a b", "--a--", "  ", "1-2\r\n3", "a \tb- -c"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "text string").select(D.clean(F.col("text"))).collect()]
    assert got == ["a b", "a", "a b", "a b", "a b", "a b", "a b c", "a b", "a", "", "1 2 3", "a b c"]
