"""Items with other names, items shorter than a window, and items of few literal words."""

from __future__ import annotations

import pytest

from loadgrain.llm.templates import find_leaks

TOM = "Tom has {} apples. Tom buys {} more. Tom gives {} to Ann. How many apples does Tom have?"
BOSTON = "a train leaves the old station of Boston at noon and reaches the far end of the line after {} long hours"
NAMES = "when Anna met Peter near Paris she told Maria that Klaus and Laura saw David with Emma in Rome"
WITHOUT_QUESTION = "Tom has {} red apples in a basket. Tom buys {} more at the market. They are all eaten by his sister."
MANY = "the quick old boat with {} men sails over the {} wide lake to the far green shore before the night"
INSERTED = "the quick old boat with {} men sails over the {} wide and deep lake to the far green shore before the night"


@pytest.mark.parametrize("look_up", [1_000_000, 0])
@pytest.mark.parametrize(
    "item, text, same",
    [
        (TOM.format(5, 3, 2), TOM.format(7, 4, 6).replace("Tom", "Mary"), False),
        (WITHOUT_QUESTION.format(5, 3), "So. " + WITHOUT_QUESTION.format(8, 6).replace("Tom", "Mary"), False),
        (BOSTON.format(5), "Then " + BOSTON.replace("Boston", "New York").format(7), False),
        (NAMES, "so " + NAMES.lower(), True),
        (MANY.format(5, 3), INSERTED.format(7, 4), False),
        ("What is the capital of France?", "They asked: what is the capital of France? Nobody knew it at that time.", True),
        ("Compute 12 + 7 - 3 x 4", "The task is this. Compute 12 + 7 - 3 x 4 and then write down what comes out.", True),
        ("12 34 56 78 90 12 34 56 78", "these are 12 34 56 78 90 12 34 56 78 in a row", True),
    ],
)
def test_found(spark, docs, look_up, item, text, same):
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = [(r["doc_id"], r["same_values"]) for r in find_leaks(docs([(3, text)]), benchmark, look_up=look_up).collect()]
    assert got == [(3, same)]


def test_not_found(spark, docs):
    items = [(1, TOM.format(5, 3, 2)), (2, "What is the capital of France?"), (3, "Compute 12 + 7 - 3 x 4")]
    rows = [
        (1, TOM.format(7, 7, 6).replace("Tom", "Mary")),  # 5 and 3 both become 7
        (2, "Compute 12 + 8 - 3 x 4"),
        (3, "What is the old capital of France?"),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert find_leaks(docs(rows), benchmark).count() == 0
