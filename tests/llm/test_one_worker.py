"""A stage that finds and masks does both in one Python worker."""

from __future__ import annotations

from loadgrain.llm.pii import mask_personal_data


def test_masking_is_one_pass(docs):
    df = docs([(1, "mail me at a.b@c.org"), (2, None)])
    masked = mask_personal_data(df)
    assert masked.columns == df.columns
    assert [r["text"] for r in masked.orderBy("doc_id").collect()] == ["mail me at [email]", None]
    plan = masked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    named = df.withColumnRenamed("items", "base").withColumnRenamed("score", "added")
    assert [(r["base"], r["added"]) for r in mask_personal_data(named).collect()] == [(2, 3), (2, 3)]
