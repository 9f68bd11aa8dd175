"""Masks of spans that overlap."""

from __future__ import annotations

from loadgrain.llm.pii import base_spans, mask_personal_data


def test_a_card_behind_an_address_is_masked_whole(docs):
    text = "host 10.0.0.4 111 1111 1111 1111 end"
    assert [(k, a, b) for a, k, b in base_spans(text)] == [(1, 5, 13), (2, 12, 32)]
    assert [r["text"] for r in mask_personal_data(docs([(1, text)])).collect()] == ["host [ip] end"]
