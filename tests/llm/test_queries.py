from __future__ import annotations

import pytest

from quirework.llm import queries

FOUND = {
    "p1_found": "field string, record_key string", "p2_found": "doc_id string, page_num int, field string", "p3_found": "request_id bigint", "p4_found": "doc_id string, page_num int, noise string",
    "p5_found": "doc_id string, page_num int, lang string", "p7_found": "doc_id bigint, item_id bigint", "p8_found": "doc_id bigint, subject string",
}


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_every_query_runs(spark, sf, name):
    df = queries.queries()[name](spark, sf)
    rows = df.collect()
    assert rows
    if name in FOUND:
        assert [f"{f.name} {f.dataType.simpleString()}" for f in df.schema] == FOUND[name].split(", ")
        assert len(rows) == len(set(rows))
