"""Topics of instant-answer payloads are opened inside their row, whatever their depth."""

import json

from leadlake.scratch import mark
from leadlake.sources import files as Files


def nested(depths: int, held):
    for i in range(depths):
        held = {"Name": "n", "Topics": [{"FirstURL": f"u/before {i}", "Text": "[[ ]"}, held, None, 3, {"FirstURL": "", "Text": "no url"}, {"Topics": {"FirstURL": "no list"}}]}
    return held


def walked(topics) -> list[tuple[str, str]]:
    """(url, text) of the entries in order, those without URL too."""
    out = []
    for t in topics if isinstance(topics, list) else []:
        if isinstance(t, dict):
            out += [(t["FirstURL"], t["Text"])] if t.get("FirstURL") is not None else walked(t.get("Topics"))
    return out


def test_payloads_are_written_once_at_any_depth(spark):
    leaf = {"FirstURL": "u/leaf", "Text": "t"}
    depths = [0, 1, Files.DEPTHS - 1, Files.DEPTHS, Files.DEPTHS + 1, 3 * Files.DEPTHS + 1, 150]
    related = [[leaf, nested(d, leaf), {"Text": "neither"}, leaf] for d in depths] + [[{"Topics": [leaf, {"Topics": [leaf]}]}] * 5000 + [nested(20, leaf)]]
    rows = [(i, json.dumps({"RelatedTopics": r})) for i, r in enumerate(related)]
    escaped = 9 * '{"T\\u006fpics":[' + '{"FirstURL":"u/escaped","Text":""}' + 9 * "]}"
    rows.append((99, '{"RelatedTopics":[' + escaped + "]}"))
    df = spark.createDataFrame(rows, "id long, payload string")
    before = mark(spark)
    hits = Files.answer_hits(df, "payload", "id")
    assert mark(spark) - before == 1
    got = sorted((r.id, r.rank, r.url, r.title) for r in hits.collect())
    assert got == [(i, k, url, text) for i, r in enumerate(related) for k, (url, text) in enumerate(walked(r), 1) if url] + [(99, 1, "u/escaped", "u/escaped")]
