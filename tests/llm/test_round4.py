"""The limits of quality rules come from all labelled texts."""

import inspect
import random

from leadlake.llm import quality


def test_bands_come_from_every_good_text(spark):
    """The good texts of low ratio have ids that a bounded draw by hash may miss; each counts."""
    rng = random.Random(5)
    stock = ["".join(rng.choices("etaoinshrdlucm", k=rng.randint(2, 9))) for _ in range(2000)]
    docs = spark.createDataFrame([(k, " ".join(rng.choices(stock, k=90))) for k in range(600)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1) for k in range(600)], "doc_id long, quality int")
    fitted = quality.fit_bands(docs, labels).fitted
    measured = quality.quality(docs).filter("not base_failed").collect()
    by_class = {}
    for r in measured:
        by_class.setdefault(sum(len(r.text.encode()) >= e for e in quality.LENGTHS), []).append(round(r.ratio, 4))
    wanted = {}
    for kind, ratios in by_class.items():
        if len(ratios) >= quality.FIT_LEAST:
            at = quality.FIT_SHARE * (len(ratios) - 1)
            low, high = sorted(ratios)[int(at)], sorted(ratios)[int(at) + 1]
            wanted[kind] = low + (high - low) * (at - int(at)) - quality.FIT_MARGIN
    assert {k: round(v, 9) for _, k, v in fitted} == {k: round(v, 9) for k, v in wanted.items()} and wanted
    assert inspect.signature(quality.fit_bands).parameters["most"].default is None
