import json

import pytest
from pyspark.sql import functions as F

from leadlake.operators import candidates as N
from leadlake.operators import enrichment as E
from leadlake.operators import queues as Q

LEAD = {
    "candidate_name": "Sample Academy", "operator_name": "Sample College", "city": "Town", "region": "BC", "country": "CA", "venue_name": "North Hall", "canonical_url": "https://www.e.org/p/?utm_source=x",
    "overnight_evidence_snippet": "overnight stay in a dorm", "recent_activity_evidence_snippet": "apply now for 2024", "provisional_program_family_tags": ["stem", "2-week"],
}


@pytest.fixture
def reports(tmp_path):
    rows = {
        "a_raw.jsonl": [{"query": "q", "title": "T", "url": "https://e.org/t"}],  # a helper by its suffix
        "b.jsonl": [{"query": "q", "title": "Raw lead", "url": "https://e.org/t", "snippet": "multi-week overnight"}],
        "c.jsonl": [{"candidate_id": "c1", "name": "Poorer"}, {"candidate_id": "c2", "name": "Many", "record_basis": "multi_venue_candidate"}],
        "d.jsonl": [{"candidate_id": "c1", **LEAD}],
        "e.jsonl": [{"candidate_id": "x", "matched_reason": "r", "name": "n"}],
    }
    for name, lines in rows.items():
        (tmp_path / name).write_text("\n".join(map(json.dumps, lines)) + "\n\n")
    (tmp_path / "f.json").write_text(json.dumps([{"name": "From an array", "city": "X"}]))
    (tmp_path / "g.json").write_text(json.dumps({"scan_type": "s", "scope": "all", "candidates": [{"name": "From a batch", "venue_name": "various"}]}))
    (tmp_path / "h.json").write_text("[1, 2]")
    (tmp_path / "i.json").write_text("no json")
    (tmp_path / "j_summary.json").write_text("[]")
    return str(tmp_path)


def test_report_kinds(spark, reports):
    kinds = {r.file: r.kind for r in N.report_kinds(N.scan_reports(spark, reports)).collect()}
    assert kinds == {"a_raw.jsonl": "skip", "b.jsonl": "raw", "c.jsonl": "candidates", "d.jsonl": "candidates", "e.jsonl": "skip", "f.json": "array", "g.json": "batch", "h.json": "skip", "i.json": "skip", "j_summary.json": "skip"}


def test_ingest(spark, reports):
    scan = N.scan_reports(spark, reports)
    rows = N.report_rows(scan, N.report_kinds(scan))
    out = N.ingest(rows, 2024)
    best = {r.candidate_id: r for r in out["candidates"].collect()}
    assert len(best) == 5 and best["c1"].name == "Sample Academy" and best["c1"].source_reports == ["c.jsonl", "d.jsonl"]
    assert best["cand-us-unk-unknown-city-raw-lead-pending-venue-e-org"].duration_guess.label == "multi-week"
    assert best["c2"].record_basis == "multi_venue_candidate"
    assert [(r.candidate_id, r.file) for r in out["conflicts"].collect()] == [("c1", "d.jsonl")]
    assert sorted(r.split_task_id for r in out["split_tasks"].collect()) == sorted(r.split_task_id for r in out["split_stubs"].collect()) and out["split_tasks"].count() == 2
    summary = json.loads(out["summary"].first().summary)
    assert summary["counts"]["aggregate_candidates"] == 5 and summary["counts"]["duplicate_candidate_ids"] == 1 and {x["file"]: x["records"] for x in summary["reports_ingested"]}["c.jsonl"] == 2


def test_one_lead(spark):
    r = N.normalised(spark.read.schema(N.SCHEMA).json(spark.sparkContext.parallelize([json.dumps(LEAD)])), 2024).first()
    assert (r.candidate_id, r.record_basis, r.canonical_url) == ("cand-ca-bc-town-sample-academy-north-hall", "venue_candidate", "https://e.org/p")
    assert r.program_family == ["stem", "academic"] or set(r.program_family) == {"stem"}
    assert set(r.camp_types) == {"overnight", "residential-academic"} and tuple(r.duration_guess) == ("2-week", 14, 14)
    assert r.validation_needs == ["ages_or_grades", "contact", "pricing"] and r.priority_flags.one_week_plus and r.activity_status_guess == "active_recent"
    assert json.loads(r.raw_discovery_source)["candidate_name"] == "Sample Academy"


def test_dossier(spark):
    rows = N.normalised(spark.read.schema(N.SCHEMA).json(spark.sparkContext.parallelize([json.dumps({**LEAD, "eligibility_summary": "Ages 12 to 17"})])), 2024)
    r = Q.dossiers(rows).first()
    assert r.reasons == [] and r.confidence == "medium" and r.operator_type == "university"
    head = json.loads(r.front_matter)
    assert head["ages"] == {"min": 12, "max": 17} and head["pricing"]["currency"] == "CAD" and head["evidence"]["overnight_source_url"] == "https://e.org/p"
    assert r.dossier.startswith("# Sample Academy at North Hall\n\n## Quick Take\n\n") and "Ages 12-17." in r.dossier and "## Open Questions" in r.dossier and r.dossier.endswith("## Sources\n\n- https://e.org/p")


def test_own_extractors(spark):
    df = spark.createDataFrame([("a", "x")], "candidate_id string, note string")
    own = {"note": lambda: E.result(F.lit("found"), F.lit("low"), F.col("note"), length=F.length("note"))}
    assert E.long_results(E.phase1(df, own), ["note"]).first().fields == '{"length":1}'
