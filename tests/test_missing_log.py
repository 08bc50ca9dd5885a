"""The log of missing reports is one JSON in pieces that do not grow."""

import json

from loamwork.plans.file_plans import missing_counts, missing_json


def test_log_in_pieces(spark):
    entries = [(k, f"c{k % 3}" if k % 4 else None, "2020" if k % 2 else None, 'a "b"') for k in range(20, 0, -1)]
    log = missing_json(spark.createDataFrame(entries, "event_id long, company_name string, year string, tier_1_error string").repartition(4)).collect()
    assert sorted(r.place for r in log) == list(range(22)) and sum(r.part == "entry" for r in log) == 20
    assert max(len(r.json) for r in log if r.part == "entry") < 100
    read = json.loads("".join(r.json for r in sorted(log)))
    assert list(read) == ["total_missing_reports", "entries", "company_names", "years"] and read["total_missing_reports"] == 20
    assert [tuple(e.values()) for e in read["entries"]] == sorted(entries) and read["company_names"] == {"Unknown": 5, "c0": 5, "c1": 5, "c2": 5}
    assert missing_counts(spark.createDataFrame(log)).first().asDict() == {"total_missing_reports": 20, "years": {"2020": 10, "Unknown": 10}}


def test_empty_log(spark):
    log = missing_json(spark.createDataFrame([], "event_id long, company_name string, year string")).collect()
    assert json.loads("".join(r.json for r in sorted(log))) == {"total_missing_reports": 0, "entries": [], "company_names": {}, "years": {}}
