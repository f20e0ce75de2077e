"""Parameters that the driver decides: cases with their results."""

from datetime import datetime

import pytest

from strandline.operators import nulls
from strandline.plans import parameters
from strandline.sources import files

NOW = datetime(2024, 3, 31, 12, 30)


def shown(function, *case):
    try:
        return str(function(*case))
    except ValueError:
        return "error"


@pytest.mark.parametrize(("text", "result"), [("6h", "2024-03-31 06:30:00"), ("30d", "2024-03-01 12:30:00"), ("2w", "2024-03-17 12:30:00"), ("1m", "2024-03-02 12:30:00"), ("1y", "2023-03-31 12:30:00"), ("", "error"), ("5x", "error"), ("d", "error")])
def test_relative_time(text, result):
    assert shown(parameters.relative_time, text, NOW) == result


@pytest.mark.parametrize(("text", "result"), [("48h30m", 174600.0), ("1m30s", 90.0), ("1.5s", 1.5), ("250ms", 0.25)])
def test_durations(text, result):
    assert parameters.duration(text).total_seconds() == result
    for bad in ("48", "h"):
        assert shown(parameters.duration, bad) == "error"


def test_windows_and_pairs():
    pair = lambda text: " ".join(f"{d:%Y-%m-%d}" for d in parameters.date_range(text))
    assert [shown(pair, t) for t in ("2024-01-01,2024-02-01", "2024-01-05, 2024-01-05", "2024-02-01,2024-01-01", "2024-01-01", "x,y")] == ["2024-01-01 2024-02-01", "2024-01-05 2024-01-05", "error", "error", "error"]
    a, b, recent, first = (datetime(2024, 1, d) for d in (2, 9, 5, 1))
    cases = [((a, b), recent, first), ((a, None), recent, first), ((None, None), recent, first), ((None, b), None, first), ((None, None), None, None)]
    assert [" ".join(f"{d:%m-%d}" if d else "-" for d in parameters.date_window(NOW, *c)) for c in cases] == ["01-02 01-09", "01-05 03-31", "01-05 03-31", "01-01 03-31", "- 03-31"]


@pytest.mark.parametrize("platform", ["telegram", "youtube", "other"])
@pytest.mark.parametrize("method", ["channel", "snowball", "random-walk", "random", "none"])
def test_sampling_matrix(platform, method):
    for urls, sample, seeds in ((u, s, d) for u in (0, 2) for s in (0, 5) for d in (0, 3)):
        known = method in {"telegram": ("channel", "snowball", "random-walk"), "youtube": ("channel", "snowball", "random")}.get(platform, ())
        given = urls == 0 and sample > 0 if method == "random" else (urls > 0) != (seeds > 0) if method == "random-walk" else urls > 0
        try:
            parameters.validate_sampling(platform, method, urls=urls, sample_size=sample, seed_size=seeds, crawl_id="c")
            valid = True
        except ValueError:
            valid = False
        assert valid == (known and given)


def test_modes_jobs_overlays_and_sizes():
    cases = [("",), ("orchestrator",), ("worker",), ("worker", "w1"), ("cluster",), ("job", "", 0, 10), ("job", "", 170, 100)]
    assert [shown(lambda *c: parameters.validate_mode(*c) or "ok", *c) for c in cases] == ["ok", "ok", "error", "ok", "error", "error", "error"]
    jobs = [("scheduled-crawl-1", ""), ("crawl", ""), ("maintenance-x", ""), ("other", "Crawl it"), ("crawler", ""), ("", "")]
    assert [parameters.job_kind(*c) for c in jobs] == ["crawl", "crawl", "maintenance", "crawl", "generic", "generic"]
    base = parameters.CrawlSettings(concurrency=3, crawl_label="base")
    laid = [base.overlaid(j) for j in ({"concurrency": 0, "max_depth": 2, "crawl_label": "nightly"}, {"concurrency": 8}, {"crawl_label": ""})]
    assert [(s.concurrency, s.max_depth, s.crawl_label) for s in laid] == [(3, 2, "nightly"), (8, -1, "base"), (3, -1, "base")]
    assert shown(base.overlaid, {"unknown": 1}) == "error"
    assert [parameters.batch_size(k, 0.3) for k in range(200)] == [min(50, max(5, int(k * 10 / 3 + 1e-9) + 1)) if k < 100 else 50 for k in range(200)]
    assert [parameters.quota_rounds(f, t) for f, t in (([50, 50], 60), ([30, 80, 80], 100), ([0] * 500, 1), ([80], 10), ([5], 0))] == [(2, 60), (3, 100), (200, 0), (1, 10), (0, 0)]


def test_settings_and_rules(spark):
    spark.conf.set("strandline.set", "given")
    spark.conf.set("strandline.empty", "")
    assert [files.setting(spark, f"strandline.{n}", "fallback") for n in ("set", "unset", "empty")] == ["given", "fallback", "fallback"]
    counts = {}
    for platform in nulls.PLATFORMS:
        for r in nulls.rules_table(spark, nulls.merged_rules(platform)).collect():
            counts[platform, r.behavior] = counts.get((platform, r.behavior), 0) + 1
    assert counts == {("youtube", "critical"): 9, ("youtube", "log"): 36, ("youtube", "optional"): 1, ("youtube", "unavailable"): 36, ("telegram", "critical"): 9, ("telegram", "log"): 26, ("telegram", "unavailable"): 47}
    rules = nulls.merged_rules("youtube", {"url": ("log", "own text"), "not_a_rule": ("critical", "new")})
    assert rules["url"] == ("log", "own text") and rules["not_a_rule"] == ("critical", "new") and rules["post_link"] == ("critical", "post_link is required")
