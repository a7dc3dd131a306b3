"""Whole runs: parts that do not need each other run side by side, and a date is scored once."""

import threading
from datetime import date
from types import SimpleNamespace

import pytest

from acctiers.plans import runs as R
from acctiers.plans import validation as V


def _run(day):
    return SimpleNamespace(tiers=f"tiers {day}", scored=SimpleNamespace(weights={}), normalized=lambda: f"normalized {day}")


@pytest.fixture
def parts(monkeypatch):
    """Stand-ins for the long parts of a back-test, which return once all of them have begun."""
    begun = threading.Barrier(4, timeout=20)

    def long(name):
        def part(*given, **named):
            begun.wait()
            return name

        return part

    monkeypatch.setattr(R, "judge", lambda orders, run, cfg: f"judged {run.tiers}")
    for name in ("lift_table", "kruskal_wallis", "anova_log_revenue", "adjacent_tier_tests", "churn_chi_square", "monotonic_outcomes"):
        monkeypatch.setattr(V, name, lambda judged, *rest, name=name: (name, judged))
    for name in ("bootstrap_spearman", "weight_sensitivity", "tier_stability"):
        monkeypatch.setattr(V, name, long(name))

    def fit(judged, *rest, **named):
        begun.wait()
        raise LookupError("no model")

    return fit


def test_parts_of_a_back_test_run_side_by_side_and_errors_come_out(parts):
    with pytest.raises(LookupError, match="no model"):  # not a broken barrier
        R.backtest(None, None, None, date(2026, 6, 30), current=_run("now"), past=_run("then"), fit=parts)


def test_both_dates_of_a_run_are_scored_side_by_side_and_once(monkeypatch):
    both, begun, scored, seen = threading.Barrier(2, timeout=20), threading.Event(), [], {}

    def score(orders, lines, customers, day, cfg):
        scored.append(day)
        both.wait()
        return _run(day)

    def segments(run, cfg):
        begun.wait(20)  # the back-test does not wait for the segments
        run.tiers = f"{run.tiers} with segments"
        return run

    def tested(*given, **named):
        begun.set()
        seen.update(named, current=named["current"]())

    monkeypatch.setattr(R, "load_inputs", lambda store: (None, None, None))
    monkeypatch.setattr(R, "score_customers", score)
    monkeypatch.setattr(R, "with_segments", segments)
    monkeypatch.setattr(R, "backtest", tested)
    monkeypatch.setattr(R, "write_tables", lambda *given: None)
    monkeypatch.setattr(R, "publish", lambda store: None)
    cfg = {**R.TIERING, "horizon_days": 30}
    run = R.run_tiering(None, "2026-06-30", "id", cfg)
    assert sorted(scored) == [date(2026, 5, 31), date(2026, 6, 30)]
    assert run is seen["current"] and run.tiers == "tiers 2026-06-30 with segments" and seen["past"].tiers == "tiers 2026-05-31"
