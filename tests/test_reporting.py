"""Dashboard controls: grain, inclusive date range, segment; long form and scorecards."""
import datetime as dt

from tidemark.operators.reporting import growth_long_form, growth_scorecards, growth_trend, select_view
from tidemark.plans.marts import Marts


def test_controls_and_shapes(raw):
    rows = [{"event_time": f"2024-01-{d:02d}", "user_id": u, "platform": p}
            for d, u, p in [(1, "a", "web"), (2, "a", "web"), (2, "b", "ios"), (9, "b", "ios"), (10, "a", "web")]]
    g = Marts(raw(rows)).growth_accounting
    days = select_view(g, "daily", dt.date(2024, 1, 2), dt.date(2024, 1, 9))
    assert sorted(r.period_start.day for r in days.collect()) == [2, 9]
    web = select_view(g, "daily", segment=("UNKNOWN", "web", "unknown"))
    assert sorted(r.period_start.day for r in web.collect()) == [1, 2, 10]
    lf = growth_long_form(g, "weekly").collect()
    assert {r.metric for r in lf} == {"active_users", "new_users", "retained_users", "resurrected_users",
                                      "churned_users"}
    assert [r.period_start for r in lf] == sorted(r.period_start for r in lf)
    sc = {r.period_grain: r for r in growth_scorecards(g).collect()}
    assert sc["daily"].periods == 4 and sc["daily"].new_users == 2 and sc["weekly"].active_users == 4
    tr = growth_trend(g, "weekly").collect()
    assert [r.period_start for r in tr] == [dt.date(2024, 1, 1), dt.date(2024, 1, 8)]
