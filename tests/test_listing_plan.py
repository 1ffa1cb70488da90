"""Which rows the listing's joins move."""

import re

from noticelake.operators import listing
from workload.derive import market

SF = "/root/testdata/sf0.001"


def test_context_is_joined_last(spark):
    """A vehicle meets its model, photos and plates before the wide context of its lot, which would move with it to each of them."""
    t = market(spark, SF)
    rows = listing.vehicle_rows(t, listing.lot_context(t))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    topmost = re.search(r"Join (\w+), \((\w+)#\d+L? = (\w+)#", plan)
    assert topmost and topmost[1] == "Inner" and topmost[2] == "lot_id"


def test_empty_lots_are_told_apart_first(spark):
    t = market(spark, SF)
    some = t["lots"].orderBy("id").limit(3).select("id").collect()
    t["vehicles"] = t["vehicles"].filter(~t["vehicles"]["lot_id"].isin([r.id for r in some]))
    found = listing.lot_rows(t)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    before = plan[:plan.index("LeftAnti")]
    assert before.count("Inner") >= 3  # event, case and record come above the anti join
    got = {r.id for r in found.select("id").collect()}
    assert {r.id for r in some} <= got and not got & {r.lot_id for r in t["vehicles"].select("lot_id").distinct().collect()}
