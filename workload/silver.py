"""Silver and gold tables."""

from __future__ import annotations

from touchline.operators import sessions as S
from touchline.plans import bindings as B
from touchline.plans.gold import first_touch_raw
from touchline.sources.tables import staged
from workload import ctes, inputs
from workload.registry import query


@query(f"WITH {ctes.VIEWS_CTE} SELECT * FROM views")
def page_view_table(spark, sf):
    return inputs.views(spark, sf)


@query(f"WITH {ctes.SESSIONS_CTE} SELECT * FROM session_table")
def session_table(spark, sf):
    return S.sessions(inputs.views(spark, sf))


@query(f"WITH {ctes.USERS_CTE} SELECT * FROM user_table")
def user_table(spark, sf):
    return S.users(inputs.views(spark, sf))


@query(f"WITH {ctes.GOLD_CTE} SELECT * FROM gold")
def first_touch_gold(spark, sf):
    return inputs.gold(spark, sf)


@query(f"WITH {ctes.RAW_GOLD_CTE} SELECT * FROM gold")
def first_touch_gold_raw(spark, sf):
    views = staged(inputs.views(spark, sf), "sessionized")
    return first_touch_raw(S.users(views), views, B.converted_users(spark, sf))
