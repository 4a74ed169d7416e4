"""The silver tables: page views, sessions, users."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from touchline.operators import sessions as S
from touchline.sources.tables import staged


@dataclass
class Silver:
    page_views: DataFrame
    sessions: DataFrame
    users: DataFrame


def silver(events: DataFrame, gap_s: int = 1800, cell_s: int | None = None) -> Silver:
    """All three silver tables of a wide event table.

    Page views are written before and after they are put into sessions, as
    several steps read them: each event is read and rolled up once.
    """
    rolled = staged(S.page_views(events), "page_views")
    views = staged(S.sessionize(rolled, gap_s=gap_s, cell_s=cell_s), "sessionized")
    return Silver(views, S.sessions(views), S.users(views))
