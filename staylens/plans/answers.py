"""The seven standing market questions over the warehouse tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from staylens.operators import market

Tables = Mapping[str, DataFrame]

QUESTIONS: dict[str, Callable[[Tables], DataFrame]] = {
    "price_by_city_and_room": lambda t: market.price_by_room(market.listing_star(t, "dim_room_type")),
    "top_neighbourhoods_by_revenue": lambda t: market.top_neighbourhoods(market.listing_star(t, "dim_neighbourhood")),
    "superhost_premium": lambda t: market.superhost_premium(market.listing_star(t, "dim_host")),
    "price_by_property_family": lambda t: market.price_by_family(market.listing_star(t, "dim_property")),
    "tenure_and_reviews": lambda t: market.tenure_activity(market.listing_star(t, "dim_host")),
    "monthly_availability": lambda t: market.monthly_availability(market.dated_star(t, "fact_calendar")),
    "subscores_by_city": lambda t: market.subscores_by_city(market.listing_star(t)),
}


def answer_all(
    tables: Tables, root: str, questions: Mapping[str, Callable[[Tables], DataFrame]] = QUESTIONS
) -> DataFrame:
    """Write each answer under its name; one status row per question. A question
    that fails is recorded and the rest go on."""
    status = []
    for name, ask in questions.items():
        try:
            ask(tables).write.mode("overwrite").parquet(f"{root}/{name}")
            status.append((name, True, None))
        except Exception as error:  # recorded, as every other answer is still wanted
            status.append((name, False, str(error)[:2000]))
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(status, "question string, ok boolean, error string")
