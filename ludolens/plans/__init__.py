"""Whole jobs composed of operators."""

from ludolens.plans.clean import clean_games
from ludolens.plans.daily import DailyPaths, DailySummary, finish_day, prepare_day, run_daily
from ludolens.plans.fetch import FetchPlan, Ingested, ingest_details, plan_fetch, update_catalogue
from ludolens.plans.reports import (
    Predictions,
    Rankings,
    detect_outliers,
    predict_prices,
    price_trends,
    rank_popularity,
)

__all__ = [
    "DailyPaths",
    "DailySummary",
    "FetchPlan",
    "Ingested",
    "Predictions",
    "Rankings",
    "clean_games",
    "detect_outliers",
    "finish_day",
    "ingest_details",
    "plan_fetch",
    "predict_prices",
    "prepare_day",
    "price_trends",
    "rank_popularity",
    "run_daily",
    "update_catalogue",
]
