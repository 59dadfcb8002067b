"""Landed pages and a media listing against the store: what to fetch, what to download."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from tagmill.operators import catalog, media
from tagmill.sources.items import ingest_pages


@dataclass(frozen=True)
class Reconciliation:
    gaps: DataFrame
    plan: DataFrame
    missing: DataFrame
    summary: DataFrame


def reconcile(
    items: DataFrame,
    listing: DataFrame,
    remote_max: int | Column,
    include_videos: bool = False,
    media_root: str | None = None,
    **window,
) -> Reconciliation:
    """Id gaps, the next fetch window, the missing media and the totals. ``window`` goes to ``fetch_plan``."""
    gaps = catalog.gap_analysis(items.select("id"), remote_max)
    wanted = media.catalog_media(items, include_videos)
    return Reconciliation(
        gaps,
        catalog.fetch_plan(gaps, remote_max, **window),
        media.missing_media(wanted, listing, media_root),
        media.media_summary(wanted, listing),
    )


def ingest(pages: DataFrame, details: DataFrame, held: DataFrame, plan: DataFrame, full: bool = False) -> DataFrame:
    """Items to store from landed documents: inside the window and not held, with their details.

    A full run takes held items again. Items whose detail has not landed are left for the next run.
    """
    wanted = catalog.in_window(pages, plan)
    fresh = wanted if full else catalog.new_items(wanted, held)
    return catalog.attach_details(fresh.drop("tags", "comments"), details)


__all__ = ["Reconciliation", "ingest", "ingest_pages", "reconcile"]
