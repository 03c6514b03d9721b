"""Operators from DataFrame to DataFrame."""

from playbill.operators.clean import (
    clean_credits, clean_episodes, clean_people, clean_ratings, clean_titles,
)
from playbill.operators.joins import enrich, orphans, with_role
from playbill.operators.marts import (
    enrich_credits, enrich_episodes, enrich_titles, episode_decade,
)
from playbill.operators.publish import (
    audit_counts, completeness, conform, ensure_database, publish,
)
from playbill.operators.topk import keep_top_groups, top_groups, top_keys, top_rows

__all__ = [
    "audit_counts", "clean_credits", "clean_episodes", "clean_people",
    "clean_ratings", "clean_titles", "completeness", "conform", "enrich",
    "enrich_credits", "enrich_episodes", "enrich_titles", "ensure_database",
    "episode_decade", "keep_top_groups", "orphans", "publish",
    "top_groups", "top_keys", "top_rows", "with_role",
]
