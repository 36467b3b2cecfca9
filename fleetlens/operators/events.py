"""Cluster events delivered in pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens import constants as K
from fleetlens.functions.blocked import number_block, running_number


def union_pages(*pages: DataFrame) -> DataFrame:
    """Append pages, keeping duplicates; columns a page lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pages)


def all_events(pages: DataFrame) -> DataFrame:
    """Exploded pages ``(cluster_id, page_no, pos, …, total_count)`` → events in arrival order (newest first).

    ``seq`` numbers the events of a cluster; ``total_count`` is the one of its first page.
    """
    totals = pages.groupBy("cluster_id").agg(F.min_by("total_count", "page_no").alias("total_count"))
    ordered = running_number(
        pages.drop("total_count"), ["cluster_id"], ["page_no", "pos"], number_block(F.col("page_no"), 100), "seq"
    )
    return ordered.join(totals, "cluster_id")


def redacted(parameters: Column) -> Column:
    """Event parameters without free-text error messages; other parameters and NULL stay."""
    return F.map_filter(parameters, lambda key, value: ~key.isin(K.REDACTED_PARAMETERS))


def redact_events(events: Column) -> Column:
    """The same for ``array<struct<… details struct<reason struct<parameters map>>>>``."""
    def clean(event: Column) -> Column:
        reason = event["details"]["reason"]
        kept = F.when(reason.isNotNull(), reason.withField("parameters", redacted(reason["parameters"])))
        details = F.when(event["details"].isNotNull(), event["details"].withField("reason", kept))
        return event.withField("details", details)

    return F.transform(events, clean)
