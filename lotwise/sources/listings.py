"""Stored listing payloads (JSON) to offer URLs and to pages still to fetch."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.functions.coerce import as_text, is_kind, not_a
from lotwise.functions.once import computed_once
from lotwise.operators.latest import first_seen
from lotwise.schemas import LISTING

# Fixed value: type name of the node that holds the search result.
SEARCH_NODE = "AdvertSearchOutput"

# Page numbers are generated in blocks, so a large count needs no large array.
PAGE_BLOCK = 4096


def find_typed_node(payload: Column, typename: str = SEARCH_NODE) -> Column:
    """First JSON object in document order with the given ``__typename``, as JSON text;
    NULL if there is none. In Python because the built-in ways to walk a document of
    unknown shape visit members by name, not by position."""

    # Local functions travel to the executors whole; these need not have this package.
    def first_typed(text: str | None) -> str | None:
        try:
            pending = [json.loads(text or "")]
            while pending:
                node = pending.pop()
                if isinstance(node, dict):
                    if node.get("__typename") == typename:
                        return json.dumps(node)
                    node = list(node.values())
                if isinstance(node, list):
                    pending.extend(reversed(node))
        except (ValueError, RecursionError):
            pass
        return None

    @F.pandas_udf("string")
    def typed_node(payloads: pd.Series) -> pd.Series:
        return payloads.map(first_typed).astype(object)

    return typed_node(payload)


def parse_listings(listings: DataFrame, payload_col: str = "payload") -> DataFrame:
    """``search`` (the search result, parsed) and ``reject_reason`` in place of the payload."""
    node = listings.withColumn("search_json", find_typed_node(F.col(payload_col)))
    reason = F.when(F.col("search_json").isNull(), "no_search_node")
    return computed_once(
        node,
        *[c for c in listings.columns if c != payload_col],
        F.from_json("search_json", LISTING).alias("search"),
        reason.alias("reject_reason"),
    )


def edge_list(edges: Column) -> Column:
    return F.try_variant_get(edges, "$", "array<variant>")


def listing_urls(parsed: DataFrame, keep: list[str]) -> DataFrame:
    """Non-empty offer URLs with their position, from ``parse_listings``."""
    return _edges(parsed, keep).filter("edge_reason IS NULL AND url <> ''").select(*keep, "edge_pos", "url")


def listing_edge_rejects(parsed: DataFrame, keep: list[str]) -> DataFrame:
    """Edges that are no objects, hold a node that is none or a URL that is no text; and
    listings whose edges are no list, with a null position. An edge without a node or with
    an empty URL is no reject: it only has no offer."""
    odd = _edges(parsed, keep).filter("edge_reason IS NOT NULL").select(*keep, "edge_pos", F.col("edge_reason").alias("reject_reason"))
    edges = F.col("search.edges")
    unlisted = parsed.filter(edges.isNotNull() & ~is_kind(edges, "ARRAY"))
    return odd.unionByName(unlisted.select(*keep, F.lit(None).cast("int").alias("edge_pos"), F.lit("bad_edges").alias("reject_reason")))


def _edges(parsed: DataFrame, keep: list[str]) -> DataFrame:
    edges = parsed.select(*keep, F.posexplode(edge_list(F.col("search.edges"))).alias("edge_pos", "edge"))
    node = F.try_variant_get("edge", "$.node", "variant")
    url = F.try_variant_get("edge", "$.node.url", "variant")
    odd = ~is_kind(F.col("edge"), "OBJECT") | (node.isNotNull() & ~is_kind(node, "OBJECT")) | not_a(url, "STRING")
    return computed_once(
        edges,
        *keep,
        "edge_pos",
        F.when(is_kind(url, "STRING"), as_text(url)).alias("url"),
        F.when(odd, F.lit("bad_edge")).alias("edge_reason"),
    )


def listing_pages(parsed: DataFrame, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """Pages 1..ceil(total / size) per listing, page 1 always among them; and the listings
    that do not tell a total or a size."""
    total, size = F.col("search.totalCount"), F.col("search.pageInfo.pageSize")
    reason = (
        F.when(F.col("reject_reason").isNotNull(), F.col("reject_reason"))
        .when(total.isNull() | size.isNull(), "missing_key")
        .when(size == 0, "zero_page_size")
    )
    sized = parsed.select(
        *keep,
        total.cast("bigint").alias("total_count"),
        size.cast("bigint").alias("page_size"),
        reason.alias("reject_reason"),
    )
    count = F.expr("(total_count + page_size - 1) div nullif(page_size, 0)")
    counted = sized.filter(F.col("reject_reason").isNull()).select(*keep, count.alias("page_count"))
    last = F.greatest(F.col("page_count"), F.lit(1))
    blocks = counted.withColumn("last", last).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.expr(f"(last - 1) div {PAGE_BLOCK}")))
    )
    first = F.col("block") * PAGE_BLOCK + 1
    pages = F.sequence(first, F.least(F.col("last"), first + (PAGE_BLOCK - 1)))
    planned = blocks.select(*keep, "page_count", F.explode(pages).alias("page"))
    rejected = sized.filter(F.col("reject_reason").isNotNull()).select(*keep, "reject_reason")
    return planned, rejected


def distinct_urls(urls: DataFrame, order: list[str]) -> DataFrame:
    """Every URL once, at the first place it was seen across targets and pages."""
    return first_seen(urls, "url", order)
