"""Filling fixed-capacity containers: vector bin packing by the dot-product heuristic.

A container has three limits at once: tokens, segments and loss-bearing tokens, the last a share of
its capacity, so that no container is all loss where others have none. It is filled item by item; the next is the one whose demands have the greatest dot product with the room that is
left, among those that fit in every limit. Items are kept as counts of equal demands, so a step
looks at the different demands only, and ties take the smallest item key.

A text within the capacity is never split. A longer one fills whole containers and leaves a rest
that is packed as an item.

Items are spread over shards of bounded size by a hash of their key, each packed by itself. Only
the last containers of a shard stay open, so the room that sharding loses is a few containers in
tens of thousands; no task ever holds more than a shard.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Items of a shard, on average.
SHARD_ITEMS = 20_000
#: Loss-bearing tokens of a container, as a share of its capacity.
LOSS_SHARE = 0.995
#: More capacities than this aren't a table of limits.
MOST_LIMITS = 1_000
CONTAINER_SCHEMA = "limit_id int, container_id long, slot int, doc_id long, part int, first_token int, n_tokens int, loss_tokens int"


def fill(demands: np.ndarray, limits: np.ndarray) -> list[list[int]]:
    """Containers as lists of item numbers; ``demands`` is (items, dimensions), each within ``limits``.

    Items of equal demands are taken in their order.
    """
    kinds, which = np.unique(demands, axis=0, return_inverse=True)
    which = which.reshape(-1)
    order = np.argsort(which, kind="stable")
    starts = np.searchsorted(which[order], np.arange(len(kinds) + 1))
    queues = [order[starts[i] : starts[i + 1]] for i in range(len(kinds))]
    # Largest first, so that the first of equal products is the largest.
    rank = np.argsort(-kinds[:, 0], kind="stable")
    kinds = kinds[rank].astype(np.float64)
    queues = [queues[i] for i in rank]
    used = np.zeros(len(kinds), np.int64)
    left = np.array([len(q) for q in queues])
    limits = limits.astype(np.float64)
    scaled = kinds / limits
    containers: list[list[int]] = []
    remaining = int(left.sum())
    while remaining:
        room = limits.copy()
        own: list[int] = []
        while remaining:
            fits = left > 0
            for d in range(kinds.shape[1]):
                fits &= kinds[:, d] <= room[d]
            products = np.where(fits, scaled @ (room / limits), -1.0)
            best = int(products.argmax())
            if products[best] < 0:
                break
            # As many of this kind as stay the best choice can't be told ahead; one at a time.
            own.append(int(queues[best][used[best]]))
            used[best] += 1
            left[best] -= 1
            remaining -= 1
            room -= kinds[best]
        containers.append(own)
        if len(containers) % 256 == 0 and (gone := left == 0).mean() > 0.3:
            keep = ~gone
            kinds, scaled, left, used = kinds[keep], scaled[keep], left[keep], used[keep]
            queues = [q for q, k in zip(queues, keep) if k]
    return containers


def packed(items: DataFrame, limits: DataFrame, n_items: int | None = None, items_per_shard: int = SHARD_ITEMS, segment_tokens: int = 16, loss_share: float = LOSS_SHARE) -> DataFrame:
    """Items in containers of every capacity in ``limits``.

    ``items``: ``doc_id`` (unique), ``n_tokens``, ``n_head`` (tokens that bear no loss, at the
    front); ``limits``: ``limit_id``, ``capacity_tokens``, a handful of rows. A container of
    capacity c takes at most c tokens, c * ``loss_share`` loss-bearing tokens and max(16, c /
    ``segment_tokens``) segments. As no text within the capacity is split, one that bears more loss
    than that fills the limit by itself and has company without loss only. One row per item and container: ``part`` and ``first_token`` count from 0; an item
    of no tokens is one row of 0 tokens. Null counts are 0; capacities below 1 and null ones
    have no containers. No items, no rows. ``n_items`` is the number of items where it is known
    more cheaply than by counting ``items``; it decides how many shards there are.
    """
    shards = max(1, math.ceil((items.count() if n_items is None else n_items) / items_per_shard))
    if limits.limit(MOST_LIMITS + 1).count() > MOST_LIMITS:
        raise ValueError(f"more than {MOST_LIMITS} capacities")
    sizes = limits.where("capacity_tokens > 0").select(F.col("limit_id").cast("int"), F.col("capacity_tokens").cast("int"))
    rows = items.select(
        F.col("doc_id").cast("long"),
        F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"),
        F.coalesce("n_head", F.lit(0)).alias("n_head"),
        F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int").alias("shard"),
    )
    # A row per capacity: the limits are read as a literal array, four in all, so that no join is needed.
    capacities = F.array(*[F.struct(F.lit(r.limit_id).alias("limit_id"), F.lit(r.capacity_tokens).alias("capacity_tokens")) for r in sizes.limit(MOST_LIMITS).collect()])
    pairs = rows.select("*", F.inline(capacities))
    return pairs.groupBy("limit_id", "shard").applyInPandas(lambda frame: _pack_shard(frame, segment_tokens, loss_share), CONTAINER_SCHEMA)


def _pack_shard(frame, segment_tokens: int, loss_share: float):
    import pandas as pd

    frame = frame.sort_values("doc_id", kind="stable")
    capacity, limit, shard = int(frame["capacity_tokens"].iloc[0]), int(frame["limit_id"].iloc[0]), int(frame["shard"].iloc[0])
    doc, n, head = (frame[c].to_numpy(np.int64) for c in ("doc_id", "n_tokens", "n_head"))
    whole = np.where(n > capacity, n // capacity, 0)
    rest = n - whole * capacity
    # Items: texts that fit and the rests of those that don't.
    item = np.flatnonzero((rest > 0) | (n == 0))
    first = whole[item] * capacity
    loss = np.maximum(0, n[item] - np.maximum(first, head[item]))
    most_loss = max(1, int(capacity * loss_share))
    demands = np.column_stack([rest[item], np.ones(len(item), np.int64), np.minimum(loss, most_loss)])
    containers = fill(demands, np.array([capacity, max(16, capacity // segment_tokens), most_loss])) if len(item) else []
    order = np.array([i for c in containers for i in c], np.int64)
    number = np.repeat(np.arange(len(containers)), [len(c) for c in containers]) if containers else np.zeros(0, np.int64)
    slot = np.concatenate([np.arange(len(c)) for c in containers]) if containers else np.zeros(0, np.int64)
    picked = item[order] if len(order) else order
    # Full parts of long texts have containers of their own.
    long_doc = np.repeat(np.arange(len(n)), whole)
    part = np.concatenate([np.arange(w) for w in whole[whole > 0]]) if len(long_doc) else np.zeros(0, np.int64)
    at = part * capacity
    base = np.int64(shard) << 32
    columns = {
        "container_id": np.concatenate([base + number, base + len(containers) + np.arange(len(long_doc))]),
        "slot": np.concatenate([slot, np.zeros(len(long_doc), np.int64)]),
        "doc_id": np.concatenate([doc[picked], doc[long_doc]]),
        "part": np.concatenate([whole[picked], part]),
        "first_token": np.concatenate([whole[picked] * capacity, at]),
        "n_tokens": np.concatenate([rest[picked], np.full(len(long_doc), capacity)]),
        "loss_tokens": np.concatenate([loss[order] if len(order) else order, np.clip(at + capacity - np.maximum(at, head[long_doc]), 0, capacity)]),
    }
    out = pd.DataFrame(columns)
    out.insert(0, "limit_id", limit)
    return out


def fill_report(containers: DataFrame, limits: DataFrame) -> DataFrame:
    """Per limit: containers, items, tokens and the share of the room that is used."""
    # Summed per container first: containers, not rows, are what the report is about.
    per = containers.groupBy("limit_id").agg(
        F.countDistinct("container_id").alias("n_containers"), F.count("*").alias("n_segments"), F.sum("n_tokens").alias("n_tokens")
    )
    sizes = limits.select(F.col("limit_id").cast("int"), F.col("capacity_tokens").cast("long"))
    return per.join(sizes, "limit_id").select(
        "limit_id", "capacity_tokens", "n_containers", "n_segments", "n_tokens", F.round(F.col("n_tokens") / (F.col("n_containers") * F.col("capacity_tokens")), 6).alias("used")
    )
