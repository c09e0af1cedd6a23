"""Connected components of a link table, by label propagation with hub
contraction: no vertex set or component ever reaches the driver or one task.

Every round a vertex takes the smallest label among its neighbours' labels
and its own, then the label of its label (pointer jumping), so a chain of
``n`` links needs about log n rounds.  All steps are ``min`` aggregations,
which combine map-side: a hub with a third of all links becomes one row per
task before the shuffle.  Each round is written to the shared folder, which
cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import materialise


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``edges(a, b)`` to ``(id, component)`` for every linked vertex, where
    ``component`` is the smallest id reachable.  An empty table gives an empty
    one."""
    half = edges.select("a", "b").where("a <> b")
    pairs = half.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = materialise(pairs, f"{name}-links")
    label = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct().select("id", F.col("id").alias("component"))
    label = materialise(
        label.join(pairs.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("low")), "id", "left").select(
            "id", F.coalesce("low", "component").alias("component")
        ),
        f"{name}-labels",
    )
    links, label = pairs, jump(label, name)
    while True:
        # Links between labels: inside a component contracted so far they vanish.
        links = (
            links.join(label.select(F.col("id").alias("a"), F.col("component").alias("ca")), "a")
            .join(label.select(F.col("id").alias("b"), F.col("component").alias("cb")), "b")
            .where("ca <> cb")
            .select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b"))
            .distinct()
        )
        links = materialise(links, f"{name}-links")
        if links.isEmpty():
            break
        # Each label hangs below the smallest label it meets; labels of labels
        # are then resolved by jumping until nothing moves.
        parent = links.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("up"))
        label = materialise(
            label.join(parent.select(F.col("id").alias("component"), "up"), "component", "left").select(
                "id", F.coalesce("up", "component").alias("component")
            ),
            f"{name}-labels",
        )
        label = jump(label, name)
    return label


def jump(label: DataFrame, name: str) -> DataFrame:
    """Replace each label by its label's label until all are fixed points."""
    while True:
        up = label.select(F.col("id").alias("component"), F.col("component").alias("up")).where("component <> up")
        if label.join(up, "component").isEmpty():
            return label
        label = materialise(
            label.join(up, "component", "left").select("id", F.coalesce("up", "component").alias("component")),
            f"{name}-labels",
        )
