"""Connected components of large graphs by contraction, as a loop of DataFrame joins.

Each round every node is merged into the node of lowest priority among itself and its neighbours; priorities are hashes of node
and round, so any graph, chains included, shrinks by a constant share a round. Edges inside a merged node vanish, and with
them all settled components. Rounds are written to the shared folder: lineage stays short and a lost executor costs one re-read;
replaced tables are deleted. A hub's choice is a partial aggregate, so stars of any size are fine.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.functions.storage import discard, written

MAX_ROUNDS = 60
#: The nodes of a round are broadcast up to this many.
BROADCAST_NODES = 300_000
#: Edges that one task settles at once; more are contracted in rounds.
TASK_EDGES = 200_000


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", task_edges: int | None = None) -> DataFrame:
    """(node, component) for every node of ``edges``; a component is named by its smallest node. Nulls are no nodes.

    ``task_edges``: TASK_EDGES, or 0 where executors have no memory left for a graph in one task.
    """
    pairs = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).filter("x is not null and y is not null")
    open_edges = written(pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct(), "edges")
    chosen: list[DataFrame] = []
    for number in range(MAX_ROUNDS):
        left = open_edges.count()
        if chosen and not left:
            break
        if left <= (TASK_EDGES if task_edges is None else task_edges):
            chosen.append(written(_settled(open_edges), "round"))
            break
        both = open_edges.unionByName(open_edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        order = [F.struct(F.xxhash64(F.lit(number), F.col(c)).alias("order"), F.col(c).alias("into")) for c in ("x", "y")]
        into = written(both.groupBy("x").agg(F.min(F.least(*order)).alias("least")).select(F.col("x").alias("from"), "least.into"), "round")
        chosen.append(into)
        x_into, y_into = (_sized(into).select(F.col("from").alias(c), F.col("into").alias(f"{c}_into")) for c in ("x", "y"))
        moved = open_edges.join(x_into, "x").join(y_into, "y").filter(F.col("x_into") != F.col("y_into"))
        rest = written(moved.select(F.least("x_into", "y_into").alias("x"), F.greatest("x_into", "y_into").alias("y")).distinct(), "edges")
        discard(open_edges)
        open_edges = rest
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    discard(open_edges)
    labels = chosen[0].select(F.col("from").alias("node"), F.col("into").alias("label"))
    for into in chosen[1:]:
        labels = labels.join(_sized(into), labels["label"] == into["from"], "left").select("node", F.coalesce("into", "label").alias("label"))
    labels = written(labels, "labels")
    discard(*chosen)
    smallest = labels.groupBy("label").agg(F.min("node").alias("component"))
    out = written(labels.join(smallest, "label").select("node", "component"), "components")
    discard(labels)
    return out


def _settled(edges: DataFrame) -> DataFrame:
    """(from, into) of a bounded graph, which one task holds: each node and the one that stands for its component."""
    node = edges.schema["x"].dataType.simpleString()

    def settle(batches):
        nodes, places, root, x_type = [], {}, [], None

        def find(i):
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        def place(value):
            key = tuple(value.values()) if isinstance(value, dict) else value
            if key not in places:
                places[key] = len(root)
                root.append(len(root))
                nodes.append(value)
            return places[key]

        for batch in batches:
            x_type = batch.column("x").type
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                a, b = sorted((find(place(x)), find(place(y))))
                root[b] = a
        if nodes:
            yield pa.RecordBatch.from_arrays([pa.array(v, x_type) for v in (nodes, [nodes[find(i)] for i in range(len(nodes))])], ["from", "into"])

    return edges.repartition(1).mapInArrow(settle, f"`from` {node}, `into` {node}")


def _sized(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.count() <= BROADCAST_NODES else table
