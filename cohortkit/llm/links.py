"""From spanning links and partner counts of classes to one row per input row."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.components import connected_components
from cohortkit.llm.tables import split_join, write_table


def spanning_links(group: np.ndarray, alike) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs that span the similar rows of each group, as stars around the
    first row of what hangs together; rows come sorted by group.  ``alike(i, j)``
    tells which of the given row pairs are similar; pairs that are connected
    already are not asked for."""
    label = np.arange(len(group))
    for d in range(1, len(group)):
        i = np.flatnonzero(group[:-d] == group[d:])
        if not len(i):
            break
        i = i[label[i] != label[i + d]]
        i = i[alike(i, i + d)]
        for a in i.tolist():
            x, y = label[a], label[a + d]
            if x != y:
                label[label == max(x, y)] = min(x, y)
    rest = np.flatnonzero(label != np.arange(len(group)))
    return label[rest], rest


def label_rows(own: DataFrame, classes: DataFrame, found: DataFrame) -> DataFrame:
    """``(id, node, class_id, n_links)`` for every row of ``own (id, node)``.

    ``classes (node, id, copies)``: equal rows as one class with its smallest
    id.  ``found (u, v, n)``: links of classes, or, with null ``v``, a part of
    the number of rows linked to class ``u``.  A row without node is alone.
    The join back to rows is on the class; Spark splits a class that holds
    many rows.
    """
    joined = connected_components(found.where("v is not null").select("u", "v"))
    partners = found.where("v is null").groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("partners"))
    named = classes.select("node", "id", "copies").join(joined, "node", "left").join(partners, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    first = named.groupBy("component").agg(F.min("id").alias("class_id"))
    named, _ = write_table(split_join(named, first, "component").select(
        "node", "class_id", (F.col("copies") - 1 + F.coalesce("partners", F.lit(0))).alias("n_links")), "labels")
    result = own.select("id", "node").join(named, "node", "left")
    return result.select("id", "node",
                         F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
                         F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
