"""Bounded samples of labelled rows, which the classifiers here are fitted on."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

MAX_LABELS = 256  # the most frequent ones are learned
PARTS = 64
MAX_BYTES = 1_000_000  # longer texts are not fitted on


def sample(
    docs: DataFrame,
    labels: DataFrame | None,
    per_label: int,
    max_labels: int = MAX_LABELS,
    max_bytes: int = MAX_BYTES,
) -> tuple[dict, list[tuple]]:
    """How many rows each label has, and up to ``per_label`` rows (label, text) of each.

    ``labels`` has ``doc_id`` and ``label``; without it ``docs`` has a label of its own in
    each row. Rows are chosen by a hash of the id, so the same rows give the same sample
    wherever they lie. Of the rows that share an id (and label, if they have their own) the
    smallest text is taken. At most ``max_labels`` * ``per_label`` texts of ``max_bytes``
    reach the driver; rarer labels than the first ``max_labels`` are not learned.
    """
    keys = ["doc_id"] if labels is not None else ["doc_id", "label"]
    labels = (docs if labels is None else labels).select("doc_id", "label")
    labels = labels.where("label is not null and doc_id is not null")
    counts = {
        r.label: r.n
        for r in labels.groupBy("label")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "label")
        .limit(max_labels)
        .collect()
    }
    if not counts:
        return {}, []
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = labels.where(F.col("label").isin(list(counts))).distinct()
    chosen = chosen.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)))
    for by in (["label", "part"], ["label"]):  # a common label is cut down in parts first
        place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        chosen = chosen.withColumn("place", place).where(F.col("place") <= per_label)
    of: dict = {}
    for r in chosen.select("doc_id", "label").collect():
        of.setdefault((r.doc_id, r.label)[: len(keys)], []).append(r.label)
    ids = sorted({key[0] for key in of})
    found = (
        docs.where(F.col("doc_id").isin(ids) & (F.octet_length("text") <= max_bytes))
        .groupBy(*keys)
        .agg(F.min("text").alias("text"))
    )
    if len(keys) > 1:
        found = found.where(F.col("label").isin(list(counts)))
    rows = sorted((tuple(r[k] for k in keys), r.text) for r in found.collect())
    return counts, [(label, text) for key, text in rows for label in sorted(of.get(key, ()))]
