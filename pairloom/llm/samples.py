"""Bounded samples of labelled rows, for the models that are fitted on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def held_out(folds: int, fold: int, id_col: str = "doc_id") -> Column:
    """Whether a row belongs to the held-out fold: the CRC-32 of its id as text, modulo the folds.

    A row without an id is held out.
    """
    rest = F.crc32(F.col(id_col).cast("string").cast("binary")) % folds
    return F.coalesce(rest == fold, F.lit(True))


#: Labels up to this number are sent to every task with their shares; more are joined by a shuffle.
MAX_SENT_LABELS = 10_000


def sample(rows: DataFrame, label_col: str, per_label: Column | int, id_col: str = "doc_id") -> DataFrame:
    """About ``per_label`` rows (a number, or a column made from the label) of each label, chosen by the hash of the id; fewer if there are no more.

    The number is kept by a threshold on the hash that follows from the count
    of the label, so no task sorts or gathers the rows of a label.  Rows with
    one id are chosen together.
    """
    wanted = per_label if isinstance(per_label, Column) else F.lit(per_label)
    counts = rows.groupBy(label_col).agg(F.count(F.lit(1)).alias("_n"))
    share = counts.select(F.col(label_col).alias("_of"), (wanted / F.col("_n")).alias("_share"))
    few = share.limit(MAX_SENT_LABELS + 1).collect()
    if len(few) <= MAX_SENT_LABELS:
        share = F.broadcast(rows.sparkSession.createDataFrame(few, share.schema))
    draw = F.pmod(F.xxhash64(F.col(id_col), F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    return rows.join(share, F.col(label_col) == F.col("_of")).filter(draw < F.col("_share")).select(*rows.columns)


def known_labels(labels: DataFrame, label_col: str, trainable: Column) -> DataFrame:
    """``(doc_id, label)`` of the rows to learn from; rows repeated for one id count as their greatest label."""
    return (
        labels.filter(trainable & F.col(label_col).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
    )


def few_labels(known: DataFrame, per_label: tuple[int, int]) -> DataFrame:
    """About ``per_label`` of the ids labelled 0 and 1."""
    return sample(known, "label", F.when(F.col("label") > 0, per_label[1]).otherwise(per_label[0]))


def labelled(docs: DataFrame, labels: DataFrame, label_col: str, trainable: Column, per_label: tuple[int, int]) -> DataFrame:
    """``(doc_id, text, label)`` of a bounded sample of documents labelled 0 and 1; rows repeated for one id count as their greatest label."""
    # of bounded size, so it may be sent to the documents
    chosen = F.broadcast(few_labels(known_labels(labels, label_col, trainable), per_label))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.join(chosen, "doc_id").dropDuplicates(["doc_id"])
