"""Folders of finished micro-batches, and larger ones that stand for several of them.

Layout under a path: one folder per micro-batch, named by query and batch, and folded ones,
``folded-...``, that stand for the folders their marker names.  A folder counts once its marker is
written, and no longer once a finished fold names it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from driftlake.sources import files
from driftlake.streaming.bronze import batch_name, with_retries

FOLDED = "folded-"

Writer = Callable[[DataFrame, str], None]


def record_batch(batch: DataFrame, batch_id: int, path: str, write: Writer, stateful: bool = False) -> None:
    """Write a micro-batch to its own folder, unless it is there; an interrupted one is written anew.

    A ``stateful`` query's batch is run in any case: its state is stored while its rows are computed,
    and Spark refuses a batch that has stored none.
    """
    folder = f"{path}/{batch_name(batch, batch_id)}"
    if files.is_done(batch.sparkSession, folder):
        if stateful:
            batch.write.format("noop").mode("overwrite").save()
        return

    def once() -> None:
        write(batch, folder)
        files.mark_done(batch.sparkSession, folder)

    with_retries(once)


def counting(spark: SparkSession, path: str) -> tuple[list[str], set[str]]:
    """Finished folders that count, and those that a folded one stands for."""
    done = files.finished_children(spark, path)
    covered = set()
    for name in done:
        if name.startswith(FOLDED):
            covered.update(files.read_lines(spark, f"{path}/{name}/{files.DONE}"))
    return [name for name in done if name not in covered], covered & set(done)


def read_counting(spark: SparkSession, path: str) -> DataFrame:
    names, _ = counting(spark, path)
    if not names:
        raise FileNotFoundError(f"{path} holds no finished batch")
    return spark.read.parquet(*[f"{path}/{n}" for n in names])


def fold(spark: SparkSession, path: str, folded: Callable[[DataFrame], DataFrame], write: Writer) -> None:
    """Bring the folders that count together in one, as ``folded`` makes of their rows.

    Folders that an earlier fold has made redundant are deleted; those of this one stay until the
    next, for readers that have planned on them.  One fold may run at a time.
    """
    names, redundant = counting(spark, path)
    if len(names) > 1:
        folder = f"{path}/{FOLDED}{uuid.uuid4().hex}"
        write(folded(spark.read.parquet(*[f"{path}/{n}" for n in names])), folder)
        files.mark_done(spark, folder, "\n".join(names))
    for name in redundant:
        files.remove(spark, f"{path}/{name}")
