"""Incremental load of revisions that are not stored yet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from repotide.sources.clustered import append_by_folder
from repotide.sources.tables import append_new_keys


def load_new_revisions(
    stream: DataFrame, target: str, checkpoint: str, keys: Sequence[str], folders: int = 0
) -> StreamingQuery:
    """Append the stream's unknown keys to the table at ``target``.

    With ``folders`` the table lies in that many folders by the hash of the key, and a batch
    reads its own ones only; hash keys have no range that would prune.

    A batch that is replayed after a failure finds its keys stored and writes
    nothing, so each key lands once.
    """

    def store(batch: DataFrame, _batch_id: int) -> None:
        # the batch is read for the key comparison and for the write
        batch.persist()
        try:
            if folders:
                append_by_folder(batch, target, keys, folders)
            else:
                append_new_keys(batch, target, keys)
        finally:
            batch.unpersist()

    return (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
