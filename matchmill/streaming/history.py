"""The history load fed by a stream of landed snapshots: all snapshots of a micro-batch in one load."""

from __future__ import annotations

import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from matchmill.sources.sinks import load_many


def load_snapshots(
    batch: DataFrame, path: str, keys: Sequence[str], track: Sequence[str], monotone: Sequence[str], load_id: str, valid_from: str,
    exists: bool,
) -> bool:
    """Apply any number of snapshots per key to the history table, in one load; returns whether the table exists now.

    At one time of a key the row with the largest values comes first, and the others are late.
    """
    return load_many(batch.sparkSession, path, batch, keys, track, monotone, load_id, valid_from, exists)


def stream_history(
    snapshots: DataFrame, path: str, checkpoint: str, keys: Sequence[str], track: Sequence[str], monotone: Sequence[str],
    valid_from: str, table_exists: bool,
) -> StreamingQuery:
    """Start a run over all landed files; ``checkpoint`` and ``path`` lie in shared storage.

    Loads are named after the streaming query, whose id lives in the checkpoint, and the batch: another checkpoint
    never meets the same name, and a replayed batch does. A replayed load changes nothing, because its values equal the
    open versions; late or regressed rows are ignored by the change rule.
    """
    state, named = {"exists": table_exists, "id": ""}, threading.Event()

    def apply(batch: DataFrame, batch_id: int) -> None:
        named.wait()
        state["exists"] = load_snapshots(
            batch, path, keys, track, monotone, f"{state['id']}-{batch_id}", valid_from, state["exists"]
        )

    writer = snapshots.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    try:
        query = writer.start()
        state["id"] = query.id
    finally:
        named.set()
    return query
