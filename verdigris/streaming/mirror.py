"""The mirror as a stream: new versions of a metadata table are copied as they are appended.

The store only ever appends files, so a file stream over a table's folder tells
which appends are new.  Each of them is copied whole under its own number,
which orders the versions there too; an append that comes again, because a batch
is tried again or its files were seen in two batches, replaces its copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..plans import metastore as ms


def follow(source: ms.MetaStore, target: ms.MetaStore, table: ms.Table, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Copies what is there and, unless once, what comes.  checkpoint: a folder that outlives the query."""
    stream = source.spark.readStream.schema(source._full(table)).parquet(source.folder(table))

    def copy(batch: DataFrame, _: int) -> None:
        for seq in sorted(r[0] for r in batch.select("_seq").distinct().collect()):  # appends since the last batch
            target.put(table, seq, source.appended(table, seq))

    writer = stream.writeStream.foreachBatch(copy).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
