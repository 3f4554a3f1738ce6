"""Structured Streaming forms of the operators (watermarks, state, foreachBatch)."""

# The stateful processors keep their state in RocksDB, so state larger than
# memory spills to local disk and is checkpointed to the shared folder.
STATE_STORE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def use_rocksdb(spark) -> None:
    for k, v in STATE_STORE_CONF.items():
        spark.conf.set(k, v)
