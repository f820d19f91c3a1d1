"""Job parameters: where the tables lie and how sessions are cut."""

from __future__ import annotations

from dataclasses import dataclass

from visitfold import fixed
from visitfold.operators.heavy import SPREAD_PARTS

# What a session running these jobs should have; results depend on the time zone, the
# handling of hot keys on adaptive execution.
SPARK_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Open sessions and remembered event keys stay on disk, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Late rows are counted over all batches of a run.
    "spark.sql.streaming.numRecentProgressUpdates": "100000",
    # A hot user sends a few partial sessions per input task to the state store, not events.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


@dataclass(frozen=True)
class Lake:
    """Table locations below one root.

    The root is used as given, so ``s3a://bucket/lake``, ``hdfs:///lake`` and a
    plain folder all work.
    """

    root: str

    def _at(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def landing(self) -> str:
        return self._at("landing")

    @property
    def bronze(self) -> str:
        return self._at("bronze")

    @property
    def silver(self) -> str:
        return self._at("silver")

    @property
    def silver_keys(self) -> str:
        return self._at("silver_keys")

    @property
    def sessions(self) -> str:
        return self._at("sessions")

    @property
    def ledger(self) -> str:
        return self._at("ledger")

    @property
    def session_states(self) -> str:
        return self._at("session_states")

    @property
    def session_snapshots(self) -> str:
        return self._at("session_snapshots")

    def gold(self, table: str) -> str:
        return self._at("gold", table)

    def stream_table(self, query: str) -> str:
        return self._at("stream", query)

    def checkpoint(self, query: str, sink: str) -> str:
        """One folder per query and sink: two sinks never share progress."""
        return self._at("checkpoints", f"{query}-{sink}")


@dataclass(frozen=True)
class Settings:
    gap_seconds: int = fixed.SESSION_GAP_SECONDS
    salt_factor: int = fixed.SALT_FACTOR
    hot_threshold: int = fixed.HOT_KEY_THRESHOLD
    partition_by: tuple[str, ...] = ("event_date",)
    top_paths: int = fixed.TOP_PATHS
    top_keys: int = fixed.TOP_KEYS
    # How much older than the newest event an event may be when the stream reads it. Two
    # gaps if not given.
    lateness_seconds: int | None = None
    # A key is spread if it holds more than this part of the rows.
    spread_parts: int = SPREAD_PARTS

    @property
    def watermark_seconds(self) -> int:
        return 2 * self.gap_seconds if self.lateness_seconds is None else self.lateness_seconds
