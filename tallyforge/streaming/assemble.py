"""Documents put together from pages that arrive one by one, in any order.

Pages wait in keyed state, on the executors' disks, until their document is whole or late; it is given out once, and its
state goes. A restart goes on from the checkpoint."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUT = "doc_id bigint, n_pages int, found int, complete boolean, text string"


class Assembler(StatefulProcessor):
    """State of a document: its pages by number, and (pages stated, deadline in ms, given out)."""

    def __init__(self, wait_ms: int):
        self.wait_ms = wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pages = handle.getMapState("pages", "page_no int", "text string")
        self.about = handle.getValueState("about", "n_pages int, deadline bigint, done boolean")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803  the interface's names
        n, deadline, done = self.about.get() if self.about.exists() else (0, -1, False)
        if done:  # late or repeated pages of what was given out
            return
        latest = deadline
        for r in rows:
            n = max(n, r.n_pages)
            latest = max(latest, int(r.ts.timestamp() * 1000) + self.wait_ms)
            if not self.pages.containsKey((r.page_no,)):
                self.pages.updateValue((r.page_no,), (r.text,))
        if latest != deadline:
            if deadline >= 0:
                self.handle.deleteTimer(deadline)
            self.handle.registerTimer(latest)
        there = sorted(k[0] for k in self.pages.keys())  # noqa: SIM118  the state is no dictionary
        done = len([k for k in there if 1 <= k <= n]) == n
        if done:
            yield self.document(key, n, there)
        self.about.update((n, latest, done))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        if self.about.exists():
            n, _, done = self.about.get()
            if not done:
                yield self.document(key, n, sorted(k[0] for k in self.pages.keys()))  # noqa: SIM118
        self.about.clear()

    def document(self, key, n: int, there: list[int]) -> Row:
        kept = [k for k in there if 1 <= k <= n]
        text = "\n".join(self.pages.getValue((k,))[0] for k in kept)
        self.pages.clear()
        return Row(doc_id=key[0], n_pages=n, found=len(kept), complete=len(kept) == n, text=text)

    def close(self) -> None:
        pass


def assembled(pages: DataFrame, wait: int = 3600, late: str = "1 hour") -> DataFrame:
    """(doc_id, n_pages, found, complete, text) of a stream of pages (doc_id, page_no from 1, n_pages, text, ts).

    A document is given out once: when all its pages are there, or incomplete when the watermark (``late`` behind the
    latest ts) is ``wait`` seconds beyond its latest page. Of pages of one number the first to arrive counts; numbers
    beyond n_pages, of which the largest stated counts, don't; pages behind the watermark, and of documents given out, are
    dropped. Null texts are empty pages; pages without doc_id, number, n_pages or time are dropped. The session must keep
    state in RocksDB (``ROCKSDB``)."""
    whole = pages.where("doc_id is not null and page_no is not null and n_pages is not null and ts is not null")
    rows = whole.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("page_no").cast("int").alias("page_no"), F.col("n_pages").cast("int").alias("n_pages"), F.coalesce("text", F.lit("")).alias("text"), F.col("ts").cast("timestamp").alias("ts"))
    return rows.withWatermark("ts", late).groupBy("doc_id").transformWithState(Assembler(wait * 1000), OUT, "append", "eventTime")
