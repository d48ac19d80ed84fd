"""Ledger files that are still written, as a stream with byte offsets.

Spark's file source takes a file once, as a whole; a ledger grows by lines.  The
``ledger_tail`` source keeps an offset in bytes for each file of a folder (all
storage that pyarrow's file systems reach, or mounted folders), reads what has
come since, up to the last full line, and splits long stretches over tasks.
Offsets are in the query's checkpoint, so a query that is stopped after any
batch goes on from there; ``store_stream`` writes batches to a ``Store`` under
their number, so a batch that runs twice is stored once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..sources.store import Store


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


@dataclass
class Stretch(InputPartition):
    file: str
    start: int
    end: int


class TailReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path, self.suffix = options["path"].rstrip("/"), options.get("suffix", ".jsonl")
        self.split = int(options.get("splitBytes", 64 << 20))
        self.most = int(options.get("maxBytesPerTrigger", 0))
        self.from_ = None

    def initialOffset(self) -> dict:
        return {}

    def _sizes(self) -> dict[str, int]:
        from pyarrow import fs

        system, root = _open(self.path)
        if system.get_file_info(root).type == fs.FileType.NotFound:
            return {}
        found = system.get_file_info(fs.FileSelector(root, recursive=True))
        return {f.path: f.size for f in found if f.is_file and f.path.endswith(self.suffix)}

    def latestOffset(self) -> dict:
        """Up to the last full line of each file."""
        at, left = dict(self.from_ or {}), self.most
        system, _ = _open(self.path)
        for name, size in sorted(self._sizes().items()):
            begun = at.get(name, 0)
            if size <= begun:
                continue
            end = min(size, begun + left) if self.most else size
            with system.open_input_file(name) as f:
                end = _line_end(f, begun, end, size)
            at[name] = end
            if self.most:
                left -= end - begun
                if left <= 0:
                    break
        self.from_ = at
        return at

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        self.from_ = end
        out = []
        for name, to in sorted(end.items()):
            at = start.get(name, 0)
            while at < to:
                out.append(Stretch(name, at, min(at + self.split, to)))
                at += self.split
        return out

    def read(self, partition: Stretch):
        """The lines that begin in a stretch; the last may end beyond it."""
        system, _ = _open(self.path)
        with system.open_input_file(partition.file) as f:
            at = partition.start
            f.seek(max(0, at - 1))
            if at and f.read(1) != b"\n":
                at += len(_line(f))
            while at < partition.end:
                line = _line(f)
                if not line:
                    return
                yield partition.file, at, line.rstrip(b"\r\n").decode("utf-8", "replace")
                at += len(line)

    def commit(self, end: dict) -> None:
        pass


def _line(f) -> bytes:
    """From the place of a file to the end of the line."""
    begun, parts = f.tell(), []
    while block := f.read(1 << 16):
        cut = block.find(b"\n") + 1
        parts.append(block[:cut] if cut else block)
        if cut:
            break
    line = b"".join(parts)
    f.seek(begun + len(line))
    return line


def _line_end(f, begun: int, end: int, size: int) -> int:
    """The last line end at or before ``end``; if a line is longer than that,
    its own end; ``begun`` if no line is whole yet."""
    at = end
    while at > begun:
        low = max(begun, at - (1 << 16))
        f.seek(low)
        cut = f.read(at - low).rfind(b"\n") + 1
        if cut:
            return low + cut
        at = low
    f.seek(end)
    rest = _line(f) if end < size else b""
    return end + len(rest) if rest.endswith(b"\n") else begun


class LedgerTail(DataSource):
    """spark.readStream.format("ledger_tail").load(folder): file, place, value."""

    @classmethod
    def name(cls) -> str:
        return "ledger_tail"

    def schema(self) -> str:
        return "file string, place bigint, value string"

    def streamReader(self, schema) -> TailReader:
        return TailReader(self.options)


def tail(spark: SparkSession, path: str, **options) -> DataFrame:
    """A stream (file, place, value) of the lines of a folder's ledger files."""
    spark.dataSource.register(LedgerTail)
    return spark.readStream.format("ledger_tail").options(**options).load(path)


def store_stream(stream: DataFrame, store: Store, checkpoint: str, name: str, once: bool = False):
    """Every micro-batch appended to a store, once, whatever is restarted."""

    def each(batch: DataFrame, number: int) -> None:
        store.append(batch, (name, number))

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def offsets(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(batch, file, place) of a query's offset log, for resuming elsewhere."""
    lines = spark.read.text(f"{checkpoint.rstrip('/')}/offsets", wholetext=True).selectExpr("_metadata.file_name name", "value")
    rows = lines.selectExpr("cast(name as bigint) batch", "explode(from_json(split(value, '\n')[2], 'map<string,bigint>')) as (file, place)")
    return rows.where("batch is not null")


def last_published(store: Store, name: str) -> int | None:
    """The last batch of a writer that a store holds."""
    return store.manifest()["writers"].get(name)
