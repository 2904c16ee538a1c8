"""A message sink that knows what was acknowledged, partition by partition.

Counting the rows that were handed to a sink says nothing about what the other side took. Here a
client of the caller's choice sends every message and learns of it whether it arrived; each task
returns what it counted with its commit, and only commits of tasks that succeeded are added up. A
client that cannot connect or refuses messages makes these count as failed, not as sent, and
does not fail the job: what failed is kept as rows with the reason, ready to be sent again.

Written as a Python data source, so Spark plans the write, retries tasks and commits. Delivery
is at least once: a task that is run again sends its messages again. A job that is given up has
sent some messages too; ``Undelivered`` then says where to read of those tasks that had finished.

``folder`` is to be reached by the driver and all executors, like ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import json
import posixpath
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any, Protocol
from uuid import uuid4

from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

REPORT = "report.jsonl"
COUNTS = "part long, n_due long, n_acknowledged long, n_failed long"
FAILED = "part long, key string, value string, reason string"


class Undelivered(RuntimeError):
    """The job was given up; messages of finished tasks have been sent."""


class Client(Protocol):
    """A connection for the messages of one part, in one task."""

    def send(self, key: str | None, value: str | None) -> Callable[[], str | None] | None:
        """Send a message. Either it is known to have arrived (None), or what is returned tells
        later, after ``flush``, why it did not (None: it did). Raises if it cannot be sent."""

    def flush(self) -> None:
        """Wait, within the client's own limit, until what was sent is acknowledged or given up."""


# Makes a client for a part of the topic; called in a task, so it must be picklable.
Connect = Callable[[int], Client]


@dataclass
class PartCounts:
    n_due: int = 0
    n_acknowledged: int = 0
    n_failed: int = 0


@dataclass
class TaskReport(WriterCommitMessage):
    counts: dict[int, PartCounts] = field(default_factory=dict)
    failed_file: str | None = None


class _FailedRows:
    """The failed messages of a task, in a file that is only made if there are any."""

    def __init__(self, folder: str):
        self.folder, self.name, self.stream = folder, None, None

    def add(self, part: int, key: str | None, value: str | None, reason: str) -> None:
        if self.stream is None:
            store, path = fs.FileSystem.from_uri(self.folder)
            self.name = f"failed-{uuid4().hex}.jsonl"
            store.create_dir(path)
            self.stream = store.open_output_stream(posixpath.join(path, self.name))
        row = {"part": part, "key": key, "value": value, "reason": reason}
        self.stream.write(json.dumps(row).encode() + b"\n")

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()


class _Writer(DataSourceWriter):
    # Messages sent before their fate is asked for; bounds what a task holds.
    AT_ONCE = 10_000

    def __init__(self, connect: Connect, folder: str):
        self.connect, self.folder = connect, folder

    def write(self, iterator: Iterator[Any]) -> TaskReport:
        """Rows come ordered by part, so one client is open at a time."""
        report, failed = TaskReport(), _FailedRows(self.folder)
        client: Client | str | None = None
        open_part: int | None = None
        pending: list[tuple] = []
        for part, key, value in iterator:
            if part != open_part or len(pending) >= self.AT_ONCE:
                self._settle(client, pending, report, failed)
                pending = []
            if part != open_part:
                open_part, client = part, self._connected(part)
            report.counts.setdefault(part, PartCounts()).n_due += 1
            pending.append((part, key, value, _sent(client, key, value)))
        self._settle(client, pending, report, failed)
        failed.close()
        report.failed_file = failed.name
        return report

    def _connected(self, part: int) -> Client | str:
        try:
            return self.connect(part)
        except Exception as error:
            return f"{type(error).__name__}: {error}"

    def _settle(self, client, pending, report: TaskReport, failed: _FailedRows) -> None:
        """Wait for the messages sent so far and count what became of each."""
        lost = None
        if pending and not isinstance(client, str):
            try:
                client.flush()
            except Exception as error:
                lost = f"{type(error).__name__}: {error}"
        for part, key, value, outcome in pending:
            reason = lost or (outcome() if callable(outcome) else outcome)
            if reason is None:
                report.counts[part].n_acknowledged += 1
            else:
                report.counts[part].n_failed += 1
                failed.add(part, key, value, reason)

    def commit(self, messages: list[TaskReport | None]) -> None:
        self._store(messages, complete=True)

    def abort(self, messages: list[TaskReport | None]) -> None:
        self._store(messages, complete=False)

    def _store(self, messages: list[TaskReport | None], complete: bool) -> None:
        total: dict[int, PartCounts] = {}
        files = []
        for report in filter(None, messages):
            files += [report.failed_file] if report.failed_file else []
            for part, counts in report.counts.items():
                own = total.setdefault(part, PartCounts())
                own.n_due += counts.n_due
                own.n_acknowledged += counts.n_acknowledged
                own.n_failed += counts.n_failed
        held = {
            "complete": complete,
            "files": files,
            "parts": [{"part": part, **vars(counts)} for part, counts in sorted(total.items())],
        }
        store, path = fs.FileSystem.from_uri(self.folder)
        store.create_dir(path)
        with store.open_output_stream(posixpath.join(path, REPORT)) as stream:
            stream.write(json.dumps(held).encode())


def _sent(client: Client | str, key: str | None, value: str | None):
    if isinstance(client, str):
        return client
    try:
        return client.send(key, value)
    except Exception as error:
        return f"{type(error).__name__}: {error}"


def message_sink(connect: Connect, folder: str) -> type[DataSource]:
    """A data source, under a name of its own, that sends ``part, key, value``."""
    label = f"messages_{uuid4().hex}"

    class MessageSink(DataSource):
        @classmethod
        def name(cls) -> str:
            return label

        def schema(self) -> str:
            return "part long, key string, value string"

        def writer(self, schema, overwrite: bool) -> DataSourceWriter:
            return _Writer(connect, folder)

    return MessageSink


@dataclass(frozen=True)
class Deliveries:
    """What became of the messages. ``counts``: part, n_due, n_acknowledged, n_failed; ``failed``:
    part, key, value and reason of each message that did not arrive, to be sent again."""

    counts: DataFrame
    failed: DataFrame


def deliver_acknowledged(
    messages: DataFrame, part: Column, connect: Connect, folder: str
) -> Deliveries:
    """Send ``messages`` (key, value) to the parts of a topic and report what was acknowledged.

    Rows are sent as they lie, ordered by part within a task, without a shuffle: a part that takes a
    third of all messages is sent by all tasks, each with a client of its own. ``folder``: a new one.
    """
    spark = messages.sparkSession
    sink = message_sink(connect, _uri(folder))
    spark.dataSource.register(sink)
    rows = messages.select(part.cast("long").alias("part"), "key", "value")
    ordered = rows.sortWithinPartitions("part")
    try:
        ordered.write.format(sink.name()).mode("append").save()
    except Exception as error:
        raise Undelivered(f"given up; finished tasks are reported in {folder}") from error
    return deliveries(spark, folder)


def deliveries(spark, folder: str) -> Deliveries:
    """Read the report of a delivery; of an aborted one, what its finished tasks counted."""
    report = json.loads(_read(f"{_uri(folder)}/{REPORT}"))
    names = ("part", "n_due", "n_acknowledged", "n_failed")
    rows = [tuple(part[name] for name in names) for part in report["parts"]]
    files = [f"{folder}/{name}" for name in report["files"]]
    if files:
        failed = spark.read.schema(FAILED).json(files)
    else:
        failed = spark.createDataFrame([], FAILED)
    return Deliveries(spark.createDataFrame(rows, COUNTS), failed)


def _uri(folder: str) -> str:
    """``from_uri`` takes absolute paths and URIs, but not Hadoop's ``file:/path``."""
    return "file://" + folder[5:] if folder.startswith("file:/") and "://" not in folder else folder


def _read(place: str) -> bytes:
    store, path = fs.FileSystem.from_uri(place)
    with store.open_input_stream(path) as stream:
        return stream.read()


def dealt_by(key: Column, parts: int) -> Column:
    """The part of a message by the hash of its key; those without a key are one part's."""
    return F.pmod(F.xxhash64(key), F.lit(parts))


@dataclass(frozen=True)
class FolderTopic:
    """A topic as files of JSON lines, for replay and rehearsals, with a broker's ways to refuse:
    messages of over ``largest`` bytes, and parts that are ``offline``."""

    folder: str
    largest: int | None = None
    offline: tuple[int, ...] = ()

    def __call__(self, part: int) -> Client:
        if part in self.offline:
            raise ConnectionError(f"part {part} is offline")
        return _FolderClient(self, part)


class _FolderClient:
    """Messages are acknowledged when the file that holds them is closed."""

    def __init__(self, topic: FolderTopic, part: int):
        self.topic, self.part, self.lines = topic, part, []
        self.store, path = fs.FileSystem.from_uri(_uri(topic.folder))
        self.path = posixpath.join(path, f"part={part}")

    def send(self, key: str | None, value: str | None) -> None:
        size = len((value or "").encode())
        if self.topic.largest is not None and size > self.topic.largest:
            raise ValueError(f"message of {size} bytes is too large")
        self.lines.append(json.dumps({"key": key, "value": value}))

    def flush(self) -> None:
        if self.lines:
            self.store.create_dir(self.path)
            place = posixpath.join(self.path, f"{uuid4().hex}.jsonl")
            with self.store.open_output_stream(place) as stream:
                stream.write(("\n".join(self.lines) + "\n").encode())
            self.lines = []
