"""The ledger of a folder of topics: which offsets are taken, and by which run.

Each write takes its offsets before it writes its records, by one small file that is put in
place under the next free number; of two writers at the same moment one gets the number,
and the other tries again behind it. The newest file says all: the next offset of
each partition of each topic, and of each application its present run, its last batch and the
offsets of that. So a write reads one file, however many came before, and only the
newest few are kept.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

LEDGER = "_offsets"
_KEPT = 8


class StaleRunError(RuntimeError):
    """A run goes on writing after another run of the same application has taken its place."""


@dataclass
class Reserved:
    """The offsets of one batch: by topic and partition the first one, and the shift to it."""

    shifts: dict[tuple[str, int], int]
    retired: list[str] = field(default_factory=list)


class Ledger:
    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark._jvm
        self.gateway = spark.sparkContext._gateway
        self.folder = f"{root.rstrip('/')}/{LEDGER}"
        conf = spark._jsc.hadoopConfiguration()
        path = self._path(self.folder)
        self.files = path.getFileSystem(conf)
        self.context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self.files.getUri(), conf
        )
        self.files.mkdirs(path)

    def newest(self) -> tuple[int, dict]:
        """The highest number and what its file says."""
        while True:
            numbers = self._numbers()
            if not numbers:
                return 0, {"next": {}, "applications": {}}
            try:
                stream = self.files.open(self._path(f"{self.folder}/{numbers[-1]:020d}.json"))
            except Py4JJavaError as error:
                # Removed by writers that were faster; there is a newer one.
                if "FileNotFound" not in str(error.java_exception):
                    raise
                continue
            try:
                return numbers[-1], json.loads(bytes(stream.readAllBytes()))
            finally:
                stream.close()

    def reserve(
        self,
        application: str,
        run: str | None,
        batch_id: int,
        spans: dict[tuple[str, int], tuple[int, int]],
    ) -> Reserved:
        """Take offsets for a batch with these lowest and highest offsets.

        A batch that is written again gets the offsets it had. ``run`` is None for a single
        write, which is never written again and leaves no entry. A run that another has
        followed is refused.
        """
        while True:
            number, state = self.newest()
            entry = state["applications"].get(application) if run is not None else None
            retired: list[str] = []
            if entry and entry["run"] != run:
                if run in entry["retired"]:
                    raise StaleRunError(
                        f"run {run} of {application} was followed by run {entry['run']}"
                    )
                retired = [*entry["retired"], entry["run"]]
            elif entry:
                retired = entry["retired"]
                if entry["batch_id"] == batch_id and entry["spans"] == _named(spans):
                    return Reserved(_from_names(entry["shifts"]), retired)
            shifts = {}
            for place, (low, high) in spans.items():
                name = _name(place)
                shifts[place] = max(state["next"].get(name, 0) - low, 0)
                state["next"][name] = high + shifts[place] + 1
            if run is not None:
                state["applications"][application] = {
                    "run": run,
                    "retired": retired,
                    "batch_id": batch_id,
                    "spans": _named(spans),
                    "shifts": {_name(place): shift for place, shift in shifts.items()},
                }
            if self._put(number + 1, state):
                return Reserved(shifts, retired)

    def _put(self, number: int, state: dict) -> bool:
        """Put a file in place under a number that nobody has taken, whole or not at all."""
        made = self._path(f"{self.folder}/.{uuid.uuid4().hex}")
        stream = self.files.create(made, False)
        stream.writeBytes(json.dumps(state))
        stream.close()
        rename = self.jvm.org.apache.hadoop.fs.Options.Rename
        options = self.gateway.new_array(rename, 1)
        options[0] = getattr(rename, "NONE")
        try:
            self.context.rename(made, self._path(f"{self.folder}/{number:020d}.json"), options)
        except Py4JJavaError as error:
            self.files.delete(made, False)
            if "FileAlreadyExists" not in str(error.java_exception):
                raise
            return False
        for old in self._numbers()[:-_KEPT]:
            self.files.delete(self._path(f"{self.folder}/{old:020d}.json"), False)
        return True

    def _numbers(self) -> list[int]:
        names = [status.getPath().getName() for status in self.files.listStatus(
            self._path(self.folder))]
        return sorted(int(name[:20]) for name in names if name[0] != "." and name.endswith(".json"))

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)


def _name(place: tuple[str, int]) -> str:
    return f"{place[1]}/{place[0]}"


def _named(spans: dict[tuple[str, int], tuple[int, int]]) -> dict[str, list[int]]:
    return {_name(place): list(span) for place, span in sorted(spans.items())}


def _from_names(values: dict[str, int]) -> dict[tuple[str, int], int]:
    return {
        (name.partition("/")[2], int(name.partition("/")[0])): value
        for name, value in values.items()
    }
