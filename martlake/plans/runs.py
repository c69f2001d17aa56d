"""Restartable runs with all-or-nothing publishing.

A run is named by a fingerprint of its input files and parameters.  Its layers lie in
a folder of that name, beside those of other runs; a layer is finished when its job
has been committed (Spark's ``_SUCCESS`` file).  A run that broke off and is started
again with the same input skips the finished layers and goes on; one that has other
input begins in another folder.

Readers find layers through numbered publications: small files that name the folder of
every layer of one run.  A publication is written beside and renamed at the end, so
readers see all layers of the last finished run or of the one before, never a mixture.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Part of the fingerprint: layers of other versions of the builders are not reused.
LAYOUT_VERSION = 1


class Files:
    """The few file operations needed, on any file system that Spark reads."""

    def __init__(self, spark: SparkSession):
        self.jvm = spark._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return bool(fs.exists(p))

    def names(self, path: str) -> list[str]:
        fs, p = self._at(path)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def states(self, path: str) -> list[tuple[str, int, int]]:
        """(name, length, time of change) of the files under a path, sorted."""
        fs, p = self._at(path)
        out, todo = [], [p]
        while todo:
            for s in fs.listStatus(todo.pop()):
                if s.isDirectory():
                    todo.append(s.getPath())
                elif not s.getPath().getName().startswith(("_", ".")):
                    out.append((s.getPath().toString(), int(s.getLen()), int(s.getModificationTime())))
        return sorted(out)

    def write_new(self, path: str, text: str) -> bool:
        """A new file, complete as soon as it has its name; False if there is one."""
        fs, p = self._at(path)
        beside = self.jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
        stream = fs.create(beside, False)
        stream.write(bytearray(text.encode("utf-8")))
        stream.close()
        done = not fs.exists(p) and bool(fs.rename(beside, p))
        if not done:
            fs.delete(beside, False)
        return done

    def read(self, path: str) -> str:
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


class Run:
    """One run of a job that writes layers under ``out_dir`` from ``inputs``."""

    def __init__(self, spark: SparkSession, out_dir: str, inputs: list[str], parameters: dict | None = None):
        self.spark, self.files, self.out = spark, Files(spark), out_dir.rstrip("/")
        state = [self.files.states(p) for p in inputs]
        told = json.dumps([LAYOUT_VERSION, state, parameters or {}], sort_keys=True, default=str)
        self.id = hashlib.sha256(told.encode("utf-8")).hexdigest()[:16]
        self.layers: dict[str, str] = {}
        #: Layers that this process found finished, and those that it wrote.
        self.skipped: list[str] = []
        self.written: list[str] = []

    def folder(self, layer: str) -> str:
        return f"{self.out}/runs/{self.id}/{layer}"

    def layer(self, name: str, write) -> DataFrame:
        """The layer ``name``; ``write(path)`` is called unless it is finished."""
        path = self.folder(name)
        if self.files.exists(f"{path}/_SUCCESS"):
            self.skipped.append(name)
        else:
            write(path)
            self.written.append(name)
        self.layers[name] = path
        return self.spark.read.parquet(path)

    def publish(self) -> int:
        """Make this run's layers the ones that readers see; the publication's
        number (the last one, if it is this run's already)."""
        folder = f"{self.out}/published"
        while True:
            last = latest(self.spark, self.out)
            if last is not None and last["run"] == self.id and last["layers"] == self.layers:
                return last["number"]
            number = (last["number"] if last else 0) + 1
            text = json.dumps({"number": number, "run": self.id, "layers": self.layers}, sort_keys=True)
            if self.files.write_new(f"{folder}/{number:010d}.json", text):
                return number


def latest(spark: SparkSession, out_dir: str) -> dict | None:
    """The last publication: ``number``, ``run`` and ``layers``; None before the first."""
    files, folder = Files(spark), f"{out_dir.rstrip('/')}/published"
    numbers = sorted(n for n in files.names(folder) if n.endswith(".json"))
    return json.loads(files.read(f"{folder}/{numbers[-1]}")) if numbers else None


def read_published(spark: SparkSession, out_dir: str, layer: str) -> DataFrame:
    """A layer of the last publication."""
    last = latest(spark, out_dir)
    if last is None or layer not in last["layers"]:
        raise LookupError(f"{out_dir} has no published layer {layer}")
    return spark.read.parquet(last["layers"][layer])
