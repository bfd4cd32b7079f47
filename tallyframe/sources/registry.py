"""A model registry in a shared folder that several writers can change at once.

Every state is a numbered manifest that names a table of entries and the production pointers. A change
reads the newest state, writes its table under a new name, and puts the next manifest in place only if
nobody has done so; the loser of a race starts again from the winner's state, so no entry is lost
and a reader always sees a whole state. Manifests are put in place by one atomic call: a hard link on local
disks, an exclusive create elsewhere, which HDFS and stores with conditional writes provide.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyframe.operators import board

END = "\n"


@dataclass(frozen=True)
class State:
    version: int
    entries: DataFrame
    pointers: dict[str, str]


class RegistryStore:
    """``upsert``, ``promote`` and reads of a registry at ``path``."""

    def __init__(self, spark: SparkSession, path: str, tries: int = 50):
        self.spark, self.path, self.tries = spark, path.rstrip("/"), tries

    # -- reading

    def state(self) -> State:
        """The newest whole state; an empty registry has version 0."""
        version = max(self._versions(), default=0)
        if version == 0:
            return State(0, self.spark.createDataFrame([], board.REGISTRY_SCHEMA), {})
        manifest = self._manifest(version)
        entries = self.spark.read.schema(board.REGISTRY_SCHEMA).parquet(f"{self.path}/{manifest['table']}")
        return State(version, entries, manifest["pointers"])

    def production(self, name: str) -> tuple[int, str | None, str | None]:
        """(version of the registry, production version, its artifact path) of a model."""
        state = self.state()
        version = state.pointers.get(name)
        if version is None:
            return state.version, None, None
        row = state.entries.where((F.col("model_name") == name) & (F.col("version") == version)).first()
        return state.version, version, row["artifact_path"] if row else None

    # -- changing

    def upsert(self, entries: DataFrame) -> State:
        return self._commit(lambda s: (board.registry_upsert(s.entries, entries), s.pointers))

    def promote(self, name: str, version: str, demote: bool = False) -> State:
        return self._commit(lambda s: (board.registry_promote(s.entries, name, version, demote)[0],
                                       {**s.pointers, name: version}))

    def _commit(self, change: Callable[[State], tuple[DataFrame, dict[str, str]]]) -> State:
        for _ in range(self.tries):
            before = self.state()
            entries, pointers = change(before)
            table = f"entries-{uuid.uuid4().hex}"
            entries.coalesce(1).write.parquet(f"{self.path}/{table}")
            text = json.dumps({"table": table, "pointers": pointers}) + END
            if self._put_if_absent(before.version + 1, text):
                return State(before.version + 1, self.spark.read.schema(board.REGISTRY_SCHEMA).parquet(
                    f"{self.path}/{table}"), pointers)
        raise TimeoutError(f"the registry at {self.path} changed {self.tries} times during one change")

    # -- files

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _versions(self) -> list[int]:
        folder, fs = self._fs(f"{self.path}/manifests")
        if not fs.exists(folder):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit() and self._whole(int(n[:-5])))

    def _text(self, version: int) -> str:
        file, fs = self._fs(f"{self.path}/manifests/{version:08d}.json")
        stream = fs.open(file)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _whole(self, version: int) -> bool:
        """A manifest that is still being written has no end mark yet."""
        return self._text(version).endswith(END)

    def _manifest(self, version: int) -> dict:
        return json.loads(self._text(version))

    def _put_if_absent(self, version: int, text: str) -> bool:
        target, fs = self._fs(f"{self.path}/manifests/{version:08d}.json")
        fs.mkdirs(target.getParent())
        local = fs.getScheme() == "file"
        written = self._fs(f"{self.path}/manifests/.new-{uuid.uuid4().hex}")[0] if local else target
        try:
            stream = fs.create(written, False)
            stream.write(bytearray(text, "utf-8"))
            stream.close()
            if local:
                files, paths = self.spark._jvm.java.nio.file.Files, self.spark._jvm.java.io.File
                files.createLink(paths(target.toUri().getPath()).toPath(), paths(written.toUri().getPath()).toPath())
            return True
        except Py4JJavaError as error:
            if "FileAlreadyExists" in str(error.java_exception):
                return False
            raise
        finally:
            if local:
                fs.delete(written, False)
