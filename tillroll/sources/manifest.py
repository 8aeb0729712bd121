"""Record of a run: which stages are written, from which inputs.

A manifest is a JSON file in the database's folder. It holds a signature of the
run (input files with size and time, settings) and, for each finished stage,
the folder of the version written. A run that finds an unfinished manifest of
its own signature goes on after the last stage whose version is still complete;
any change of an input or a setting starts anew. A manifest is written under a
temporary name and renamed, so a reader sees a whole one or none.
"""

from __future__ import annotations

import hashlib
import json
import threading
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession

from tillroll.sources.warehouse import (
    WriteReceipt, children, database_location, ensure_database, filesystem, publish, read_version, version_complete,
)

FOLDER = "_manifests"


def input_signature(spark: SparkSession, paths: Sequence[str]) -> str:
    """SHA-256 of the names, sizes and times of all files under ``paths``."""
    digest = hashlib.sha256()
    for path in sorted(paths):
        fs, p = filesystem(spark, path)
        files = fs.listFiles(p, True) if fs.exists(p) else None
        found = []
        while files is not None and files.hasNext():
            s = files.next()
            found.append(f"{s.getPath().toString()} {s.getLen()} {s.getModificationTime()}")
        digest.update("\n".join([path, *sorted(found), ""]).encode())
    return digest.hexdigest()


class Run:
    """The stages of one run into ``database``, restarted where an earlier
    unfinished run of the same ``signature`` stopped."""

    def __init__(self, spark: SparkSession, database: str, signature: dict):
        ensure_database(spark, database)
        self._spark, self._database = spark, database
        self._home = f"{database_location(spark, database).rstrip('/')}/{FOLDER}"
        self._lock = threading.Lock()
        last = self._last()
        same = last is not None and last["signature"] == signature and not last["finished"]
        self._state = last if same else {"signature": signature, "stages": {}, "finished": False}
        self.resumed = sorted(k for k in self._state["stages"] if self._done(k))

    def _last(self) -> dict | None:
        names = [p for p in children(self._spark, self._home) if p.endswith(".json")]
        if not names:
            return None
        fs, p = filesystem(self._spark, max(names))
        stream = fs.open(p)
        try:
            body = self._spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(body)

    def _save(self) -> None:
        name = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}.json"
        fs, part = filesystem(self._spark, f"{self._home}/_{name}.part")
        out = fs.create(part, True)
        try:
            out.write(bytearray(json.dumps(self._state).encode()))
        finally:
            out.close()
        _, whole = filesystem(self._spark, f"{self._home}/{name}")
        if not fs.rename(part, whole):
            raise OSError(f"cannot write {whole}")
        for old in children(self._spark, self._home):
            if old.rsplit("/", 1)[-1] < name and old.endswith(".json"):
                fs.delete(filesystem(self._spark, old)[1], False)

    def _done(self, key: str) -> bool:
        stage = self._state["stages"].get(key)
        return stage is not None and version_complete(self._spark, stage["version"])

    def stage(self, key: str, build: Callable[[], DataFrame | tuple[DataFrame, Observation]]) -> WriteReceipt:
        """The receipt of stage ``key``: of the version already written, or of
        a new one from ``build()``, which is only called then. An observation
        that ``build`` gives besides is kept with the stage (``figures``)."""
        if self._done(key):
            s = self._state["stages"][key]
            return WriteReceipt(s["table"], s["row_count"], list(s["columns"]), s["version"])
        built = build()
        df, observed = built if isinstance(built, tuple) else (built, None)
        receipt = publish(df, self._database, key)
        with self._lock:
            self._state["stages"][key] = {"table": receipt.table, "row_count": receipt.row_count,
                                          "columns": receipt.columns, "version": receipt.version,
                                          "figures": observed.get if observed is not None else {}}
            self._save()
        return receipt

    def figures(self, key: str) -> dict:
        return self._state["stages"][key]["figures"]

    def read(self, key: str) -> DataFrame:
        """The version of stage ``key`` that this run has written."""
        return read_version(self._spark, self._state["stages"][key]["version"])

    def finish(self) -> None:
        with self._lock:
            self._state["finished"] = True
            self._save()
