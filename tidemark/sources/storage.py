"""Small documents and folders below a root, on the driver's disk or on any file system that Spark can reach."""

from __future__ import annotations

import json
import os
import re
import shutil
from pathlib import Path

from tidemark import model as M

#: The largest control document that is read.
LARGEST = 1 << 20


class Storage:
    """Names are relative to the root. `create` is atomic: of several that create a name one succeeds."""

    def __new__(cls, root: str):
        remote = re.match(r"[a-z][a-z0-9+.-]*:/", root) and not root.startswith("file:")
        return object.__new__(_Hadoop if remote else _Local)

    def read_json(self, name: str) -> object:
        return json.loads(self.read(name))

    def create_json(self, name: str, value: object) -> None:
        self.create(name, M.canonical_json(value) + "\n")

    def put_json(self, name: str, value: object) -> None:
        self.put(name, M.canonical_json(value) + "\n")


class _Local(Storage):
    def __init__(self, root: str):
        self.root = Path(re.sub(r"^file:(//)?", "", root))

    def url(self, name: str) -> str:
        return f"file://{self.root / name}"

    def exists(self, name: str) -> bool:
        return (self.root / name).exists()

    def names(self, folder: str) -> list[str]:
        at = self.root / folder
        return sorted(p.name for p in at.iterdir() if not p.name.startswith(".")) if at.is_dir() else []

    def read(self, name: str) -> str:
        with (self.root / name).open(encoding="utf-8") as f:
            found = f.read(LARGEST + 1)
        if len(found) > LARGEST:
            raise ValueError(f"{name} is larger than {LARGEST}")
        return found

    def _draft(self, name: str, body: str) -> Path:
        path = self.root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        draft = path.with_name(f".{path.name}.{os.getpid()}.{os.urandom(4).hex()}")
        with draft.open("x", encoding="utf-8") as f:
            f.write(body)
            f.flush()
            os.fsync(f.fileno())
        return draft

    def put(self, name: str, body: str) -> None:
        os.replace(self._draft(name, body), self.root / name)

    def create(self, name: str, body: str) -> None:
        draft = self._draft(name, body)
        try:
            os.link(draft, self.root / name)
        finally:
            draft.unlink()

    def move(self, name: str, to: str) -> None:
        (self.root / to).parent.mkdir(parents=True, exist_ok=True)
        shutil.move(self.root / name, self.root / to)

    def remove(self, name: str) -> None:
        path = self.root / name
        shutil.rmtree(path) if path.is_dir() else path.unlink(missing_ok=True)


class _Hadoop(Storage):
    """By Hadoop's FileContext, whose rename refuses a target that is there."""

    def __init__(self, root: str):
        from pyspark.sql import SparkSession

        self.root, spark = root.rstrip("/"), SparkSession.active()
        self.jvm, self.gateway = spark._jvm, spark.sparkContext._gateway
        conf = spark._jsc.hadoopConfiguration()
        self.files = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path("").toUri(), conf)
        self.system = self._path("").getFileSystem(conf)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))

    def url(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        return self.system.exists(self._path(name))

    def names(self, folder: str) -> list[str]:
        if not self.exists(folder):
            return []
        found = [s.getPath().getName() for s in self.system.listStatus(self._path(folder))]
        return sorted(n for n in found if not n.startswith("."))

    def read(self, name: str) -> str:
        if self.system.getFileStatus(self._path(name)).getLen() > LARGEST:
            raise ValueError(f"{name} is larger than {LARGEST}")
        stream = self.system.open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _draft(self, name: str, body: str) -> str:
        folder, _, last = name.rpartition("/")
        draft = f"{folder}/.{last}.{os.urandom(8).hex()}".lstrip("/")
        stream = self.system.create(self._path(draft), False)
        try:
            stream.write(body.encode())
        finally:
            stream.close()
        return draft

    def _rename(self, name: str, to: str, replace: bool) -> None:
        kinds = self.jvm.org.apache.hadoop.fs.Options.Rename
        options = self.gateway.new_array(kinds, int(replace))
        if replace:
            options[0] = kinds.OVERWRITE
        self.system.mkdirs(self._path(to).getParent())
        self.files.rename(self._path(name), self._path(to), options)

    def put(self, name: str, body: str) -> None:
        self._rename(self._draft(name, body), name, True)

    def create(self, name: str, body: str) -> None:
        draft = self._draft(name, body)
        try:
            self._rename(draft, name, False)
        except Exception as e:
            self.remove(draft)
            if "AlreadyExists" in str(e):
                raise FileExistsError(name) from None
            raise

    def move(self, name: str, to: str) -> None:
        self._rename(name, to, False)

    def remove(self, name: str) -> None:
        self.system.delete(self._path(name), True)
