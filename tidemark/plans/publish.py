"""Publication: a log of pointers in which creating the next file is the compare-and-swap."""

from __future__ import annotations

from tidemark.plans.manifests import Manifest
from tidemark.sources.storage import Storage


class PublicationConflict(RuntimeError):
    """Another generation was published since the candidate was built."""


class PointerLog:
    """manifests/{generation}.json, and pointer/{version}.json of which the last is the published one."""

    def __init__(self, root: str):
        self.files = Storage(root)

    def register(self, manifest: Manifest) -> None:
        """Put a candidate if there is none of its name; the same one again is no fault."""
        manifest.checked()
        try:
            self.files.create_json(f"manifests/{manifest.generation_id}.json", manifest.as_dict())
        except FileExistsError:
            if self.manifest(manifest.generation_id).sha256 != manifest.sha256:
                raise ValueError("another manifest has this generation id") from None

    def manifest(self, generation_id: str) -> Manifest:
        return Manifest.parse(self.files.read_json(f"manifests/{generation_id}.json"))

    def _versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self.files.names("pointer") if n.removesuffix(".json").isdigit()]

    def _pointer(self, version: int) -> dict:
        return self.files.read_json(f"pointer/{version:08d}.json")

    def version(self) -> int:
        return max(self._versions(), default=0)

    def active(self) -> Manifest | None:
        version = self.version()
        if not version:
            return None
        pointer = self._pointer(version)
        found = self.manifest(pointer["generation_id"])
        if found.sha256 != pointer["manifest_sha256"]:
            raise ValueError("the published manifest was changed")
        return found

    def publish(self, generation_id: str) -> int:
        """Make a registered candidate the published generation, if its parent still is; its version."""
        candidate, version, active = self.manifest(generation_id), self.version(), self.active()
        if (active.generation_id if active else None) != candidate.parent_generation_id:
            self._supersede(generation_id)
            raise PublicationConflict(generation_id)
        pointer = {"generation_id": generation_id, "manifest_sha256": candidate.sha256, "version": version + 1}
        try:
            self.files.create_json(f"pointer/{version + 1:08d}.json", pointer)
        except FileExistsError:
            self._supersede(generation_id)
            raise PublicationConflict(generation_id) from None
        return version + 1

    def _supersede(self, generation_id: str) -> None:
        self.files.put(f"manifests/{generation_id}.superseded", "")

    def status(self, generation_id: str) -> str:
        """CANDIDATE, PUBLISHED (now or before) or SUPERSEDED."""
        if self.files.exists(f"manifests/{generation_id}.superseded"):
            return "SUPERSEDED"
        published = {self._pointer(v)["generation_id"] for v in self._versions()}
        return "PUBLISHED" if generation_id in published else "CANDIDATE"

    def history(self, spark):
        """One row per registered generation and table: generation_id, parent, mode, status, version, table, snapshot_id."""
        versions = {self._pointer(v)["generation_id"]: v for v in self._versions()}
        rows = []
        for name in self.files.names("manifests"):
            if name.endswith(".json"):
                m = self.manifest(name.removesuffix(".json"))
                told = (m.generation_id, m.parent_generation_id, m.mode, self.status(m.generation_id), versions.get(m.generation_id))
                rows += [(*told, table, snapshot) for table, snapshot in sorted(m.snapshots.items())]
        kinds = "generation_id string, parent_generation_id string, mode string, status string, version int, table string, snapshot_id string"
        return spark.createDataFrame(rows, kinds)

    def rollback(self, generation_id: str, to: str) -> Manifest:
        """A new candidate with an earlier generation's snapshots, on top of the active one."""
        active, old = self.active(), self.manifest(to)
        value = old.as_dict() | {"generation_id": generation_id, "parent_generation_id": active.generation_id if active else None}
        manifest = Manifest.parse(value)
        self.register(manifest)
        return manifest
