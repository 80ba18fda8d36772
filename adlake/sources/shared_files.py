"""Small files that tasks and the driver share, in any file system that pyarrow knows (local, S3, GCS, HDFS); and the crawl's circuit breaker made of them."""

from __future__ import annotations

import posixpath
import time
import uuid


class Folder:
    """A folder by its path or URI. Files are written whole, or not at all."""

    def __init__(self, uri: str, fs=None):
        import pyarrow.fs as pf

        if fs is not None:
            self.fs, self.path = fs, uri
        elif "://" in uri or uri.startswith("file:"):
            self.fs, self.path = pf.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file:///") else uri)
        else:
            self.fs, self.path = pf.LocalFileSystem(), uri
        self.path = self.path.rstrip("/")

    def at(self, name: str) -> str:
        return posixpath.join(self.path, name)

    def names(self, sub: str = "") -> list[str]:
        import pyarrow.fs as pf

        found = self.fs.get_file_info(pf.FileSelector(self.at(sub) if sub else self.path, allow_not_found=True))
        return sorted(f.base_name for f in found if f.is_file and not f.base_name.startswith("."))

    def read(self, name: str) -> str:
        with self.fs.open_input_stream(self.at(name)) as f:
            return f.read().decode()

    def write(self, name: str, text: str) -> None:
        to = self.at(name)
        self.fs.create_dir(posixpath.dirname(to), recursive=True)
        part = posixpath.join(posixpath.dirname(to), f".{uuid.uuid4().hex}")
        with self.fs.open_output_stream(part) as f:
            f.write(text.encode())
        self.fs.move(part, to)

    def delete(self, name: str) -> None:
        try:
            self.fs.delete_file(self.at(name))
        except FileNotFoundError:
            pass


class Breaker:
    """One circuit breaker for all workers of a crawl: `refusals` in a row, whoever gets them, hold everybody's requests for `pause` seconds.

    State is in a shared folder: a file for each refusal since the last success, and one named by the time until which requests are held. Without a
    folder each worker process counts for itself."""

    _alone: dict[str, float] = {"refused": 0, "until": 0.0}

    def __init__(self, path: str | None, refusals: int, pause: float):
        self.folder = Folder(path) if path else None
        self.refusals, self.pause = refusals, pause

    def held(self) -> float:
        """Seconds for which requests are still held."""
        if self.folder is None:
            until = self._alone["until"]
        else:
            until = max((int(n.split("-")[1]) / 1000 for n in self.folder.names() if n.startswith("until-")), default=0.0)
        return max(0.0, until - time.time())

    def wait(self) -> None:
        if (left := self.held()) > 0:
            time.sleep(left)

    def refused(self) -> None:
        until = time.time() + self.pause
        if self.folder is None:
            self._alone["refused"] += 1
            if self._alone["refused"] >= self.refusals:
                self._alone.update(refused=0, until=until)
            return
        self.folder.write(f"refused-{uuid.uuid4().hex}", "")
        marks = [n for n in self.folder.names() if n.startswith("refused-")]
        if len(marks) >= self.refusals:
            self.folder.write(f"until-{int(until * 1000)}", "")
            for n in marks:
                self.folder.delete(n)

    def succeeded(self) -> None:
        if self.folder is None:
            self._alone["refused"] = 0
            return
        for n in self.folder.names():
            if n.startswith("refused-") or (n.startswith("until-") and int(n.split("-")[1]) / 1000 < time.time()):
                self.folder.delete(n)
