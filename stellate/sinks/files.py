"""Small metadata operations through the Hadoop file system a path belongs to (the driver's
part of a commit: markers, renames of folders; never data)."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return bool(self._fs.exists(self._path(path)))

    def names(self, path: str) -> list[str]:
        """Names of visible entries (data files and partition folders)."""
        if not self.exists(path):
            return []
        found = (s.getPath().getName() for s in self._fs.listStatus(self._path(path)))
        return sorted(n for n in found if not n.startswith(("_", ".")))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def rename(self, old: str, new: str) -> None:
        if not self._fs.rename(self._path(old), self._path(new)):
            raise OSError(f"could not move {old} to {new}")

    def mkdirs(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def write(self, path: str, text: str, overwrite: bool = True) -> None:
        out = self._fs.create(self._path(path), overwrite)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()

    def read(self, path: str) -> str | None:
        if not self.exists(path):
            return None
        stream = self._fs.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def size(self, path: str) -> int:
        """Listed bytes of a file or of all files under a folder."""
        return int(self._fs.getContentSummary(self._path(path)).getLength()) if self.exists(path) else 0

    def glob(self, path: str) -> list[str]:
        """Data files at a file, folder or pattern, in name order."""
        out = []
        for status in self._fs.globStatus(self._path(path)) or ():
            found = [status] if status.isFile() else self._walk(status.getPath())
            out += [s.getPath().toString() for s in found if s.isFile() and not s.getPath().getName().startswith(("_", "."))]
        return sorted(out)

    def readable(self, path: str) -> list[tuple[str, bool]]:
        """Paths right below a folder that Spark's readers do not skip, and whether each is a
        folder, in name order; none if ``path`` is anything else."""
        at = self._path(path)
        if any(c in path for c in "*?[{") or not self._fs.exists(at) or not self._fs.getFileStatus(at).isDirectory():
            return []
        out = []
        for s in self._fs.listStatus(at):
            name = s.getPath().getName()
            if not name.startswith(".") and (not name.startswith("_") or "=" in name):
                out.append((s.getPath().toString(), bool(s.isDirectory())))
        return sorted(out)

    def folders(self, path: str) -> list[str]:
        """Visible folders right below a folder or pattern."""
        tops = [t.getPath() for t in self._fs.globStatus(self._path(path)) or () if t.isDirectory()]
        found = [s for t in tops for s in self._fs.listStatus(t) if s.isDirectory()]
        return [s.getPath().toString() for s in found if not s.getPath().getName().startswith(("_", "."))]

    def _walk(self, folder) -> list:
        out = []
        for s in self._fs.listStatus(folder):
            if not s.getPath().getName().startswith(("_", ".")):
                out += [s] if s.isFile() else self._walk(s.getPath())
        return out
