"""Paths on the session's file system, and ledgers of finished work."""

from __future__ import annotations

import json
from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _make(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is there, be it moved aside for the moment of a replacement. Looking changes nothing."""
    fs, target = _fs(spark, path)
    return fs.exists(target) or fs.exists(_make(spark, _previous(path)))


def current_path(spark: SparkSession, path: str) -> str:
    """Where a table's content lies: at ``path``, or beside it while a replacement is between its two renames."""
    fs, target = _fs(spark, path)
    if not fs.exists(target) and fs.exists(_make(spark, _previous(path))):
        return _previous(path)
    return path


def _previous(path: str) -> str:
    return path.rstrip("/") + ".previous"


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the visible folders directly under ``path``."""
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory()]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def content_state(spark: SparkSession, path: str) -> str:
    """Names, sizes and times of a file, or of the files of a folder: another text when the content is another."""
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return ""
    files = sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(target))
    return str(files)


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.delete(target, True)


def recover(spark: SparkSession, path: str) -> None:
    """Bring a replacement that a crash interrupted to its end; otherwise does nothing.

    Only for the table's one writer, before it writes: a replacement still under way would be cut short. A
    table that was moved aside comes back. Partitions that a run wrote completely, which its mark beside
    them says, are moved in; those without a mark are dropped.
    """
    fs, final = _fs(spark, path)
    old = _make(spark, _previous(path))
    if fs.exists(old):
        if fs.exists(final):
            fs.delete(old, True)
        else:
            _move(fs, old, final)
    base, parent = path.rstrip("/"), final.getParent()
    name = final.getName()
    beside = [s.getPath().getName() for s in fs.listStatus(parent)] if parent is not None and fs.exists(parent) else []
    for found in sorted(n for n in beside if n.startswith(f"{name}.switch-")):
        _move_partitions(spark, fs, base, found.removeprefix(f"{name}.switch-"))
    for found in beside:
        if found.startswith(f"{name}.staged-"):
            fs.delete(_make(spark, f"{base}.staged-{found.removeprefix(f'{name}.staged-')}"), True)


def _move(fs, source, target) -> None:
    if not fs.rename(source, target):
        raise OSError(f"cannot move {source} to {target}")


def _move_partitions(spark: SparkSession, fs, base: str, run: str) -> None:
    """Each staged partition takes the place of its old version; one that is no longer staged has done so."""
    for name in child_folders(spark, f"{base}.staged-{run}"):
        target = _make(spark, f"{base}/{name}")
        if fs.exists(target):
            fs.delete(target, True)
        _move(fs, _make(spark, f"{base}.staged-{run}/{name}"), target)
    fs.delete(_make(spark, f"{base}.staged-{run}"), True)
    fs.delete(_make(spark, f"{base}.switch-{run}"), False)


def staging(path: str, run: str) -> str:
    """Where ``run`` writes new versions of some of a table's partitions before they take their places."""
    return f"{path.rstrip('/')}.staged-{run}"


def switch_partitions(spark: SparkSession, path: str, run: str, touched: Iterable = ()) -> None:
    """Put the partitions that ``run`` wrote at ``staging(path, run)`` in the place of the table's.

    Of the ``touched`` partition values those without a staged version have become empty: an empty folder takes
    their place. The mark is created once all is complete. From then on a crash is harmless: the table's
    next writer moves the remaining ones.
    """
    base = path.rstrip("/")
    fs, folder = _fs(spark, staging(path, run))
    staged = set(child_folders(spark, staging(path, run)))
    if touched and not fs.exists(folder):
        fs.mkdirs(folder)
    if not fs.exists(folder):
        raise OSError(f"{folder} is gone: somebody else wrote to {path}")
    values = {str(value) for value in touched}
    for name in child_folders(spark, path):
        if name not in staged and unquote(name.partition("=")[2]) in values:
            fs.mkdirs(_make(spark, f"{staging(path, run)}/{name}"))
    fs.create(_make(spark, f"{base}.switch-{run}"), True).close()
    _move_partitions(spark, fs, base, run)


def swap_in(spark: SparkSession, fresh: str, path: str) -> None:
    """Put the finished folder ``fresh`` in the place of ``path``; the old one goes last."""
    recover(spark, path)
    fs, new = _fs(spark, fresh)
    final, old = _make(spark, path), _make(spark, _previous(path))
    fs.mkdirs(final.getParent())
    if fs.exists(final) and not fs.rename(final, old):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(new, final):
        raise OSError(f"cannot move {fresh} to {path}")
    fs.delete(old, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file of a driver's notes."""
    fs, target = _fs(spark, path)
    stream = fs.create(target, True)
    stream.write(bytearray(text, "utf-8"))
    stream.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def note_of(spark: SparkSession, path: str) -> dict:
    """The note a table was replaced with; empty without one."""
    return json.loads(read_text(spark, current_path(spark, path).rstrip("/") + "/_note") or "{}")


def replace_table(df: DataFrame, path: str, note: dict | None = None) -> DataFrame:
    """Write ``df`` beside ``path``, then put it in its place; a failed write leaves the old table.

    A ``note`` takes its place together with the table: what it says holds for exactly this content.
    """
    fresh = path.rstrip("/") + ".fresh"
    df.write.mode("overwrite").parquet(fresh)
    if note is not None:
        write_text(df.sparkSession, f"{fresh}/_note", json.dumps(note))
    swap_in(df.sparkSession, fresh, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Ledger:
    """An append-only note of finished work beside a table.

    A job writes its data first, in a way that may be repeated, and its ledger entry last. After a
    crash in between the entry is missing and the work is simply done again.

    Entries are added as tiny JSON files. `compact`, for the ledger's writer, puts them into one Parquet
    table beside them, so that a read opens few files however long the history is.
    """

    #: So many files are left to be read one by one.
    TAIL = 40

    def __init__(self, spark: SparkSession, table: str, schema: str) -> None:
        self._spark, self._schema = spark, schema
        self.path = table.rstrip("/") + ".ledger"
        self._base = self.path + "-base"

    def exists(self) -> bool:
        return exists(self._spark, self.path) or exists(self._spark, self._base)

    def _tail(self) -> list[str]:
        """Files that are not in the Parquet table yet."""
        fs, target = _fs(self._spark, self.path)
        if not fs.exists(target):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(target)]
        held = set(note_of(self._spark, self._base).get("files", ())) if exists(self._spark, self._base) else set()
        return sorted(f"{self.path}/{n}" for n in names if not n.startswith(("_", ".")) and n not in held)

    def read(self) -> DataFrame:
        reader = self._spark.read.schema(self._schema)
        parts = [reader.json(tail)] if (tail := self._tail()) else []
        if exists(self._spark, self._base):
            parts.append(self._spark.read.schema(self._schema).parquet(current_path(self._spark, self._base)))
        if not parts:
            return self._spark.createDataFrame([], self._schema)
        return parts[0] if len(parts) == 1 else parts[1].unionByName(parts[0])

    def add(self, entries: Iterable[tuple], mode: str = "append") -> None:
        rows = list(entries)
        if rows:
            self._spark.createDataFrame(rows, self._schema).coalesce(1).write.mode(mode).json(self.path)
            if mode == "overwrite":
                remove(self._spark, self._base)

    def restart(self, entries: Iterable[tuple]) -> None:
        """Forget what was noted before: the table was built anew."""
        self.add(entries, "overwrite")

    def compact(self) -> None:
        """Move the entries of many small files into the Parquet table, if there are many.

        The table's note names the files it took over. They are removed only then, and a reader in between
        leaves them out.
        """
        tail = self._tail()
        if len(tail) <= self.TAIL:
            return
        if exists(self._spark, self._base):  # what a crash left of the files taken over before
            for name in note_of(self._spark, self._base).get("files", ()):
                remove(self._spark, f"{self.path}/{name}")
        names = [path.rsplit("/", 1)[1] for path in tail]
        replace_table(self.read().coalesce(1), self._base, {"files": names})
        for path in tail:
            remove(self._spark, path)
