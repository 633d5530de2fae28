"""Archives of a sample's tables or flanks as a Spark data source, for exchange; the library itself keeps tables as Parquet.

``tables``: one zip for each sample, with a tab-separated file for each element. ``flanks``: one tar.gz for each sample, with a FASTA file
for each element and bucket and a manifest of them, which may also lie beside it, as ``<sample>/<sample>.manifest.tsv``.

Reading gives a partition for each run of archives of about RUN_BYTES. An archive that can't be read gives one row that only says so, in
``problem``, so that bad ones are counted and skipped. A filter on the element is pushed down: members of other elements aren't unpacked,
and an archive whose manifest beside it names none of them isn't opened.

Writing keeps one member in memory or in a temporary file at a time, and moves an archive to its place when it is complete, so a task that
runs twice leaves the same file. Rows of a sample must lie together (write_archives sees to that). A row without an element stands for a
sample with nothing to report, which gets an archive without tables.

Paths are opened by pyarrow's file systems, so a folder has to be one that the driver and all executors reach.
"""

from __future__ import annotations

import csv
import io
import tarfile
import tempfile
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, In, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

#: Bytes of archives that one task reads, about; an archive is one task's.
RUN_BYTES = 64 << 20
#: Bytes of a member that are kept in memory before it is written.
IN_MEMORY = 8 << 20
ENDS = {"tables": ".zip", "flanks": ".tar.gz"}
FLANKS = "sample string, is_element string, bucket string, header string, seq string, problem string"
BROKEN = (zipfile.BadZipFile, tarfile.TarError, EOFError, OSError, ValueError, KeyError, zlib.error)


@dataclass
class Run(InputPartition):
    archives: list[str]


def _system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))


class _File(io.RawIOBase):
    """A file of pyarrow's whose wrong seeks are errors that zipfile knows."""

    def __init__(self, file):
        self.file = file

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        return self.file.readinto(buffer)

    def seek(self, at: int, whence: int = 0) -> int:
        try:
            return self.file.seek(at, whence)
        except pa.ArrowInvalid as e:
            raise OSError(str(e)) from e

    def tell(self) -> int:
        return self.file.tell()


def _sample(path: str, end: str) -> str:
    return path.rsplit("/", 1)[-1].removesuffix(end)


class _Reader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.kind, self.path, self.names, self.wanted = options["kind"], options["path"], schema.names, None

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, EqualTo | In) and f.attribute == ("is_element",):
                values = set(f.value if isinstance(f, In) else [f.value])
                self.wanted = values if self.wanted is None else self.wanted & values
            else:
                yield f

    def partitions(self) -> list[Run]:
        system, at = _system(self.path)
        found = sorted((i for i in system.get_file_info(fs.FileSelector(at)) if i.is_file and i.path.endswith(ENDS[self.kind])), key=lambda i: i.path)
        runs, held = [], 0
        for info in found:
            if not runs or held + info.size > RUN_BYTES:
                runs.append(Run([]))
                held = 0
            runs[-1].archives.append(info.path)
            held += info.size
        return runs or [Run([])]

    def read(self, partition: Run) -> Iterator[tuple]:
        system = _system(self.path)[0]
        for path in partition.archives:
            rows = self._tables(system, path) if self.kind == "tables" else self._flanks(system, path)
            try:
                yield from rows
            except BROKEN as e:
                yield self._row({"sample": _sample(path, ENDS[self.kind]), "problem": f"{type(e).__name__}: {e}"})

    def _row(self, values: dict) -> tuple:
        return tuple(values.get(n) for n in self.names)

    def _is_wanted(self, element: str | None) -> bool:
        return self.wanted is None or element in self.wanted

    def _tables(self, system: fs.FileSystem, path: str) -> Iterator[tuple]:
        own = {"sample": _sample(path, ".zip")}
        with system.open_input_file(path) as raw, zipfile.ZipFile(io.BufferedReader(_File(raw))) as archive:
            for name in archive.namelist():
                element = name.rsplit("/", 1)[-1].removesuffix(".tsv")
                if not name.endswith(".tsv") or self.wanted is not None and element not in {safe(w) for w in self.wanted if w is not None}:
                    continue
                with archive.open(name) as member:
                    for row in csv.DictReader(io.TextIOWrapper(member, "utf-8", newline=""), delimiter="\t", quoting=csv.QUOTE_NONE):
                        # A field that is empty is missing.
                        values = {"is_element": element, **own, **{k: v or None for k, v in row.items()}}
                        if self._is_wanted(values["is_element"]):
                            yield self._row(values)

    def _manifest(self, member) -> list[tuple[str, str]]:
        """(element, bucket) of the entries that are asked for and not empty."""
        rows = csv.DictReader(io.TextIOWrapper(member, "utf-8", newline=""), delimiter="\t")
        return [(r["is_element"], r["side"]) for r in rows if self._is_wanted(r["is_element"]) and int(r["n_seqs"]) > 0]

    def _flanks(self, system: fs.FileSystem, path: str) -> Iterator[tuple]:
        sample = _sample(path, ".tar.gz")
        beside = f"{path.rsplit('/', 1)[0]}/{sample}/{sample}.manifest.tsv"
        wanted = None
        if system.get_file_info(beside).is_file:
            with system.open_input_file(beside) as raw:
                if not (wanted := self._manifest(raw)):
                    return
        with system.open_input_file(path) as raw, tarfile.open(fileobj=raw, mode="r:gz") as archive:
            index = {m.name.rsplit("/", 1)[-1]: m for m in archive.getmembers() if m.isfile()}
            if wanted is None:
                if (inside := index.get(f"{sample}.manifest.tsv")) is None:
                    yield self._row({"sample": sample, "problem": "no manifest"})
                    return
                wanted = self._manifest(archive.extractfile(inside))
            for element, bucket in wanted:
                if (member := index.get(f"{sample}__{safe(element)}__{bucket}.overhangs.fasta")) is None:
                    yield self._row({"sample": sample, "is_element": element, "bucket": bucket, "problem": "listed in the manifest, but missing"})
                    continue
                header, parts = None, []
                for line in io.TextIOWrapper(archive.extractfile(member), "utf-8"):
                    if line.startswith(">"):
                        if header is not None:
                            yield self._row({"sample": sample, "is_element": element, "bucket": bucket, "header": header, "seq": "".join(parts)})
                        header, parts = line[1:].rstrip("\r\n"), []
                    else:
                        parts.append(line.strip())
                if header is not None:
                    yield self._row({"sample": sample, "is_element": element, "bucket": bucket, "header": header, "seq": "".join(parts)})


def safe(name: str) -> str:
    return name.replace("/", "_")


class _Zip:
    """A zip that takes the rows of one element after another."""

    def __init__(self, sink, sample: str, names: list[str]):
        self.archive, self.names, self.member = zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED), names, None

    def begin(self, element: str) -> None:
        self.end()
        self.member = self.archive.open(f"{safe(element)}.tsv", "w")
        self._line(self.names)

    def _line(self, values) -> None:
        self.member.write(("\t".join("" if v is None else str(v) for v in values) + "\n").encode())

    def add(self, row) -> None:
        self._line(row[n] for n in self.names)

    def end(self) -> None:
        if self.member is not None:
            self.member.close()
            self.member = None

    def close(self) -> None:
        self.end()
        self.archive.close()


class _Tar:
    """A tar.gz that takes the flanks of one element and bucket after another, and the manifest at last; the last database of an element's rows counts for all."""

    def __init__(self, sink, sample: str, names: list[str]):
        self.archive, self.sample, self.entries, self.database, self.key, self.buffer = tarfile.open(fileobj=sink, mode="w:gz"), sample, [], {}, None, None

    def begin(self, element: str) -> None:
        self.element = element

    def _put(self, name: str, body) -> None:
        info = tarfile.TarInfo(name)
        info.size = body.tell()
        body.seek(0)
        self.archive.addfile(info, body)

    def add(self, row) -> None:
        if self.key != (row["is_element"], row["bucket"]):
            self.end()
            self.key, self.n, self.buffer = (row["is_element"], row["bucket"]), 0, tempfile.SpooledTemporaryFile(IN_MEMORY)
        self.buffer.write(f">{row['header']}\n{row['seq']}\n".encode())
        self.n += 1
        if "database" in row:
            self.database[row["is_element"]] = row["database"] or ""

    def end(self) -> None:
        if self.buffer is not None:
            self._put(name := f"{self.sample}__{safe(self.key[0])}__{self.key[1]}.overhangs.fasta", self.buffer)
            self.entries.append((*self.key, self.n, name))
            self.buffer.close()
            self.buffer = self.key = None

    def close(self) -> None:
        self.end()
        body = io.BytesIO()
        body.write(b"is_element\tside\tn_seqs\tfasta_path\tdatabase\n")
        for element, bucket, n, name in self.entries:
            body.write(f"{element}\t{bucket}\t{n}\t{name}\t{self.database.get(element, '')}\n".encode())
        self._put(f"{self.sample}.manifest.tsv", body)
        self.archive.close()


class _Writer(DataSourceWriter):
    def __init__(self, options: dict, schema: StructType, overwrite: bool):
        self.kind, self.path, self.overwrite = options["kind"], options["path"], overwrite
        self.names = [n for n in schema.names if n != "sample"] if self.kind == "tables" else schema.names

    def write(self, iterator) -> WriterCommitMessage:
        system, at = _system(self.path)
        system.create_dir(at, recursive=True)
        now = None
        for row in iterator:
            row = row.asDict()
            if now is None or row["sample"] != now[0]:
                self._finish(system, at, now)
                name = f"{at}/_{uuid.uuid4().hex}"
                sink = system.open_output_stream(name)
                now = [row["sample"], name, sink, (_Zip if self.kind == "tables" else _Tar)(sink, row["sample"], self.names), None]
            if row["is_element"] is None:
                continue
            if row["is_element"] != now[4]:
                now[3].begin(row["is_element"])
                now[4] = row["is_element"]
            now[3].add(row)
        self._finish(system, at, now)
        return WriterCommitMessage()

    def _finish(self, system: fs.FileSystem, at: str, now: list | None) -> None:
        if now:
            now[3].close()
            now[2].close()
            system.move(now[1], f"{at}/{now[0]}{ENDS[self.kind]}")


class Archives(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sample_archives"

    def schema(self) -> str:
        return FLANKS

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(dict(self.options), schema)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(dict(self.options), schema, overwrite)


def _registered(spark: SparkSession) -> None:
    spark.dataSource.register(Archives)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_tables(spark: SparkSession, path: str, schema: str, only: list[str] | None = None) -> DataFrame:
    """sample, is_element, the columns of schema (by name; null where a table lacks one) and problem of all zips in a folder; only: these elements."""
    _registered(spark)
    wanted = [x.strip().split(" ") for x in schema.split(",")]
    names = list(dict.fromkeys(["sample", "is_element", *[c for c, _ in wanted], "problem"]))
    raw = spark.read.format("sample_archives").schema(", ".join(f"`{n}` string" for n in names)).option("kind", "tables").load(path)
    raw = raw if only is None else raw.where(F.col("is_element").isin(only))
    kinds = dict(wanted)
    return raw.select(*[F.col(f"`{n}`").cast(kinds.get(n, "string")).alias(n) for n in names])


def read_flanks(spark: SparkSession, path: str, only: list[str] | None = None) -> DataFrame:
    """Flanks of all tar.gz files in a folder, of all elements or only some."""
    _registered(spark)
    raw = spark.read.format("sample_archives").option("kind", "flanks").load(path)
    return raw if only is None else raw.where(F.col("is_element").isin(only))


def write_archives(rows: DataFrame, path: str, kind: str = "tables", samples: DataFrame | None = None) -> None:
    """An archive for each sample of rows, and an empty one for each of samples without rows; columns sample, is_element and, of flanks, bucket, header, seq and, if there is one, database."""
    _registered(rows.sparkSession)
    if samples is not None:
        rows = samples.select("sample").distinct().join(rows, "sample", "left")
    order = ["sample", "is_element"] + (["bucket", "header"] if kind == "flanks" else [])
    rows.repartition("sample").sortWithinPartitions(*order).write.format("sample_archives").option("kind", kind).mode("append").save(path)
