"""A tree of text documents as DataFrames: inventory, documents and lines."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chroniq.functions import text as T
from chroniq.sources.stored import Scratch

#: Names and suffixes of text files, and folders that are not scanned (fixed values).
TEXT_NAMES = (".gitignore",)
TEXT_SUFFIXES = (".md", ".py", ".txt", ".yaml", ".yml", ".json")
SKIPPED = (".git", "templates")


def _hidden(path: str) -> bool:
    return any(p[:1] in "._" for p in path.split("/"))


class Documents:
    """Documents given as a table (path, content binary) of all files.

    Tests for skipped folders look at the path below the root only.
    """

    def __init__(self, spark: SparkSession, raw: DataFrame):
        self.spark, self._raw, self._held = spark, raw, False

    @property
    def raw(self) -> DataFrame:
        return self._raw

    @property
    def paths(self) -> DataFrame:
        return self.raw.select("path")

    @property
    def inventory(self) -> DataFrame:
        """path, kind: files, and the folders that hold them."""
        parts = F.split("path", "/")
        up = self.paths.select(F.explode(F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))).alias("path")).distinct()
        return self.paths.withColumn("kind", F.lit("file")).unionByName(up.withColumn("kind", F.lit("folder")))

    @property
    def files(self) -> DataFrame:
        """path, content of the text files that are scanned."""
        parts = F.split("path", "/")
        name = F.element_at(parts, -1)
        # a suffix needs a stem before it
        text = name.isin(*TEXT_NAMES) | F.lower(name).rlike(r"[^/]" + "(" + "|".join(rf"\{s}" for s in TEXT_SUFFIXES) + r")\z")
        return self.raw.filter(text & ~F.arrays_overlap(parts, F.array(*[F.lit(s) for s in SKIPPED])))

    @property
    def decoded(self) -> DataFrame:
        """path, text (null: not UTF-8)."""
        s = F.col("content").cast("string")
        return self.files.select("path", F.when(F.is_valid_utf8(s), s).alias("text"))

    def hold(self, scratch: Scratch) -> None:
        """Store the files, so that all that follows reads them from there."""
        if not self._held:
            self._raw, self._held = scratch.store(self._raw, "files"), True

    @property
    def documents(self) -> DataFrame:
        return self.decoded.filter("text is not null")

    @property
    def lines(self) -> DataFrame:
        """path, line_no (from 1), line."""
        return self.documents.select("path", F.posexplode(T.lines("text")).alias("_p", "line")).select("path", (F.col("_p") + 1).alias("line_no"), "line")

    def named(self, name: str) -> DataFrame:
        """path, content of the files whose path ends in a name."""
        return self.raw.filter(F.col("path").endswith(name))


class Corpus(Documents):
    """A folder in any store that Spark reaches.

    Spark's reader lists no file of a hidden name (a dot or underscore first); those few are read by the driver, which
    lists the tree for them: names, no contents.
    """

    def __init__(self, spark: SparkSession, root: str):
        super().__init__(spark, None)
        self.root = root

    @cached_property
    def _listing(self) -> tuple[str, list[str]]:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        fs = path.getFileSystem(conf)
        base, it, out = fs.makeQualified(path).toUri().getPath().rstrip("/"), fs.listFiles(path, True), []
        while it.hasNext():
            out.append(it.next().getPath().toUri().getPath()[len(base) + 1 :])
        return base, out

    @cached_property
    def paths(self) -> DataFrame:
        return self.spark.createDataFrame([(p,) for p in self._listing[1]], "path string")

    def hold(self, scratch: Scratch) -> None:
        """Store the decoded texts; the files themselves stay where they are."""
        if not self._held:
            self._texts, self._held = scratch.store(super().decoded, "texts"), True

    @property
    def decoded(self) -> DataFrame:
        return self._texts if self._held else super().decoded

    @cached_property
    def raw(self) -> DataFrame:
        _, names = self._listing
        out = self._visible() if any(not _hidden(n) for n in names) else self.spark.createDataFrame([], "path string, content binary")
        hidden = [n for n in names if _hidden(n) and _is_text(n)]
        return out.unionByName(self._rows(hidden)) if hidden else out

    def _visible(self, glob: str | None = None) -> DataFrame:
        reader = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        df = (reader.option("pathGlobFilter", glob) if glob else reader).load(self.root)
        base = self._listing[0]
        return df.select(F.expr(f"substring(path, locate({_sql(base + '/')}, path) + {len(base) + 1})").alias("path"), "content")

    def _rows(self, names: list[str]) -> DataFrame:
        return self.spark.createDataFrame([(n, bytes(self._read(n))) for n in names], "path string, content binary")

    def _read(self, name: str) -> bytes:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(self.root, name)
        stream = path.getFileSystem(conf).open(path)
        try:
            return jvm.org.apache.commons.io.IOUtils.toByteArray(stream)
        finally:
            stream.close()

    def named(self, name: str) -> DataFrame:
        names = [n for n in self._listing[1] if n.endswith(name) and not _hidden(n)]
        return self._visible(glob=name.rsplit("/", 1)[-1]).filter(F.col("path").endswith(name)) if names else self.spark.createDataFrame([], "path string, content binary")


def _sql(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _is_text(path: str) -> bool:
    name = path.rsplit("/", 1)[-1]
    return name in TEXT_NAMES or any(name.lower().endswith(s) and len(name) > len(s) for s in TEXT_SUFFIXES)
