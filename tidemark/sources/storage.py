"""Storage by URL: which backend a URL names, and listing, reading and atomic writing through Hadoop's file systems."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from dataclasses import dataclass, field
from urllib.parse import urlparse, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

@dataclass(frozen=True)
class Location:
    """A parsed URL: the backend, the URI that Spark opens, and Hadoop settings that it needs."""

    backend: str
    uri: str
    parts: dict[str, str] = field(default_factory=dict)
    settings: dict[str, str] = field(default_factory=dict)


def resolve(url: str, env: dict[str, str] | None = None) -> Location:
    """The location of a URL, by its scheme and host; raises ValueError for one that names no backend. AWS_REGION,
    AWS_DEFAULT_REGION and AWS_ENDPOINT_URL stand in where an S3 URL doesn't say."""
    env = dict(os.environ) if env is None else env
    if url.startswith(("/", "file:")):
        path = url.removeprefix("file:")
        return Location("local", "file:///" + path.lstrip("/"), {"path": path})
    lead, own_endpoint, rest = url.partition("::")  # s3::http://host:port/bucket/key has an endpoint of its own
    split = urlsplit(rest if own_endpoint else url)
    scheme, host, path = (lead if own_endpoint else split.scheme).lower(), split.hostname or "", split.path.lstrip("/")
    first, _, after = path.partition("/")
    labels = host.split(".")
    if scheme in ("s3", "s3a"):
        if own_endpoint and split.scheme in ("http", "https") and split.port and first:
            return _s3(first, after, env, endpoint=f"{split.scheme}://{host}:{split.port}")
        if not own_endpoint and host:
            return _s3(split.netloc, path, env)
    elif scheme == "https" and host.endswith(".amazonaws.com"):
        if labels[0] == "s3" and len(labels) == 4 and first:
            return _s3(first, after, env, region=labels[1])
        if len(labels) > 4 and labels[-4] == "s3":
            return _s3(".".join(labels[:-4]), path, env, region=labels[-3])
    elif scheme == "gs" and split.netloc:
        return Location("gcs", f"gs://{split.netloc}/{path}", {"bucket": split.netloc, "key": path})
    elif scheme == "https" and host == "storage.googleapis.com" and first:
        return Location("gcs", f"gs://{first}/{after}", {"bucket": first, "key": after})
    elif scheme == "https" and host.endswith(".storage.googleapis.com"):
        bucket = host.removesuffix(".storage.googleapis.com")
        return Location("gcs", f"gs://{bucket}/{path}", {"bucket": bucket, "key": path})
    elif scheme in ("abfs", "abfss") and split.username and host.endswith(".dfs.core.windows.net"):
        return _azure(labels[0], split.username, path)
    elif scheme == "https" and labels[1:] in (["blob", "core", "windows", "net"], ["dfs", "core", "windows", "net"]) and first:
        return _azure(labels[0], first, after)
    raise ValueError(f"no storage backend for {url!r}")


def _s3(bucket: str, key: str, env: dict[str, str], region: str | None = None, endpoint: str | None = None) -> Location:
    region, endpoint = region or env.get("AWS_REGION") or env.get("AWS_DEFAULT_REGION"), endpoint or env.get("AWS_ENDPOINT_URL")
    settings = {"fs.s3a.endpoint.region": region} if region else {}
    if endpoint:
        settings |= {"fs.s3a.endpoint": endpoint, "fs.s3a.path.style.access": "true"}
    return Location("s3", f"s3a://{bucket}/{key}", {"bucket": bucket, "key": key}, settings)


def _azure(account: str, container: str, key: str) -> Location:
    return Location("azure", f"abfss://{container}@{account}.dfs.core.windows.net/{key}", {"account": account, "container": container, "key": key})


def is_not_found(error: BaseException) -> bool:
    """Whether an error says that a file or folder doesn't exist."""
    return isinstance(error, FileNotFoundError) or any(x in str(error) for x in ("FileNotFoundException", "PATH_NOT_FOUND", "does not exist", "NoSuchFile"))


class Storage:
    """Files under a base URL. Paths are relative to it, with / between parts."""

    def __init__(self, spark: SparkSession, url: str, options: dict[str, str] | None = None):
        self.spark = spark
        self.location = resolve(url) if not re.match(r"(hdfs|viewfs|s3a|wasbs?|dbfs)://", url) or url.startswith("s3a://") else Location("hadoop", url)
        conf = spark._jsc.hadoopConfiguration()
        for k, v in (self.location.settings | (options or {})).items():
            conf.set(k, v)
        self.base = self.location.uri.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self._path(self.base or "/").getFileSystem(conf)
        self.qualified = self.fs.makeQualified(self._path(self.base or "/")).toString().rstrip("/")

    def uri(self, path: str = "") -> str:
        return f"{self.base}/{path}" if path else self.base

    def _at(self, path: str):
        return self._path(self.uri(path))

    def exists(self, path: str = "") -> bool:
        return self.fs.exists(self._at(path))

    def list(self, prefix: str = "") -> list[tuple[str, int]]:
        """(path, size) of every file below a prefix, hidden ones too; none if the prefix doesn't exist."""
        if not self.exists(prefix):
            return []
        found, out = self.fs.listFiles(self._at(prefix), True), []
        while found.hasNext():
            status = found.next()
            out.append((self.relative(status.getPath().toString()), status.getLen()))
        return out

    def names(self, folder: str) -> list[str]:
        """Names in a folder, whatever comes and goes there meanwhile."""
        if not self.exists(folder):
            return []
        return [status.getPath().getName() for status in self.fs.listStatus(self._at(folder))]

    def relative(self, uri: str) -> str:
        """A listed URI's path below the base."""
        plain = re.sub(r"^file:/+", "/", uri)
        return plain[len(re.sub(r"^file:/+", "/", self.qualified)) :].lstrip("/")

    def read(self, path: str) -> bytes:
        stream = self.fs.open(self._at(path))
        try:
            return bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def write(self, path: str, data: bytes) -> None:
        """Replaces a small file at once: readers see the old content or the new."""
        target = self._at(path)
        beside = self._at(f"{path}.{uuid.uuid4().hex}.tmp")
        self.fs.mkdirs(target.getParent())
        self._put(beside, data)
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.spark._jsc.hadoopConfiguration())
        overwrite = self.spark._jvm.java.lang.reflect.Array.newInstance(self.spark._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 1)
        overwrite[0] = getattr(self.spark._jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
        context.rename(beside, target, overwrite)

    def _put(self, target, data: bytes) -> None:
        stream = self.fs.create(target, True)
        try:
            stream.write(bytearray(data))
        finally:
            stream.close()

    def put_if_absent(self, path: str, data: bytes) -> bool:
        """Creates a file whole, unless it exists; of several writers one gets True. A local file is linked into place;
        elsewhere a rename that doesn't replace does it, so the store must have one."""
        target, beside = self._at(path), self._at(f"{path}.{uuid.uuid4().hex}.tmp")
        if self.fs.exists(target):
            return False
        self._put(beside, data)
        try:
            if self.location.backend == "local":
                local = lambda p: p.toUri().getPath()
                try:
                    os.link(local(beside), local(target))
                except FileExistsError:
                    return False
                return True
            return not self.fs.exists(target) and self.fs.rename(beside, target)
        finally:
            self.fs.delete(beside, False)

    def rename(self, source: str, target: str) -> None:
        self.fs.mkdirs(self._at(target).getParent())
        if not self.fs.rename(self._at(source), self._at(target)):
            raise OSError(f"can't rename {self.uri(source)} to {self.uri(target)}")

    def delete(self, path: str = "") -> bool:
        return self.fs.delete(self._at(path), True)

    def manifest(self, suffixes: tuple[str, ...] = (), prefixes: list[str] | None = None, hidden: bool = False) -> DataFrame:
        """(path, partition, filename, size) of the files, listed by Spark's own distributed listing; names that begin with
        _ or . are left out, as are folders of such names and files without a byte. Prefixes that don't exist are skipped; None lists all."""
        wanted = [""] if not prefixes else sorted(set(prefixes))
        there = [self.uri(p) for p in wanted if self.exists(p)]
        schema = "path string, partition string, filename string, size long"
        if not there:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        if suffixes:
            reader = reader.option("pathGlobFilter", "*{" + ",".join(suffixes) + "}")
        base = re.sub(r"^file:/+", "/", self.qualified)
        plain = F.regexp_replace("path", r"^file:/+", "/")
        path = F.substring(plain, len(base) + 2, 1 << 20)
        listed = reader.load(there).select(path.alias("path"), F.col("length").alias("size")).distinct()
        if not hidden:
            listed = listed.filter(~F.col("path").rlike(r"(^|/)[_.]"))
        return listed.select("path", dirname("path").alias("partition"), F.substring_index("path", "/", -1).alias("filename"), "size")


def dirname(path: str):
    """A path column's folder; empty for one at the root."""
    return F.when(F.instr(path, "/") > 0, F.regexp_replace(path, "/[^/]*$", "")).otherwise(F.lit(""))


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder that driver and executors share, removed when the driver exits."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    base = base or "file://" + tempfile.gettempdir()
    uri = f"{base.rstrip('/')}/tidemark-work-{name}-{uuid.uuid4().hex}"

    def forget() -> None:
        try:
            path = spark._jvm.org.apache.hadoop.fs.Path(uri)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # noqa: BLE001  the session may be gone
            if uri.startswith("file:"):
                shutil.rmtree(urlparse(uri).path, ignore_errors=True)

    atexit.register(forget)
    return uri
