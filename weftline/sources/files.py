"""File sources and sinks.

Readers give DataFrames with a declared schema. Writers use Spark's commit protocol, which already is all or nothing.
Connectors to services check hosts, sizes and signatures; what fetches is a parameter, by default the standard library.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def split_front_matter(text: Column | str) -> Column:
    """A struct of the header between the first two rules, its fields, and the trimmed body; an error instead where the
    header is missing or not closed."""
    text = F.col(text) if isinstance(text, str) else text
    good = F.startswith(text, F.lit("---\n")) & (F.instr(F.substring(text, 5, 2**31 - 1), "\n---\n") > 0)
    rest = F.substring(text, 5, 2**31 - 1)
    head = F.substring_index(rest, "\n---\n", 1)
    body = F.regexp_replace(F.substr(rest, F.length(head) + 6), r"(?U)^\s+|\s+$", "")
    fields = F.str_to_map(head, F.lit("\n"), F.lit(": "))
    return F.when(good, F.struct(fields.alias("header"), body.alias("body"), F.lit(None).cast("string").alias("error"))).otherwise(F.struct(F.lit(None).cast("map<string,string>").alias("header"), F.lit(None).cast("string").alias("body"), F.lit("front matter is missing or not closed").alias("error")))


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    """(path, header, body, error) of each file, one row per file."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return files.select("path", split_front_matter("value").alias("d")).select("path", "d.*")


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path, multiLine=True)


def read_verified_pages(spark: SparkSession, path: str) -> DataFrame:
    """OCR pages (view, markdown, sha256), each checked against its digest."""
    pages = spark.read.schema("view int, markdown string, sha256 string").json(path)
    same = F.sha2("markdown", 256) == F.col("sha256")
    return pages.select("view", F.when(same, F.col("markdown")).otherwise(F.raise_error(F.concat(F.lit("digest differs in view "), F.col("view").cast("string")))).alias("markdown"))


RDF_SCHEMA = "struct<title: string, creator: array<string>, subject: array<string>, format: array<string>>"


def parse_rdf(text: Column | str) -> Column:
    """Metadata of an RDF/XML record, lists sorted; documents with a DTD or entities are refused."""
    text = F.col(text) if isinstance(text, str) else text
    safe = ~text.rlike("<!(DOCTYPE|ENTITY)")
    r = F.from_xml(text, RDF_SCHEMA)
    made = F.struct(r["title"].alias("title"), F.array_sort(r["creator"]).alias("creators"), F.array_sort(r["subject"]).alias("subjects"), F.array_sort(r["format"]).alias("formats"))
    return F.when(safe, made)


def write_exports(rows: DataFrame, path: str, by: str, internal: tuple[str, ...] = ()) -> None:
    """JSON lines per value of a column, without internal columns."""
    rows.drop(*internal).write.mode("overwrite").partitionBy(by).json(path)


def write_json_arrays(rows: DataFrame, path: str, by: str, internal: tuple[str, ...] = ()) -> None:
    """Files that hold one JSON array each, per value of a column, without internal columns. Lines are written as they
    come, so no task holds an array whole."""
    kept = [c for c in rows.columns if c not in (*internal, by)]

    def arrays(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None
        for b in batches:
            out = []
            for key, line in zip(b[by], b["line"], strict=True):
                out += [(key, "[")] if last is None else [(last[0], last[1] + ",")] if last[0] == key else [last, (last[0], "]"), (key, "[")]
                last = (key, line)
            yield pd.DataFrame(out, columns=[by, "value"])
        if last is not None:
            yield pd.DataFrame([last, (last[0], "]")], columns=[by, "value"])

    lines = rows.select(by, F.to_json(F.struct(*kept)).alias("line")).sortWithinPartitions(by)
    lines.mapInPandas(arrays, f"{by} string, value string").write.mode("overwrite").partitionBy(by).text(path)


def hashed_records(text: Column | str) -> Column:
    """array of (path, sha256, bytes): all objects with a path and a digest, however deep they stand in a JSON text."""

    def walk(value: object) -> Iterator[tuple]:
        waiting = [value]
        while waiting:
            at = waiting.pop()
            if isinstance(at, dict):
                if at.get("path") and len(str(at.get("sha256") or "")) == 64:
                    yield at["path"], at["sha256"], at.get("bytes")
                waiting += at.values()
            elif isinstance(at, list):
                waiting += at

    @F.pandas_udf("array<struct<path: string, sha256: string, bytes: long>>")
    def run(s: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(("path", "sha256", "bytes"), r, strict=True)) for r in walk(json.loads(t))] if t else [] for t in s], dtype="object")

    return run(text)


def unpruned(spark: SparkSession, path: str, pruned: tuple[str, ...]) -> list[str]:
    """The files below a path, without entering folders of these names (whatever stands before a `=` in them)."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    files, folders = [], [root]
    while folders:
        for entry in fs.listStatus(folders.pop()):
            name = entry.getPath().getName()
            if entry.isDirectory():
                if name.split("=", 1)[-1] not in pruned:
                    folders.append(entry.getPath())
            elif not name.startswith(("_", ".")):
                files.append(entry.getPath().toString())
    return sorted(files)


def repository_lines(spark: SparkSession, path: str, pruned: tuple[str, ...]) -> DataFrame:
    """(path, value): the lines of all files below a path but those below folders of these names, which aren't listed."""
    found = unpruned(spark, path, pruned)
    if not found:
        return spark.createDataFrame([], "path string, value string")
    return spark.read.text(found).select(F.col("_metadata.file_path").alias("path"), "value")


def write_cluster_texts(rows: DataFrame, path: str, cluster: str, line: str) -> None:
    """A text partition per cluster."""
    rows.select(cluster, F.col(line).alias("value")).write.mode("overwrite").partitionBy(cluster).text(path)


def hashed_artifacts(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes, sha256) of all files below a path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


#: How files of a kind begin; fixed values.
SIGNATURES = {"jpeg": (b"\xff\xd8",), "png": (b"\x89PNG",), "pdf": (b"%PDF-",), "xml": (b"<?xml", b"<rdf", b"<!DOCTYPE"), "html": (b"<!DOCTYPE", b"<html")}


class Refused(ValueError):
    """Why a response isn't taken: host, redirect, size or signature."""


def fetch_https(url: str) -> tuple[str, dict[str, str], Iterator[bytes]]:
    """(address that answered, headers, chunks) by the standard library."""
    from urllib.request import urlopen

    answer = urlopen(url, timeout=60)  # noqa: S310  the scheme is checked before
    return answer.geturl(), {k.lower(): v for k, v in answer.headers.items()}, iter(lambda: answer.read(65_536), b"")


class Connector:
    """A service reached over the network. Hosts are pinned, for the request and for what it is redirected to, answers are
    read no further than `most` bytes, and must begin as their kind does."""

    def __init__(self, hosts: tuple[str, ...], most: int = 20_000_000, kind: str | None = None, fetch: Callable = fetch_https):
        self.hosts, self.most, self.kind, self.fetch = hosts, most, kind, fetch

    def allowed(self, url: str) -> bool:
        """An https address of a pinned host, or of one below a host that is pinned with a leading dot."""
        from urllib.parse import urlsplit

        parts = urlsplit(url)
        name = parts.hostname or ""
        return parts.scheme == "https" and any(name == h or h.startswith(".") and name.endswith(h) for h in self.hosts)

    def open(self, url: str) -> bytes:
        if not self.allowed(url):
            raise Refused("host")
        final, headers, chunks = self.fetch(url)
        if not self.allowed(final):
            raise Refused("redirect")
        if int(headers.get("content-length", 0)) > self.most:
            raise Refused("size")
        held = bytearray()
        for chunk in chunks:
            held += chunk
            if len(held) > self.most:
                raise Refused("size")
        if self.kind and not bytes(held[:16]).startswith(SIGNATURES[self.kind]):
            raise Refused("signature")
        return bytes(held)


def canonical_json(value: object) -> str:
    """Sorted keys, no spaces, characters as they are: what object hashes are taken of."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
