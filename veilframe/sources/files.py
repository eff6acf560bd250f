"""Reading and writing: listings, manifests, ledgers, annotations, features, archives of page images."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.functions.kernels import png_size
from veilframe.operators.annotations import XML_SCHEMA
from veilframe.operators.manifest import basename, page_number

MANIFEST_SCHEMA = "object_name STRING, subject_id STRING"
LEDGER_SCHEMA = "subject_id STRING, object_name STRING, used BOOLEAN, warning_ordering STRING, warning_censoring STRING, time DOUBLE, status STRING, error STRING"
REGION = "STRUCT<x: DOUBLE, y: DOUBLE, width: DOUBLE, height: DOUBLE, original_width: INT, original_height: INT, rectanglelabels: ARRAY<STRING>>"
ANNOTATION_SCHEMA = f"image STRING, image_type STRING, roi_type STRING, censor_type STRING, close_type STRING, label ARRAY<{REGION}>"


def list_files(spark: SparkSession, folder: str, extension: str | list[str] | None = None, recursive: bool = False) -> DataFrame:
    """path, sorted: the files of a folder with an extension, or one of several, or all (None, "*", "all"); the dot is optional.

    Only paths are read, not contents. Files of no bytes hold no page and are not listed.
    """
    x = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(folder).select("path")
    if extension not in (None, "*", "all"):
        ends = [extension] if isinstance(extension, str) else list(extension)
        x = x.filter(" OR ".join(f"endswith(path, '.{e.lstrip('.')}')" for e in ends))
    return x.orderBy("path")


def list_folders(files: DataFrame, hidden: bool = False) -> DataFrame:
    """folder, sorted: the distinct parents of listed files."""
    x = files.select(F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder")).distinct()
    return (x if hidden else x.filter(~F.col("folder").rlike(r"/[.]"))).orderBy("folder")


#: The characters that windows-1252 has where ISO-8859-1 has the controls 0x80 to 0x9F, by its definition.
_CP1252 = {chr(b): bytes([b]).decode("cp1252") for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}


def read_manifest(spark: SparkSession, path: str, encoding: str = "UTF-8", schema: str | None = MANIFEST_SCHEMA) -> DataFrame:
    """A CSV with a header; legacy code pages by their name.

    Spark reads few code pages; windows-1252 (cp1252) is read as ISO-8859-1, the characters that differ are put in after.
    """
    windows = encoding.lower().replace("_", "-") in ("windows-1252", "cp1252")
    r = spark.read.option("header", True).option("encoding", "ISO-8859-1" if windows else encoding)
    x = (r.schema(schema) if schema else r).csv(path)
    if not windows:
        return x
    text = lambda c: F.translate(F.col(f"`{c}`"), "".join(_CP1252), "".join(_CP1252.values())).alias(c)
    return x.select(*(text(c) if kind == "string" else F.col(f"`{c}`") for c, kind in x.dtypes))


def read_ledgers(spark: SparkSession, folder: str, without: str | None = None) -> DataFrame:
    """All ledger CSVs of a folder but one (by its name, in any case)."""
    x = spark.read.option("header", True).schema(LEDGER_SCHEMA).csv(f"{folder}/*.csv").withColumn("__file", F.col("_metadata.file_name"))
    return (x if without is None else x.filter(F.lower("__file") != without.lower())).drop("__file")


def write_ledger(df: DataFrame, path: str, batch_id: str) -> None:
    """Appends a batch's rows; each write is committed as a whole."""
    df.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(path)


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    """One row for each page entry of annotation documents (JSON arrays): template (the file's stem), doc_pos, and its fields."""
    raw = spark.read.text(path, wholetext=True).select(F.regexp_extract("_metadata.file_name", r"^(.*?)([.][^.]*)?$", 1).alias("template"), F.from_json("value", f"ARRAY<STRUCT<{ANNOTATION_SCHEMA.replace(' STRING', ': STRING').replace('label ARRAY', 'label: ARRAY')}>>").alias("pages"))
    return raw.select("template", F.posexplode("pages").alias("doc_pos", "p")).select("template", "doc_pos", "p.*")


def read_xml(spark: SparkSession, path: str) -> DataFrame:
    """One row for each <image>, with its boxes."""
    return spark.read.format("xml").option("rowTag", "image").schema(XML_SCHEMA).load(path)


def parse_xml(df: DataFrame, column: str) -> DataFrame:
    """The same from a column of texts that hold one <image> each."""
    return df.select(F.from_xml(column, XML_SCHEMA).alias("i")).select("i.*")


def write_xml(images: DataFrame, path: str) -> None:
    images.write.format("xml").option("rowTag", "image").option("rootTag", "annotations").mode("overwrite").save(path)


def read_features(spark: SparkSession, path: str, templates: list[str] | None = None) -> DataFrame:
    """Features computed of template boxes beforehand, of the templates named."""
    x = spark.read.parquet(path)
    return x if templates is None else x.filter(F.col("template").isin(templates))


def write_features(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").partitionBy("template").parquet(path)


def tar_image_sizes(archives: DataFrame, content: str = "content") -> DataFrame:
    """path, member, page_no, width, height: PNG members of tar archives, by their first 24 bytes; other members are skipped."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for path, data in zip(frame["path"], frame[content], strict=True):
                with tarfile.open(fileobj=io.BytesIO(data)) as tar:
                    for m in tar:
                        head = tar.extractfile(m).read(24) if m.isfile() else b""
                        try:
                            rows.append((path, m.name, *png_size(head)))
                        except ValueError:
                            continue
            yield pd.DataFrame(rows, columns=["path", "member", "width", "height"])

    sizes = archives.select("path", content).mapInPandas(run, "path string, member string, width int, height int")
    return sizes.select("path", "member", page_number(F.col("member")).alias("page_no"), "width", "height")


def tar_folders(pages: DataFrame, id_: str = "subject_id") -> DataFrame:
    """subject_id, archive: one tar for each subject of its files (name, data), in order of names; the same bytes each time.

    A grouped map: a subject's pages are a few dozen.
    """

    def run(group: pd.DataFrame) -> pd.DataFrame:
        out = io.BytesIO()
        with tarfile.open(fileobj=out, mode="w") as tar:
            for name, data in sorted(zip(group["name"], group["data"], strict=True)):
                info = tarfile.TarInfo(f"{group[id_].iloc[0]}/{name}")
                info.size = len(data)
                tar.addfile(info, io.BytesIO(bytes(data)))
        return pd.DataFrame({id_: [group[id_].iloc[0]], "archive": [out.getvalue()]})

    kind = pages.schema[id_].dataType.simpleString()
    return pages.select(id_, "name", "data").groupBy(id_).applyInPandas(run, f"{id_} {kind}, archive binary")


def done_files(files: DataFrame, mark: str = "_done") -> DataFrame:
    return files.filter(F.contains("path", F.lit(mark)))


def with_names(files: DataFrame) -> DataFrame:
    return files.withColumn("name", basename(F.col("path")))
