"""Report sources: XML files, class-per-file CSV, stage tables."""

from __future__ import annotations

import warnings
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from reportlens.operators.rows import drop_columns_matching, tag_source, union_sources

_CSV = dict(header=True, quote='"', escape='"', encoding="UTF-8",
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)

XML_SECTIONS = {"findings": "FINDINGS", "impression": "IMPRESSION", "indication": "INDICATION", "comparison": "COMPARISON"}


# --------------------------------------------------------------------- XML

_XML_REPORT = ("uid string, pmc_id string, filename string, findings string, impression string, indication string, comparison string, "
               "mesh_major string, mesh_minor string, num_images int, image_ids string, malformed boolean, error string")


def _report_reader(encoding: str | None):
    """A function of Arrow batches (document, filename); it is made here so that tasks receive its code along with it."""
    sections, names = dict(XML_SECTIONS), [c.split()[0] for c in _XML_REPORT.split(", ")]

    def report(xml):
        root = ElementTree.fromstring(xml, ElementTree.XMLParser(encoding=encoding))

        def below(tag):
            return [e for e in root.iter(tag) if e is not root]

        def attribute(tag):
            found = below(tag)
            return found[0].get("id") if found else None
        # The text before a child element; the last element of a label counts.
        texts = {e.get("Label"): (e.text or "").strip() for e in below("AbstractText")}
        terms = {kind: [e.text.strip() for mesh in below("MeSH")[:1] for e in mesh.findall(kind) if e.text] for kind in ("major", "minor")}
        images = [e.get("id", "") for e in below("parentImage")]
        return [attribute("uId"), attribute("pmcId"), *[texts.get(label, "") for label in sections.values()],
                "|".join(terms["major"]), "|".join(terms["minor"]), len(images), "|".join(images)]

    def run(batches):
        for batch in batches:
            rows = []
            for xml, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    uid, pmc, *rest = report(xml if xml is not None else b"")
                    rows.append([uid, pmc, name, *rest, False, None])
                except (ElementTree.ParseError, LookupError, ValueError) as e:
                    rows.append([None, None, name, *[None] * 8, True, str(e)])
            kinds = [pa.string()] * 9 + [pa.int32(), pa.string(), pa.bool_(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)
    return run


def parse_xml_reports(df: DataFrame, xml: str = "value", filename: str = "filename") -> DataFrame:
    """Flat report rows from a column of XML documents (text or bytes), each
    parsed once, with its elements found at any depth. Adds ``malformed`` and
    ``error``, the parser's message with the place; a malformed document has null
    fields.

    A repeated section label is overwritten by its last element; missing
    sections are ``''``; texts are stripped; terms of white space stay as ``''``.
    Bytes are read in the encoding that the document declares.
    """
    text = isinstance(df.schema[xml].dataType, T.StringType)
    raw = df.select(F.col(xml).cast("binary").alias("xml"), F.col(filename).cast("string").alias("filename"))
    return raw.mapInArrow(_report_reader("utf-8" if text else None), _XML_REPORT)


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(~F.col("malformed")).drop("malformed", "error")


def quarantine(parsed: DataFrame) -> DataFrame:
    """The malformed documents: (filename, error)."""
    return parsed.filter("malformed").select("filename", "error")


def scan_xml_reports(spark: SparkSession, path: str, keep_malformed: bool = False, pattern: str = "*.xml") -> DataFrame:
    """One report per file of a folder and those below it whose name fits
    ``pattern``. Spark leaves out files without a byte.

    Spark makes a task of some 30 small files; 32 such are read by one here, if
    that leaves four for each core, as to begin a task takes longer than to read
    the files."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path).select(
        "content", F.col("_metadata.file_name").alias("filename"))
    splits, few = raw.rdd.getNumPartitions(), 4 * spark.sparkContext.defaultParallelism
    if splits > few:
        raw = raw.coalesce(max(few, splits // 32))
    parsed = parse_xml_reports(raw, "content")
    return parsed if keep_malformed else good_rows(parsed)


# --------------------------------------------------------------------- CSV

def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def scan_labelled_csv(spark: SparkSession, files: dict, source: str, schema: T.StructType | None = None,
                      label: str = "condition", multi_line: bool = True) -> DataFrame:
    """Stack one CSV per class by column name, tagged with class and source.
    Report texts hold line breaks; without any, ``multi_line=False`` lets Spark
    split large files.

    Absent files are skipped with a warning. Columns are strings unless a schema
    is given, so no extra pass infers types.
    """
    frames = []
    for name, path in files.items():
        if not _exists(spark, path):
            warnings.warn(f"no file for class {name}: {path}", stacklevel=2)
            continue
        d = read_csv(spark, path, schema, multi_line)
        frames.append(drop_columns_matching(d, r"^(Unnamed.*|EndHere||_c\d+)$").withColumn(label, F.lit(name)))
    if not frames:
        raise FileNotFoundError("none of the class files exists")
    return tag_source(union_sources(frames), source)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = False) -> DataFrame:
    """A CSV with a header. Fields with line breaks need ``multi_line``, which
    reads each file in one task."""
    reader = spark.read.options(**_CSV, multiLine=multi_line)
    d = (reader.schema(schema) if schema else reader).csv(path)
    # A byte-order mark sticks to the first name.
    return d.toDF(*[c.lstrip("﻿") for c in d.columns])


def empty_to_null(df: DataFrame) -> DataFrame:
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in names}) if names else df


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None, multi_line: bool = True) -> DataFrame:
    """Read a stage table back. From CSV the empty string comes back as null."""
    if fmt == "csv":
        return empty_to_null(read_csv(spark, path, schema, multi_line))
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.format(fmt).load(path)
