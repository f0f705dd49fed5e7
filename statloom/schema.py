"""Schemas of the records, in the order in which they are written."""

from __future__ import annotations

from pyspark.sql import types as T

ANNOTATION = T.StructType([T.StructField("heading", T.StringType()), T.StructField("text", T.StringType())])
RANGE = T.StructType([T.StructField(n, T.StringType()) for n in ("start", "end", "raw")])
ANOMALY = T.StructType([T.StructField(n, T.StringType()) for n in ("field", "observed", "corrected", "confidence", "evidence")])

_KINDS = {
    "crossReferences": T.ArrayType(T.StringType()),
    "annotations": T.ArrayType(ANNOTATION),
    "headingIsSupplied": T.BooleanType(),
    "isRepealed": T.BooleanType(),
    "covers": RANGE,
    "titleIsSupplied": T.BooleanType(),
    "sourceAnomalies": T.ArrayType(ANOMALY),
}
#: Fields of a section record in their order (fixed values).
SECTION_FIELDS = (
    "sectionNumber title chapterNumber docType partHeading bodyText history crossReferences caseNotes annotations headingIsSupplied isRepealed covers titleIsSupplied sourceAnomalies numberSource filename url bodyHtml"
).split()
SECTION = T.StructType([T.StructField(n, _KINDS.get(n, T.StringType())) for n in SECTION_FIELDS])

_FILE = T.StructType([T.StructField("filename", T.StringType()), T.StructField("url", T.StringType()), T.StructField("isIndex", T.BooleanType())])
_CHAPTER = T.StructType([T.StructField("number", T.StringType()), T.StructField("dirName", T.StringType()), T.StructField("volumeNumber", T.IntegerType()), T.StructField("title", T.StringType()), T.StructField("files", T.ArrayType(_FILE))])
_VOLUME = T.StructType([T.StructField("number", T.IntegerType()), T.StructField("dirName", T.StringType()), T.StructField("chapterRange", T.StringType()), T.StructField("chapters", T.ArrayType(_CHAPTER))])
MANIFEST = T.StructType([T.StructField("createdAt", T.StringType()), T.StructField("baseUrl", T.StringType()), T.StructField("volumes", T.ArrayType(_VOLUME)), T.StructField("totalFiles", T.LongType())])

#: Tables of the side database, re-runnable (types as Spark has them).
DDL = {
    "volumes": "number INT NOT NULL, dir_name STRING NOT NULL, chapter_range STRING",
    "chapters": "number STRING NOT NULL, dir_name STRING NOT NULL, volume_number INT NOT NULL, title STRING",
    "sections": "section_number STRING NOT NULL, chapter_number STRING NOT NULL, title STRING, body_text STRING, history STRING, case_notes STRING, cross_references ARRAY<STRING>, part_heading STRING, is_repealed BOOLEAN, doc_type STRING, filename STRING, url STRING",
}
