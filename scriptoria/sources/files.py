"""File scans, page readers and sinks."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Suffixes that can be read, and the type each stands for.
FILE_TYPES = {"pdf": "pdf", "docx": "docx", "png": "image", "jpg": "image", "jpeg": "image", "webp": "image"}

PAGE_SCHEMA = "path string, page int, text string, extraction_method string, confidence double, error string"


def file_type(path: Column) -> Column:
    suffix = F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))
    return F.create_map(*[F.lit(x) for kv in FILE_TYPES.items() for x in kv])[suffix]


def subject_topic(path: Column, root: str) -> tuple[Column, Column]:
    """First and second folder under root; null where the file lies higher."""
    rest = F.regexp_replace(path, "^" + _quoted(root.rstrip("/") + "/"), "")
    parts = F.split(rest, "/")
    return F.when(F.size(parts) > 1, parts[0]), F.when(F.size(parts) > 2, F.get(parts, F.lit(1)))


def _quoted(text: str) -> str:
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def scan_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, file_hash, file_type, size_bytes, modified_at, content) of all files; type is null if unsupported."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    visible = raw.filter(~F.col("path").rlike(r"/\.[^/]*$"))
    return visible.select("path", F.sha2("content", 256).alias("file_hash"), file_type(F.col("path")).alias("file_type"), F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified_at"), "content")


def docx_text(content: bytes) -> str:
    """Non-blank paragraphs, then the rows of all tables with cells joined by a bar."""
    ns = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{ns}body")
    said = lambda node: "".join(t.text or "" for t in node.iter(f"{ns}t"))
    lines = [s for p in body.findall(f"{ns}p") if (s := said(p).strip())]
    for table in body.iter(f"{ns}tbl"):
        for row in table.iter(f"{ns}tr"):
            lines.append(" | ".join(said(cell).strip() for cell in row.findall(f"{ns}tc")))
    return "\n".join(lines)


def read_pages(files: DataFrame, pdf: Callable[[bytes], list[str | None]] | None = None, image: Callable[[bytes], str] | None = None) -> DataFrame:
    """Pages of files(path, file_type, content). A file that fails gives one row with its error, and the rest goes on.

    pdf and image are readers to plug in; without them such pages wait for transcription.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows: list[tuple] = []
            for path, kind, content in zip(b["path"], b["file_type"], b["content"]):
                try:
                    if kind == "docx":
                        rows.append((path, 1, docx_text(content), "docx_text", 0.95, None))
                    elif kind == "pdf" and pdf:
                        rows += [(path, n, t, "pdf_text" if t else "pending_vision", 0.9 if t else 0.0, None) for n, t in enumerate(pdf(content), 1)]
                    elif kind == "image" and image:
                        rows.append((path, 1, image(content), "image_ocr", 0.7, None))
                    elif kind in ("pdf", "image"):
                        rows.append((path, 1, None, "pending_vision", 0.0, None))
                    else:
                        rows.append((path, 1, None, "failed", 0.0, "unsupported_file_type"))
                except Exception as e:
                    rows.append((path, 1, None, "failed", 0.0, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["path", "page", "text", "extraction_method", "confidence", "error"])

    return files.select("path", "file_type", "content").mapInPandas(read, PAGE_SCHEMA)


def ingest(files: DataFrame, manifest: DataFrame, version: str, root: str, at: str, pdf: Callable[[bytes], list[str | None]] | None = None, image: Callable[[bytes], str] | None = None, force: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pages, dead letters, manifest after) of scanned files that no run has read at this version.

    Pages carry file_hash, subject, topic and the gate's judgement: a page of a text layer that fails the gate
    waits for transcription. A file that fails gives a dead letter (path, error) and no manifest entry. Equal
    contents at several paths are read once, at the least path.
    """
    from scriptoria.operators.quality import assess

    todo = files.filter("file_type is not null")
    if not force:
        todo = todo.join(manifest.filter(F.col("pipeline_version") == version).select("file_hash").distinct(), "file_hash", "left_anti")
    todo = todo.groupBy("file_hash").agg(F.min_by(F.struct("path", "file_type", "content"), "path").alias("x")).select("file_hash", "x.*")
    subject, topic = subject_topic(F.col("path"), root)
    names = todo.select("path", "file_hash", subject.alias("subject"), topic.alias("topic"))
    read = read_pages(todo, pdf, image).join(names, "path")
    bad = read.filter("error is not null").select("path", "file_hash", "error")
    good = assess(read.filter("error is null"))
    waits = (F.col("extraction_method") == "pdf_text") & F.col("q_reason").isNotNull()
    pages = good.select("file_hash", "path", "subject", "topic", "page", F.when(~waits, F.col("text")).alias("text"), F.when(waits, "pending_vision").otherwise(F.col("extraction_method")).alias("extraction_method"), F.when(waits, 0.0).otherwise(F.least("confidence", "q_confidence")).alias("confidence"), F.col("q_reason").isNotNull().alias("is_garbled"), F.col("q_reason").alias("garbled_reason"), F.col("q_chars").alias("char_count"))
    done = names.join(bad.select("file_hash"), "file_hash", "left_anti").select("file_hash", F.col("path").alias("original_path"), F.lit(version).alias("pipeline_version"), F.lit(at).alias("processed_at"))
    return pages, bad, upsert_manifest(manifest.select("file_hash", "original_path", "pipeline_version", "processed_at"), done)


def upsert_manifest(old: DataFrame, new: DataFrame) -> DataFrame:
    """The last entry of every file_hash by processed_at, as an instant; of equal ones the new one."""
    both = old.withColumn("_n", F.lit(0)).unionByName(new.withColumn("_n", F.lit(1)))
    cols = [c for c in both.columns if c != "_n"]
    best = both.groupBy("file_hash").agg(F.max_by(F.struct(*cols), F.struct(F.try_to_timestamp(F.col("processed_at")), F.col("_n"))).alias("x"))
    return best.select("x.*")


def nested_documents(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """One row per document with its pages as an ordered array, as the JSON files hold them."""
    item = F.struct("page", "text", "extraction_method", "confidence", "is_garbled", "garbled_reason", "char_count")
    grouped = pages.dropDuplicates(["document_id", "page"]).groupBy("document_id").agg(F.array_sort(F.collect_list(item)).alias("pages"))
    return documents.dropDuplicates(["document_id"]).join(grouped, "document_id", "left")


def write_json(df: DataFrame, folder: str, by: str = "document_id", buckets: int = 64) -> None:
    """JSON lines in folders by a hash of the key; a reader prunes to the folder of its key."""
    df.withColumn("bucket", F.pmod(F.xxhash64(by), F.lit(buckets))).repartition("bucket").write.mode("overwrite").partitionBy("bucket").json(folder)


def read_json(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """JSON with a fixed schema; rows that can't be parsed are left out."""
    lines = spark.read.text(folder)
    parsed = F.from_json("value", schema + ", _corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    return lines.select(parsed.alias("x")).filter("x._corrupt_record is null").select("x.*").drop("_corrupt_record")
