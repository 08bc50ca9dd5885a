"""Files as tables: discovery, checks, ZIP members, DOCX paragraphs and pages of PDF files.

Files are read by Spark's binaryFile source and decoded in Arrow batches, one file at a
time; a broken file gives a row with an error instead of failing the job.
"""

from __future__ import annotations

import functools
import io
import re
import zipfile
import zlib
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
#: Bytes that a PDF file has at least.
LEAST_PDF = 1000


def find_files(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """path, name, length, serial of files at any depth, by serial and path; serial is the number that leads the name, else 999999. Contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    serial = F.coalesce(F.regexp_extract(name, "^([0-9]+)_", 1).try_cast("int"), F.lit(999_999))
    return found.select("path", name.alias("name"), "length", serial.alias("serial")).orderBy("serial", "path")


def first_files(spark: SparkSession, folder: str, pattern: str, most: int | None = None) -> DataFrame:
    """The first ``most`` files by path, or all."""
    found = find_files(spark, folder, pattern).orderBy("path")
    return found if most is None else found.limit(most)


def read_files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """path and content of files at any depth."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder).select("path", "content")


def pdf_problem(content) -> object:
    """Why bytes are no PDF file, else null: too small, without the mark, or without a page (where objects are not packed)."""
    pages = F.decode(content, "ISO-8859-1").rlike(r"/Type\s*/(Page\b|ObjStm)")
    return F.when(content.isNull(), "missing").when(F.length(content) < LEAST_PDF, "too small").when(F.substring(content, 1, 4) != F.lit(b"%PDF"), "no PDF mark").when(~pages, "no pages")


def pdf_info(files: DataFrame) -> DataFrame:
    """path, filename, file_size_mb, pages, title, author, creation_date of PDF files (path, content), as far as their objects are not packed."""
    raw = F.decode("content", "ISO-8859-1")
    said = lambda key: F.regexp_extract(raw, rf"/{key}\s*\(((?:\\.|[^()\\])*)\)", 1)
    pages = F.size(F.regexp_extract_all(raw, F.lit(r"(/Type\s*/Page\b)(?!s)"), 1))
    return files.select(
        "path", F.element_at(F.split("path", "/"), -1).alias("filename"), (F.length("content") / F.lit(1024.0 * 1024)).alias("file_size_mb"), pages.cast("long").alias("pages"),
        said("Title").alias("title"), said("Author").alias("author"), said("CreationDate").alias("creation_date"),
    )


def _decoded(files: DataFrame, decode: Callable[[bytes], list[str]], columns: tuple[str, str]) -> DataFrame:
    place, value = columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                try:
                    values, error = decode(content.as_py() or b""), None
                except Exception as e:  # a broken file of any kind must not fail the job
                    values, error = [None], f"{type(e).__name__}: {e}"
                n = len(values)
                yield pa.RecordBatch.from_pydict(
                    {"path": pa.array([path] * n, pa.string()), place: pa.array(range(1, n + 1), pa.int64()), value: pa.array(values), "error": pa.array([error] * n, pa.string())}
                    if values and values[0] is not None
                    else {"path": pa.array([path] * n, pa.string()), place: pa.array([None] * n, pa.int64()), value: pa.array([None] * n, pa.string()), "error": pa.array([error] * n, pa.string())}
                )

    return files.select("path", "content").mapInArrow(run, f"path string, {place} long, {value} string, error string")


def docx_paragraphs_of(content: bytes) -> list[str]:
    body = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(content)).read("word/document.xml"))
    return ["".join(t.text or "" for t in p.iter(f"{_W}t")) for p in body.iter(f"{_W}p")]


def docx_paragraphs(files: DataFrame) -> DataFrame:
    """path, paragraph (from 1), text, error of DOCX files (path, content)."""
    return _decoded(files, docx_paragraphs_of, ("paragraph", "text"))


def pdf_pages_of(content: bytes) -> list[str]:
    """Pages of a plain PDF file: uncompressed objects, literal strings, one line for each text operator.

    Fonts with own encodings, object streams and scanned pages need another decoder.
    """
    if content[:4] != b"%PDF":
        raise ValueError("no PDF mark")
    objects = {int(m[1]): m[2] for m in re.finditer(rb"(?s)(\d+) 0 obj(.*?)endobj", content)}
    pages = []
    for body in objects.values():
        if not re.search(rb"/Type\s*/Page\b(?!s)", body):
            continue
        lines = []
        for ref in re.findall(rb"(\d+) 0 R", (re.search(rb"(?s)/Contents\s*(\[.*?\]|\d+ 0 R)", body) or [b"", b""])[1]):
            found = re.search(rb"(?s)stream\r?\n(.*?)\r?\nendstream", objects.get(int(ref), b""))
            data = b"" if not found else zlib.decompress(found[1]) if b"/FlateDecode" in objects[int(ref)] else found[1]
            for shown in re.findall(rb"(?s)((?:\((?:\\.|[^()\\])*\)|[-\d.\s\[])+)\]?\s*T[jJ]", data):
                parts = re.findall(rb"(?s)\(((?:\\.|[^()\\])*)\)", shown)
                lines.append(re.sub(rb"\\(.)", rb"\1", b"".join(parts)).decode("latin-1"))
        pages.append("\n".join(lines))
    return pages


def pdf_pages(files: DataFrame, decode: Callable[[bytes], list[str]] = pdf_pages_of) -> DataFrame:
    """path, page (from 1), text, error of PDF files (path, content); ``decode`` gives the texts of a file's pages."""
    return _decoded(files, decode, ("page", "text"))


def pages_with_fallbacks(files: DataFrame, decoders: list[Callable[[bytes], list[str]]], least: int = 50) -> DataFrame:
    """path, page, text, error: of each page the first decoder's text that has ``least`` characters, else the last one's that has any; a decoder that fails is passed over."""

    def decode(content: bytes) -> list[str]:
        best: list[str] = []
        failed = None
        for d in decoders:
            try:
                found = d(content)
            except Exception as e:  # the next one may read it
                failed = e
                continue
            best += [""] * (len(found) - len(best))
            for k, text in enumerate(found):
                if len(best[k].strip()) < least and text.strip():
                    best[k] = text
        if not best and failed:
            raise failed
        return best

    return pdf_pages(files, decode)


def placed_words(files: DataFrame, decode: Callable[[bytes], list[tuple[int, str, float, float, float, float]]]) -> DataFrame:
    """path, page, text, x0, x1, top, bottom, error: the words of files (path, content) with their places, as ``decode`` gives them; a file that cannot be read has one row with an error."""
    names = ["page", "text", "x0", "x1", "top", "bottom"]
    types = [pa.int64(), pa.string(), *[pa.float64()] * 4]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                try:
                    words, error = decode(content.as_py() or b""), None
                except Exception as e:  # a broken file of any kind must not fail the job
                    words, error = [(None,) * 6], f"{type(e).__name__}: {e}"
                columns = list(zip(*words, strict=True)) or [()] * 6
                n = len(words)
                yield pa.RecordBatch.from_arrays([pa.array([path] * n, pa.string()), *(pa.array(c, t) for c, t in zip(columns, types, strict=True)), pa.array([error] * n, pa.string())], names=["path", *names, "error"])

    return files.select("path", "content").mapInArrow(run, "path string, page long, text string, x0 double, x1 double, top double, bottom double, error string")


def json_sizes(files: DataFrame) -> DataFrame:
    """path and chars of text files (path, content), the longest first."""
    return files.select("path", F.length(F.col("content").cast("string")).alias("chars")).orderBy(F.desc("chars"), "path")


def routed_pages(files: DataFrame, text: Callable[[bytes], list[str]], scanned: Callable[[bytes], list[str]]) -> DataFrame:
    """path, page, text, error of files (path, content, kind): 'scanned' ones by one decoder, all others by the other."""
    by_text = pdf_pages(files.filter("kind IS NULL OR kind <> 'scanned'"), text)
    return by_text.unionByName(pdf_pages(files.filter("kind = 'scanned'"), scanned))


def binarised(pixels: np.ndarray, contrast: float = 1.5) -> np.ndarray:
    """Black and white of a picture (rows, columns, red green blue) for reading: grey, more contrast around the mean, cut at the mean."""
    grey = pixels[..., :3] @ np.array([0.299, 0.587, 0.114]) if pixels.ndim == 3 else pixels.astype(float)
    strong = np.clip(np.rint(grey.mean()) + contrast * (grey - np.rint(grey.mean())), 0, 255)
    return np.where(strong > strong.mean(), 255, 0).astype(np.uint8)


def first_pages(pages: DataFrame, most: int) -> DataFrame:
    """path and text of the first ``most`` pages of each file, joined."""
    kept = pages.filter(F.col("page") <= most)
    return kept.groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", F.coalesce("text", F.lit("")).alias("t")))), lambda p: p["t"]), "\n").alias("text"))


_X = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def xlsx_rows_of(content: bytes) -> list[list[str | None]]:
    """Rows of the first sheet of a workbook, cells as text in their columns."""
    box = zipfile.ZipFile(io.BytesIO(content))
    names = box.namelist()
    text = lambda e: "".join(t.text or "" for t in e.iter(f"{_X}t"))
    shared = [text(e) for e in ElementTree.fromstring(box.read("xl/sharedStrings.xml")).findall(f"{_X}si")] if "xl/sharedStrings.xml" in names else []
    sheet = ElementTree.fromstring(box.read(min(x for x in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", x))))
    out = []
    for row in sheet.iter(f"{_X}row"):
        cells: list[str | None] = []
        for c in row.findall(f"{_X}c"):
            letters = re.match("[A-Z]*", c.get("r", ""))[0]
            at = functools.reduce(lambda n, x: n * 26 + ord(x) - 64, letters, 0) - 1 if letters else len(cells)
            value = c.find(f"{_X}v")
            cells += [None] * (at - len(cells))
            kind = c.get("t")
            cells.append(text(c) if kind == "inlineStr" else None if value is None else shared[int(value.text)] if kind == "s" else value.text)
        out.append(cells)
    return out


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a registry in a workbook (.xlsx) or CSV file, as text, with ``row_index`` from 1; headers lose white space at their ends. A registry is one small file."""
    if not path.endswith(".xlsx"):
        raw = spark.read.option("header", "true").csv(path).coalesce(1)
        return raw.toDF(*(c.strip() for c in raw.columns)).withColumn("row_index", F.monotonically_increasing_id() + 1)
    head, *rows = xlsx_rows_of(spark.read.format("binaryFile").load(path).select("content").first()[0]) or [[]]
    names = [str(c or f"column {k}").strip() for k, c in enumerate(head)]
    schema = ", ".join(f"`{n}` string" for n in [*names])
    table = [(*(r + [None] * len(names))[: len(names)], k) for k, r in enumerate(rows, 1)]
    return spark.createDataFrame(table, f"{schema}, row_index long" if names else "row_index long")


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV table with a header, or an empty one where there is none; columns that it lacks are null, broken rows too."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], schema)
    wanted = spark.createDataFrame([], schema).schema
    raw = spark.read.option("header", "true").csv(path)
    return raw.select(*((F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in raw.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in wanted.fields))


def report_files(spark: SparkSession, folder: str) -> DataFrame:
    """path, source_file, json and error of JSON reports at any depth, one file one row; broken ones have an error and no JSON."""
    t = F.col("content").cast("string")
    broken = F.from_json(t, "map<string,string>").isNull() & ~F.ltrim(t).startswith("[")
    read = read_files(spark, folder, "*.json").select("path", t.alias("t"), broken.alias("broken"))
    return read.select("path", F.element_at(F.split("path", "/"), -1).alias("source_file"), F.when(~F.col("broken"), F.col("t")).alias("json"), F.when(F.col("broken"), "no JSON object").alias("error"))


def first_member(files: DataFrame, suffix: str = ".pdf") -> DataFrame:
    """path, member, content, error: the first member with the suffix of each ZIP file (path, content)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                member = data = error = None
                try:
                    box = zipfile.ZipFile(io.BytesIO(content.as_py() or b""))
                    member = next((x for x in box.namelist() if x.lower().endswith(suffix)), None)
                    data, error = (box.read(member), None) if member else (None, f"no {suffix} member")
                except (zipfile.BadZipFile, zlib.error) as e:
                    error = str(e)
                yield pa.RecordBatch.from_arrays([pa.array([path], pa.string()), pa.array([member], pa.string()), pa.array([data], pa.binary()), pa.array([error], pa.string())], names=["path", "member", "content", "error"])

    return files.select("path", "content").mapInArrow(run, "path string, member string, content binary, error string")


def missing_entries(files: DataFrame) -> DataFrame:
    """Entries of JSON files (path, content), which are a list or an object with 'entries': one row each, as JSON."""
    t = F.col("content").cast("string")
    kind = "array<string>"
    entries = F.coalesce(F.from_json(F.get_json_object(t, "$.entries"), kind), F.from_json(t, kind))
    return files.select("path", F.posexplode(entries).alias("place", "entry"))
