"""Files from tables: DOCX and JSON documents, charts and comparison pages."""

from __future__ import annotations

import html
import io
import json
import uuid
import zipfile
from collections.abc import Callable, Iterator
from xml.sax.saxutils import escape

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_TYPES = (
    '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
    '<Override PartName="/word/document.xml" ContentType="application/vnd.openxmlformats-officedocument.wordprocessingml.document.main+xml"/></Types>'
)
_RELATIONS = (
    '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" '
    'Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="word/document.xml"/></Relationships>'
)
NO_TEXT = "[No text on this page]"


def docx_bytes(paragraphs: list[tuple[int, str]]) -> bytes:
    """A DOCX file of (level, text): level 0 is plain text, others are headings. Control characters are left out."""
    plain = lambda t: escape("".join(c for c in t if c in "\t\n" or c >= " "))
    style = lambda n: f'<w:pPr><w:pStyle w:val="Heading{min(n, 9)}"/></w:pPr>' if n else ""
    body = "".join(f'<w:p>{style(n)}<w:r><w:t xml:space="preserve">{plain(t)}</w:t></w:r></w:p>' for n, t in paragraphs)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as box:
        for name, text in (
            ("[Content_Types].xml", _TYPES),
            ("_rels/.rels", _RELATIONS),
            ("word/document.xml", f'<?xml version="1.0" encoding="UTF-8"?><w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>{body}</w:body></w:document>'),
        ):
            box.writestr(zipfile.ZipInfo(name), text)  # no time, so equal texts give equal bytes
    return out.getvalue()


def docx_files(pages: DataFrame) -> DataFrame:
    """name and content of one DOCX file for each report (name, page, text): a heading for each page, then its paragraphs.

    An empty page says so. A report's pages are gathered in one row; no reports span rows.
    """
    reports = pages.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("page", F.coalesce("text", F.lit("")).alias("text")))).alias("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, x in zip(batch.column("name").to_pylist(), batch.column("x"), strict=True):
                parts = []
                for p in x.as_py():
                    parts.append((1, f"Page {p['page']}"))
                    parts += [(0, t.strip()) for t in p["text"].split("\n\n") if t.strip()] or [(0, NO_TEXT)]
                yield pa.RecordBatch.from_pydict({"name": pa.array([name], pa.string()), "content": pa.array([docx_bytes(parts)], pa.binary())})

    return reports.mapInArrow(run, "name string, content binary")


def json_files(reports: DataFrame, name: str) -> DataFrame:
    """name and content of one JSON file for each row: all columns but ``name``, set out in lines."""
    rest = F.struct(*(c for c in reports.columns if c != name))
    return reports.select(F.col(name).alias("name"), F.to_json(rest, {"pretty": "true", "ignoreNullFields": "false"}).cast("binary").alias("content"))


def report_docx(reports: DataFrame) -> DataFrame:
    """name and content of one DOCX file for each report (name, title, blocks: as of plans.sections.heading_blocks): the title, then headings by level and their paragraphs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                parts = [(1, row["title"] or "")]
                for block in row["blocks"] or []:
                    parts.append((min(9, block["level"] + 1), block["heading"] or ""))
                    parts += [(0, p) for p in block["content"] if p]
                yield pa.RecordBatch.from_pydict({"name": pa.array([row["name"]], pa.string()), "content": pa.array([docx_bytes(parts)], pa.binary())})

    return reports.select("name", "title", F.transform("blocks", lambda b: F.struct(b["level"].alias("level"), b["heading"].alias("heading"), b["content"].alias("content"))).alias("blocks")).mapInArrow(run, "name string, content binary")


def _place(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder: of its scheme if it has one, else this machine's, as in tests."""
    return pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pafs.LocalFileSystem(), folder)


def write_files(files: DataFrame, folder: str, suffix: str = "") -> int:
    """Write files (name, content) to a folder that all executors share; returns their number.

    The folder may be a path or an address such as hdfs://host/path. A file is written
    aside and then renamed, so a task that runs again replaces it whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _place(folder)
        system.create_dir(base, recursive=True)
        for batch in batches:
            for name, content in zip(batch.column("name").to_pylist(), batch.column("content"), strict=True):
                aside = f"{base}/.{uuid.uuid4().hex}"
                with system.open_output_stream(aside) as f:
                    f.write(content.as_py())
                system.move(aside, f"{base}/{name}{suffix}")
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    return files.select("name", "content").mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def replace_table(df: DataFrame, path: str, kind: str = "csv") -> None:
    """Write ``df`` in place of the table at ``path``, also if it was read from there: written aside, then renamed."""
    spark, aside = df.sparkSession, f"{path}.{uuid.uuid4().hex}"
    writer = df.write.option("header", "true") if kind == "csv" else df.write
    writer.format(kind).save(aside)
    where = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    system = where(path).getFileSystem(spark._jsc.hadoopConfiguration())
    system.delete(where(path), True)
    system.rename(where(aside), where(path))


def export_all(sinks: dict[str, Callable[[], object]]) -> dict[str, str | None]:
    """Run every sink; for each the error that it ended with, or null. One that fails does not keep others back."""
    out: dict[str, str | None] = {}
    for name, sink in sinks.items():
        try:
            sink()
            out[name] = None
        except Exception as e:  # whatever it is, it is reported
            out[name] = f"{type(e).__name__}: {e}"
    return out


def topic_exports(folder: str, topics: DataFrame, documents: DataFrame, keywords: DataFrame) -> dict[str, str | None]:
    """Write the tables of a topic model as CSV: topic_info (Topic, Count, Name), topic_keywords, document_topics and model_stats; outliers (-1) are counted apart."""
    real, lost = F.when(F.col("Topic") != -1, F.col("Count")), F.when(F.col("Topic") == -1, F.col("Count"))
    stats = topics.agg(
        F.sum("Count").alias("total_documents"), F.count(real).alias("num_topics"), F.round(F.coalesce(F.sum(lost), F.lit(0)) * 100 / F.sum("Count"), 4).alias("outlier_percentage"),
        F.avg(real).alias("avg_topic_size"), F.median(real).alias("median_topic_size"), F.max(real).alias("largest_topic_size"), F.min(real).alias("smallest_topic_size"),
    )
    tables = {"topic_info": topics, "topic_keywords": keywords.filter("Topic <> -1"), "document_topics": documents, "model_stats": stats}
    return export_all({name: (lambda name=name, df=df: replace_table(df, f"{folder}/{name}")) for name, df in tables.items()})


def themes_text(keywords: DataFrame) -> DataFrame:
    """One line for each topic (topic, place, word): its number and words in order."""
    rows = keywords.groupBy("topic").agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("x"))
    return rows.orderBy("topic").select(F.concat(F.lit("Topic "), F.col("topic").cast("string"), F.lit(": ['"), F.array_join(F.transform("x", lambda y: y["word"]), "', '"), F.lit("']")).alias("value"))


def summary_json(counts: DataFrame, made_at: str) -> str:
    """A JSON text of a run: ``made_at`` and the figures of one row."""
    row = counts.first()
    return json.dumps({"timestamp": made_at, **(row.asDict(recursive=True) if row else {})}, indent=2, ensure_ascii=False, default=str)


def save_model(model, path: str) -> None:
    """Save a fitted pipeline or model of pyspark.ml, in place of one that is there."""
    model.write().overwrite().save(path)


def load_model(path: str):
    """Load what save_model saved, whatever its class."""
    return DefaultParamsReader.loadParamsInstance(path, SparkSession.active())


#: Bars and rows that a page shows at most; it says how many there are in all, and tables hold the rest.
MOST_BARS = 200
# Colours of the categories.
COLOURS = ["#2ecc71", "#3498db", "#9b59b6", "#e67e22", "#e74c3c", "#1abc9c", "#34495e", "#f1c40f"]


def _page(title: str, body: str) -> str:
    return f'<!DOCTYPE html><html><head><meta charset="utf-8"><title>{html.escape(title)}</title></head><body><h1>{html.escape(title)}</h1>{body}</body></html>'


def _largest(data: DataFrame, label: str, value: str) -> tuple[list, str]:
    """The largest values, ties by label, and a note if there are more."""
    known = data.select(label, value).filter(F.col(value).isNotNull())
    rows = known.orderBy(F.desc(value), label).limit(MOST_BARS).collect()
    total = known.count() if len(rows) == MOST_BARS else len(rows)
    return rows, f"<p>The first {len(rows)} of {total}.</p>" if total > len(rows) else ""


def bar_chart(data: DataFrame, label: str, value: str, title: str) -> str:
    """An HTML page with the bars of the largest values, ties by label."""
    rows, note = _largest(data, label, value)
    most = max((float(r[1]) for r in rows), default=1.0) or 1.0
    bars = "".join(f'<tr><td>{html.escape(str(r[0]))}</td><td><div style="width:{max(0.0, 400 * float(r[1]) / most):.1f}px;height:12px;background:#2f6f8f"></div></td><td>{r[1]}</td></tr>' for r in rows)
    return _page(title, f"<table>{bars}</table>{note}")


def pie_chart(data: DataFrame, label: str, value: str, title: str) -> str:
    """An HTML page with a pie of the values and their percentages, the largest first."""
    rows, note = _largest(data, label, value)
    total, at, slices, items = sum(float(r[1]) for r in rows) or 1.0, 0.0, [], []
    for k, r in enumerate(rows):
        share, colour = 100 * float(r[1]) / total, COLOURS[k % len(COLOURS)]
        slices.append(f"{colour} {at:.3f}% {at + share:.3f}%")
        items.append(f'<li><span style="color:{colour}">&#9632;</span> {html.escape(str(r[0]))}: {r[1]} ({share:.1f}%)</li>')
        at += share
    return _page(title, f'<div style="width:320px;height:320px;border-radius:50%;background:conic-gradient({", ".join(slices) or "#ccc 0% 100%"})"></div><ul>{"".join(items)}</ul>{note}')


def table_page(data: DataFrame, title: str, order: str) -> str:
    """An HTML page with the rows of a table with the largest ``order``; ties by all columns."""
    rows = data.orderBy(F.desc(order), *data.columns).limit(MOST_BARS).collect()
    total = data.count() if len(rows) == MOST_BARS else len(rows)
    head = "".join(f"<th>{html.escape(c)}</th>" for c in data.columns)
    body = "".join("<tr>" + "".join(f"<td>{html.escape(str(v))}</td>" for v in r) + "</tr>" for r in rows)
    return _page(title, f"<table><tr>{head}</tr>{body}</table>" + (f"<p>The first {len(rows)} of {total}.</p>" if total > len(rows) else ""))


def sunburst(data: DataFrame, title: str, inner: int = 10) -> str:
    """An HTML page with totals (category, topic, n) nested: all, each category and its ``inner`` largest topics; the rest of a category is one entry."""
    place = Window.partitionBy("category").orderBy(F.desc("n"), "topic")
    ranked = data.groupBy("category", "topic").agg(F.sum("n").alias("n")).withColumn("topic", F.when(F.row_number().over(place) <= inner, F.col("topic").cast("string")).otherwise("others"))
    # at most ``inner`` and one rows a category; categories are few
    rows = ranked.groupBy("category", "topic").agg(F.sum("n").alias("n")).orderBy("category", F.desc("n"), "topic").collect()
    groups: dict[str, list] = {}
    for r in rows:
        groups.setdefault(str(r["category"]), []).append(r)
    lists = "".join(f"<li>{html.escape(c)}: {sum(r['n'] for r in rs)}<ul>{''.join(f'<li>{html.escape(str(r['topic']))}: {r['n']}</li>' for r in rs)}</ul></li>" for c, rs in groups.items())
    return _page(title, f"<p>Total: {sum(r['n'] for r in rows)}</p><ul>{lists}</ul>")


def comparison_page(metrics: DataFrame, title: str) -> str:
    """An HTML page with a column for each model (column ``model``) and a row for each figure, and what the model whose ``wins_...`` figures are true wins; models are few."""
    rows = metrics.orderBy("model").limit(MOST_BARS).collect()
    head = "".join(f"<th>{html.escape(str(r['model']))}</th>" for r in rows)
    body = "".join(f"<tr><td>{html.escape(c)}</td>" + "".join(f"<td>{r[c]}</td>" for r in rows) + "</tr>" for c in metrics.columns if c != "model" and not c.startswith("wins_"))
    won = "".join(f"<li>{html.escape(c[5:])}: {html.escape(', '.join(str(r['model']) for r in rows if r[c]))}</li>" for c in metrics.columns if c.startswith("wins_"))
    return _page(title, f"<table><tr><th></th>{head}</tr>{body}</table><ul>{won}</ul>")
