"""Sources: fixed-width and CSV registries, captured pages, documents, brand files.

Every reader is Spark's own, so any store Spark reads works and files are read in
parallel. Missing values are empty strings.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.names import blank, header_name
from ..operators.derive import OFFICER_TITLES, code_label

# Fields of the fixed-width record as (0-based start, length).
CORDATA = {
    "entity_number": (0, 12), "name": (12, 192), "status_code": (204, 1), "filing_type": (205, 15),
    "principal_addr_1": (220, 42), "principal_addr_2": (262, 42), "principal_city": (304, 28), "principal_state": (332, 2), "principal_zip": (334, 10), "principal_country": (344, 2),
    "mail_addr_1": (346, 42), "mail_addr_2": (388, 42), "mail_city": (430, 28), "mail_state": (458, 2), "mail_zip": (460, 10), "mail_country": (470, 2),
    "file_date": (472, 8), "fei_number": (480, 14), "more_officers": (494, 1), "last_transaction_date": (495, 8),
    "agent_name": (544, 42), "agent_code": (586, 1), "agent_addr": (587, 42), "agent_city": (629, 28), "agent_state": (657, 2), "agent_zip": (659, 9),
}
OFFICER = {"title_code": (0, 4), "type_code": (4, 1), "name": (5, 42), "addr": (47, 42), "city": (89, 28), "state": (117, 2), "zip": (119, 9)}
OFFICERS_AT, OFFICER_WIDTH, OFFICER_SLOTS, LEAST_WIDTH = 668, 128, 6, 1300
PDF_MAGIC = "%PDF"


def cordata(lines: DataFrame, value: str = "value") -> DataFrame:
    """Fixed-width records: trimmed fields, status, officers (blank names dropped). Short lines go; other columns stay."""
    at = lambda start, n: F.trim(F.substring(F.col(value), start + 1, n))

    # The officers' block is cut once, blank names go before anything is built.
    block = F.substring(F.col(value), OFFICERS_AT + 1, OFFICER_WIDTH * OFFICER_SLOTS)
    slots = F.array(*(F.substring("officers_", k * OFFICER_WIDTH + 1, OFFICER_WIDTH) for k in range(OFFICER_SLOTS)))

    def officer(slot: Column) -> Column:
        f = {n: F.trim(F.substring(slot, s + 1, w)) for n, (s, w) in OFFICER.items()}
        kind = F.when(f["type_code"] == "P", "Person").when(f["type_code"] == "C", "Corporation").otherwise(f["type_code"])
        return F.struct(f["title_code"].alias("title_code"), code_label(f["title_code"], OFFICER_TITLES).alias("title"), kind.alias("type"), *(f[n].alias(n) for n in ("name", "addr", "city", "state", "zip")))

    start, width = OFFICER["name"]
    officers = F.transform(F.filter(slots, lambda s: F.trim(F.substring(s, start + 1, width)) != ""), officer)
    fields = {n: at(s, w) for n, (s, w) in CORDATA.items()}
    rest = [c for c in lines.columns if c != value]
    out = lines.filter(F.length(value) >= LEAST_WIDTH).withColumn("officers_", block).select(*rest, *(c.alias(n) for n, c in fields.items()), officers.alias("officers"))
    return out.withColumn("status", F.when(F.col("status_code") == "A", "Active").otherwise("Inactive")).withColumn("more_than_six_officers", F.col("more_officers") == "Y").drop("status_code", "more_officers")


def read_cordata(spark: SparkSession, path: str) -> DataFrame:
    """Fixed-width shards (Latin-1 text files), unzipped beforehand since zip cannot be split."""
    return cordata(spark.read.option("encoding", "ISO-8859-1").text(path))


def zip_shards(spark: SparkSession, path: str) -> DataFrame:
    """path, member: the text members of zip files, by name; one task a file, of the listing only."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches):
        import io
        import zipfile

        import pandas as pd

        for batch in batches:
            rows = [(p, m) for p, c in zip(batch["path"], batch["content"]) for m in sorted(zipfile.ZipFile(io.BytesIO(c)).namelist()) if m.lower().endswith(".txt")]
            yield pd.DataFrame(rows, columns=["path", "member"])

    return files.mapInPandas(run, "path string, member string")


def read_zip_lines(spark: SparkSession, path: str, encoding: str = "latin-1", rows: int = 20_000) -> DataFrame:
    """path, member, line_no, value: lines of the text members of zip files.

    Each member is a task of its own, which opens the file through Spark's reader and inflates its member
    as a stream; only ``rows`` lines are held at a time. Compression methods beyond the standard ones need
    the files unpacked first.
    """
    members = zip_shards(spark, path)
    content = spark.read.format("binaryFile").load(path).select("path", "content")
    many = max(members.count(), 1)

    def run(batches):
        import io
        import zipfile

        import pandas as pd

        for batch in batches:
            for p, m, c in zip(batch["path"], batch["member"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(c)).open(m) as f:
                    held: list[str] = []
                    at = 0
                    for line in io.TextIOWrapper(f, encoding=encoding, newline="\n"):
                        held.append(line.rstrip("\r\n"))
                        if len(held) == rows:
                            yield pd.DataFrame({"path": p, "member": m, "line_no": range(at, at + rows), "value": held})
                            at, held = at + rows, []
                    if held:
                        yield pd.DataFrame({"path": p, "member": m, "line_no": range(at, at + len(held)), "value": held})

    return members.join(content, "path").repartition(min(many, 10_000), "path", "member").select("path", "member", "content").mapInPandas(run, "path string, member string, line_no long, value string")


def read_registry_csv(spark: SparkSession, path: str, required: str | None = None, header_names: bool = True) -> DataFrame:
    """A CSV as strings with blank missing values; headers as lower-case names; a missing required column is an error."""
    df = spark.read.csv(path, header=True, multiLine=False, inferSchema=False, encoding="UTF-8")
    names = [c.lstrip("﻿") for c in df.columns]
    df = df.toDF(*(map(header_name, names) if header_names else names))
    if required and required not in df.columns:
        raise ValueError(f"{path}: no column {required}")
    return df.select(*(blank(F.col(c)).alias(c) for c in df.columns))


def read_raw_records(spark: SparkSession, path: str) -> DataFrame:
    """All raw brand files with ``file`` and ``ord``: rows numbered by file name, then place; ranks within a file plus a prefix sum over files."""
    df = spark.read.csv(path, header=True, inferSchema=False).select("*", F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"), F.col("_metadata.file_block_start").alias("block_"), F.monotonically_increasing_id().alias("at_"))
    body = [c for c in df.columns if c not in ("file", "block_", "at_")]
    ranked = df.withColumn("rank_", F.row_number().over(Window.partitionBy("file").orderBy("block_", "at_")))
    files = df.groupBy("file").agg(F.count("*").alias("n_"))
    before = files.select("file", F.coalesce(F.sum("n_").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before_"))
    return ranked.join(before, "file").select(*(blank(F.col(c)).alias(c) for c in body), "file", (F.col("before_") + F.col("rank_") - 1).alias("ord"))


def read_if_there(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A headed CSV, or no rows if the path does not exist."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], schema)
    return spark.read.csv(path, header=True, schema=schema)


def read_json_cache(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON file of one value or list; what does not parse gives no rows."""
    return spark.read.json(path, schema=schema, multiLine=True, mode="DROPMALFORMED")


def brand_file(raw: DataFrame, aliases: list[str]) -> DataFrame:
    """Rows of the first file, by name, whose first row's brand is one of the aliases; copies of originals are skipped."""
    firsts = raw.filter(~F.col("file").contains(".original")).groupBy("file").agg(F.min_by("brand", "ord").alias("brand_"))
    first = firsts.filter(F.lower(F.trim("brand_")).isin(*[a.lower() for a in aliases])).agg(F.min("file").alias("file"))
    return raw.join(F.broadcast(first), "file")  # one row


def read_captured(spark: SparkSession, path: str) -> DataFrame:
    """entity_number (from the file name), text of captured pages, one file each."""
    return spark.read.text(path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.[^.]*)?$", 1).alias("entity_number"), F.col("value").alias("text"))


def read_items(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Landed search results, one JSON item a line; broken lines give no row."""
    return spark.read.json(path, schema=schema, mode="DROPMALFORMED")


def settings(lines: DataFrame, value: str = "value") -> DataFrame:
    """key, value of ``K=V`` lines; comments and other lines go, quotes around values too."""
    p = r"^\s*([A-Za-z_][A-Za-z0-9_]*)\s*=\s*(.*?)\s*$"
    good = lines.filter(F.col(value).rlike(p))
    return good.select(F.regexp_extract(value, p, 1).alias("key"), F.regexp_replace(F.regexp_extract(value, p, 2), "^[\"']|[\"']$", "").alias("value"))


def stale(files: DataFrame, days: int, today: str) -> DataFrame:
    """Files (path, modificationTime) older than some days; the day is a parameter."""
    return files.filter(F.datediff(F.lit(today).cast("date"), F.to_date("modificationTime")) > days)


def pages_in_range(pages: DataFrame, ranges: DataFrame) -> DataFrame:
    """Pages within the configured inclusive range of their file, clamped to the pages there are."""
    r = ranges.select(F.col("file_name").alias("doc_id"), "start_page", "end_page", "brand")
    return pages.join(r, "doc_id").filter(F.col("page_no").between(F.greatest(F.lit(1), F.col("start_page")), F.col("end_page"))).drop("start_page", "end_page")


def pdf_pages(spark: SparkSession, path: str, extract: Callable[[bytes], list[str]]) -> DataFrame:
    """doc_id, page_no (from 1), text of PDF files by the given extractor; files without the magic bytes or that fail give no pages."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(path).filter(F.substring("content", 1, 4) == F.lit(PDF_MAGIC).cast("binary")).select("path", "content")

    def run(batches):
        import pandas as pd

        for batch in batches:
            rows = []
            for name, content in zip(batch["path"], batch["content"]):
                try:
                    rows += [(name.rsplit("/", 1)[-1], n, t or "") for n, t in enumerate(extract(content), 1)]
                except Exception as problem:  # a broken file is reported, not fatal
                    print(f"{name}: {problem}")
            yield pd.DataFrame(rows, columns=["doc_id", "page_no", "text"])

    return files.mapInPandas(run, "doc_id string, page_no int, text string")


def html_rows(pages: DataFrame, html: str = "html", least: int = 3) -> DataFrame:
    """Other columns, row_no, cells, href of table rows with enough cells."""
    rows = F.regexp_extract_all(blank(F.col(html)), F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))
    rest = [c for c in pages.columns if c != html]
    out = pages.select(*rest, F.posexplode(rows).alias("row_no", "row"))
    cells = F.transform(F.regexp_extract_all("row", F.lit(r"(?is)<td\b[^>]*>(.*?)</td>"), F.lit(1)), lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, r"<[^>]+>", " "), r"\s+", " ")))
    return out.withColumn("cells", cells).withColumn("href", F.regexp_extract("row", r"""(?i)href\s*=\s*["']([^"']*)["']""", 1)).filter(F.size("cells") >= least).drop("row")


def taxpayer_rows(rows: DataFrame) -> DataFrame:
    """name, taxpayer_number (11 digits at the end of the link, else the second cell), zip."""
    linked = F.regexp_extract("href", r"/(\d{11})$", 1)
    return rows.withColumns({"name": F.col("cells")[0], "taxpayer_number": F.when(linked != "", linked).otherwise(F.col("cells")[1]), "zip": F.col("cells")[2]}).filter("name <> '' and taxpayer_number <> ''").drop("cells")
