"""Readers for landed data (A1–A5).

Landed JSON files are whole documents (a bare array, or an object holding the array), so each
file is read as one text value and parsed with ``from_json`` against an explicit schema —
no inference, position kept with ``posexplode``, unreadable files turned into error rows
instead of failing the run. Like Spark's own multi-line JSON reader, a single file is not
split across tasks; files are spread over tasks. Landed data with large files has a document per line
instead (``read_json_lines``) and is split by Spark's text reader.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.core import truthy
from ..functions.text import strip_html
from ..operators.keys import default_tasks
from ..session import store
from .literals import empty_frame, literal_frame


def _path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def path_below(spark: SparkSession, root: str, file_path: str = "file_path") -> Column:
    """The path of a file below ``root``, free of scheme, host and the place of the root itself."""
    p = spark._jvm.org.apache.hadoop.fs.Path(root)
    depth = p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).depth()
    parts = F.split(F.regexp_replace(F.col(file_path), "^[^/]*//[^/]*", ""), "/")
    return F.url_decode(F.replace(F.array_join(F.slice(parts, depth + 2, F.greatest(F.size(parts), F.lit(1))), "/"), F.lit("+"), F.lit("%2B")))


def read_documents(spark: SparkSession, path: str, glob: str = "*.json", recursive: bool = False) -> DataFrame:
    """Every matching file as one row ``(file_name, file_path, value)``."""
    return (spark.read.option("wholetext", True).option("pathGlobFilter", glob)
                 .option("recursiveFileLookup", recursive).text(path)
                 .select(F.col("_metadata.file_name").alias("file_name"),
                         F.col("_metadata.file_path").alias("file_path"), F.col("value")))


def read_wrapped_json(spark: SparkSession, path: str, wrapper: str, schema: T.StructType,
                      glob: str = "*.json", recursive: bool = False) -> tuple[DataFrame, DataFrame]:
    """A1: files holding a bare array of records or ``{wrapper: [records]}``. Returns
    ``(rows, errors)``: rows carry ``file_name`` and 1-based ``pos``; a wrapper object without
    the array yields no rows. A file that does not parse, a wrapper that holds no array and an array
    element that is no JSON object each yield one error row (``pos`` NULL for whole files); the other
    elements of such an array are read, and keep their positions."""
    rows, errors = _parsed_documents(read_documents(spark, path, glob, recursive), wrapper, schema, ["file_name", "file_path"])
    return rows, errors.select("file_name", "pos", "reason")


def _parsed_documents(docs: DataFrame, wrapper: str, schema: T.StructType, place: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows (``place``, 1-based ``pos``, the record) and errors (``place``, ``pos``, ``reason``, ``raw`` text) of documents
    in ``value``."""
    v = F.col("value")
    is_array = F.ltrim(v).startswith("[")
    # elements stay JSON text first, so that one bad element does not void the array
    texts = T.ArrayType(T.StringType())
    inner = F.get_json_object(v, f"$['{wrapper}']")
    as_array = F.from_json(v, texts)
    as_wrapped = F.when(F.json_array_length(inner).isNotNull(), F.from_json(inner, texts))
    # from_json is permissive (a broken document can come back as a struct of NULLs), so
    # validity is decided by a JSON scan of the document itself
    valid = F.when(is_array, F.json_array_length(v).isNotNull()).otherwise(F.json_object_keys(v).isNotNull())
    parsed = docs.select(*place, is_array.alias("_is_array"),
                         F.when(is_array, as_array).otherwise(as_wrapped).alias("_arr"),
                         (~is_array & inner.isNotNull()).alias("_wrapped"), F.coalesce(valid, F.lit(False)).alias("_ok"), v.alias("raw"))
    elements = (parsed.filter("_ok").select(*place, F.posexplode(F.col("_arr")).alias("_p", "_e"))
                      .select(*place, (F.col("_p") + 1).alias("pos"), "_e",
                              F.coalesce(F.json_object_keys("_e").isNotNull(), F.lit(False)).alias("_object")))
    rows = (elements.filter("_object").withColumn("_r", F.from_json("_e", schema))
                    .select(*place, "pos", "_r.*"))
    files = parsed.select(*place, F.lit(None).cast("int").alias("pos"),
                          F.when(~F.col("_ok"), "unreadable JSON")
                           .when(F.col("_wrapped") & F.col("_arr").isNull(), f"{wrapper} is no array").alias("reason"), "raw")
    errors = files.filter(F.col("reason").isNotNull()).unionByName(
        elements.filter(~F.col("_object")).select(*place, "pos", F.lit("record is no JSON object").alias("reason"), F.col("_e").alias("raw")))
    return rows, errors


def read_lines(spark: SparkSession, path: str, glob: str = "*", recursive: bool = False) -> DataFrame:
    """``(file_name, file_path, line, value)``: every line of every matching file with its 1-based number.

    Files are split over tasks by Spark's text reader, however large. A line's number is its place in its block
    plus the lines of the blocks before: the lines are stored once with the block's start and a number that grows within
    it, the blocks (one row each) are counted and added up per file. The blocks are broadcast, so the lines do not move:
    they are no more than the splits that the driver has listed to plan the scan."""
    raw = (spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", recursive).text(path)
           .select(F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_path").alias("file_path"),
                   F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"), "value"))
    raw = store(raw, "lines")
    blocks = raw.groupBy("file_path", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy("file_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file_path", "_block", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return raw.join(F.broadcast(blocks), ["file_path", "_block"]).select(
        "file_name", "file_path", (F.col("_before") + F.col("_at") - F.col("_first") + 1).alias("line"), "value")


def read_json_lines(spark: SparkSession, path: str, wrapper: str, schema: T.StructType, glob: str = "*",
                    recursive: bool = False) -> tuple[DataFrame, DataFrame]:
    """A1, splittable: files with one document per line, each a record, a bare array of records or ``{wrapper: [records]}``.
    Returns ``(rows, errors)`` as ``read_wrapped_json`` does, both also with ``line``; ``pos`` counts within the line's
    document (1 for a line that is a record itself). Blank lines hold nothing. An object with ``wrapper`` is taken for a
    wrapper. A line that does not parse is one error row with its ``raw`` text, and the other lines are read."""
    docs = read_lines(spark, path, glob, recursive).filter(F.trim(F.col("value")) != "")
    single = ~F.ltrim("value").startswith("[") & F.json_object_keys("value").isNotNull() \
        & ~F.array_contains(F.json_object_keys("value"), wrapper)
    docs = docs.withColumn("value", F.when(F.coalesce(single, F.lit(False)), F.concat(F.lit("["), "value", F.lit("]"))).otherwise(F.col("value")))
    return _parsed_documents(docs, wrapper, schema, ["file_name", "file_path", "line"])


def read_entity_dir(spark: SparkSession, path: str, suffix: str, schema: T.StructType,
                    slug_from_dir: str | None = None) -> tuple[DataFrame, DataFrame]:
    """A2: one JSON object per entity file named ``<slug><suffix>``; only such files are
    read. With ``slug_from_dir='slug'`` the slug comes from a ``slug=<value>`` folder instead
    (the layout Spark's partitioned writer produces). Returns ``(rows with slug, error rows)``. Opening a file costs more
    than its text, so the texts are stored once and both frames read that table; it is written by at most as many tasks as
    there are shuffle partitions, since Spark's reader makes a task of every few small files."""
    docs = read_documents(spark, path, "*" + suffix, slug_from_dir is not None)
    docs = store(docs.coalesce(default_tasks(docs)), "entity-texts")
    parsed = docs.select("file_name", "file_path", F.from_json(F.col("value"), schema).alias("_r"),
                         F.coalesce(F.json_object_keys(F.col("value")).isNotNull(), F.lit(False)).alias("_obj"))
    if slug_from_dir:
        slug = F.regexp_extract(F.col("file_path"), f"/{slug_from_dir}=([^/]+)/[^/]+$", 1)
    else:
        slug = F.expr(f"substring(file_name, 1, length(file_name) - {len(suffix)})")
    ok = parsed.filter(F.col("_r").isNotNull() & F.col("_obj")).select(slug.alias("slug"), "_r.*")
    bad = parsed.filter(F.col("_r").isNull() | ~F.col("_obj")).select(
        slug.alias("slug"), "file_name", F.lit("unreadable JSON").alias("reason"))
    return ok, bad


def read_source_tree(spark: SparkSession, root: str, registry: list[tuple[str, str, str | None]],
                     wrapper: str, schema: T.StructType, glob: str = "*.json",
                     recursive: bool = False, lines: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A3: read each registered source folder ``(key, folder, dataSource)`` in the declared
    order; rows get ``sourceFolder``, ``dataSource`` (registry value, else the folder name),
    ``source_rank`` and ``file_below`` (the file's path below the source folder). A missing folder is reported in the log frame, not fatal. The
    third frame has the files and records that could not be read: source, file_name, pos, reason. ``lines``:
    the files hold a document per line (``read_json_lines``; rows and errors then also have ``line``)."""
    parts, log, failed = [], [], []
    line = ["line"] if lines else []
    for rank, (key, folder, data_source) in enumerate(registry):
        p = f"{root.rstrip('/')}/{folder}"
        if not _path_exists(spark, p):
            log.append((key, folder, "missing folder"))
            continue
        reader = read_json_lines if lines else read_wrapped_json
        rows, errors = reader(spark, p, wrapper, schema, glob, recursive)
        parts.append(rows.withColumn("sourceFolder", F.lit(folder))
                         .withColumn("dataSource", F.lit(data_source or folder))
                         .withColumn("source_rank", F.lit(rank))
                         .withColumn("file_below", path_below(spark, p)))
        failed.append(errors.select(F.lit(key).alias("source"), "file_name", *line, "pos", "reason"))
        log.append((key, folder, None))
    empty = empty_frame(spark, schema).withColumn("file_name", F.lit(None).cast("string")) \
        .withColumn("file_path", F.lit(None).cast("string")) \
        .withColumn("pos", F.lit(None).cast("int")).withColumn("sourceFolder", F.lit(None).cast("string")) \
        .withColumn("dataSource", F.lit(None).cast("string")).withColumn("source_rank", F.lit(None).cast("int")) \
        .withColumn("file_below", F.lit(None).cast("string"))
    if lines:
        empty = empty.withColumn("line", F.lit(None).cast("long"))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts, empty)
    log_df = literal_frame(spark, log, "source string, folder string, problem string")
    errors = reduce(lambda a, b: a.unionByName(b), failed, literal_frame(
        spark, [], f"source string, file_name string, {'line long, ' if lines else ''}pos int, reason string"))
    return rows, log_df, errors


# Defaults of the flat feed normaliser.
UNTITLED_JOB = "Untitled Job"


FLAT_COLUMNS = ["id", "title", "desc", "date", "location", "url", "company"]


def read_flat_jobs(df: DataFrame) -> DataFrame:
    """A4: normalise the flat 7-column job table (id, title, desc, date, location, url,
    company): title defaults to 'Untitled Job', empty strings become NULL, location trimmed,
    date text parsed (unparsable → NULL). Other columns pass through unchanged."""
    def nz(c):
        return F.when(truthy(F.col(c)), F.col(c))
    extra = [c for c in df.columns if c not in FLAT_COLUMNS]
    return df.select(*extra,
        F.col("id").cast("string").alias("id"),
        F.when(truthy(F.col("title")), F.col("title")).otherwise(F.lit(UNTITLED_JOB)).alias("title"),
        nz("desc").alias("desc"),
        F.when(truthy(F.col("location")), F.trim(F.col("location"))).alias("location"),
        nz("url").alias("url"),
        nz("company").alias("company"),
        F.try_to_timestamp(F.col("date").cast("string")).alias("date"),
    )


# Per-vendor field paths of landed career-site responses, the company value
# (a constant or a field) and the public job URL template ({} = posting id).
VENDORS = {
    "amazon": {
        "records": "jobs", "id": "id_icims", "title": "title", "date": "posted_date",
        "desc": "description_short", "location": "location", "company_field": "company_name",
        "url": "https://www.amazon.jobs/en/jobs/{}",
    },
    "microsoft": {
        "records": "operationResult.result.jobs", "id": "jobId", "title": "title", "date": "postingDate",
        "desc": "properties.description", "location": "properties.primaryLocation", "company": "microsoft",
        "url": "https://jobs.careers.microsoft.com/global/en/job/{}",
    },
    "netflix": {
        "records": "records.postings", "id": "external_id", "title": "text", "date": "created_at",
        "desc": "description", "location": "location", "company": "netflix",
        "url": "https://jobs.netflix.com/jobs/{}",
    },
}
GOOGLE_URL = "https://www.google.com/about/careers/applications/jobs/results/{}"


def conform_vendor_postings(raw: DataFrame, vendor: str, as_of=None) -> DataFrame:
    """A5: landed vendor responses (one parsed response per row) → the common record
    ``(id, title, desc, company, location, date, url)``; descriptions are stripped of tags.
    Google responses are positional arrays (``[0]`` id, ``[1]`` title, ``[3][1]`` description,
    ``[8]`` location) in a ``value`` column of JSON text and take ``as_of`` as their date."""
    if vendor == "google":
        arr = F.from_json(F.col("value"), T.ArrayType(T.StringType()))
        rows = raw.select(F.explode(arr).alias("_j"))
        j = F.from_json(F.col("_j"), T.ArrayType(T.StringType()))
        inner = F.from_json(F.try_element_at(j, F.lit(4)), T.ArrayType(T.StringType()))
        pid = F.try_element_at(j, F.lit(1))
        return rows.select(
            pid.alias("id"), F.try_element_at(j, F.lit(2)).alias("title"),
            strip_html(F.try_element_at(inner, F.lit(2))).alias("desc"),
            F.lit("Google").alias("company"), F.try_element_at(j, F.lit(9)).alias("location"),
            F.lit(str(as_of) if as_of is not None else None).cast("string").alias("date"),
            F.format_string(GOOGLE_URL.replace("{}", "%s"), pid).alias("url"))
    spec = VENDORS[vendor]
    rows = raw.select(F.explode(F.col(spec["records"])).alias("j"))
    pid = F.col(f"j.{spec['id']}").cast("string")
    company = F.col(f"j.{spec['company_field']}") if "company_field" in spec else F.lit(spec["company"])
    return rows.select(
        pid.alias("id"), F.col(f"j.{spec['title']}").alias("title"),
        strip_html(F.col(f"j.{spec['desc']}")).alias("desc"), company.alias("company"),
        F.col(f"j.{spec['location']}").cast("string").alias("location"),
        F.col(f"j.{spec['date']}").cast("string").alias("date"),
        F.format_string(spec["url"].replace("{}", "%s"), pid).alias("url"))
