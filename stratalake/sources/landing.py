"""Landed API documents: pages, records, counts, cursors.

A document is the text of one landed file: a single page, or a JSON array of
pages; a page is an object or, for offset paging, an array of records. The
JSON is parsed once into VARIANT and taken apart by generators, because the
plain JSON reader turns an array of arrays into one row of NULLs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The collection fields looked for in a page, in this order.
COUNT_FIELDS = ("data", "results", "records", "items")
# The envelope fields that hold a page's records, in this order.
ENVELOPE_FIELDS = ("records", "value")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed file: file, file_size, payload."""
    return (
        spark.read.option("recursiveFileLookup", True)
        .text(path, wholetext=True)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_size").alias("file_size"),
            F.col("value").alias("payload"),
        )
    )


def kind_of(value: Column) -> Column:
    """``object``, ``array`` or ``scalar``; NULL for unparsable text."""
    schema = F.schema_of_variant(value)
    return (
        F.when(value.isNull(), F.lit(None).cast("string"))
        .when(schema.startswith("OBJECT"), F.lit("object"))
        .when(schema.startswith("ARRAY"), F.lit("array"))
        .otherwise(F.lit("scalar"))
    )


def items_of(value: Column) -> Column:
    """The elements of a JSON array as an array of variants; NULL for anything else."""
    return value.try_cast("array<variant>")


def field_of(value: Column, name: str) -> Column:
    """A top-level field of a JSON object; NULL when absent or not an object."""
    return F.try_variant_get(value, f"$['{name}']", "variant")


def text_of(value: Column, name: str) -> Column:
    return F.try_variant_get(value, f"$['{name}']", "string")


def is_present(value: Column) -> Column:
    """Neither absent nor JSON null."""
    return F.coalesce(value.isNotNull() & ~F.is_variant_null(value), F.lit(False))


def explode_pages(
    documents: DataFrame,
    payload: str = "payload",
    keep: Sequence[str] = ("file",),
    pagination: str | None = None,
) -> DataFrame:
    """One row per page: the kept columns, ``page_no`` (from 1), ``page`` (VARIANT).

    A single page is landed as it came, several as an array of pages. So an
    array of objects is ambiguous: pages, or one page that is a record list.
    The ``pagination`` column settles it: NONE never has several pages, OFFSET
    pages are arrays themselves, and CURSOR pages are objects. Without it the
    elements count as pages. Unparsable text gives one page that is NULL.
    """
    settings = [pagination] if pagination and pagination not in keep else []
    parsed = documents.select(*keep, *settings, F.try_parse_json(F.col(payload)).alias("_doc"))
    elements = items_of(F.col("_doc"))
    several = F.size(elements) > 0
    if pagination:
        kind = F.upper(F.coalesce(F.col(pagination), F.lit("NONE")))
        lists = items_of(F.try_element_at(elements, F.lit(1))).isNotNull()
        several = several & ((kind == "CURSOR") | ((kind == "OFFSET") & lists))
    # An empty array is one page without records, not no page at all.
    pages = F.when(F.coalesce(several, F.lit(False)), elements).otherwise(F.array(F.col("_doc")))
    return parsed.select(*keep, F.posexplode(pages).alias("_pos", "page")).select(
        *keep, (F.col("_pos") + 1).cast("int").alias("page_no"), "page"
    )


def record_count(page: Column, fields: Sequence[str] = COUNT_FIELDS) -> Column:
    """Records in a page: an array's length; the length of the first listed field
    that is an array; otherwise 1. A page that could not be parsed has none."""
    sizes = [F.size(items_of(field_of(page, f))) for f in fields]
    # size() of a NULL array is NULL under ANSI and -1 without it.
    known = [F.when(s >= 0, s) for s in [F.size(items_of(page)), *sizes]]
    return F.when(page.isNull(), F.lit(0)).otherwise(F.coalesce(*known, F.lit(1)))


def landing_metrics(
    pages: DataFrame,
    run: Sequence[str] = ("file",),
    fields: Sequence[str] = COUNT_FIELDS,
    size: str | None = None,
) -> DataFrame:
    """Per run: records_read, pages_read, broken_pages (not parsable) and, when given, the landed size in bytes."""
    sized = [F.max(size).alias("landing_file_size_bytes")] if size else []
    return pages.withColumn("_n", record_count(F.col("page"), fields)).groupBy(*run).agg(
        F.sum("_n").cast("bigint").alias("records_read"),
        F.count(F.lit(1)).alias("pages_read"),
        F.count_if(F.col("page").isNull()).alias("broken_pages"),
        *sized,
    )


def last_cursor(pages: DataFrame, cursor_field: str = "next_cursor", run: Sequence[str] = ("file",)) -> DataFrame:
    """Per run: the last cursor that is neither NULL nor empty, as text; NULL if none."""
    cursor = text_of(F.col("page"), cursor_field)
    usable = F.when(cursor != "", cursor)
    return (
        pages.select(*run, "page_no", usable.alias("_cursor"))
        .groupBy(*run)
        .agg(F.max_by("_cursor", F.when(F.col("_cursor").isNotNull(), F.col("page_no"))).alias("state_value"))
    )


def incomplete_pulls(
    pages: DataFrame,
    run: Sequence[str] = ("file",),
    pagination: str = "pagination_type",
    page_size: str = "page_size",
    cursor_field: str = "cursor_field",
) -> DataFrame:
    """Runs whose last page still promised another one, or whose settings or pages can't tell.

    ``pages`` carries the paging settings as columns. OFFSET promises more when
    its last page is full, CURSOR when it has a cursor, NONE never does. An
    unknown type, OFFSET without a positive page size, and a last page that
    can't be parsed are listed as well: nothing shows that such a pull is whole.
    """
    kind = F.upper(F.coalesce(F.col(pagination), F.lit("NONE")))
    length = F.size(items_of(F.col("page")))
    # The cursor's field name is a setting, so it is looked up by a path built
    # per row, through the object's map form.
    fields = F.col("page").try_cast("map<string,variant>")
    cursor = fields[F.coalesce(F.col(cursor_field), F.lit("next_cursor"))].try_cast("string")
    more = (
        F.when(F.col("page").isNull() | ~kind.isin("NONE", "OFFSET", "CURSOR"), F.lit(True))
        .when(kind == "OFFSET", F.coalesce(F.col(page_size) < 1, F.lit(True)) | (length == F.col(page_size)))
        .when(kind == "CURSOR", F.coalesce(cursor, F.lit("")) != "")
        .otherwise(F.lit(False))
    )
    return (
        pages.select(*run, "page_no", kind.alias("pagination_type"), F.coalesce(more, F.lit(False)).alias("_more"))
        .groupBy(*run)
        .agg(
            F.max("page_no").alias("pages_read"),
            F.max_by("pagination_type", "page_no").alias("pagination_type"),
            F.max_by("_more", "page_no").alias("_more"),
        )
        .filter("_more")
        .drop("_more")
    )


def extract_envelope(documents: DataFrame, payload: str = "payload", keep: Sequence[str] = ("file",)) -> DataFrame:
    """One row per record of a payload: the kept columns and ``record`` (VARIANT).

    An object gives the elements of its ``records`` list, else of its ``value``
    list, else itself. A list gives its elements. Elements that are not objects
    are dropped. A ``records`` or ``value`` that is not a list, or a payload
    that is neither object nor list, raises.
    """
    doc = F.col("_doc")
    named = [field_of(doc, f) for f in ENVELOPE_FIELDS]
    records = F.lit(None).cast("array<variant>")
    problem = F.lit(None).cast("string")
    for name, value in reversed(list(zip(ENVELOPE_FIELDS, named))):
        records = F.when(is_present(value), items_of(value)).otherwise(records)
        problem = F.when(
            is_present(value) & items_of(value).isNull(), F.lit(f"field '{name}' must be a list")
        ).otherwise(F.when(is_present(value), F.lit(None)).otherwise(problem))
    shape = kind_of(doc)
    problem = F.when(
        shape.isNull() | (shape == "scalar"), F.lit("payload must be an object or a list")
    ).when(shape == "object", problem)
    found = (
        F.when(problem.isNotNull(), F.raise_error(problem).cast("array<variant>"))
        .when(shape == "array", items_of(doc))
        .otherwise(F.coalesce(records, F.array(doc)))
    )
    return (
        documents.select(*keep, F.parse_json(F.col(payload)).alias("_doc"))
        .select(*keep, F.explode(found).alias("record"))
        .filter(kind_of(F.col("record")) == "object")
    )


def record_values(documents: DataFrame, payload: str = "payload", keep: Sequence[str] = ("file",)) -> DataFrame:
    """One row per record or page object: the kept columns, page_no, record_no,
    ``record`` (VARIANT) and ``raw``, the text of a document that does not parse.

    Arrays are opened twice, which covers plain objects, lists of records,
    lists of pages and lists of lists. The document's text does not travel with
    its records; only an unparsable one, which is a single row, keeps it.
    """
    parsed = documents.select(
        *keep, F.try_parse_json(F.col(payload)).alias("_doc"), F.col(payload).alias("_text")
    ).select(*keep, "_doc", F.when(F.col("_doc").isNull(), F.col("_text")).alias("raw"))

    def opened(value: Column) -> Column:
        # An empty array has no records and gives no row.
        return F.coalesce(items_of(value), F.array(value))

    pages = parsed.select(*keep, "raw", F.posexplode(opened(F.col("_doc"))).alias("_page", "_value"))
    records = pages.select(*keep, "raw", "_page", F.posexplode(opened(F.col("_value"))).alias("_record", "record"))
    return records.select(
        *keep,
        (F.col("_page") + 1).cast("int").alias("page_no"),
        (F.col("_record") + 1).cast("int").alias("record_no"),
        "record",
        "raw",
    )


def split_records(documents: DataFrame, payload: str = "payload", keep: Sequence[str] = ("file",)) -> DataFrame:
    """The same with ``record`` as JSON text.

    Written out, this is the compaction of landed documents to JSON lines,
    which later readers can split.
    """
    values = record_values(documents, payload, keep)
    return values.withColumn("record", F.coalesce("raw", F.to_json("record"))).drop("raw")
