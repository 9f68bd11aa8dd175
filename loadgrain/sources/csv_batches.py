"""CSV batches whose names carry the terminal, the user or the date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadgrain.functions.columns import join_null_safe
from loadgrain.plans.small import pin_small

RAW = "_corrupt_record"


def read_batches(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    name_pattern: str,
    name_columns: list[str],
    timestamp_format: str | None = None,
    column_order: list[str] | None = None,
    options: dict[str, str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Read many CSV files and return ``(rows, rejected rows)``.

    Columns are taken by the header of each file, whatever their order. ``name_pattern`` is a
    regular expression searched in the file path; its groups become ``name_columns``. A row
    is rejected, not dropped, when a value does not fit its type, when it has too many or
    too few values, or when its file has no header or headers in different orders; the rejected rows keep
    their text and the reason. A header that is repeated within a file is not a row.

    Finding the headers reads the files once more. ``column_order`` spares that if all files have
    their columns in one order. ``options`` go to the CSV reader, such as ``sep`` or ``encoding``.
    """
    names = [f.name for f in schema.fields]
    separator = next((v for k, v in (options or {}).items() if k.lower() in ("sep", "delimiter")), ",")
    cells = [f"_c{i}" for i in range(len(names))]
    raw_schema = T.StructType([T.StructField(c, T.StringType()) for c in [*cells, RAW]])
    cell = lambda c: F.trim(F.regexp_replace(c, "^\ufeff", ""))
    raw = (
        spark.read.schema(raw_schema)
        .options(**(options or {}))
        .option("recursiveFileLookup", True)
        .option("columnNameOfCorruptRecord", RAW)
        .csv(path)
        .select(
            F.array(*cells).alias("_cells"),
            F.col(RAW),
            F.url_decode(F.col("_metadata.file_path")).alias("source_file"),
        )
    )
    # a header holds every column name once, in any order
    is_header = F.array_sort(F.transform("_cells", cell)) == F.array(*[F.lit(n) for n in sorted(names)])
    is_header = F.coalesce(is_header, F.lit(False))
    body = raw.filter(~is_header)
    if column_order:
        body = body.withColumn("_header", F.array(*[F.lit(n) for n in column_order])).withColumn("_mixed", F.lit(False))
    else:
        # the order of the columns, one row per file
        header = F.transform("_cells", cell)
        headers = raw.filter(is_header).groupBy("source_file")
        headers = headers.agg(F.min(header).alias("_header"), (F.min(header) != F.max(header)).alias("_mixed"))
        # broadcast if the files are few; otherwise a huge file is split as a skewed join
        body = join_null_safe(body, pin_small(headers, 100_000)[0], ["source_file"], "left")

    text = {n: F.try_element_at("_cells", F.array_position("_header", n).cast("int")) for n in names}
    typed = body.select(
        *[F.regexp_extract("source_file", name_pattern, i + 1).alias(c) for i, c in enumerate(name_columns)],
        "source_file",
        *[_parse(f, text[f.name], timestamp_format).alias(f.name) for f in schema.fields],
        # the reader keeps the text of a record that does not fit; the cells of others are all there is
        F.coalesce(RAW, F.concat_ws(separator, F.transform("_cells", lambda c: F.coalesce(c, F.lit(""))))).alias("raw"),
        F.when(F.col("_header").isNull(), "no header")
        .when(F.col("_mixed"), "several headers")
        .when(F.col(RAW).isNotNull(), "number of values")
        .when(
            F.array_contains(
                F.array(
                    *[
                        text[f.name].isNotNull() & _parse(f, text[f.name], timestamp_format).isNull()
                        for f in schema.fields
                    ]
                ),
                True,
            ),
            "value",
        )
        .when(F.lit(bool(name_columns)) & ~F.col("source_file").rlike(name_pattern), "file name")
        .alias("reason"),
    )
    rows = typed.filter(F.col("reason").isNull()).drop("raw", "reason")
    rejected = typed.filter(F.col("reason").isNotNull()).select("source_file", *name_columns, "raw", "reason")
    return rows, rejected


def _parse(field: T.StructField, text, timestamp_format: str | None):
    if timestamp_format and isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.try_to_timestamp(text, F.lit(timestamp_format)).cast(field.dataType)
    return F.trim(text).try_cast(field.dataType)
