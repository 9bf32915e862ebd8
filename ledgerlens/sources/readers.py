"""Readers for the raw zone, always with a declared schema.

Multi-line JSON and CSV files cannot be split: one file is one task.  At
scale, land many files (the source system writes one file per work item) or
convert once to JSON Lines / Parquet; the readers take the same options for
both layouts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..functions.text import basename
from ..schemas import HIT_XML


def read_records(spark: SparkSession, path: str | list[str], schema: StructType, *,
                 multiline: bool = True, recursive: bool = True, glob: str | None = None,
                 corrupt_column: str | None = None) -> DataFrame:
    """JSON records (one object per line, or a JSON array per file).

    With ``corrupt_column`` a record that does not parse is kept, with its raw
    text in that column and the other fields null, instead of failing the job.
    """
    if corrupt_column and corrupt_column not in schema.fieldNames():
        schema = StructType(list(schema.fields) + [StructField(corrupt_column, StringType())])
    r = spark.read.schema(schema).option("multiLine", multiline)
    if recursive:
        r = r.option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if corrupt_column:
        r = r.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_column)
    return r.json(path)


def read_envelope(spark: SparkSession, path: str | list[str], record: StructType, *,
                  field: str = "value", recursive: bool = True, glob: str | None = None,
                  multiline: bool = True) -> DataFrame:
    """``{"value": [record, ...]}`` files -> one row per element of ``value``.

    Without ``multiline`` every line is an envelope of its own, and large files split.
    Trees of ``key=value`` directories: :func:`read_partitioned_json`.
    """
    schema = StructType([StructField(field, ArrayType(record))])
    r = spark.read.schema(schema).option("multiLine", multiline)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", True)
    return _records(r.json(path), record, field)


def _records(df: DataFrame, record: StructType, field: str) -> DataFrame:
    """One row per element of ``field``, beside the path keys (all other columns)."""
    keys = [c for c in df.columns if c != field]
    rec = {f.name.lower(): f for f in record.fields}
    clash = [k for k in keys if k.lower() in rec]
    x = df.select(*[F.col(k).alias("__path_" + k) if k in clash else F.col(k) for k in keys],
                  F.inline(F.col(field)))
    # A key present both in the directory name and in the record: the record
    # value wins, the path key (cast to the record's type) fills in.
    out = [F.col(k) for k in keys if k not in clash]
    for f in record.fields:
        hit = [k for k in clash if k.lower() == f.name.lower()]
        c = F.col(f.name)
        out.append(F.coalesce(c, F.col("__path_" + hit[0]).try_cast(f.dataType)).alias(f.name) if hit else c)
    return x.select(*out)


def envelope_rejects(spark: SparkSession, path: str | list[str], record: StructType, *, field: str = "value",
                     recursive: bool = True, glob: str | None = None, multiline: bool = True) -> DataFrame:
    """``(path, raw)`` of the envelope files (without ``multiline``: lines) that
    :func:`read_envelope` has no rows of because they do not parse (cut off, not JSON)."""
    schema = StructType([StructField(field, ArrayType(record)), StructField("_corrupt_record", StringType())])
    r = spark.read.option("wholetext", multiline)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", True)
    parsed = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    df = r.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("raw"),
                             parsed["_corrupt_record"].alias("corrupt"))
    return df.filter(F.col("corrupt").isNotNull()).select("path", "raw")


def path_keys(spark: SparkSession, path: str) -> list[str]:
    """The names of the ``key=value`` directories of a tree below ``path``, from
    one of its files."""
    one = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path").limit(1).collect())
    below = one[0].path.split(path.rstrip("/").rsplit("/", 1)[-1] + "/", 1)[-1] if one else ""
    return [part.split("=", 1)[0] for part in below.split("/")[:-1] if "=" in part]


def read_partitioned_json(spark: SparkSession, path: str, record: StructType, *,
                          keys: Sequence[str] | None = None, field: str = "value",
                          multiline: bool = True) -> DataFrame:
    """Envelope files under ``institution=/jahr=/betragstyp=`` directories.

    The path keys are read as text (``0010`` stays ``0010``) because they are
    declared so, for this read alone: no session setting is touched, reads may
    run side by side, and filters on them still prune directories.  Values that
    are also inside the records win, the path keys fill in where they are
    missing.  ``keys``: their names (default: those of the tree's first file).
    """
    keys = path_keys(spark, path) if keys is None else list(keys)
    schema = StructType([StructField(field, ArrayType(record)), *(StructField(k, StringType()) for k in keys)])
    df = spark.read.schema(schema).option("multiLine", multiline).json(path)
    return _records(df, record, field)


def read_partitioned_parquet(spark: SparkSession, path: str, *, keys: Sequence[str] | None = None) -> DataFrame:
    """Parquet under ``key=value`` directories; the path keys stay text (see
    :func:`read_partitioned_json`)."""
    keys = path_keys(spark, path) if keys is None else list(keys)
    data = spark.read.option("recursiveFileLookup", True).parquet(path).schema
    fields = [f for f in data.fields if f.name not in keys]
    return spark.read.schema(StructType([*fields, *(StructField(k, StringType()) for k in keys)])).parquet(path)


def read_survey_csv(spark: SparkSession, path: str | list[str], *, glob: str,
                    columns: list[str] | None = None) -> DataFrame:
    """Survey CSV: header, ``"`` quotes, ``,`` separator, quoted newlines.

    Only files whose names match ``glob`` are read. There is no default: the
    code list lands as a CSV of its own in the same folder, and must not be
    read as respondents.  Without ``columns`` the header decides the
    columns; every value is text.
    """
    r = (spark.read.option("header", True).option("multiLine", True)
         .option("quote", '"').option("escape", '"').option("sep", ",")
         .option("recursiveFileLookup", True).option("pathGlobFilter", glob))
    if columns is not None:
        r = r.schema(StructType([StructField(c, StringType()) for c in columns])) \
             .option("enforceSchema", False)
    return r.csv(path)


def read_business_xml(spark: SparkSession, path: str | list[str], *, row_tag: str = "Hit",
                      multiline: bool = True) -> DataFrame:
    """Search-result XML -> one row per ``<Hit>`` with the declared tree;
    repeated elements are arrays whether they occur once or many times.

    A file is one document (what follows its root is not read).  Without
    ``multiline`` each hit stands on a line of its own: such files split, and
    need no common root."""
    df = (spark.read.format("xml").option("rowTag", row_tag).schema(HIT_XML).option("multiLine", multiline)
          .option("recursiveFileLookup", True).load(path))
    return df.select(F.struct(*df.columns).alias("hit"))


def list_documents(spark: SparkSession, path: str, *, suffix: str = ".pdf") -> DataFrame:
    """Document manifest below ``path``: ``(path, dateiname, length)`` for files
    whose name ends with ``suffix`` in any case.  File contents are not read."""
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
          .select("path", "length"))
    return manifest(df, "path", suffix, url=False).select("path", "dateiname", "length")


def manifest(df: DataFrame, path_col: str, suffix: str, *, url: bool = True) -> DataFrame:
    """Rows whose path ends with ``suffix``, any case, with the last path segment
    as ``dateiname``. Of a URL the query and fragment are ignored; in a file key
    ``?`` and ``#`` are characters like others."""
    p = F.regexp_replace(F.col(path_col), r"[?#].*$", "") if url else F.col(path_col)
    name = basename(F.col(path_col)) if url else F.regexp_extract(p, r"([^/]*)$", 1)
    return df.filter(F.lower(p).endswith(suffix.lower())).withColumn("dateiname", name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table or view by name."""
    return spark.table(name)
