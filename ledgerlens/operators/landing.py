"""Routing rejects in one pass: every landed record is parsed once and carries
its outcome, the write is partitioned by it, and the run's counters are observed
by that same write.

``status`` is ``good`` or ``rejected``.  A rejected row keeps its raw text and no
parsed value, a good one its parsed value and no raw text, so good + rejected
is what was read, and nothing is parsed again to find what went wrong.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..schemas import HIT_XML

GOOD, REJECTED = "good", "rejected"
CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class Counters:
    """Of one run: records read, and how they were routed."""
    read: int
    good: int
    rejected: int


def _with_corrupt(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(CORRUPT, StringType())])


def json_parser(schema: StructType) -> Callable[[Column], Column]:
    s = _with_corrupt(schema)
    return lambda c: F.from_json(c, s, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def xml_parser(schema: StructType) -> Callable[[Column], Column]:
    s = _with_corrupt(schema)
    return lambda c: F.from_xml(c, s, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def route(df: DataFrame, text: str, parser: Callable[[Column], Column], schema: StructType,
          keep: Sequence[str] = ()) -> DataFrame:
    """``(keep..., status, parsed, raw)``, a row for each row of ``df``.

    The parse stands inside a generator, so that a later filter is not pushed
    below it and parses again.  A null text, and one that parses to nothing, is
    rejected too.
    """
    parsed = df.select(*keep, F.col(text).alias("_text"), F.explode(F.array(parser(F.col(text)))).alias("_p"))
    bad = F.col("_p").isNull() | F.col(f"_p.{CORRUPT}").isNotNull()
    value = F.struct(*[F.col("_p")[f.name].alias(f.name) for f in schema.fields])
    return parsed.select(*keep, F.when(bad, REJECTED).otherwise(GOOD).alias("status"),
                         F.when(~bad, value).alias("parsed"), F.when(bad, F.col("_text")).alias("raw"))


def land(routed: DataFrame, path: str) -> Counters:
    """Write routed rows below ``path``, partitioned by status (a run replaces
    the run before); the counters come from the write."""
    seen = Observation()
    count = lambda s: F.count(F.when(F.col("status") == s, 1))
    observed = routed.observe(seen, F.count(F.lit(1)).alias("read"), count(GOOD).alias("good"), count(REJECTED).alias("rejected"))
    observed.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("status").parquet(path)
    got = seen.get
    return Counters(got["read"], got["good"], got["rejected"])


def _landed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(StructType([*schema.fields, StructField("status", StringType())])).parquet(path)


def good(spark: SparkSession, path: str, routed: StructType) -> DataFrame:
    """The parsed rows of a landing (``routed``: the schema that was landed)."""
    return _landed(spark, path, routed).filter(F.col("status") == GOOD).drop("status", "raw")


def rejects(spark: SparkSession, path: str, routed: StructType) -> DataFrame:
    """The rejected rows, with their raw text."""
    return _landed(spark, path, routed).filter(F.col("status") == REJECTED).drop("status", "parsed")


def land_envelopes(spark: SparkSession, source: str | list[str], record: StructType, path: str, *,
                   field: str = "value", glob: str | None = None, multiline: bool = True) -> tuple[Counters, StructType]:
    """Envelope files (without ``multiline``: lines) -> a landing of ``(path,
    status, parsed, raw)``; records are read with :func:`envelope_records`."""
    r = spark.read.option("wholetext", multiline).option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    envelope = StructType([StructField(field, ArrayType(record))])
    lines = r.text(source).select(F.col("_metadata.file_path").alias("path"), "value")
    routed = route(lines, "value", json_parser(envelope), envelope, keep=("path",))
    return land(routed, path), routed.schema


def envelope_records(spark: SparkSession, path: str, routed: StructType, field: str = "value") -> DataFrame:
    """The records of the good envelopes, one row each."""
    return good(spark, path, routed).select(F.inline(F.col("parsed")[field]))


def land_hits(hits: DataFrame, path: str, xml: str = "xml", keep: Sequence[str] = ()) -> tuple[Counters, StructType]:
    """Search hits (XML text) -> a landing; the good ones have the declared tree in ``parsed``."""
    routed = route(hits, xml, xml_parser(HIT_XML), HIT_XML, keep=keep)
    return land(routed, path), routed.schema
