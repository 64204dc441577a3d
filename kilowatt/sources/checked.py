"""Delimited files whose bad records are kept aside (S3, S5, X1).

A record that doesn't fit the declared schema (a value of another type, too few
or too many fields, a required value missing) is neither dropped nor turned
into NULLs that look like missing readings: it keeps its raw line and says
why. Accepted and rejected records are written by one pass, as two partitions
of one folder, in batch and in streams alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

RAW, REASON, REJECTED = "_raw_record", "_reject_reason", "_rejected"


def with_raw(schema: StructType) -> StructType:
    """``schema`` with a column for the raw line of a record that doesn't fit it."""
    return StructType([*schema.fields, StructField(RAW, StringType(), True)])


def reader_options(header: bool = True, timestamp_format: str | None = None, delimiter: str = ",") -> dict[str, str]:
    # all columns are parsed whatever is selected: a record is good or bad as a whole
    out = {"header": str(header).lower(), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW, "sep": delimiter, "columnPruning": "false"}
    if timestamp_format:
        out["timestampFormat"] = timestamp_format
    return out


def reject_reason(schema: StructType, required: Sequence[str] = (), delimiter: str = ",") -> Column:
    """Why a record is rejected, NULL for a good one: ``fields: 4 of 6`` where their
    number differs, else the first column whose text isn't of its type
    (``production_kwh: not a double``), else the first missing required value
    (``site_id: missing``)."""
    raw = F.from_csv(F.col(RAW), F.lit(", ".join(f"c{i} string" for i in range(len(schema) + 1))), {"sep": delimiter, "mode": "PERMISSIVE"})
    # fields are counted as the parser splits them: a column more than the schema shows a surplus
    texts = [raw.getField(f"c{i}") for i in range(len(schema))]
    given = F.size(F.split(F.col(RAW), delimiter, -1))
    quoted = F.col(RAW).contains('"')
    wrong_number = F.when(~quoted & (given != len(schema)), F.concat(F.lit("fields: "), given, F.lit(f" of {len(schema)}")))
    wrong_number = F.coalesce(wrong_number, F.when(raw.getField(f"c{len(schema)}").isNotNull(), F.lit(f"fields: more than {len(schema)}")))
    wrong_type = [F.when(t.isNotNull() & F.col(f"`{f.name}`").isNull(), F.lit(f"{f.name}: not a {f.dataType.simpleString()}"))
                  for f, t in zip(schema.fields, texts)]
    missing = [F.when(F.col(f"`{c}`").isNull(), F.lit(f"{c}: missing")) for c in required]
    broken = F.when(F.col(RAW).isNotNull(), F.coalesce(wrong_number, *wrong_type, F.lit("record: malformed")))
    return F.coalesce(broken, *missing)


def checked(records: DataFrame, schema: StructType, required: Sequence[str] = (), delimiter: str = ",") -> DataFrame:
    """Records read with :func:`with_raw` → the schema's columns with the raw line
    and reason of rejected ones and the flag ``_rejected``. A record rejected for
    a missing value has no raw line of its own (it fits the schema)."""
    out = records.withColumn(REASON, reject_reason(schema, required, delimiter))
    return out.withColumn(REJECTED, F.col(REASON).isNotNull())


def read_checked(spark: SparkSession, path: str, schema: StructType, required: Sequence[str] = (), glob: str | None = None,
                 header: bool = True, timestamp_format: str | None = None, delimiter: str = ",") -> DataFrame:
    """CSV files below ``path``, each record checked (see :func:`checked`). Spark
    reads no CSV for its raw lines alone, so ask for the flag or the reason
    together with other columns, or after :func:`write_checked`."""
    r = spark.read.schema(with_raw(schema)).options(**reader_options(header, timestamp_format, delimiter))
    if glob:
        r = r.option("pathGlobFilter", glob)
    return checked(r.csv(path), schema, required, delimiter)


def stream_checked(spark: SparkSession, path: str, schema: StructType, required: Sequence[str] = (), glob: str | None = "*.csv",
                   header: bool = True, timestamp_format: str | None = None, max_files_per_trigger: int | None = None, delimiter: str = ",") -> DataFrame:
    """The same of a stream of files."""
    r = spark.readStream.schema(with_raw(schema)).options(**reader_options(header, timestamp_format, delimiter))
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return checked(r.csv(path), schema, required, delimiter)


def write_checked(records: DataFrame, path: str, mode: str = "append") -> None:
    """Accepted and rejected records as two partitions of ``path``, in one pass."""
    records.write.mode(mode).partitionBy(REJECTED).parquet(path)


def accepted(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The good records written to ``path`` by batch or stream, further columns
    (audit columns, say) included; the others' files are not opened."""
    found = spark.read.schema(_stored_schema(spark, path, schema)).parquet(path)
    return found.filter(~F.col(REJECTED)).drop(REJECTED, RAW, REASON)


def rejected(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The records kept aside, with their raw lines and reasons."""
    return spark.read.schema(_stored_schema(spark, path, schema)).parquet(path).filter(F.col(REJECTED)).drop(REJECTED)


def _stored_schema(spark: SparkSession, path: str, schema: StructType) -> StructType:
    """Columns of the stored records; the flag is a boolean whatever folder names say."""
    found = spark.read.parquet(path).schema
    return StructType([StructField(f.name, schema[f.name].dataType if f.name in schema.names else f.dataType)
                       for f in found if f.name != REJECTED] + [StructField(REJECTED, BooleanType())])
