"""CSV sources: parse, clean and type a header-row CSV file as a DataFrame.

Parsing (Spark's CSV reader, one pass):

* header row; ``"`` quotes with a doubled ``""`` as the escape, which reads
  both unquoted files and fully quoted ones; ``multiLine`` so a quoted line
  break stays inside its field (multi-line files are read one task per
  file, as they cannot be split);
* rows with more fields than the header are malformed: they are read into
  an extra ``_overflow`` column and dropped (and counted). Short rows are
  kept with NULLs in the missing fields. ``land`` keeps what is dropped: the raw
  record, its file and place, and the reason;
* UTF-8 by default. Spark does not fail on invalid UTF-8 but substitutes
  U+FFFD, a character a valid file may hold, too. So ``encoding="auto"`` looks
  at the bytes: the lines are read as raw text and tested with
  ``is_valid_utf8``; a file with a line that is not valid is read as latin-1.

Cleaning: column names get spaces and dashes turned into ``_`` and are
lower-cased; the null tokens below become NULL in every column.

Typing: every column is read as text, then one aggregate pass decides, per
column, whether all values are integers (BIGINT), numbers (DOUBLE) or
booleans, the way a dataframe library would infer them; an integer column
with missing values becomes DOUBLE, one with a value beyond 64 bits stays text
(no digit is lost), and a boolean column with missing values stays text. Only
plain decimal notation is a number (``12F`` and ``7D`` are text). Only one row of flags per file reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts read as a missing value.
NULL_TOKENS = ["", "NULL", "null", "NaN"]
# Texts read as booleans.
TRUE_TOKENS = ["True", "TRUE", "true"]
FALSE_TOKENS = ["False", "FALSE", "false"]

OVERFLOW = "_overflow"
RECORD = "_record"  # the raw text of a record, where asked for

# Reasons for which a record is rejected.
TOO_MANY_FIELDS = "too many fields"
BAD_VALUE = "not a value of the column's type"


@dataclass
class CsvRead:
    """A parsed file: ``raw`` as text with the overflow column, and ``shape``, which
    turns ``raw`` into the clean, typed table."""
    raw: DataFrame
    shape: Callable[[DataFrame], DataFrame]
    encoding: str

    @property
    def df(self) -> DataFrame:
        return self.shape(self.raw)

    @property
    def dropped_rows(self) -> DataFrame:
        """One row: the count of rows with too many fields."""
        return self.raw.agg(F.count_if(F.col(OVERFLOW).isNotNull()).alias("dropped_rows"))

    def observed(self, counts: Observation) -> DataFrame:
        """``df`` that, when written, also counts the rows read into ``counts``:
        ``source_rows`` (kept) and ``dropped_rows``."""
        over = F.col(OVERFLOW).isNotNull()
        return self.shape(self.raw.observe(counts, F.count_if(~over).alias("source_rows"),
                                           F.count_if(over).alias("dropped_rows")))


def clean_column_name(name: str) -> str:
    return name.replace(" ", "_").replace("-", "_").lower()


def _reader(spark: SparkSession, encoding: str, multi_line: bool = True):
    return (
        spark.read.option("header", True)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", encoding)
        .option("mode", "PERMISSIVE")
    )


def header(spark: SparkSession, path: str, encoding: str = "UTF-8", multi_line: bool = True) -> list[str]:
    """Column names from the header row (reads the first record only)."""
    return _reader(spark, encoding, multi_line).option("inferSchema", False).csv(path).columns


def _texts(names: list[str], extra: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in (
        *(f"_c{i}" for i in range(len(names))), extra)])


def _raw(spark: SparkSession, path: str, encoding: str,
         multi_line: bool = True) -> tuple[DataFrame, list[str]]:
    names = header(spark, path, encoding, multi_line)
    df = _reader(spark, encoding, multi_line).option("enforceSchema", True).schema(
        _texts(names, OVERFLOW)).csv(path)
    return df, names


def _recorded(spark: SparkSession, path: str, encoding: str,
              multi_line: bool = True) -> tuple[DataFrame, list[str]]:
    """Like ``_raw``, with the raw text of every record that has another number of fields
    than the header; the text of those few is cut again to find a field too many."""
    names = header(spark, path, encoding, multi_line)
    df = _reader(spark, encoding, multi_line).option("enforceSchema", True).option(
        "columnNameOfCorruptRecord", RECORD).schema(_texts(names, RECORD)).csv(path)
    again = F.from_csv(RECORD, _texts(names, OVERFLOW).simpleString()[len("struct<"):-1].replace(":", " "),
                       {"quote": '"', "escape": '"'})
    return df.select("*", F.when(F.col(RECORD).isNotNull(), again[OVERFLOW]).alias(OVERFLOW)), names


def null_tokens_to_null(col: Column, tokens: list[str] = NULL_TOKENS) -> Column:
    return F.when(col.isin(*tokens), F.lit(None).cast("string")).otherwise(col)


def _clean(names: list[str]) -> Callable[[DataFrame], DataFrame]:
    def shape(raw: DataFrame) -> DataFrame:
        return raw.where(F.col(OVERFLOW).isNull()).select(*[
            null_tokens_to_null(F.col(f"_c{i}")).alias(clean_column_name(n))
            for i, n in enumerate(names)])
    return shape


def is_utf8(spark: SparkSession, path: str) -> bool:
    """Whether all bytes of the file(s) are valid UTF-8 (lines are tested in parallel)."""
    return spark.read.text(path).where(~F.is_valid_utf8("value")).isEmpty()


_INT_RE = r"^[+-]?[0-9]+$"
_NUMBER_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def infer_types(df: DataFrame) -> dict[str, T.DataType]:
    """Per-column type from one aggregate over the text columns."""
    aggs = []
    for i, c in enumerate(df.columns):
        v = F.col(c)
        present = v.isNotNull()
        aggs += [
            F.max(present & ~v.rlike(_INT_RE)).alias(f"nonint_{i}"),
            F.max(present & v.rlike(_INT_RE) & v.try_cast("bigint").isNull()).alias(f"long_{i}"),
            F.max(present & ~v.rlike(_NUMBER_RE)).alias(f"nonnum_{i}"),
            F.max(present & ~v.isin(*TRUE_TOKENS, *FALSE_TOKENS)).alias(f"nonbool_{i}"),
            F.max(~present).alias(f"hasnull_{i}"),
            F.max(present).alias(f"any_{i}"),
        ]
    return _types_from(df, df.agg(*aggs).first().asDict())


def _types_from(df: DataFrame, row: dict) -> dict[str, T.DataType]:
    out: dict[str, T.DataType] = {}
    for i, c in enumerate(df.columns):
        if not row[f"any_{i}"]:
            out[c] = T.StringType()  # all missing: text
        elif not row[f"nonint_{i}"] and row[f"long_{i}"]:
            out[c] = T.StringType()  # an integer beyond 64 bits
        elif not row[f"nonint_{i}"]:
            out[c] = T.DoubleType() if row[f"hasnull_{i}"] else T.LongType()
        elif not row[f"nonnum_{i}"]:
            out[c] = T.StringType() if row[f"long_{i}"] else T.DoubleType()
        elif not row[f"nonbool_{i}"] and not row[f"hasnull_{i}"]:
            out[c] = T.BooleanType()
        else:
            out[c] = T.StringType()
    return out


def apply_types(df: DataFrame, types: dict[str, T.DataType]) -> DataFrame:
    cols = []
    for c in df.columns:
        t = types.get(c, T.StringType())
        v = F.col(c)
        if isinstance(t, T.BooleanType):
            cols.append(v.isin(*TRUE_TOKENS).alias(c))
        elif isinstance(t, T.DoubleType):
            # NaN text is a null token; any NaN left after the cast is NULL too
            d = v.cast("double")
            cols.append(F.when(F.isnan(d), F.lit(None).cast("double")).otherwise(d).alias(c))
        else:
            cols.append(v.cast(t).alias(c))
    return df.select(*cols)


def _unreadable(names: list[str], types: dict[str, T.DataType]) -> Column:
    """The columns (named in a list) whose text is not a value of their declared type."""
    bad = []
    for i, n in enumerate(names):
        t = types.get(clean_column_name(n), T.StringType())
        v = null_tokens_to_null(F.col(f"_c{i}"))
        if isinstance(t, T.BooleanType):
            wrong = ~v.isin(*TRUE_TOKENS, *FALSE_TOKENS)
        elif isinstance(t, T.StringType):
            continue
        else:
            wrong = v.try_cast(t).isNull()
        bad.append(F.when(v.isNotNull() & wrong, F.lit(clean_column_name(n))))
    return F.array_compact(F.array(*bad)) if bad else F.array().cast("array<string>")


def land(spark: SparkSession, path: str, *, schema: T.StructType | None = None,
         encoding: str = "auto", multi_line: bool = True) -> tuple[DataFrame, list[str], str]:
    """The records of a CSV file as text with ``_kept`` and ``_reject``; the header; the encoding.

    One pass decides on every record: ``_reject`` is NULL for those kept, else the raw
    record (where it has as many fields as the header, those written as CSV), its file, the byte range of the file split that held it, its running number in
    the scan (it orders the rejects of a file) and the reason: too many fields, or, with a
    declared ``schema``, the columns whose text is not a value of their type.
    """
    if encoding == "auto":
        encoding = "UTF-8" if is_utf8(spark, path) else "ISO-8859-1"
    raw, names = _recorded(spark, path, encoding, multi_line)
    types = {f.name: f.dataType for f in schema.fields} if schema else {}
    wrong = _unreadable(names, types)
    reason = F.when(F.col(OVERFLOW).isNotNull(), F.lit(TOO_MANY_FIELDS)).when(
        F.size(wrong) > 0, F.concat(F.lit(BAD_VALUE + ": "), F.array_join(wrong, ", ")))
    whole = F.coalesce(RECORD, F.array_join(F.array(*[  # of as many fields as the header
        F.when(F.col(f"_c{i}").rlike('[",\\r\\n]'), F.concat(F.lit('"'), F.replace(
            F.col(f"_c{i}"), F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(
                F.coalesce(f"_c{i}", F.lit(""))) for i in range(len(names))]), ","))
    placed = raw.select(
        "*", reason.alias("_reason"), whole.alias("_whole"), F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.col("_metadata.file_block_length").alias("_length"),
        F.monotonically_increasing_id().alias("_number"))
    reject = F.when(F.col("_reason").isNotNull(), F.struct(
        F.col("_reason").alias("reason"), F.col("_whole").alias("record"), F.col("_file").alias("file"),
        F.col("_start").alias("split_start"), F.col("_length").alias("split_length"),
        F.col("_number").alias("number")))
    kept = F.col("_reason").isNull()
    return placed.select(*[F.when(kept, F.col(f"_c{i}")).alias(f"_c{i}") for i in range(len(names))],
                         reject.alias("_reject"), kept.alias("_kept")), names, encoding


def shaped(landed: DataFrame, names: list[str], schema: T.StructType | None = None) -> DataFrame:
    """Kept landed records as the clean, typed table (types inferred without a schema)."""
    clean = landed.select(*[null_tokens_to_null(F.col(f"_c{i}")).alias(clean_column_name(n))
                            for i, n in enumerate(names)])
    types = infer_types(clean) if schema is None else {f.name: f.dataType for f in schema.fields}
    return apply_types(clean, types)


def read_csv(spark: SparkSession, path: str, *, schema: T.StructType | None = None,
             encoding: str = "auto", multi_line: bool = True) -> CsvRead:
    """Read, clean and type a CSV file; ``schema`` overrides inference.

    ``encoding="auto"`` reads the lines once to test them, and inference takes
    one aggregate pass. ``multi_line=False`` lets Spark split a large file across
    tasks; use it only for files without line breaks inside quoted fields.
    """
    if encoding == "auto":
        encoding = "UTF-8" if is_utf8(spark, path) else "ISO-8859-1"
    raw, names = _raw(spark, path, encoding, multi_line)
    clean = _clean(names)
    types = infer_types(clean(raw)) if schema is None else {f.name: f.dataType for f in schema.fields}
    return CsvRead(raw, lambda df: apply_types(clean(df), types), encoding)
