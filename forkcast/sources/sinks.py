"""Writers and readers for the stage outputs (SRC1, SRC2, SNK1-SNK5).

Paths are parameters; on a cluster they must name shared storage.  The
helper ``scratch_path`` derives a fresh folder under the session's
reliable checkpoint folder, the shared location the cluster names.
"""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forkcast.session import ensure_checkpoint_dir

# The texts pandas reads as missing by default.
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
             "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

VENUE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("subzone", T.StringType()),
    T.StructField("cuisine", T.StringType()), T.StructField("type", T.StringType()),
    T.StructField("cost", T.DoubleType()), T.StructField("cost_2", T.DoubleType()),
    T.StructField("lat", T.DoubleType()), T.StructField("lng", T.DoubleType()),
    T.StructField("rating_number", T.DoubleType()), T.StructField("votes", T.DoubleType()),
    T.StructField("rating_text", T.StringType())])


def scratch_path(spark: SparkSession, name: str) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/forkcast-out/{name}-{uuid.uuid4().hex[:12]}"


def _numeric_columns(df: DataFrame, names: list[str]) -> set[str]:
    """The text columns whose every present value is a number (one pass)."""
    if not names:
        return set()
    text = {c: F.when(~F.col(f"`{c}`").isin(NA_TOKENS), F.col(f"`{c}`")) for c in names}
    row = df.agg(*[(F.count(text[c]) > 0).alias(f"some{i}") for i, c in enumerate(names)],
                 *[(F.count(text[c]) == F.count(text[c].try_cast("double"))).alias(f"all{i}") for i, c in enumerate(names)]).first()
    return {c for i, c in enumerate(names) if row[f"some{i}"] and row[f"all{i}"]}


def read_venue_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, key: str = "id",
                   multi_line: bool = True) -> DataFrame:
    """Venue CSV with a header, doubled quotes inside fields and pandas'
    missing-value texts.

    Without ``schema`` the columns are taken by NAME from the header, read
    as text (no inference pass over the data), and the known venue columns
    are cast to their types; unknown columns become DOUBLE if all their
    present values are numbers (one pass over those columns), else stay text,
    in file order.  A file without ``key`` gets one: 64-bit, unique, and the
    same for the same files read with the same split sizes; write it out to
    keep it.  With ``schema`` the file is read positionally with that schema.
    NA texts become NULL in string columns, NaN becomes NULL in numeric
    ones, and a value that does not parse as a number becomes NULL.

    ``multi_line``: fields may hold line breaks; a file is then one task.
    Without them, pass False and Spark splits large files."""
    opts = dict(header=True, multiLine=multi_line, escape='"', quote='"', mode="PERMISSIVE",
                ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    if schema is not None:
        df = spark.read.schema(schema).options(nanValue="NaN", **opts).csv(path)
        fields = schema.fields
    else:
        df = spark.read.options(inferSchema=False, **opts).csv(path)
        known = {f.name: f.dataType for f in VENUE_SCHEMA.fields}
        numbers = _numeric_columns(df, [c for c in df.columns if c not in known])
        fields = [T.StructField(c, T.DoubleType() if c in numbers else known.get(c, T.StringType())) for c in df.columns]
    out = []
    for f in fields:
        c = F.col(f"`{f.name}`")
        if schema is None and not isinstance(f.dataType, T.StringType):
            text = F.when(c.isin(NA_TOKENS), F.lit(None).cast("string")).otherwise(c)
            c = text.try_cast(f.dataType)
        if isinstance(f.dataType, T.StringType):
            out.append(F.when(c.isin(NA_TOKENS), F.lit(None).cast("string")).otherwise(c).alias(f.name))
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.nanvl(c, F.lit(None).cast("double")).alias(f.name))
        else:
            out.append(c.alias(f.name))
    if schema is None and key not in df.columns:
        out.insert(0, F.monotonically_increasing_id().alias(key))
    return df.select(*out)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header; ARRAY columns as JSON text (CSV cannot hold arrays)."""
    cols = [F.to_json(F.col(c)).alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes]
    (df.select(*cols).write.mode("overwrite")
       .options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path))


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_metrics_json(metrics: DataFrame, path: str) -> None:
    """The metrics record (one row) as JSON lines, nesting preserved."""
    metrics.coalesce(1).write.mode("overwrite").json(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
