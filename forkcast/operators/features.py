"""Feature engineering (FE1-FE11, ARR3-ARR4, SCL13-SCL15).

Everything is a projection over the cleaned venue frame except the
fitted parts: the sorted category lists of the wide encoders (their
entries are the columns), the dictionaries of the sparse ones (tables,
of any size), per-suburb counts (one row
per suburb, joined back; AQE broadcasts it when small and splits a hot
suburb's partition otherwise) and the votes median (exact, bounded).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forkcast.functions.scalars import (bin_right_closed, flag_at_least_keep_null, flag_greater,
                                        rating_binary, rating_ordinal)
from forkcast.functions.text import as_text, list_column, nan_to_null, normalise_key
from forkcast.operators import dictionary
from forkcast.operators.stats import exact_median

def column_name(prefix: str, value: str) -> str:
    """``<prefix>_<value>`` as a column name; a dot or backtick (which Spark
    would read as struct access / quoting) becomes ``_``."""
    return f"{prefix}_{value}".replace(".", "_").replace("`", "_")


def one_hot_vector(df: DataFrame, col: str, out_col: str) -> DataFrame:
    """Sparse one-hot for any number of categories, in alphabetical order
    (see ``dictionary``); a NULL is all zeros, as in the wide form."""
    known = dictionary.codes(df, F.col(col))
    coded = dictionary.encode(df, F.col(col), known, "_code")
    one = F.when(F.col("_code").isNull(), F.array().cast("array<bigint>")).otherwise(F.array("_code"))
    return dictionary.sparse_vectors(coded, one, dictionary.size(known), out_col).drop("_code")


def list_categories(df: DataFrame, col: str, parity: bool = False) -> list[str]:
    """Fit of a multi-hot encoder: sorted distinct items.  They become
    columns, so the wide form is for category sets that fit a schema; the
    caller asks for ``form="sparse"`` otherwise."""
    return [r["v"] for r in df.select(F.explode(list_column(col, parity)).alias("v")).distinct().orderBy("v").collect()]


def wide_categories(df: DataFrame, list_cols: list[str], text_cols: list[str], parity: bool = False) -> dict[str, list[str]]:
    """``list_categories`` of several list columns and the distinct values of
    text columns, sorted, from one scan."""
    pair = lambda c, v: F.struct(F.lit(c).alias("c"), v.cast("string").alias("v"))
    listed = lambda c: F.transform(list_column(c, parity), lambda x: pair(c, x))
    items = [F.coalesce(listed(c), F.array().cast("array<struct<c:string,v:string>>")) for c in list_cols]
    items += [F.array(pair(c, as_text(c, parity))) for c in text_cols]
    if not items:
        return {}
    rows = df.select(F.explode(F.concat(*items)).alias("x")).select("x.*").where("v is not null").distinct().collect()
    out: dict[str, list[str]] = {c: [] for c in (*list_cols, *text_cols)}
    for c, v in sorted((r["c"], r["v"]) for r in rows):
        out[c].append(v)
    return out


def multi_hot(df: DataFrame, col: str, prefix: str | None = None, categories: list[str] | None = None,
              parity: bool = False, keep_list: bool = True) -> DataFrame:
    """``MultiLabelBinarizer``: one INT 0/1 column ``<prefix>_<item>`` per
    category (sorted), presence not count.  ``col`` is replaced by the
    cleaned ARRAY<STRING> when ``keep_list``."""
    prefix = prefix or col
    cats = categories if categories is not None else list_categories(df, col, parity)
    lst = list_column(col, parity)
    tmp = df.withColumn(col, lst)
    cols = {}
    for c in cats:                          # two values may share a sanitised name: OR them
        flag = F.coalesce(F.array_contains(F.col(col), F.lit(c)), F.lit(False))
        name = column_name(prefix, c)
        cols[name] = (cols[name] | flag) if name in cols else flag
    cols = {k: v.cast("int") for k, v in cols.items()}
    out = tmp.withColumns(cols)
    return out if keep_list else out.drop(col)


def multi_hot_vector(df: DataFrame, col: str, out_col: str | None = None, parity: bool = False) -> tuple[DataFrame, DataFrame]:
    """Sparse form for any number of categories: presence of every item of
    the cleaned list, in alphabetical order; returns (frame, dictionary)."""
    tmp = df.withColumn(col, F.coalesce(list_column(col, parity), F.array().cast("array<string>")))
    known = dictionary.codes(tmp.select(F.explode(col).alias("v")), F.col("v"))
    coded = dictionary.encode_items(tmp, F.col(col), known, "_codes")
    return dictionary.sparse_vectors(coded, F.col("_codes"), dictionary.size(known), out_col or f"{col}_vec").drop("_codes"), known


def diversity(df: DataFrame, col: str = "cuisine", out: str = "cuisine_diversity", parity: bool = False) -> DataFrame:
    """Distinct items per row (= row sum of the multi-hot columns)."""
    lst = F.col(col) if dict(df.dtypes).get(col, "").startswith("array") else list_column(col, parity)
    return df.withColumn(out, F.coalesce(F.size(F.array_distinct(lst)), F.lit(0)).cast("int"))


def group_frequency(df: DataFrame, col: str, out: str) -> DataFrame:
    """Rows sharing this row's value of ``col`` (FE4, JN2); NULL keys are
    one group.  Aggregate + join back, not a window over a skewed key; the
    counts are written first, so their real size decides between a broadcast
    and a shuffle and a hot value's rows need not move."""
    from forkcast.session import materialize
    counts = materialize(df.groupBy(F.col(col).alias("__k")).agg(F.count(F.lit(1)).alias(out)), "group-counts")
    j = df.join(counts, df[col].eqNullSafe(counts["__k"]), "left")
    return j.drop("__k").withColumn(out, F.col(out).cast("bigint"))


def one_hot_bool(df: DataFrame, col: str, prefix: str | None = None, categories: list[str] | None = None,
                 parity: bool = False) -> DataFrame:
    """``get_dummies``: one BOOLEAN column per distinct value (sorted)."""
    prefix = prefix or col
    key = as_text(col, parity)
    if categories is None:
        rows = df.select(key.alias("v")).where(F.col("v").isNotNull()).distinct().orderBy("v").collect()
        categories = [r["v"] for r in rows]
    cols = {}
    for v in categories:
        flag = F.coalesce(key == F.lit(v), F.lit(False))
        name = column_name(prefix, v)
        cols[name] = (cols[name] | flag) if name in cols else flag
    return df.withColumns(cols)


def cost_bin(df: DataFrame, col: str = "cost", out: str = "cost_bin") -> DataFrame:
    """Low [0,50], Medium (50,100], High (100,200], Luxury (200,500]; else NULL."""
    return df.withColumn(out, bin_right_closed(nan_to_null(F.col(col))))


def votes_intensity(df: DataFrame, col: str = "votes", out: str = "votes_intensity") -> DataFrame:
    """1 if votes > exact median of votes, else 0 (missing -> 0)."""
    med = exact_median(df, col)
    thr = F.lit(med).cast("double")
    return df.withColumn(out, flag_greater(nan_to_null(F.col(col)), thr))


def suburb_density(df: DataFrame, freq_col: str = "subzone_freq", out: str = "suburb_density",
                   parity_out: str | None = "suburb_density_parity") -> DataFrame:
    """Venues in the row's suburb (= the frequency).  The reference's
    prefix selection also sweeps the frequency column itself, giving
    f * (1 + sum_s f_s^2); that value is kept as ``parity_out``.
    sum_s f_s^2 = sum over rows of f (a scalar subquery)."""
    out_df = df.withColumn(out, F.col(freq_col).cast("bigint"))
    if parity_out:
        s2 = df.select(F.sum(F.col(freq_col)).cast("bigint")).scalar()
        out_df = out_df.withColumn(parity_out, (F.col(freq_col) * (F.lit(1) + s2)).cast("bigint"))
    return out_df


def add_rating_ordinal(df: DataFrame, col: str = "rating_text", out: str = "rating_text_ord") -> DataFrame:
    return df.withColumn(out, rating_ordinal(col))


def add_rating_binary(df: DataFrame, col: str = "rating_text", out: str = "rating_binary") -> DataFrame:
    return df.withColumn(out, rating_binary(col))


def ensure_rating_binary(df: DataFrame, approx_error: float = 0.01) -> DataFrame:
    """Keep an existing ``rating_binary``; else ord >= 3; else rating_number
    >= its approximate median (1% rank error; NULL if no values); else a
    NULL INT column (FE11)."""
    if "rating_binary" in df.columns:
        return df
    if "rating_text_ord" in df.columns:
        return df.withColumn("rating_binary", flag_at_least_keep_null("rating_text_ord", F.lit(3)))
    if "rating_number" in df.columns:
        acc = max(1, int(round(1.0 / approx_error)))
        med = df.select(F.percentile_approx(nan_to_null(F.col("rating_number")), 0.5, acc)).scalar()
        return df.withColumn("rating_binary", flag_at_least_keep_null("rating_number", med))
    return df.withColumn("rating_binary", F.lit(None).cast("int"))


def build_features(clean: DataFrame, parity: bool = False, wide_subzone: bool = True, form: str = "wide") -> DataFrame:
    """The feature stage: ordinal label, cuisine/type multi-hot, suburb
    frequency and one-hot, diversity, cost bin, votes intensity, suburb
    density; raw categorical columns dropped at the end.

    ``form`` is the caller's choice and never the data's: "wide" makes a 0/1
    column per category at any number of them, "sparse" one vector column
    per categorical one."""
    if form not in ("wide", "sparse"):
        raise ValueError(f"form must be 'wide' or 'sparse', not {form!r}")
    df = add_rating_ordinal(clean)
    if "subzone" in df.columns:
        df = df.withColumn("subzone", normalise_key("subzone", parity))
    lists = [c for c in ("cuisine", "type") if c in df.columns]
    known = wide_categories(df, lists, ["subzone"] if wide_subzone and "subzone" in df.columns else [], parity) if form == "wide" else {}
    for col in ("cuisine", "type"):
        if col in df.columns:
            df = multi_hot(df, col, categories=known[col], parity=parity) if form == "wide" else multi_hot_vector(df, col, f"{col}_vec", parity)[0]
    if "subzone" in df.columns:
        df = group_frequency(df, "subzone", "subzone_freq")
        if wide_subzone:
            df = one_hot_bool(df, "subzone", categories=known["subzone"], parity=parity) if form == "wide" else one_hot_vector(df, "subzone", "subzone_vec")
    if "cuisine" in df.columns:
        df = diversity(df, "cuisine")
    if "cost" in df.columns:
        df = cost_bin(df)
    if "votes" in df.columns:
        df = votes_intensity(df)
    if "subzone_freq" in df.columns:
        df = suburb_density(df)
    return df.drop(*[c for c in ("rating_text", "cuisine", "type", "subzone") if c in df.columns])


def standardise(df: DataFrame, cols: list[str], ddof: int = 1, prefix: str = "z_",
                keep: list[str] | None = None, places: int | None = None) -> DataFrame:
    """(x - mean) / std per column; ``ddof=0`` is the population std of
    scikit-learn's scaler (FE13), ``ddof=1`` the sample std of Spark's
    (FE14).  A constant column maps to 0.  Means and stds come from ONE
    aggregate pass (fitted scalars), then one projection."""
    std_fn = F.stddev_pop if ddof == 0 else F.stddev_samp
    x = {c: nan_to_null(F.col(c)) for c in cols}
    st = df.agg(*[F.avg(x[c]).alias(f"m{i}") for i, c in enumerate(cols)],
                *[std_fn(x[c]).alias(f"s{i}") for i, c in enumerate(cols)]).first()   # one pass
    out = [F.col(k) for k in (keep or [])]
    for i, c in enumerate(cols):
        m, s = F.lit(st[f"m{i}"]).cast("double"), F.lit(st[f"s{i}"]).cast("double")
        z = F.when(s == 0, F.lit(0.0)).otherwise((x[c] - m) / s)
        out.append((F.round(z, places) if places is not None else z).alias(prefix + c))
    return df.select(*out)
