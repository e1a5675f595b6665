"""Dataset tables: projections, typing and column metadata."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trialbook.plans.scan import running

# Legal feature types; the procedure a task type falls back to.
LEGAL_TYPES = ("nominal", "numeric", "string", "date")
DEFAULT_PROCEDURES = {1: 1, 2: 7, 3: 13, 5: 17}
# Catalog name and text patterns.
NAME_PATTERN = r"^[a-zA-Z0-9_\-\.\(\),]+$"
NAME_OFFENDERS = r"[^a-zA-Z0-9_\-\.\(\),]"
ASCII_OFFENDERS = r"[^\x00-\x7f]"


@dataclass(frozen=True)
class Feature:
    """Metadata of one column."""

    index: int
    name: str
    data_type: str
    nominal_values: tuple[str, ...] | None = None
    is_target: bool = False
    is_ignore: bool = False
    is_row_identifier: bool = False


@dataclass(frozen=True)
class Data:
    """A dataset cut into inputs and target; both keep ``rowid`` when the table has it."""

    X: DataFrame
    y: DataFrame | None
    categorical: list[bool]
    names: list[str]


def get_data(
    df: DataFrame, features: Sequence[Feature], target: str | Sequence[str] | None = None,
    include_row_id: bool = False, include_ignore_attribute: bool = False,
) -> Data:
    """Drop row ids and ignored columns unless asked for, split off the target."""
    kept = [f for f in features
            if (include_row_id or not f.is_row_identifier) and (include_ignore_attribute or not f.is_ignore)]
    targets = [] if target is None else target.split(",") if isinstance(target, str) else list(target)
    if len(targets) > 1:
        raise NotImplementedError(f"one target at a time, got {targets}")
    position = ["rowid"] if "rowid" in df.columns else []
    inputs = [f for f in kept if f.name not in targets]
    if targets and len(inputs) == len(kept):
        raise ValueError(f"no column {targets[0]!r} to predict")
    y = df.select(*position, targets[0]) if targets else None
    return Data(df.select(*position, *[f.name for f in inputs]), y,
                [f.data_type == "nominal" for f in inputs], [f.name for f in inputs])


def features_by_type(
    features: DataFrame, data_type: str, exclude: Sequence[str] = (),
    exclude_ignore_attribute: bool = True, exclude_row_id_attribute: bool = True,
) -> DataFrame:
    """(did, position, name) of the features of a type, numbered as if excluded columns were absent."""
    if data_type not in LEGAL_TYPES:
        raise TypeError(f"no feature type {data_type!r}")
    gone = F.col("name").isin(list(exclude)) if exclude else F.lit(False)
    if exclude_ignore_attribute:
        gone = gone | F.col("is_ignore")
    if exclude_row_id_attribute:
        gone = gone | F.col("is_row_identifier")
    kept = features.select("did", "index", "name", "data_type", (~gone).alias("_kept")).filter("_kept")
    before = running(kept, ["did"], ["index"], {"_upto": ("count", F.lit(1))})
    return before.filter(F.col("data_type") == data_type).select("did", (F.col("_upto") - 1).alias("position"), "name")


def class_labels(df: DataFrame, feature: Feature, rowid: str = "rowid") -> DataFrame | None:
    """(label, position): the declared domain, or a text column's values as first seen; else None."""
    if feature.data_type == "nominal":
        declared = [(v, i) for i, v in enumerate(feature.nominal_values or ())]
        return df.sparkSession.createDataFrame(declared, "label string, position long")
    if feature.data_type == "string":
        seen = df.groupBy(F.col(feature.name).alias("label")).agg(F.min(rowid).alias("first"))
        return running(seen, [], ["first"], {"_n": ("count", F.lit(1))}).select("label", (F.col("_n") - 1).alias("position"))
    return None


def _nan_like(label: Column) -> Column:
    return label.isNull() | (F.lower(label) == "nan")


def decode_nominal(df: DataFrame, code: str, domain: Sequence[str | None], name: str) -> DataFrame:
    """Code to label. Missing codes, codes outside the domain and nan-like labels give NULL."""
    labels = F.array(*[F.lit(v).cast("string") for v in domain])
    number = F.col(code).try_cast("double").cast("int")
    label = F.get(labels, number)
    return df.withColumn(name, F.when(~_nan_like(label), label))


def outside_domain(df: DataFrame, code: str, domain: Sequence[str | None]) -> DataFrame:
    """How many codes point outside the domain, negatives included."""
    number = F.col(code).try_cast("double").cast("int")
    return df.agg(F.count_if((number < 0) | (number >= len(domain))).alias("n_outside"))


def is_boolean_domain(domain: Sequence[str] | None) -> bool:
    return domain is not None and len(domain) == 2 and {v.lower() for v in domain} == {"true", "false"}


def decode_booleans(df: DataFrame, features: Sequence[Feature]) -> DataFrame:
    """Columns whose domain is {true, false} in any case become BOOLEAN."""
    names = [f.name for f in features if f.data_type == "nominal" and is_boolean_domain(f.nominal_values)]
    low = {n: F.lower(n) for n in names}
    return df.withColumns({n: F.when(c == "true", True).when(c == "false", False) for n, c in low.items()}) if names else df


def narrowing_facts(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(name, narrow): whether a numeric column is whole, within 0..255 and never missing. One pass."""
    def fits(c: Column) -> Column:
        whole = F.count_if(c.isNull() | (c != F.floor(c))) == 0
        return whole & (F.min(c) >= 0) & (F.max(c) <= 255)

    one = df.agg(*[F.coalesce(fits(F.col(n)), F.lit(False)).alias(n) for n in names])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("name"), F.col(n).alias("narrow")) for n in names])).alias("f")).select("f.*")


def narrow(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Cast what fits to SMALLINT (Spark has no unsigned byte). The facts are one row per column."""
    small = [r["name"] for r in narrowing_facts(df, names).filter("narrow").collect()]
    return df.withColumns({n: F.col(n).cast("smallint") for n in small}) if small else df


def attributes_of(df: DataFrame, nominal: Mapping[str, Sequence[str]] | None = None) -> list[tuple[str, str | list[str]]]:
    """ARFF attributes from a schema; text is nominal only where a domain is declared."""
    out: list[tuple[str, str | list[str]]] = []
    for field in df.schema.fields:
        domain = (nominal or {}).get(field.name)
        if domain is not None:
            if not all(isinstance(v, str) for v in domain):
                raise ValueError(f"the domain of {field.name!r} holds values that are not text")
            out.append((field.name, list(domain)))
        elif isinstance(field.dataType, T.BooleanType):
            out.append((field.name, ["True", "False"]))
        elif isinstance(field.dataType, T.IntegralType):
            out.append((field.name, "INTEGER"))
        elif isinstance(field.dataType, T.FractionalType):
            out.append((field.name, "REAL"))
        elif isinstance(field.dataType, T.StringType):
            out.append((field.name, "STRING"))
        else:
            raise ValueError(f"column {field.name!r} of type {field.dataType.simpleString()} has no ARFF type")
    return out


def expand(names: str | Sequence[str] | None) -> list[str]:
    """A comma list as trimmed names."""
    if isinstance(names, str):
        return [n.strip() for n in names.split(",")]
    return list(names or [])


def describe_dataset(
    df: DataFrame, *, target: str | Sequence[str] | None = None, ignore: str | Sequence[str] | None = None,
    row_id: str | None = None, nominal: Mapping[str, Sequence[str]] | None = None,
    overrides: Mapping[str, str | list[str]] | None = None,
) -> list[Feature]:
    """Column metadata of a new dataset; every named column must exist."""
    attributes = [(n, (overrides or {}).get(n, t)) for n, t in attributes_of(df, nominal)]
    known = [n for n, _ in attributes]
    roles = {"target": expand(target), "ignore": expand(ignore), "row_id": [row_id] if row_id else []}
    for role, names in roles.items():
        for n in names:
            if n not in known:
                raise ValueError(f"{role} names {n!r}, the columns are {known}")
    out = []
    for i, (n, t) in enumerate(attributes):
        kind = "nominal" if isinstance(t, list) else "string" if t.upper() == "STRING" else "numeric"
        f = Feature(i, n, kind, tuple(t) if isinstance(t, list) else None)
        out.append(replace(f, is_target=n in roles["target"], is_ignore=n in roles["ignore"],
                           is_row_identifier=n in roles["row_id"]))
    return out


def feature_rows(df: DataFrame, features: Sequence[Feature], did: int) -> DataFrame:
    """The ``features`` table of a dataset with its missing counts, in one pass over the rows."""
    one = df.agg(*[F.count_if(F.col(f.name).isNull()).alias(f.name) for f in features])
    rows = F.array(*[F.struct(
        F.lit(did).cast("long").alias("did"), F.lit(f.index).alias("index"), F.lit(f.name).alias("name"),
        F.lit(f.data_type).alias("data_type"),
        (F.array(*[F.lit(v) for v in f.nominal_values]) if f.nominal_values is not None
         else F.lit(None).cast("array<string>")).alias("nominal_values"),
        F.col(f.name).alias("number_of_missing_values"), F.lit(f.is_target).alias("is_target"),
        F.lit(f.is_ignore).alias("is_ignore"), F.lit(f.is_row_identifier).alias("is_row_identifier"),
    ) for f in features])
    return one.select(F.explode(rows).alias("f")).select("f.*")


def text_violations(df: DataFrame, key: str, texts: Sequence[str], name: str | None = None) -> DataFrame:
    """(key, field, offenders): texts beyond ASCII and names outside the allowed characters."""
    parts = []
    for column, pattern in [*[(t, ASCII_OFFENDERS) for t in texts], *([(name, NAME_OFFENDERS)] if name else [])]:
        found = F.array_sort(F.array_distinct(F.regexp_extract_all(F.col(column), F.lit(f"({pattern})"))))
        parts.append(F.struct(F.lit(column).alias("field"), F.concat_ws("", found).alias("offenders"),
                              (F.size(found) > 0).alias("bad")))
    return df.select(key, F.explode(F.array(*parts)).alias("v")).filter("v.bad").select(key, "v.field", "v.offenders")


def task_inputs(tasks: DataFrame, rows: DataFrame, targets: Sequence[str]) -> DataFrame:
    """(task_id, rowid, inputs.., y): the rows of each task's dataset; clustering has no ``y``.

    ``targets`` are the columns that tasks may name; all of them are read as text.
    """
    choices = F.coalesce(*[F.when(F.col("target") == t, F.col(t).cast("string")) for t in targets])
    y = F.when(F.col("ttid") != 5, choices)
    return tasks.select("task_id", "did", "ttid", "target").join(rows, "did").withColumn("y", y).drop("ttid", "target")


def profile(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(name, n, missing, distinct) per column. Values are counted before columns are, so no
    group is larger than a column's distinct values."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("name"), F.col(n).cast("string").alias("value")) for n in names])).alias("c")).select("c.*")
    counts = long.groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("name").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("missing"),
        F.count("value").alias("distinct"))


def domains(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(name, value, n): the observed values of each column as rows, however many there are."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("name"), F.col(n).cast("string").alias("value")) for n in names])).alias("c")).select("c.*")
    return long.filter("value IS NOT NULL").groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))


def create_tasks(wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Task definitions with the procedure of their type where none is given; and the rejects."""
    table = F.create_map(*[F.lit(v) for pair in DEFAULT_PROCEDURES.items() for v in pair])
    legal = F.col("ttid").isin(list(DEFAULT_PROCEDURES))
    accepted = wanted.filter(legal).withColumn("procedure_id", F.coalesce("procedure_id", F.element_at(table, F.col("ttid"))))
    return accepted, wanted.filter(~F.coalesce(legal, F.lit(False)))


def feature_violations(features: DataFrame) -> DataFrame:
    """(did, name, problem): illegal types, domains that are absent or out of place, index gaps."""
    nominal = F.col("data_type") == "nominal"
    problem = (
        F.when(~F.col("data_type").isin(list(LEGAL_TYPES)), "illegal type")
        .when(nominal & F.col("nominal_values").isNull(), "nominal without values")
        .when(~nominal & F.col("nominal_values").isNotNull(), "values without nominal")
    )
    single = features.select("did", "name", problem.alias("problem")).filter("problem IS NOT NULL")
    order = features.groupBy("did").agg(
        F.count("index").alias("n"), F.count_distinct("index").alias("d"), F.min("index").alias("lo"), F.max("index").alias("hi"))
    gaps = order.filter("lo <> 0 OR hi <> n - 1 OR d <> n").select(
        "did", F.lit(None).cast("string").alias("name"), F.lit("indices are not 0..n-1").alias("problem"))
    return single.unionByName(gaps)
