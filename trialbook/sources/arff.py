"""ARFF files: dense, sparse and gzipped reading, and writing as a header plus row files.

Only the header goes through the driver. Rows are read as text, in any number of splits, and get
a dense 0-based ``rowid`` in file order.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trialbook.operators.datasets import Feature, attributes_of, is_boolean_domain

# ARFF types and what they become.
TYPES = {"REAL": "double", "NUMERIC": "double", "INTEGER": "bigint", "STRING": "string"}
# Bytes of a header the driver reads, about; a wide table has a line per column.
HEADER_BYTES = 512 << 20

_NAME = re.compile(r"""@attribute\s+(?:'((?:[^'\\]|\\.)*)'|"((?:[^"\\]|\\.)*)"|(\S+))\s+(.+)$""", re.I)
_ITEM = re.compile(r"""\s*(?:'((?:[^'\\]|\\.)*)'|"((?:[^"\\]|\\.)*)"|([^,]*?))\s*(?:,|$)""")


@dataclass(frozen=True)
class Header:
    """Relation name, attributes in order and the number of header lines that are not comments."""

    relation: str
    attributes: list[tuple[str, str | list[str]]]
    lines: int

    def features(self) -> list[Feature]:
        def kind(t: str | list[str]) -> str:
            return "nominal" if isinstance(t, list) else "string" if t == "STRING" else "numeric"

        return [Feature(i, n, kind(t), tuple(t) if isinstance(t, list) else None) for i, (n, t) in enumerate(self.attributes)]


def _plain(quoted: str | None) -> str | None:
    return None if quoted is None else re.sub(r"\\(.)", r"\1", quoted)


def _pick(match: re.Match) -> str:
    return next((v for v in (_plain(match[1]), _plain(match[2]), match[3]) if v is not None), "")


def parse_header(lines: Sequence[str]) -> Header | None:
    """The header in the given first lines, or None when ``@data`` is not among them."""
    relation, attributes, count = "", [], 0
    for line in lines:
        text = line.strip()
        if not text or text.startswith("%"):
            continue
        count += 1
        low = text.lower()
        if low.startswith("@relation"):
            relation = text[9:].strip().strip("'\"")
        elif low.startswith("@attribute"):
            found = _NAME.match(text)
            if not found:
                raise ValueError(f"bad attribute line: {text}")
            spec = found[4].strip()
            if spec.startswith("{"):
                inner = spec[1:spec.rindex("}")]
                values = [_pick(m) for m in _ITEM.finditer(inner) if m.end() > m.start()]
                attributes.append((_pick(found), values))
            else:
                t = spec.split()[0].upper()
                if t not in TYPES:
                    raise ValueError(f"attribute type {spec!r} is not supported")
                attributes.append((_pick(found), t))
        elif low.startswith("@data"):
            return Header(relation, attributes, count)
    return None


def read_header(spark: SparkSession, path: str) -> Header:
    """Read as many leading lines as the header needs."""
    return _header_and_next(spark, path)[0]


def _is_row(line: str) -> bool:
    return bool(line.strip()) and not line.lstrip().startswith("%")


def _header_and_next(spark: SparkSession, path: str) -> tuple[Header, str | None]:
    """The header, and the first line after it that is neither blank nor a comment (None where the file ends)."""
    n = 1_000
    while True:
        lines = [r[0] for r in spark.read.text(path).take(n)]
        header = parse_header(lines)
        ended = len(lines) < n
        if header is not None:
            rest = [line for line in lines if _is_row(line)][header.lines:]
            if rest or ended:
                return header, rest[0] if rest else None
        elif ended:
            raise ValueError(f"no @data line in {path}")
        size = sum(map(len, lines))
        if size >= HEADER_BYTES and header is None:
            raise ValueError(f"no @data line in the first {size} characters of {path}")
        n = min(n * 10, max(n + 1_000, n * HEADER_BYTES // max(1, size)))


def _row_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).filter(~F.ltrim("value").startswith("%") & (F.trim("value") != ""))


def numbered_lines(spark: SparkSession, path: str, skip: int = 0) -> DataFrame:
    """(rowid, value) of the lines that are neither blank nor comments, without the first ``skip``.

    The text is read twice and not copied. The first reading counts the lines of each split, one small row per split,
    which gives each split its first row number; the second one adds it to the order within the split.
    """
    lines = _row_lines(spark, path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"))
    blocks = lines.groupBy("_file", "_block").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # One row per split of the input.
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("_file", "_block", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    rowid = F.col("_at") + F.col("_shift") - skip
    # Later filters may run before this one, so header lines also lose their text.
    body = lines.join(F.broadcast(starts), ["_file", "_block"]).select(rowid.alias("rowid"), F.when(rowid >= 0, F.col("value")).alias("value"))
    return body.filter(F.col("rowid") >= 0)


# A quoted text and a cell. Possessive quantifiers keep the matcher iterative on long texts.
_QUOTED = r"""'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+\""""
_CELL = rf"""\s*+({_QUOTED}|[^,'"\s][^,]*?|)\s*+,"""


def _cells(line: Column) -> Column:
    """The cells of a row; only lines with a quote take the regular expression."""
    plain = F.transform(F.split(line, ",", -1), lambda c: F.trim(c, F.lit(" \t")))
    quoted = F.regexp_extract_all(F.concat(F.trim(line), F.lit(",")), F.lit(_CELL), F.lit(1))
    return F.when(line.rlike("['\"]"), quoted).otherwise(plain)


def _unescape(text: Column) -> Column:
    hidden = F.replace(text, F.lit("\\\\"), F.lit("\u0000"))
    for code, char in (("\\n", "\n"), ("\\t", "\t"), ("\\r", "\r")):
        hidden = F.replace(hidden, F.lit(code), F.lit(char))
    return F.replace(F.regexp_replace(hidden, r"\\(.)", "$1"), F.lit("\u0000"), F.lit("\\"))


def _decoded(cell: Column) -> Column:
    """Text of a cell: quotes off, escapes resolved; a bare ``?`` is missing."""
    quoted = cell.rlike("^['\"]")
    inner = F.substring(cell, F.lit(2), F.length(cell) - 2)
    return F.when(quoted, F.when(inner.contains("\\"), _unescape(inner)).otherwise(inner)).when(cell != "?", cell)


def _typed(text: Column, name: str, kind: str | list[str]) -> Column:
    if isinstance(kind, str):
        if kind == "INTEGER":
            return F.coalesce(text.try_cast("bigint"), text.cast("double").cast("bigint"))
        return text.cast(TYPES[kind])
    domain = F.array(*[F.lit(v) for v in kind])
    legal = F.when(text.isNull() | F.array_contains(domain, text), text).otherwise(
        F.raise_error(F.concat(F.lit(f"{name} has no value "), text)))
    if is_boolean_domain(kind):
        return F.lower(legal) == "true"
    return legal


def _typed_rows(
    lines: DataFrame, attributes: Sequence[tuple[str, str | list[str]]], position: str | None = "rowid",
) -> DataFrame:
    n = len(attributes)
    cells = lines.withColumn("_c", _cells(F.col("value")))
    checked = F.when(F.col("value").isNull() | (F.size("_c") == n), F.col("_c")).otherwise(
        F.raise_error(F.concat(F.lit(f"expected {n} cells, got: "), F.col("value"))))
    ready = cells.select("rowid", checked.alias("_c"))
    place = [F.col("rowid").alias(position)] if position else []
    return ready.select(*place, *[_typed(_decoded(F.col("_c")[i]), name, kind).alias(name)
                                  for i, (name, kind) in enumerate(attributes)])


def _parts(spark: SparkSession, path: str, positions: bool = True) -> tuple[Header, DataFrame]:
    """Header and numbered rows of a single file, or of a folder as ``write`` lays it out.

    Where no positions are wanted the rows of a folder are read once, and ``rowid`` is NULL.
    """
    if re.search(r"\.arff(\.gz)?$", path, re.I):
        header = read_header(spark, path)
        return header, numbered_lines(spark, path, header.lines)
    rows = numbered_lines(spark, f"{path}/rows") if positions else _row_lines(spark, f"{path}/rows").select(F.lit(None).cast("long").alias("rowid"), "value")
    return read_header(spark, f"{path}/header"), rows


def read_dense(spark: SparkSession, path: str, position: str | None = "rowid") -> tuple[DataFrame, list[Feature]]:
    """Rows with their ``position`` (left out when None) and typed columns, and the declared features."""
    header, lines = _parts(spark, path, position is not None)
    names = [n for n, _ in header.attributes]
    if position in names:
        raise ValueError(f"the file has a column {position!r} of its own; name the position otherwise")
    return _typed_rows(lines, header.attributes, position), header.features()


def _sparse_entries(spark: SparkSession, path: str) -> tuple[Header, DataFrame]:
    """(rowid, entries): the entries (col, value) that each row of a sparse file writes out."""
    header, lines = _parts(spark, path)
    if any(kind == "STRING" for _, kind in header.attributes):
        raise ValueError("text columns cannot be sparse")
    pair = rf"""(\d+\s+(?:{_QUOTED}|[^,}}\s]+))\s*[,}}]"""
    domains = {i: kind for i, (_, kind) in enumerate(header.attributes) if isinstance(kind, list)}
    codes = F.create_map(*[x for i, kind in domains.items() for x in (F.lit(i), F.array(*[F.lit(v) for v in kind]))]) if domains else None

    def number(col: Column, text: Column) -> Column:
        if codes is None:
            return text.try_cast("float")
        coded = F.array_position(F.try_element_at(codes, col), text) - 1
        return F.when(col.isin(list(domains)), F.when(coded >= 0, coded).cast("float")).otherwise(text.try_cast("float"))

    def entry(e: Column) -> Column:
        col, text = F.regexp_extract(e, r"^(\d+)", 1).cast("int"), _decoded(F.regexp_extract(e, r"^\d+\s+(.*)$", 1))
        bad = text.isNotNull() & number(col, text).isNull()
        value = F.when(bad, F.raise_error(F.concat(F.lit("bad sparse value "), text)).cast("float")).otherwise(number(col, text))
        return F.struct(col.alias("col"), value.alias("value"))

    return header, lines.select("rowid", F.transform(F.regexp_extract_all("value", F.lit(pair), F.lit(1)), entry).alias("entries"))


def read_sparse(spark: SparkSession, path: str) -> tuple[DataFrame, list[Feature]]:
    """(rowid, col, value FLOAT) of the entries that are written out; a missing value is NULL.

    A nominal value counts as its position in the domain; text columns are refused.
    """
    header, rows = _sparse_entries(spark, path)
    return rows.select("rowid", F.explode("entries").alias("e")).select("rowid", "e.col", "e.value"), header.features()


def sparse_shape(entries: DataFrame) -> DataFrame:
    """(rows, columns): one more than the largest position written out."""
    return entries.agg((F.max("rowid") + 1).alias("rows"), (F.max("col") + 1).alias("columns"))


def sparse_rows(spark: SparkSession, path: str) -> DataFrame:
    """(rowid) of every row of a sparse file, those without entries too."""
    return _parts(spark, path)[1].select("rowid")


def is_sparse(spark: SparkSession, path: str) -> bool:
    """Whether the first row of data is written in braces."""
    if re.search(r"\.arff(\.gz)?$", path, re.I):
        first = _header_and_next(spark, path)[1]
    else:
        rows = _row_lines(spark, f"{path}/rows").take(1)  # all rows are written alike
        first = rows[0]["value"] if rows else None
    return first is not None and first.lstrip().startswith("{")


def _vector(entries: Column, width: int) -> Column:
    """A ``pyspark.ml`` sparse vector of (col, value) entries; a missing value is NaN, zeros are left out."""
    from pyspark.ml.linalg import VectorUDT

    filled = F.transform(entries, lambda e: F.struct(e["col"].alias("col"), F.coalesce(e["value"].cast("double"), F.lit(float("nan"))).alias("value")))
    kept = F.array_sort(F.filter(filled, lambda e: e["value"] != 0))
    parts = F.struct(F.lit(0).alias("type"), F.lit(width).alias("size"), F.transform(kept, lambda e: e["col"]).alias("indices"), F.transform(kept, lambda e: e["value"]).alias("values"))
    # The storage form of a vector, read as one.
    return F.from_json(F.to_json(F.struct(parts.alias("v"))), T.StructType([T.StructField("v", VectorUDT())]))["v"]


def sparse_vectors(entries: DataFrame, width: int, rows: DataFrame | None = None) -> DataFrame:
    """One ``pyspark.ml`` sparse vector per row: its size, and the places and values that are not zero, NaN where one is missing.

    ``rows`` (rowid) keeps the rows without entries, as empty vectors.
    """
    kept = entries.groupBy("rowid").agg(F.collect_list(F.struct("col", "value")).alias("e"))
    if rows is not None:
        kept = rows.join(kept, "rowid", "left")
    e = F.coalesce("e", F.array().cast("array<struct<col: int, value: float>>"))
    return kept.select("rowid", _vector(e, width).alias("features"))


def read_sparse_dataset(spark: SparkSession, path: str) -> DataFrame:
    """(rowid, features) of a sparse file, with a vector for every row."""
    header, rows = _sparse_entries(spark, path)
    return rows.select("rowid", _vector(F.col("entries"), len(header.attributes)).alias("features"))


def read_splits(spark: SparkSession, path: str) -> DataFrame:
    """(repeat, fold, sample, type, rowid) of a split file, its columns found by name."""
    return split_columns(read_dense(spark, path, None)[0])


def split_columns(table: DataFrame) -> DataFrame:
    """Check and order the columns of a split table; ``sample`` is 0 where the file has none."""
    have = {c.lower(): c for c in table.columns}
    absent = {"type", "rowid", "repeat", "fold"} - set(have)
    if absent:
        raise ValueError(f"a split needs {sorted(absent)}")
    kind = F.col(have["type"])
    checked = F.when(kind.isin("TRAIN", "TEST"), kind).otherwise(F.raise_error(F.concat(F.lit("unknown split type "), kind)))
    sample = F.coalesce(F.col(have["sample"]).cast("int"), F.lit(0)) if "sample" in have else F.lit(0)
    return table.select(
        F.col(have["repeat"]).cast("int").alias("repeat"), F.col(have["fold"]).cast("int").alias("fold"),
        sample.alias("sample"), checked.alias("type"), F.col(have["rowid"]).cast("long").alias("rowid"))


# Columns of a trace file.
TRACE_COLUMNS = ("repeat", "fold", "iteration", "evaluation", "selected")
TRACE_PREFIX = "parameter_"


def read_trace(spark: SparkSession, path: str, run_id: int | None = None) -> DataFrame:
    """(run_id, repeat, fold, iteration, evaluation, selected, parameters) of a trace file."""
    table, features = read_dense(spark, path, None)
    names = [f.name for f in features]
    absent = [c for c in TRACE_COLUMNS if c not in names]
    if absent:
        raise ValueError(f"the trace lacks {absent}")
    parameters = [n for n in names if n not in TRACE_COLUMNS]
    unknown = [n for n in parameters if not n.startswith(TRACE_PREFIX)]
    if unknown:
        raise ValueError(f"trace columns {unknown} do not start with {TRACE_PREFIX}")
    entries = [x for n in parameters for x in (F.lit(n[len(TRACE_PREFIX):]), F.col(f"`{n}`").cast("string"))]
    selected = F.col("selected").cast("boolean")
    return table.select(
        F.lit(run_id).cast("long").alias("run_id"), F.col("repeat").cast("int").alias("repeat"), F.col("fold").cast("int").alias("fold"),
        F.col("iteration").cast("long").alias("iteration"), F.col("evaluation").cast("double").alias("evaluation"),
        F.when(selected.isNotNull(), selected).otherwise(F.raise_error(F.lit("selected is neither true nor false"))).alias("selected"),
        (F.create_map(*entries) if entries else F.create_map().cast("map<string,string>")).alias("parameters"))


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """A stored prediction table, ``sample`` being 0 where the file has none."""
    out, _ = read_dense(spark, path, None)
    if "prediction" not in out.columns and "cluster" not in out.columns:
        raise ValueError("a prediction file has a prediction or cluster column")
    whole = {c: F.col(c).cast("int") for c in ("repeat", "fold", "sample") if c in out.columns}
    out = out.withColumns({**whole, "row_id": F.col("row_id").cast("long")})
    return out if "sample" in out.columns else out.withColumn("sample", F.lit(0))


def _quoted_name(text: str) -> str:
    if re.fullmatch(r"[^\s,'\"%{}\\]+", text) and text != "?":
        return text
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def header_lines(relation: str, attributes: Sequence[tuple[str, str | list[str]]]) -> list[str]:
    def spec(t: str | list[str]) -> str:
        return t if isinstance(t, str) else "{" + ",".join(_quoted_name(v) for v in t) + "}"

    return [f"@RELATION {_quoted_name(relation)}", "", *[f"@ATTRIBUTE {_quoted_name(n)} {spec(t)}" for n, t in attributes], "", "@DATA"]


def _cell_text(column: Column, is_boolean: bool, is_text: bool) -> Column:
    if is_boolean:
        text = F.when(column, "True").otherwise("False")
    elif is_text:
        escaped = column
        for char, code in (("\\", "\\\\"), ("'", "\\'"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
            escaped = F.replace(escaped, F.lit(char), F.lit(code))
        simple = column.rlike(r"^[^\s,'\"%{}\\]+\z") & (column != "?")
        text = F.when(simple, column).otherwise(F.concat(F.lit("'"), escaped, F.lit("'")))
    else:
        text = column.cast("string")
    return F.when(column.isNull(), "?").otherwise(text)


def _write(rows: DataFrame, relation: str, attributes, path: str, compression: str | None) -> None:
    spark = rows.sparkSession
    head = spark.createDataFrame([("\n".join(header_lines(relation, attributes)),)], "value string")
    head.coalesce(1).write.text(f"{path}/header")
    rows.write.option("compression", compression or "none").text(f"{path}/rows")


def write_dense(
    df: DataFrame, path: str, relation: str, nominal: Mapping[str, Sequence[str]] | None = None,
    compression: str | None = None, order: str | None = "rowid",
) -> None:
    """Write ``path/header`` and ``path/rows``; rows keep the order of ``order`` across part files."""
    data = df.drop("rowid") if order == "rowid" else df
    attributes = attributes_of(data, nominal)
    if order is not None and order in df.columns:
        df = df.repartitionByRange(order).sortWithinPartitions(order)
    kinds = dict(data.dtypes)
    cells = [_cell_text(F.col(f"`{n}`"), kinds[n] == "boolean", kinds[n] == "string") for n, _ in attributes]
    _write(df.select(F.concat_ws(",", *cells).alias("value")), relation, attributes, path, compression)


def write_sparse(df: DataFrame, path: str, relation: str, order: str = "rowid") -> None:
    """Write numeric columns as ``{position value, ...}``, leaving out zeros; NULL is written as ``?``."""
    data = df.drop("rowid")
    attributes = attributes_of(data)
    if any(kind == "STRING" for _, kind in attributes):
        raise ValueError("text columns cannot be sparse")
    if order in df.columns:
        df = df.repartitionByRange(order).sortWithinPartitions(order)
    entries = [F.when(F.col(f"`{n}`").isNull(), f"{i} ?").when(F.col(f"`{n}`") != 0, F.concat(F.lit(f"{i} "), F.col(f"`{n}`").cast("string")))
               for i, (n, _) in enumerate(attributes)]
    row = F.concat(F.lit("{"), F.concat_ws(", ", *entries), F.lit("}"))
    _write(df.select(row.alias("value")), relation, attributes, path, None)
