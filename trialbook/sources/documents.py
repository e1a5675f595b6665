"""Registry XML documents: one loader and one exporter per kind of entity.

Elements are cut out of files of any size (``elements``) and parsed with an explicit schema, so any number of files and
of entities per file load in parallel, and an entity may hold any number of entries. Prefix and namespace are
parameters of what is written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trialbook.operators.flows import ways
from trialbook.session import brief, stage
from trialbook.sources import elements
from trialbook.sources.elements import CORRUPT, PREFIX, element, escaped, opened, write_lines

# Task types that can be instantiated.
RUNNABLE_TASK_TYPES = (1, 2, 3, 5)

NAMED_TEXT = "array<struct<_name string, _VALUE string>>"


def read(spark: SparkSession, path: str, tag: str, schema: str, *, strict: bool = True) -> DataFrame:
    """Rows of one tag, whatever the prefix. Not strict: a row that does not fit is kept whole in ``_corrupt``."""
    return elements.records(spark, path, tag, schema, strict=strict)


def _parsed(rows: DataFrame, keys: list[str], record: str, tag: str, schema: str, prefix: str) -> DataFrame:
    """The columns of an element's text beside the keys; an element that does not fit is an error."""
    options = {**elements.PARSE, "rowTag": f"{prefix}{tag}", "mode": "FAILFAST"}
    return rows.select(*keys, F.explode(F.array(F.from_xml(record, schema, options))).alias("_r")).select(*keys, "_r.*")


def foreign_documents(spark: SparkSession, path: str, namespace: str, prefix: str = PREFIX) -> DataFrame:
    """(path) of the files that do not declare the namespace."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").contains(f'xmlns:{prefix}="{namespace}"').alias("declares"))
    return lines.groupBy("path").agg(F.max("declares").alias("declares")).filter(~F.col("declares")).select("path")


def text(name: str | Column) -> Column:
    """Trimmed text, NULL when empty.

    The blanks are those of ``\\s``, cut without a pattern. Only before a last line separator that is none of them, where ``$``
    matches too, a pattern is needed.
    """
    column = F.col(name) if isinstance(name, str) else name
    separated = column.endswith("\u0085") | column.endswith("\u2028") | column.endswith("\u2029")
    return F.nullif(F.when(separated, F.regexp_replace(column, r"^\s+|\s+$", "")).otherwise(F.btrim(column, F.lit(" \t\n\x0b\f\r"))), F.lit(""))


def _id(name: str) -> Column:
    return text(name).cast("long")


def _named(entries: str | Column, name: str) -> Column:
    """The value of the entry with a given name attribute."""
    return F.get(F.filter(entries, lambda e: e["_name"] == name), F.lit(0))["_VALUE"]


def features(spark: SparkSession, path: str, did: int | None = None, **how) -> DataFrame:
    """Column metadata; the dataset comes from ``did`` or from the folder of the file. Whitespace
    in nominal values counts, a missing count that is absent is 0."""
    raw = read(spark, path, "feature", "index string, name string, data_type string, nominal_value array<string>, "
               "is_target string, is_ignore string, is_row_identifier string, number_of_missing_values string, ontology array<string>", **how)
    owner = F.lit(did).cast("long") if did is not None else F.regexp_extract(F.col("_metadata.file_path"), r"/(-?\d+)/[^/]*$", 1).try_cast("long")
    kind = text("data_type")
    return raw.select(
        owner.alias("did"), text("index").cast("int").alias("index"), F.col("name"), kind.alias("data_type"),
        F.when(kind == "nominal", F.coalesce("nominal_value", F.array().cast("array<string>"))).otherwise(F.col("nominal_value")).alias("nominal_values"),
        F.coalesce(_id("number_of_missing_values"), F.lit(0)).alias("number_of_missing_values"),
        *[F.coalesce(F.lower(text(c)) == "true", F.lit(False)).alias(c) for c in ("is_target", "is_ignore", "is_row_identifier")],
        F.col("ontology").alias("ontologies"))


def qualities(spark: SparkSession, path: str, did: int | None = None, **how) -> DataFrame:
    """(did, name, value); an absent, empty or 'null' value is NULL."""
    raw = read(spark, path, "quality", "name string, value string", **how)
    owner = F.lit(did).cast("long") if did is not None else F.regexp_extract(F.col("_metadata.file_path"), r"/(-?\d+)/[^/]*$", 1).try_cast("long")
    value = text("value").try_cast("double")
    return raw.select(owner.alias("did"), text("name").alias("name"), F.when(~F.isnan(value), value).alias("value"))


# Text fields of a dataset description, and those that may be repeated.
DESCRIPTION_TEXT = ("name", "description", "format", "collection_date", "upload_date", "language", "licence", "url",
                    "default_target_attribute", "row_id_attribute", "version_label", "citation", "visibility",
                    "original_data_url", "paper_url", "update_comment", "md5_checksum", "parquet_url", "status")
DESCRIPTION_LISTS = ("creator", "contributor", "ignore_attribute", "tag")


def descriptions(spark: SparkSession, path: str, **how) -> DataFrame:
    """Dataset descriptions as catalog rows."""
    schema = ", ".join(["id string", "version string", *[f"{c} string" for c in DESCRIPTION_TEXT], *[f"{c} array<string>" for c in DESCRIPTION_LISTS]])
    raw = read(spark, path, "data_set_description", schema, **how)
    texts = [c for c in DESCRIPTION_TEXT if c != "upload_date"]
    return raw.select(
        _id("id").alias("did"), text("version").cast("int").alias("version"), *[text(c).alias(c) for c in texts],
        text("upload_date").try_cast("timestamp").alias("upload_date"),
        *[F.filter(F.transform(c, text), lambda v: v.isNotNull()).alias(c) for c in DESCRIPTION_LISTS])


TASK_SCHEMA = (
    "task_id string, task_type_id string, task_type string, input array<struct<_name string, "
    "data_set struct<data_set_id string, target_feature string>, "
    f"estimation_procedure struct<id string, type string, data_splits_url string, parameter {NAMED_TEXT}>, "
    "evaluation_measures struct<evaluation_measure string>>>, tag array<string>"
)


def tasks(spark: SparkSession, path: str, **how) -> tuple[DataFrame, DataFrame]:
    """(tasks of the types that can be run, the others). Parameters without text are ''."""
    raw = read(spark, path, "task", TASK_SCHEMA, **how)

    def part(name: str) -> Column:
        return F.get(F.filter("input", lambda i: i["_name"] == name), F.lit(0))

    procedure = part("estimation_procedure")["estimation_procedure"]
    given = F.transform(procedure["parameter"], lambda p: F.struct(p["_name"].alias("key"), F.coalesce(text(p["_VALUE"]), F.lit("")).alias("value")))
    out = raw.select(
        _id("task_id").alias("task_id"), text("task_type_id").cast("int").alias("ttid"), text("task_type").alias("task_type"),
        text(part("source_data")["data_set"]["data_set_id"]).cast("long").alias("did"),
        text(part("source_data")["data_set"]["target_feature"]).alias("target"),
        F.struct(text(procedure["id"]).cast("int").alias("id"), text(procedure["type"]).alias("type"),
                 F.map_from_entries(given).alias("parameters")).alias("estimation"),
        text(procedure["data_splits_url"]).alias("data_splits_url"),
        text(part("evaluation_measures")["evaluation_measures"]["evaluation_measure"]).alias("measure"), F.col("tag").alias("tags"))
    runnable = F.col("ttid").isin(list(RUNNABLE_TASK_TYPES))
    return out.filter(runnable), out.filter(~F.coalesce(runnable, F.lit(False)))


RUN_SCHEMA = (
    "run_id string, uploader string, uploader_name string, task_id string, task_type string, task_evaluation_measure string, "
    "flow_id string, flow_name string, setup_id string, setup_string string, error_message string, run_details string, "
    "parameter_setting array<struct<name string, value string, component string>>, "
    "input_data struct<dataset struct<did string>>, "
    "output_data struct<file array<struct<file_id string, name string, url string>>>, tag array<string>"
)
EVALUATION_SCHEMA = "_repeat string, _fold string, _sample string, name string, value string, array_data string"


@dataclass(frozen=True)
class Parsed:
    """``heads``: a row per document, with its number; ``entries``: a row per entry, with the id of its document."""

    heads: DataFrame
    entries: DataFrame


def _documents(found: elements.Documents, tag: str, schema: str, key: str, entry_tag: str, entry_schema: str) -> Parsed:
    """Documents with typed ``key``, and their entries parsed."""
    heads = stage(_parsed(found.heads, ["document"], "record", tag, schema, found.prefix).withColumn(key, _id(key)), f"{tag}-heads")
    entries = _parsed(found.entries, ["document", "place"], "entry", entry_tag, entry_schema, found.prefix)
    return Parsed(heads, heads.select("document", key).join(entries, "document"))


def run_documents(spark: SparkSession, path: str) -> Parsed:
    """Run documents with typed ids, for ``runs`` and ``run_evaluations``. A run may have any number of evaluations."""
    found = elements.documents(spark, path, "run", "</{p}evaluation>", "<{p}evaluation(?=[\\s/>])")
    parsed = _documents(found, "run", RUN_SCHEMA, "run_id", "evaluation", EVALUATION_SCHEMA)
    return Parsed(parsed.heads.withColumns({c: _id(c) for c in ("uploader", "task_id", "flow_id", "setup_id")}), parsed.entries)


def _run_rows(documents: Parsed) -> DataFrame:
    settings = F.transform("parameter_setting", lambda p: F.struct(
        F.concat_ws("/", text(p["component"]), text(p["name"])).alias("key"), p["value"].alias("value")))
    predictions = F.get(F.filter("output_data.file", lambda f: text(f["name"]) == "predictions"), F.lit(0))
    return documents.heads.select(
        "run_id", "uploader", text("uploader_name").alias("uploader_name"), "task_id", text("task_type").alias("task_type"),
        text("task_evaluation_measure").alias("task_evaluation_measure"), "flow_id", text("flow_name").alias("flow_name"), "setup_id",
        text("setup_string").alias("setup_string"), F.coalesce(text("error_message"), F.lit("")).alias("error_message"),
        text(F.col("input_data.dataset.did")).cast("long").alias("did"), settings.alias("parameters"),
        text(predictions["file_id"]).cast("long").alias("predictions_file_id"), text(predictions["url"]).alias("predictions_url"),
        text("run_details").alias("run_details"), F.col("tag").alias("tags")).distinct()


def runs(documents: Parsed) -> DataFrame:
    """A row per run; documents that agree in all of this are one. Ids that are in ``run_conflicts`` are left out."""
    return _told_apart(_run_rows(documents), "run_id", True).withColumn("parameters", F.map_from_entries("parameters"))


def run_conflicts(documents: Parsed) -> DataFrame:
    """Rows of one run id that say different things, or have no id at all; ``parameters`` are entries."""
    return _told_apart(_run_rows(documents), "run_id", False)


def _told_apart(table: DataFrame, key: str, single: bool) -> DataFrame:
    said = table.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*table.columns)).alias("_row"))
    if single:
        return said.filter(F.col(key).isNotNull() & (F.col("_n") == 1)).select("_row.*")
    return table.join(said.filter("_n > 1").select(F.col(key).alias("_key")), F.col(key) == F.col("_key"), "left_semi").unionByName(table.filter(F.col(key).isNull()))


def run_evaluations(documents: Parsed) -> DataFrame:
    """(run_id, function, repeat, fold, sample, value, array_data); what is NULL tells the scope."""
    e = documents.entries
    value, arrays = text("value").cast("double"), text("array_data")
    fold = F.when(F.col("_repeat").isNotNull(), text("_fold").cast("int"))
    required = F.when(value.isNotNull() | arrays.isNotNull(), value).otherwise(
        F.raise_error(F.concat(F.lit("neither value nor array_data in run "), F.col("run_id").cast("string"))))
    return e.select(
        "run_id", text("name").alias("function"), F.when(fold.isNotNull(), text("_repeat").cast("int")).alias("repeat"),
        fold.alias("fold"), F.when(fold.isNotNull(), text("_sample").cast("int")).alias("sample"),
        required.alias("value"), F.when(value.isNull(), arrays).alias("array_data"))


def traces(spark: SparkSession, path: str) -> DataFrame:
    """Trace iterations with parameters decoded from their JSON text; a trace may have any number of them."""
    found = elements.documents(spark, path, "trace", "</{p}trace_iteration>", "<{p}trace_iteration(?=[\\s/>])")
    t = _documents(found, "trace", "run_id string", "run_id", "trace_iteration",
                   "repeat string, fold string, iteration string, setup_string string, evaluation string, selected string").entries
    chosen = F.lower(text("selected"))
    return t.select(
        "run_id", text("repeat").cast("int").alias("repeat"), text("fold").cast("int").alias("fold"),
        text("iteration").cast("long").alias("iteration"), text("evaluation").cast("double").alias("evaluation"),
        F.when(chosen == "true", True).when(chosen == "false", False).otherwise(F.raise_error(F.lit("selected is neither true nor false"))).alias("selected"),
        F.from_json(text("setup_string"), "map<string,string>").alias("parameters"))


PARAMETER = "struct<id string, flow_id string, flow_name string, full_name string, parameter_name string, data_type string, default_value string, value string>"


def setups(spark: SparkSession, path: str, tag: str = "setup", **how) -> DataFrame:
    """Setup parameters as rows; a setup without parameters is one row of NULLs.

    The tag is ``setup_parameters`` in a document of one setup, ``setup`` in a list.
    """
    raw = read(spark, path, tag, f"setup_id string, flow_id string, parameter array<{PARAMETER}>", **how)
    p = raw.select(_id("setup_id").alias("setup_id"), _id("flow_id").alias("flow_id"), F.explode_outer("parameter").alias("p"))
    return p.select(
        "setup_id", "flow_id", text(F.col("p.id")).cast("long").alias("parameter_id"), text(F.col("p.flow_id")).cast("long").alias("parameter_flow_id"),
        *[text(F.col(f"p.{c}")).alias(c) for c in ("flow_name", "full_name", "parameter_name", "data_type", "default_value", "value")])


FLOW_TEXT = ("name", "external_version", "uploader", "description", "upload_date", "language", "dependencies", "version",
             "binary_url", "binary_format", "binary_md5", "class_name", "custom_name")


FLOW_SCHEMA = ", ".join(["id string", *[f"{c} string" for c in FLOW_TEXT], "parameter array<struct<name string, data_type string, default_value string, description string>>", "tag array<string>"])


def flow_nodes(spark: SparkSession, path: str) -> DataFrame:
    """(document, root_id, path, flow_id, fields.., parameters): every flow of every document with its place.

    Flows nest to any depth. ``document`` tells the trees apart, also where their outermost flow has no id.
    """
    nodes = elements.tree(spark, path, "flow", "component", "identifier", FLOW_SCHEMA)
    given = F.transform("record.parameter", lambda p: F.struct(
        text(p["name"]).alias("name"), text(p["data_type"]).alias("data_type"), p["default_value"].alias("default_value"), text(p["description"]).alias("description")))
    nodes = stage(nodes.select("document", "node", "path", text("record.id").cast("long").alias("flow_id"),
                               *[text(f"record.{c}").alias(c) for c in FLOW_TEXT], given.alias("parameters"), F.col("record.tag").alias("tags")), "flow-nodes")
    roots = nodes.filter("node = document").select("document", F.col("flow_id").alias("root_id"))
    return roots.join(nodes.hint("merge"), "document").drop("node")


STUDY_LISTS = (("data", "data_id"), ("task", "task_id"), ("flow", "flow_id"), ("setup", "setup_id"), ("run", "run_id"))
# The element that holds the ids of each kind.
STUDY_ELEMENTS = {"data": "data", "task": "tasks", "flow": "flows", "setup": "setups", "run": "runs"}


STUDY_SCHEMA = ("id string, alias string, main_entity_type string, benchmark_suite string, name string, description string, "
                "status string, creation_date string, creator string, tag array<struct<name string, write_access string>>")


def studies(spark: SparkSession, path: str, entity: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(studies, their members as rows, of any number); with ``entity`` given, a study of another kind is an error."""
    kinds = "|".join(kind for kind, _ in STUDY_LISTS)
    # Ids end at "_id>", and so do their begin tags.
    found = elements.documents(spark, path, "study", "_id>", f"[^<>]*</{{p}}(?:{kinds})$", f"\\s*<{{p}}(?:{kinds})$")
    raw = stage(_parsed(found.heads, ["document"], "record", "study", STUDY_SCHEMA, found.prefix), "study-heads")
    kind = text("main_entity_type")
    if entity is not None:
        kind = F.when(kind == entity, kind).otherwise(F.raise_error(F.concat(F.lit(f"expected a study of {entity}, got "), kind)))
    table = raw.select(
        _id("id").alias("study_id"), text("alias").alias("alias"), kind.alias("main_entity_type"), _id("benchmark_suite").alias("benchmark_suite"),
        text("name").alias("name"), text("description").alias("description"), text("status").alias("status"),
        text("creation_date").try_cast("timestamp").alias("creation_date"), _id("creator").alias("creator"),
        F.transform("tag", lambda t: text(t["name"])).alias("tags"))
    pattern = f"(?s)^(.*)</{found.prefix}({kinds})_id>$"
    members = found.entries.select("document", F.regexp_extract("entry", pattern, 2).alias("entity_type"), text(F.regexp_extract("entry", pattern, 1)).cast("long").alias("entity_id"))
    owners = raw.select("document", _id("id").alias("study_id"))
    return table.distinct(), owners.join(members, "document").select("study_id", "entity_type", "entity_id")


# Fields of the listing documents; ids are numbers, the rest is text.
LISTINGS = {
    "dataset": ("did", ("did", "version", "uploader"), ("name", "status", "format")),
    "task": ("task_id", ("task_id", "task_type_id", "did"), ("task_type", "name", "status", "format")),
    "run": ("run_id", ("run_id", "task_id", "setup_id", "flow_id", "uploader", "task_type_id"), ("upload_time", "error_message")),
    "flow": ("id", ("id", "version", "uploader"), ("full_name", "name", "external_version")),
    "evaluation": ("run_id", ("run_id", "task_id", "setup_id", "flow_id", "data_id", "uploader"),
                   ("flow_name", "data_name", "function", "upload_time", "value", "values", "array_data")),
    "study": ("id", ("id", "creator"), ("alias", "main_entity_type", "name", "status", "creation_date")),
}


def listing(spark: SparkSession, path: str, entity: str) -> tuple[DataFrame, DataFrame]:
    """(rows of a listing document, rows that could not be used).

    Qualities and task inputs become maps; ``values`` becomes an array; a run without an error
    message has ''. A row without its key, with an id that is no number, or with a quality or input named
    twice goes to the rejects. A quality without a number is NULL.
    """
    key, ids, texts = LISTINGS[entity]
    extra = {"dataset": f", quality {NAMED_TEXT}", "task": f", input {NAMED_TEXT}, quality {NAMED_TEXT}, tag array<string>"}.get(entity, "")
    schema = ", ".join(f"`{c}` string" for c in (*ids, *texts)) + extra

    def cleaned(r: Column) -> Column:
        return F.struct(*[text(r[c]).alias(c) for c in (*ids, *texts)])

    raw = elements.records(spark, path, entity, schema, strict=False, also=cleaned)
    clean = {c: F.col(f"_also.{c}") for c in (*ids, *texts)}
    numbers = {c: clean[c].try_cast("long") for c in ids}
    bad = F.col(CORRUPT).isNotNull() | numbers[key].isNull()
    for c in ids:
        bad = bad | (clean[c].isNotNull() & numbers[c].isNull())
    for c in [c for c in ("quality", "input") if c in raw.columns]:
        names = F.transform(c, lambda e: e["_name"])
        bad = bad | F.coalesce(F.size(F.array_distinct(names)) < F.size(names), F.lit(False))
    columns = [numbers[c].alias(c) for c in ids]
    for c in texts:
        if c == "value":
            columns.append(clean[c].try_cast("double").alias(c))
        elif c == "values":
            columns.append(F.from_json(clean[c], "array<double>").alias(c))
        elif c == "error_message":
            columns.append(F.coalesce(clean[c], F.lit("")).alias(c))
        else:
            columns.append(clean[c].alias(c))
    if entity in ("dataset", "task"):
        columns.append(_map("quality", "double").alias("qualities"))
    if entity == "task":
        columns += [_map("input", "string").alias("inputs"), F.col("tag").alias("tags")]
    return raw.filter(~bad).select(*columns), raw.filter(bad).drop("_also")


def quality_names(spark: SparkSession, path: str) -> DataFrame:
    """(name) of a vocabulary of qualities."""
    return _names(spark, path, "quality")


def measures(spark: SparkSession, path: str) -> DataFrame:
    """(name) of a vocabulary of evaluation measures."""
    return _names(spark, path, "measure")


def _names(spark: SparkSession, path: str, tag: str) -> DataFrame:
    # An element that holds only text is read by an attribute that it may have.
    return read(spark, path, tag, "_id string, _VALUE string").select(text("_VALUE").alias("name")).filter("name IS NOT NULL").distinct()


# Task types an estimation procedure may belong to.
PROCEDURE_TASK_TYPES = tuple(range(1, 10))


def procedures(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """((procedure_id, ttid, procedure_name, type, repeats, folds, ..) of known task types, the others)."""
    fields = ("id", "task_type_id", "name", "type", "repeats", "folds", "samples", "percentage", "stratified_sampling")
    raw = read(spark, path, "estimationprocedure", ", ".join(f"{c} string" for c in fields))
    out = raw.select(
        text("id").cast("int").alias("procedure_id"), text("task_type_id").try_cast("int").alias("ttid"), text("name").alias("procedure_name"), text("type").alias("type"),
        *[text(c).try_cast("int").alias(c) for c in ("repeats", "folds", "samples", "percentage")], (F.lower(text("stratified_sampling")) == "true").alias("stratified_sampling"))
    known = F.coalesce(F.col("ttid").isin(list(PROCEDURE_TASK_TYPES)), F.lit(False))
    return out.filter(known), out.filter(~known)


def write_vocabulary(names: DataFrame, path: str, tag: str, root: str, **how) -> None:
    """One element of text per name."""
    prefix = how.get("prefix", PREFIX)
    full = f"{prefix}:{tag}" if prefix else tag
    first = names.select(F.col(names.columns[0]).alias("entity")).filter("entity IS NOT NULL")
    write_lines(first.select("entity", F.concat(F.lit(f"<{full}>"), escaped(F.col("entity")), F.lit(f"</{full}>")).alias("line")), path, root, [], **how)


def write_procedures(table: DataFrame, path: str, **how) -> None:
    """Estimation procedures in the form ``procedures`` reads."""
    write(table.select(F.col("procedure_id").alias("id"), F.col("ttid").alias("task_type_id"), F.col("procedure_name").alias("name"),
                       *[c for c in ("type", "repeats", "folds", "samples", "percentage", "stratified_sampling") if c in table.columns]), path, "estimationprocedure", "estimationprocedures", **how)


def _map(entries: str, kind: str) -> Column:
    """Named entries as a map. A number that is missing, or NaN, is NULL."""
    def value(e: Column) -> Column:
        return F.nanvl(text(e["_VALUE"]).try_cast("double"), F.lit(None).cast("double")) if kind == "double" else text(e["_VALUE"])

    return F.map_from_entries(F.transform(entries, lambda e: F.struct(e["_name"].alias("key"), value(e).alias("value"))))


# Rows of a compressed file. Nothing splits such a file, so it is kept small.
PACKED_ROWS = 1 << 18


def write(df: DataFrame, path: str, tag: str, root: str, *, prefix: str = PREFIX, namespace: str | None = None, compression: str | None = None) -> None:
    """Rows as documents of a tag, a line each. Columns become elements, fields that begin with ``_`` attributes,
    ``_VALUE`` the text of an element; NULL fields are left out. Names and tags make up most of the text, so with
    ``compression`` (gzip) it takes a small part of the disk, in files of at most ``PACKED_ROWS`` rows."""
    full = f"{prefix}:" if prefix else ""
    declared = f' xmlns:{prefix}="{namespace}"' if prefix and namespace else ""
    renamed = df.select(F.struct(*df.columns).cast(_prefixed(df.schema, full)).alias("r")).select("r.*")
    packed = {"compression": compression, "maxRecordsPerFile": PACKED_ROWS} if compression else {}
    (renamed.write.format("xml").option("validateName", "false").option("rowTag", f"{full}{tag}").option("rootTag", f"{full}{root}{declared}")
     .option("declaration", "version=\"1.0\" encoding=\"UTF-8\"").option("indent", "").options(**packed).save(path))


def _prefixed(kind: T.DataType, prefix: str) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name if f.name.startswith("_") else prefix + f.name, _prefixed(f.dataType, prefix)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_prefixed(kind.elementType, prefix))
    return kind


def _entries(column: str) -> Column:
    """A map as elements with a name attribute."""
    return F.transform(F.map_entries(column), lambda e: F.struct(e["key"].alias("_name"), e["value"].cast("string").alias("_VALUE")))


def write_features(features_table: DataFrame, path: str, **how) -> None:
    """One element per column; for one dataset, or for many with ``did`` as the folder."""
    out = features_table.select(
        "index", "name", "data_type", F.col("nominal_values").alias("nominal_value"), "is_target", "is_ignore",
        "is_row_identifier", "number_of_missing_values")
    write(out, path, "feature", "data_features", **how)


def write_qualities(table: DataFrame, path: str, **how) -> None:
    write(table.select("name", "value"), path, "quality", "data_qualities", **how)


def write_descriptions(datasets: DataFrame, path: str, **how) -> None:
    """Whatever description fields the table has."""
    names = [c for c in ("version", *DESCRIPTION_TEXT, *DESCRIPTION_LISTS) if c in datasets.columns]
    write(datasets.select(F.col("did").alias("id"), *names), path, "data_set_description", "descriptions", **how)


def write_tasks(table: DataFrame, path: str, **how) -> None:
    """Tasks in the form ``tasks`` reads."""
    empty = "struct<data_set_id bigint, target_feature string>", "struct<id int, type string, data_splits_url string, parameter array<struct<_name string, _VALUE string>>>", "struct<evaluation_measure string>"
    def part(name: str, data=None, procedure=None, measure=None) -> Column:
        return F.struct(F.lit(name).alias("_name"), (data if data is not None else F.lit(None)).cast(empty[0]).alias("data_set"),
                        (procedure if procedure is not None else F.lit(None)).cast(empty[1]).alias("estimation_procedure"),
                        (measure if measure is not None else F.lit(None)).cast(empty[2]).alias("evaluation_measures"))

    parts = F.array(
        part("source_data", data=F.struct("did", "target")),
        part("estimation_procedure", procedure=F.struct("estimation.id", "estimation.type", "data_splits_url", _entries("estimation.parameters"))),
        part("evaluation_measures", measure=F.struct("measure")))
    out = table.select("task_id", F.col("ttid").alias("task_type_id"), "task_type", parts.alias("input"), F.col("tags").alias("tag"))
    write(out, path, "task", "tasks", **how)


def _element(columns: list[Column | str], table: DataFrame, tag: str, prefix: str, one_line: bool = False) -> Column:
    """Columns of a table as one element; the names of fields get the prefix."""
    full = f"{prefix}:" if prefix else ""
    return element(F.struct(*columns).cast(_prefixed(table.select(*columns).schema, full)), tag, prefix, one_line=one_line)


def _end(*tags: str, prefix: str) -> Column:
    return F.lit("".join(f"</{prefix}:{t}>" if prefix else f"</{t}>" for t in tags))


def _write_documents(heads: DataFrame, entries: DataFrame, path: str, root: str, tag: str, inner: tuple[str, ...], how: dict) -> None:
    """Documents from (entity, line) of their beginnings and (entity, key.., line) of their entries, all of known entities;
    ``inner`` elements stay open around these."""
    prefix = how.get("prefix", PREFIX)
    keys = [c for c in entries.columns if c not in ("entity", "line")]
    begin = "".join(f"<{prefix}:{t}>" if prefix else f"<{t}>" for t in inner)
    edges = F.array(F.struct(F.lit(0).alias("_at"), F.concat("line", F.lit(begin)).alias("line")),
                    F.struct(F.lit(2).alias("_at"), _end(*reversed(inner), tag, prefix=prefix).alias("line")))
    edges = heads.select("entity", F.explode(edges).alias("e")).select("entity", "e.*")
    write_lines(edges.unionByName(entries.withColumn("_at", F.lit(1)), allowMissingColumns=True), path, root, ["_at", *keys], **how)


def write_runs(run_table: DataFrame, evaluations: DataFrame, path: str, **how) -> None:
    """Runs with their evaluations, of any number; repeat, fold and sample are attributes. An evaluation is a line."""
    prefix = how.get("prefix", PREFIX)
    optional = [c for c in ("uploader", "uploader_name", "task_type", "flow_name", "setup_string", "error_message", "run_details") if c in run_table.columns]
    with brief(run_table.sparkSession) as put:
        # Read twice; evaluations of unknown runs are left out before they become text.
        run_table = put(run_table.select("run_id", *optional, "task_id", "flow_id", "setup_id"), "run-table")
        evaluations = evaluations.join(run_table.select("run_id"), "run_id", "left_semi")
        head = _element(["run_id", *optional, "task_id", "flow_id", "setup_id"], run_table, "run", prefix)
        each = _element([F.col("repeat").alias("_repeat"), F.col("fold").alias("_fold"), F.col("sample").alias("_sample"),
                         F.col("function").alias("name"), "value", "array_data"], evaluations, "evaluation", prefix, one_line=True)
        _write_documents(
            run_table.select(F.col("run_id").alias("entity"), opened(head, "run", prefix).alias("line")),
            evaluations.select(F.col("run_id").alias("entity"), "repeat", "fold", "sample", "function", each.alias("line")), path, "runs", "run", ("output_data",), how)


def write_traces(table: DataFrame, path: str, **how) -> None:
    """Traces of runs, of any length, with parameters as JSON text."""
    prefix = how.get("prefix", PREFIX)
    each = _element(["repeat", "fold", "iteration", F.to_json("parameters").alias("setup_string"), "evaluation", F.col("selected").cast("string").alias("selected")],
                    table, "trace_iteration", prefix)
    owners = table.select("run_id").distinct()
    table = table.filter("run_id IS NOT NULL")
    _write_documents(
        owners.select(F.col("run_id").alias("entity"), opened(_element(["run_id"], owners, "trace", prefix), "trace", prefix).alias("line")),
        table.select(F.col("run_id").alias("entity"), "repeat", "fold", "iteration", each.alias("line")), path, "traces", "trace", (), how)


def write_setups(parameters: DataFrame, path: str, **how) -> None:
    fields = [c for c in ("id", "flow_id", "flow_name", "full_name", "parameter_name", "data_type", "default_value", "value") if c in parameters.columns]
    out = parameters.groupBy("setup_id", "flow_id").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("parameter"))
    write(out, path, "setup", "setups", **how)


def write_studies(table: DataFrame, members: DataFrame, path: str, **how) -> None:
    """Studies with their member ids, of any number, in a list per kind."""
    prefix = how.get("prefix", PREFIX)
    fields = [c for c in ("alias", "main_entity_type", "name", "description", "status", "creation_date", "creator") if c in table.columns]
    head = _element([F.col("study_id").alias("id"), *fields], table, "study", prefix)
    full = f"{prefix}:" if prefix else ""
    numbers = {kind: i for i, (kind, _) in enumerate(STUDY_LISTS)}

    def by_kind(values: dict[str, str]) -> Column:
        return F.element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), F.col("entity_type"))

    members = members.join(table.select("study_id"), "study_id", "left_semi")
    known = members.filter(F.col("entity_type").isin(list(numbers))).select(
        F.col("study_id").alias("entity"), "entity_type", by_kind(numbers).alias("kind"), F.lit(1).alias("part"), F.col("entity_id").alias("id"))
    lists = known.select("entity", "entity_type", "kind").distinct()
    ids = known.select("entity", "kind", "part", "id", F.concat(by_kind({k: f"<{full}{inner}>" for k, inner in STUDY_LISTS}), F.col("id").cast("string"), by_kind({k: f"</{full}{inner}>" for k, inner in STUDY_LISTS})).alias("line"))
    ends = [lists.select("entity", "kind", F.lit(part).alias("part"), F.lit(None).cast("long").alias("id"), by_kind({k: f"<{slash}{full}{STUDY_ELEMENTS[k]}>" for k in numbers}).alias("line"))
            for part, slash in ((0, ""), (2, "/"))]
    _write_documents(table.select(F.col("study_id").alias("entity"), opened(head, "study", prefix).alias("line")),
                     ids.unionByName(ends[0]).unionByName(ends[1]), path, "studys", "study", (), how)


def write_listing(table: DataFrame, path: str, entity: str, **how) -> None:
    """A listing document of an entity from columns named as in ``LISTINGS``."""
    _, ids, texts = LISTINGS[entity]
    out = table.select(
        *[c for c in (*ids, *texts) if c in table.columns],
        *([_entries("inputs").alias("input")] if "inputs" in table.columns else []),
        *([_entries("qualities").alias("quality")] if "qualities" in table.columns else []))
    write(out, path, entity, f"{entity}s", **how)


def write_flows(nodes: DataFrame, edges: DataFrame, path: str, **how) -> None:
    """Flows as nested documents of any depth, one per flow that is no component of another.

    ``nodes`` is (flow_id, name, ..), ``edges`` (parent, identifier, child) over them; a flow that contains itself, or
    one that is not in ``nodes``, is an error. A begin tag sorts before the flow's components, its end tag after them.
    """
    prefix = how.get("prefix", PREFIX)
    fields = [c for c in FLOW_TEXT if c in nodes.columns] + (["parameter"] if "parameter" in nodes.columns else [])
    unknown = edges.join(nodes.select(F.col("flow_id").alias("child")).hint("merge"), "child", "left_anti").first()
    if unknown is not None:
        raise ValueError(f"flows contain themselves or unknown flows, {unknown['child']} for one")
    steps = "array<struct<end int, identifier string, child bigint>>"
    roots = nodes.select("flow_id").join(edges.select(F.col("child").alias("flow_id")).hint("merge"), "flow_id", "left_anti")
    below = ways(edges, nodes).filter(F.col("steps")[0]["known"]).select(
        F.col("root_id").alias("entity"), "flow_id", F.transform("steps", lambda s: F.struct(F.lit(0).alias("end"), s["identifier"].alias("identifier"), s["child"].alias("child"))).alias("at"))
    places = stage(roots.select(F.col("flow_id").alias("entity"), "flow_id", F.array().cast(steps).alias("at")).unionByName(below), "flow-places")
    texts = nodes.select("flow_id", opened(_element([F.col("flow_id").alias("id"), *fields], nodes, "flow", prefix), "flow", prefix).alias("text"))
    full = f"{prefix}:" if prefix else ""
    inside = F.size("at") > 0
    wrapped = F.concat(F.lit(f"<{full}component><{full}identifier>"), escaped(F.element_at("at", -1)["identifier"]), F.lit(f"</{full}identifier>"))
    begins = places.join(texts.hint("merge"), "flow_id").select("entity", "at", F.concat(F.when(inside, wrapped).otherwise(F.lit("")), "text").alias("line"))
    last = F.struct(F.lit(1).alias("end"), F.lit("").alias("identifier"), F.lit(0).cast("long").alias("child"))
    ends = places.select("entity", F.array_append("at", last).alias("at"), F.when(F.size("at") > 0, _end("flow", "component", prefix=prefix)).otherwise(_end("flow", prefix=prefix)).alias("line"))
    write_lines(begins.unionByName(ends), path, "flows", ["at"], **how)
