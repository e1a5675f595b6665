"""XML elements from files of any size, and documents of any size from rows.

Files are cut at an end tag: the text source takes it as the record delimiter, so Hadoop splits a large file like any
text file and no task needs a whole one. Three readers stand on that:

- ``records``: one row per element of a tag, parsed with a schema. No shuffle.
- ``documents``: elements that hold very many entries of one kind (the evaluations of a run). Entries are rows of their
  own, the rest of a document is a row, and both carry the document's number.
- ``tree``: elements that hold elements of the same tag, to any depth.

The last two need to know what came before a cut. Splits of the files are ordered slices as they are: sums per split,
one row each, give every split its start, and rows are numbered while their split is read, without a shuffle.

The writer makes documents from rows of text in order, so an entity is never one cell. A file holds whole documents only.
It is written by many tasks, each of which puts its part of the sorted rows at the place that the bytes before it give. A
store that takes a file from one writer only, and whole, gets it as a stream of sorted rows from one task.

Elements are found by their text: the prefix is that of the first file's head. An element whose tag stands under
another prefix, whose end tag has blanks in it, or whose tag stands in a comment or in CDATA, is an error (``records``
that are not strict keep its text in a column instead); it is never left out silently.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from trialbook.plans.scan import running
from trialbook.session import brief, stage

# Fixed value: the element prefix of registry documents, for writing.
PREFIX = "oml"
CORRUPT = "_corrupt"
# Text of a file that is written at once, but for a longer line.
BLOCK_BYTES = 4 << 20
# Text of a file that may be compressed. Nothing splits such a file, so a longer one stays plain.
PACKED_BYTES = 1 << 30
# A tag's attributes.
ATTRIBUTES = r"""(?:\s+[^\s=<>]+\s*=\s*(?:"[^"<]*"|'[^'<]*'))*\s*"""
PARSE = {"ignoreNamespace": "true", "ignoreSurroundingSpaces": "false"}


def _text(spark: SparkSession, path: str, end: str) -> DataFrame:
    return spark.read.option("lineSep", end).option("recursiveFileLookup", "true").text(path)


def prefix_of(spark: SparkSession, path: str) -> str:
    """The prefix (with its colon, or nothing) of the first element, read from the head of the first file that has one."""
    heads = _text(spark, path, ">").select(F.regexp_extract("value", r"^\s*<((?:[\w.-]+:)?)[A-Za-z_]", 1).alias("p"), "value")
    first = heads.filter(F.col("value").rlike(r"^\s*<[A-Za-z_]")).select("p").first()
    return first["p"] if first else ""


def pieces(spark: SparkSession, path: str, end: str) -> DataFrame:
    """(value, path, block, line): the text between the ends, in the order (path, block, line)."""
    return _text(spark, path, end).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))


def opening(prefix: str, tag: str) -> str:
    """A pattern of an element's beginning, up to its name."""
    return f"<{re.escape(prefix + tag)}(?=[\\s/>])"


def _once(column: Column) -> Column:
    """Rows of an array; what makes it is computed once, whatever is read of it."""
    return F.explode(column)


def records(
    spark: SparkSession, path: str, tag: str, schema: str, *, strict: bool = True, prefix: str | None = None, also: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Rows of one tag with ``_metadata.file_path``. Not strict: a row that does not fit is kept whole in ``_corrupt``.

    ``also`` makes one more column, ``_also``, of a row; it is computed once per row, whatever filters and columns use it.
    """
    p = prefix_of(spark, path) if prefix is None else prefix
    name = re.escape(p + tag)
    cut = _text(spark, path, f"</{p}{tag}>").select("value", F.struct(F.col("_metadata.file_path").alias("file_path")).alias("_metadata"))
    none = F.array().cast("array<string>")
    # What stands before the last beginning may hold elements without content, and nothing else of this tag. Patterns are
    # searched for only where the text they need occurs, and what is used twice is a column.
    empty = F.when(F.col("value").contains("/>"), F.regexp_extract_all("value", F.lit(f"<{name}{ATTRIBUTES}/>"), F.lit(0))).otherwise(none)
    cut = cut.select("*", F.split("value", opening(p, tag)).alias("parts"), empty.alias("empty"))
    last = F.element_at("parts", -1)
    has_last = (F.size("parts") > 1) & ~last.rlike(f"^{ATTRIBUTES}/>")
    cut = cut.withColumn("whole", F.concat("empty", F.when(has_last, F.array(F.concat(F.lit(f"<{p}{tag}"), last, F.lit(f"</{p}{tag}>")))).otherwise(none)))
    others = F.regexp_count("value", F.lit(rf"<(?:[\w.-]+:)?{re.escape(tag)}(?=[\s/>])"))
    sections = F.col("value").contains("<![CDATA[") | F.col("value").contains("]]>")
    odd = (others != F.size("whole")) | (sections & (F.regexp_count("value", F.lit(r"<!\[CDATA\[")) != F.regexp_count("value", F.lit(r"\]\]>"))))
    options = {**PARSE, "rowTag": f"{p}{tag}", "mode": "FAILFAST" if strict else "PERMISSIVE"}
    if strict:
        said = F.concat(F.lit(f"elements {tag} cannot be told apart in "), F.col("_metadata.file_path"), F.lit(": "), F.substring("value", 1, 200))
        whole = F.when(odd, F.raise_error(said).cast("array<string>")).otherwise(F.col("whole"))
        parsed = F.transform(whole, lambda x: F.from_xml(x, schema, options))
    else:
        schema = f"{schema}, {CORRUPT} string"
        options["columnNameOfCorruptRecord"] = CORRUPT
        unread = F.from_xml(F.lit(f"<{p}{tag}/>"), schema, options).withField(CORRUPT, F.col("value"))
        parsed = F.when(odd, F.array(unread)).otherwise(F.transform("whole", lambda x: F.from_xml(x, schema, options)))
    if also is None:
        return cut.select("_metadata", _once(parsed).alias("_r")).select("_r.*", "_metadata")
    both = F.transform(parsed, lambda r: F.struct(r.alias("r"), also(r).alias("also")))
    return cut.select("_metadata", _once(both).alias("_r")).select("_r.r.*", "_metadata", F.col("_r.also").alias("_also"))


def numbered(cut: DataFrame, sums: Mapping[str, Column], of_file: Sequence[str] = ()) -> DataFrame:
    """``cut`` (with path, block, line) with the sum over all rows before, in file order, for each name; over those of
    the same file for the names in ``of_file``. ``cut`` comes from ``pieces`` by projections alone.

    The first reading gives one row of sums per split; the second one numbers the rows of each split as they come, since
    one task reads a whole split in order.
    """
    names = list(sums)

    def before(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, upto = None, [0] * len(names)
        for batch in batches:
            if not batch.num_rows:
                continue
            path = batch.column("path").dictionary_encode()
            code, block = path.indices.to_numpy(), batch.column("block").to_numpy()
            begins = np.flatnonzero(np.r_[True, (np.diff(code) != 0) | (np.diff(block) != 0)])
            first, last = [(path.dictionary[int(code[i])].as_py(), int(block[i])) for i in (0, -1)]
            columns = []
            for k, name in enumerate(names):
                added = batch.column(f"_in_{name}").to_numpy()
                total = np.cumsum(added)
                at_start = (total - added)[begins]
                if first == split:
                    at_start[0] -= upto[k]
                here = total - np.repeat(at_start, np.diff(np.r_[begins, len(added)]))
                upto[k] = int(here[-1])
                columns.append(pa.array(here - added))
            split = last
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *[f"_here_{n}" for n in names]])

    added = cut.withColumns({f"_in_{k}": c.cast("long") for k, c in sums.items()})
    of_split = added.groupBy("path", "block").agg(*[F.sum(f"_in_{k}").alias(f"_sum_{k}") for k in sums])
    # One row per split of the files.
    earlier = Window.orderBy("path", "block").rowsBetween(Window.unboundedPreceding, -1)
    in_file = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = of_split.select("path", "block", *[F.coalesce(F.sum(f"_sum_{k}").over(in_file if k in of_file else earlier), F.lit(0)).alias(f"_start_{k}") for k in sums])
    local = added.mapInArrow(before, ", ".join([f"`{c}` {t}" for c, t in added.dtypes] + [f"`_here_{k}` bigint" for k in names]))
    return local.join(F.broadcast(starts), ["path", "block"]).select(
        *cut.columns, *[(F.col(f"_start_{k}") + F.col(f"_here_{k}")).alias(k) for k in sums])


@dataclass(frozen=True)
class Documents:
    """``heads`` (document, path, record): each document without its entries. ``entries`` (document, place, entry): their text, in order."""

    heads: DataFrame
    entries: DataFrame
    prefix: str


def documents(spark: SparkSession, path: str, tag: str, end: str, entry: str, between: str | None = None, prefix: str | None = None) -> Documents:
    """Documents of a tag with their entries cut out, both as text.

    ``end`` ends an entry, and ``entry`` is a pattern of where its text begins; a text before ``end`` that matches
    ``between`` ends no entry and belongs to no document. ``{p}`` stands for the prefix. Entries of one document keep their
    order in ``place``, also over the splits of a file.
    """
    p = prefix_of(spark, path) if prefix is None else prefix
    end, entry, between = end.replace("{p}", p), entry.replace("{p}", re.escape(p)), (between or "$^").replace("{p}", re.escape(p))
    close = f"</{p}{tag}>"
    # Where the pattern matches, the entry starts; what stands before it belongs to the documents.
    parts = F.split("value", entry, 2)
    cut = pieces(spark, path, end)
    found = F.size(parts) > 1
    cut = cut.select("path", "block", "line", F.when(found, F.substr("value", F.length(parts[0]) + 1)).alias("entry"), F.when(found, parts[0]).when(F.col("value").rlike(between), F.regexp_replace("value", between, "")).otherwise(F.concat("value", F.lit(end))).alias("rest"))
    fragments = F.split("rest", re.escape(close))
    cut = numbered(cut, {"document": F.size(fragments) - 1, "place": F.lit(1)})
    cut = stage(cut.select("path", "document", "place", "entry", fragments.alias("fragments")), f"{tag}-pieces", compression="zstd")
    entries = cut.filter("entry IS NOT NULL").select((F.col("document") + F.size("fragments") - 1).alias("document"), "place", F.concat("entry", F.lit(end)).alias("entry"))
    rests = cut.select("path", "document", "place", F.posexplode("fragments").alias("k", "text")).filter(F.col("text").rlike(r"\S"))
    heads = rests.groupBy((F.col("document") + F.col("k")).alias("document")).agg(
        F.min("path").alias("path"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "k", "text"))), lambda x: x["text"]), "").alias("text"))
    begins = F.split("text", opening(p, tag))
    record = F.concat(F.lit(f"<{p}{tag}"), F.element_at(begins, -1), F.lit(close))
    told = F.when(F.size(begins) == 2, record).otherwise(F.raise_error(F.concat(F.lit(f"elements {tag} cannot be told apart in "), "path", F.lit(": "), F.substring("text", 1, 200))))
    # What follows the last document of a file is the end of its root.
    heads = heads.filter(F.col("text").rlike(rf"<(?:[\w.-]+:)?{re.escape(tag)}(?=[\s/>])")).select("document", "path", told.alias("record"))
    return Documents(heads, entries, p)


def tree(spark: SparkSession, path: str, tag: str, wrapper: str, name: str, schema: str, prefix: str | None = None) -> DataFrame:
    """(document, node, path, file, record): every element of a tag that may hold others of its kind, at any depth.

    Inside such an element each child stands in a ``wrapper`` element after its ``name``; ``path`` are the names from
    the outermost element on. ``document`` is the ``node`` of that one, so documents are told apart without any ids.
    ``record`` is the element itself, without its children, parsed with ``schema``.

    An end tag closes the element that is open; the begin tags since the last end tag open one each. Their running
    sums give every stretch of text its depth, and the last element that was opened at this depth owns it.
    """
    p = prefix_of(spark, path) if prefix is None else prefix
    e = re.escape(p)
    stretches = F.split("value", f"<{e}{tag}(?=[\\s>])")
    cut = numbered(pieces(spark, path, f"</{p}{tag}>").withColumn("stretches", stretches), {"depth": F.size("stretches") - 2, "piece": F.lit(1)}, ["depth"])
    text = cut.select(F.col("path").alias("file"), "piece", "depth", F.posexplode("stretches").alias("k", "text"))
    # A place is unique and ascending: the piece, then the stretch in it.
    place = F.col("piece") * F.lit(1 << 20) + F.col("k")
    text = text.select("file", "piece", "k", (F.col("depth") + F.col("k")).alias("depth"), place.alias("place"), F.when(F.col("k") > 0, place).alias("opened"), "text")
    # At depth 0 stands the root of the file.
    owned = stage(running(text, ["depth"], ["place"], {"node": ("max", "opened")}), f"{tag}-text")

    # The element before the first begin tag of a piece, or the one opened just before, is the parent.
    before = owned.filter("depth > 0").select("piece", (F.col("k") + 1).alias("k"), F.col("node").alias("parent"), "text")
    last = F.element_at(F.split("text", f"<{e}{re.escape(wrapper)}{ATTRIBUTES}>"), -1)
    named = F.regexp_extract(last, f"(?s)^\\s*<{e}{re.escape(name)}{ATTRIBUTES}>(.*?)</{e}{re.escape(name)}>\\s*$", 1)
    before = before.select("piece", "k", "parent", _unescaped(F.trim(named)).alias("name"))
    nodes = owned.filter("k > 0").select("piece", "k", "node", "file").join(before.hint("merge"), ["piece", "k"], "left")
    nameless = F.raise_error(F.concat(F.lit(f"an element {tag} stands in another one without a {name} before it, in "), "file")).cast("string")
    nodes = stage(nodes.select(
        "node", "file", F.col("parent").alias("above"), F.when(F.col("parent").isNull(), F.array().cast("array<string>"))
        .otherwise(F.array(F.when(F.col("name") != "", F.col("name")).otherwise(nameless))).alias("path")), f"{tag}-nodes")
    nodes = to_roots(nodes)

    wrapping = f"<{e}{wrapper}{ATTRIBUTES}>\\s*(?:<{e}{name}{ATTRIBUTES}>[^<]*</{e}{name}>)?\\s*$|</{e}{wrapper}>|<{e}{wrapper}{ATTRIBUTES}/>"
    bare = F.regexp_replace("text", wrapping, "")
    content = owned.filter("depth > 0").select("node", "place", bare.alias("text")).filter(F.col("text").rlike(r"\S")).groupBy("node").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "text"))), lambda x: x["text"]), "").alias("text"))
    whole = F.concat(F.lit(f"<{p}{tag}"), F.col("text"), F.lit(f"</{p}{tag}>"))
    parsed = content.select("node", _once(F.array(F.from_xml(whole, schema, {**PARSE, "rowTag": f"{p}{tag}", "mode": "FAILFAST"}))).alias("record"))
    return nodes.join(parsed.hint("merge"), "node").select("document", "node", "path", "file", "record")


def to_roots(nodes: DataFrame) -> DataFrame:
    """(node, file, path, document) from (node, file, above, path): ``path`` grows to all names from the root on.

    Every node jumps to the ancestor of its ancestor, so the rounds are as many as the depth has binary digits.
    """
    nodes = nodes.withColumn("document", F.when(F.col("above").isNull(), F.col("node")))
    while not nodes.filter("above IS NOT NULL").isEmpty():
        up = nodes.select(F.col("node").alias("above"), F.col("above").alias("_above"), F.col("path").alias("_path"), F.col("document").alias("_document"))
        nodes = stage(nodes.join(up.hint("merge"), "above", "left").select(
            "node", "file", F.col("_above").alias("above"), F.concat(F.coalesce("_path", F.array().cast("array<string>")), "path").alias("path"),
            F.coalesce("document", "_document").alias("document")), "ancestors")
    return nodes.drop("above")


def _unescaped(text: Column) -> Column:
    """Text with its five named entities resolved."""
    for entity, character in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(character))
    return text


def escaped(text: Column) -> Column:
    for character, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(character), F.lit(entity))
    return text


def element(value: Column, tag: str, prefix: str = PREFIX, *, one_line: bool = False) -> Column:
    """A struct as an element: fields become elements, those that begin with ``_`` attributes, ``_VALUE`` its text; NULL fields are left out."""
    options = {"rowTag": f"{prefix}:{tag}" if prefix else tag, "validateName": "false"}
    return F.btrim(F.to_xml(value, {**options, "indent": ""}), F.lit("\n")) if one_line else F.to_xml(value, options)


def opened(element_text: Column, tag: str, prefix: str = PREFIX) -> Column:
    """An element's text without its end tag."""
    full = f"{prefix}:{tag}" if prefix else tag
    return F.when(element_text.endswith(f"</{full}>"), F.substring_index(element_text, f"</{full}>", 1)).otherwise(F.regexp_replace(element_text, r"/>\s*$", ">"))


def _blocks(lines: DataFrame, by: Sequence[str], put: Callable[..., DataFrame], compression: str | None) -> DataFrame:
    """(slice, packed, place, content): the lines of each slice in the order of ``by``, as blocks of bytes and where these
    begin in the file of their slice. ``by`` begins with the slice; ordered ranges of the lines ignore the borders of slices.
    With ``compression`` blocks are gzip members, and ``packed`` tells whether the file of a slice consists of these: members
    that follow each other are one gzip file, so each may be written by another task.
    """

    def member(content: bytes) -> bytes:
        work = zlib.compressobj(wbits=31)
        return work.compress(content) + work.flush()

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, upto, packed_upto = None, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            number, text = batch.column("slice").to_numpy(), batch.column("line")
            full = np.cumsum(pc.binary_length(text).to_numpy(), dtype=np.int64) // BLOCK_BYTES
            begins = np.flatnonzero(np.r_[True, (np.diff(number) != 0) | (np.diff(full) != 0)])
            runs = pa.ListArray.from_arrays(pa.array(np.r_[begins, len(number)], pa.int32()), text)
            content = pc.binary_join(runs, "").cast(pa.binary())
            size, at, packed_at = pc.binary_length(content).to_numpy().astype(np.int64), [], []
            if compression:
                content = pa.array([member(c.as_py()) for c in content], pa.binary())
            packed_size = pc.binary_length(content).to_numpy().astype(np.int64)
            for n, n_bytes, n_packed in zip(number[begins], size, packed_size):
                upto, packed_upto = (upto, packed_upto) if n == last else (0, 0)
                at.append(upto)
                packed_at.append(packed_upto)
                last, upto, packed_upto = n, upto + int(n_bytes), packed_upto + int(n_packed)
            first = pa.array(begins)
            yield pa.RecordBatch.from_arrays(
                [batch.column("slice").take(first), batch.column("part").take(first), pa.array(at, pa.int64()), pa.array(size), pa.array(packed_at, pa.int64()), pa.array(packed_size), content],
                names=["slice", "part", "at", "size", "packed_at", "packed_size", "content"])

    ended = F.concat(F.coalesce("line", F.lit("")), F.lit("\n")).alias("line")
    ranges = lines.repartitionByRange(*by).sortWithinPartitions(*by).select("slice", F.spark_partition_id().alias("part"), ended)
    written = put(ranges.mapInArrow(joined, "slice int, part int, at long, size long, packed_at long, packed_size long, content binary"), "blocks")
    # One row per range, and one per slice.
    whole = Window.partitionBy("slice")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = written.groupBy("slice", "part").agg(F.sum("size").alias("_n"), F.sum("packed_size").alias("_m")).select(
        "slice", "part", (F.lit(bool(compression)) & (F.sum("_n").over(whole) <= PACKED_BYTES)).alias("packed"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"), F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_packed_start"))
    place = F.when(F.col("packed"), F.col("_packed_start") + F.col("packed_at")).otherwise(F.col("_start") + F.col("at"))
    return written.join(F.broadcast(starts), ["slice", "part"]).select("slice", "packed", place.alias("place"), "content")


def _put(blocks: DataFrame, folder: str, compression: str | None) -> None:
    """Write blocks into a file per slice, each at its place. A task that runs again writes the same bytes to the same places."""

    def put(rows: Iterator[Row]) -> None:
        opened, file = None, None
        try:
            for number, packed, place, content in rows:
                if number != opened:
                    if file is not None:
                        os.close(file)
                        file = None
                    os.makedirs(f"{folder}/slice={number}", exist_ok=True)
                    file, opened = os.open(f"{folder}/slice={number}/part-00000.txt{'.gz' if packed else ''}", os.O_WRONLY | os.O_CREAT, 0o666), number
                rest = memoryview(zlib.decompress(content, wbits=31) if compression and not packed else content)
                while rest:
                    n = os.pwrite(file, rest, place)
                    rest, place = rest[n:], place + n
        finally:
            if file is not None:
                os.close(file)

    blocks.foreachPartition(put)


def write_lines(
    lines: DataFrame, path: str, root: str, order: Sequence[str], entity: str = "entity", *, prefix: str = PREFIX, namespace: str | None = None, compression: str | None = None,
) -> None:
    """(entity, order.., line) as files of whole documents, each below a root element of its own.

    Entities are dealt to folders by their hash, and a folder has one file. Where the path lies on a file system that is
    mounted, ordered ranges of all lines go to tasks, whatever folder they are for, and each task writes its part of a file
    in its place, so that no task has a whole document. Other stores take a file from one task, which sorts the rows of a
    folder (on disk, where they are many) and writes them one after the other.

    With ``compression`` (gzip) files are compressed, in the first case those of up to ``PACKED_BYTES`` of text, as a reader
    takes a compressed file whole.
    """
    if compression not in (None, "gzip"):
        raise ValueError(f"files are compressed by gzip, not {compression}")
    spark = lines.sparkSession
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    full, declared = f"{prefix}:{root}" if prefix else root, f' xmlns:{prefix}="{namespace}"' if prefix and namespace else ""
    ends = spark.range(slices).select(F.col("id").cast("int").alias("slice"), F.explode(F.array(
        F.struct(F.lit(0).alias("_part"), F.lit(f'<?xml version="1.0" encoding="UTF-8"?>\n<{full}{declared}>').alias("line")),
        F.struct(F.lit(2).alias("_part"), F.lit(f"</{full}>").alias("line")))).alias("e")).select("slice", "e.*")
    dealt = lines.select(F.pmod(F.xxhash64(entity), F.lit(slices)).cast("int").alias("slice"), F.lit(1).alias("_part"), entity, *order, "line")
    by = ["slice", "_part", entity, *order]
    every = dealt.unionByName(ends, allowMissingColumns=True)

    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    target = jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(conf)
    if store.getUri().getScheme() != "file" or store.exists(target):
        # An existing path is an error of the writer.
        every.repartition("slice").sortWithinPartitions(*by).select("slice", "line").write.partitionBy("slice").text(path, compression=compression)
        return
    target = store.makeQualified(target)
    # Hidden from readers until it is whole.
    made = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    try:
        # Lines that agree in all else are told apart by their text, so that many of them are many ranges, too.
        with brief(spark) as put:
            _put(_blocks(every, [*by, "line"], put, compression), made.toUri().getPath(), compression)
        store.create(jvm.org.apache.hadoop.fs.Path(made, "_SUCCESS")).close()
        if store.exists(target) or not store.rename(made, target):
            raise OSError(f"{made} cannot be renamed to {target}")
    except BaseException:
        store.delete(made, True)
        raise
