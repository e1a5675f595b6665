"""Train/test splits: generation, validation, cells.

A split is stored as the TEST fold of each row per repeat; the TRAIN rows of a fold are all the
others. Rows are placed by a digest of (seed, repeat, rowid), so a split is the same on every run
and any SQL engine can reproduce it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialbook.plans.scan import hash_counts, hash_positions
from trialbook.session import stage


def _ranked(rows: DataFrame, repeats: int, seed: int, stratify: str | None) -> tuple[DataFrame, list[str]]:
    """Rows per repeat with ``_rank``, their place within repeat (and class) in digest order."""
    groups = ["repeat"] + ([stratify] if stratify else [])
    kept = rows.select("rowid", *([stratify] if stratify else []))
    each = kept.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    digest = F.md5(F.concat_ws("-", F.lit(str(seed)), F.col("repeat").cast("string"), F.col("rowid").cast("string")))
    return hash_positions(each.withColumn("_digest", digest), groups, "_digest", "rowid", "_rank"), groups


def cross_validation(rows: DataFrame, repeats: int, folds: int, seed: int = 0, stratify: str | None = None) -> DataFrame:
    """(repeat, rowid, fold): every row is tested once per repeat; classes are spread evenly."""
    if folds < 2:
        raise ValueError("cross-validation needs at least two folds")
    ranked, _ = _ranked(rows, repeats, seed, stratify)
    return ranked.select("repeat", "rowid", (F.col("_rank") % folds).cast("int").alias("fold"))


def holdout(rows: DataFrame, share: float, seed: int = 0, stratify: str | None = None) -> DataFrame:
    """(repeat, rowid, fold, type): one fold with the given share of rows (of each class) in TEST."""
    if not 0 < share < 1:
        raise ValueError("the test share lies between 0 and 1")
    ranked, groups = _ranked(rows, 1, seed, stratify)
    ranked = ranked.drop("_digest")
    # Counting again from the source keeps the class totals out of the ranking shuffle.
    if stratify:
        totals = rows.groupBy(F.col(stratify).alias("_class")).agg(F.count(F.lit(1)).alias("_n"))
        sized = ranked.join(totals, F.col(stratify).eqNullSafe(F.col("_class")))
    else:
        totals = rows.agg(F.count(F.lit(1)).alias("_n"))
        sized = ranked.join(F.broadcast(totals))  # one row
    kind = F.when(F.col("_rank") < F.round(F.lit(float(share)) * F.col("_n")), "TEST").otherwise("TRAIN")
    return sized.select("repeat", "rowid", F.lit(0).alias("fold"), kind.alias("type"))


def learning_ranks(rows: DataFrame, folds: int, seed: int = 0, stratify: str | None = None) -> DataFrame:
    """(repeat, rowid, fold, ranks): every row once, with its TEST fold and, per fold, its place among the fold's TRAIN rows.

    TRAIN rows of a fold are taken in the digest order of (seed, 'train', rowid), so the TRAIN rows of a sample of n rows
    are those of other folds whose rank is below n. Ranks are exact; that of the row's own fold is NULL.
    """
    test = cross_validation(rows, 1, folds, seed, stratify)
    digest = F.md5(F.concat_ws("-", F.lit(str(seed)), F.lit("train"), F.col("rowid").cast("string")))
    # A row's place among the TRAIN rows of a fold is its place among all rows less the fold's own
    # TEST rows before it. Counting the earlier rows of each fold once does for all folds.
    counted = hash_counts(test.withColumn("_digest", digest), ["repeat"], "_digest", "rowid",
                          {f"_n{f}": F.col("fold") == f for f in range(folds)})
    earlier = sum((F.col(f"_n{f}") for f in range(folds)), F.lit(0))
    ranks = F.array(*[F.when(F.col("fold") != f, earlier - F.col(f"_n{f}")) for f in range(folds)])
    return counted.select("repeat", "rowid", "fold", ranks.alias("ranks"))


def learning_curve(rows: DataFrame, folds: int, sizes: Sequence[int], seed: int = 0, stratify: str | None = None) -> DataFrame:
    """(repeat, fold, sample, type, rowid): nested, growing TRAIN prefixes and the same TEST rows, as a split file has them.

    ``learning_ranks`` says the same with one row per row; it is evaluated once and written.
    """
    ranked = stage(learning_ranks(rows, folds, seed, stratify), "ranks")
    samples = F.array(*[F.struct(F.lit(i).alias("sample"), F.lit(int(n)).alias("size")) for i, n in enumerate(sizes)])
    # Only the places that some prefix reaches leave the row.
    places = F.filter(F.transform("ranks", lambda r, f: F.struct(f.alias("fold"), r.alias("rank"))), lambda p: p["rank"] < max(sizes))
    growing = (
        ranked.select("repeat", "rowid", F.explode(places).alias("r"))
        .select("repeat", "rowid", "r.fold", "r.rank", F.explode(samples).alias("s")).filter("rank < s.size")
        .select("repeat", "fold", "s.sample", F.lit("TRAIN").alias("type"), "rowid")
    )
    tested = ranked.withColumn("sample", F.explode(F.array(*[F.lit(i) for i in range(len(sizes))])))
    return growing.unionByName(tested.select("repeat", "fold", "sample", F.lit("TEST").alias("type"), "rowid"))


def long_form(test_folds: DataFrame, folds: int) -> DataFrame:
    """(repeat, fold, type, rowid): every row once per fold, for files and cell-wise work."""
    every = test_folds.select("repeat", "rowid", F.col("fold").alias("_test"),
                              F.explode(F.sequence(F.lit(0), F.lit(folds - 1))).alias("fold"))
    kind = F.when(F.col("fold") == F.col("_test"), "TEST").otherwise("TRAIN")
    return every.select("repeat", "fold", kind.alias("type"), "rowid")


def cell(splits: DataFrame, repeat: int = 0, fold: int = 0, sample: int = 0) -> DataFrame:
    """(type, rowid) of one cell; an unknown index is an error that names it."""
    in_repeat = F.col("repeat") == repeat
    in_fold = in_repeat & (F.col("fold") == fold)
    in_cell = in_fold & (F.col("sample") == sample)
    known = splits.filter(in_repeat).agg(F.count(F.lit(1)).alias("r"), F.count_if(in_fold).alias("f"), F.count_if(in_cell).alias("s")).first()
    for name, wanted, n in (("Repeat", repeat, known["r"]), ("Fold", fold, known["f"]), ("Sample", sample, known["s"])):
        if not n:
            raise ValueError(f"{name} {wanted} not known")
    return splits.filter(in_cell).select("type", "rowid")


def dimensions(splits: DataFrame) -> DataFrame:
    """(repeats, folds, samples); every repeat must have the same folds, else ``folds`` is NULL."""
    cells = splits.select("repeat", "fold", "sample").distinct()
    per_repeat = cells.groupBy("repeat").agg(
        F.count_distinct("fold").alias("f"), F.count_distinct("sample").alias("s"))
    return per_repeat.agg(
        F.count(F.lit(1)).alias("repeats"),
        F.when(F.min("f") == F.max("f"), F.max("f")).alias("folds"), F.max("s").alias("samples"))


def violations(splits: DataFrame, n_rows: int | Column | None = None) -> DataFrame:
    """(check, repeat, fold, sample, n): cells whose TRAIN and TEST overlap, rows not tested once.

    ``incomplete`` counts the rows a cell lacks; learning-curve samples leave ``n_rows`` out.
    """
    per_row = splits.groupBy("repeat", "fold", "sample", "rowid").agg(
        F.count_if(F.col("type") == "TEST").alias("t"), F.count(F.lit(1)).alias("c"))
    overlap = per_row.filter("c > 1").groupBy("repeat", "fold", "sample").agg(F.count(F.lit(1)).alias("n"))
    found = overlap.select(F.lit("overlap").alias("check"), "repeat", "fold", "sample", "n")
    tested = per_row.groupBy("repeat", "sample", "rowid").agg(F.sum("t").alias("t")).filter("t <> 1")
    found = found.unionByName(tested.groupBy("repeat", "sample").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("not tested once").alias("check"), "repeat", F.lit(None).cast("int").alias("fold"), "sample", "n"))
    if n_rows is not None:
        size = per_row.groupBy("repeat", "fold", "sample").agg(F.count(F.lit(1)).alias("c"))
        lacking = size.withColumn("n", F.lit(n_rows) - F.col("c")).filter("n <> 0")
        found = found.unionByName(lacking.select(F.lit("incomplete").alias("check"), "repeat", "fold", "sample", "n"))
    return found


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows only one split has; empty means equal."""
    columns = ["repeat", "fold", "sample", "type", "rowid"]
    a, b = left.select(*columns), right.select(*columns)
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))
