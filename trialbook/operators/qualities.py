"""Dataset qualities: simple, statistical and information-theoretic.

Percentages run from 0 to 100, deviations and higher moments are those of the population,
kurtosis is the excess, entropies are in bits over observed frequencies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialbook.operators.datasets import Feature

# Columns per array or aggregate, so that wide tables do not make one expression of thousands of terms.
COLUMNS_PER_PASS = 200


def _rows(pairs: Sequence[tuple[str, Column]]) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(n).alias("name"), c.cast("double").alias("value")) for n, c in pairs]))


def _long(one_row: DataFrame, pairs: Sequence[tuple[str, Column]]) -> DataFrame:
    return one_row.select(_rows(pairs).alias("q")).select("q.*")


def simple(df: DataFrame, features: Sequence[Feature]) -> DataFrame:
    """Counts and shares of rows, columns and missing values."""
    numeric = sum(f.data_type == "numeric" for f in features)
    nominal = sum(f.data_type == "nominal" for f in features)
    binary = sum(f.data_type == "nominal" and len(f.nominal_values or ()) == 2 for f in features)
    # Gaps are counted in arrays of some columns each, so a wide table makes no deep expression.
    names = ["`" + f.name.replace("`", "``") + "` IS NULL" for f in features]
    gaps = [F.expr(f"size(filter(array({', '.join(names[i : i + COLUMNS_PER_PASS])}), x -> x))") for i in range(0, len(names), COLUMNS_PER_PASS)]
    one = df.select(F.aggregate(F.array(*gaps), F.lit(0).cast("long"), lambda a, x: a + x).alias("g")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("g").alias("missing"), F.count_if(F.col("g") > 0).alias("incomplete"))
    n, width = F.col("n"), F.lit(float(len(features)))
    missing, incomplete = F.coalesce("missing", F.lit(0)), F.col("incomplete")
    return _long(one, [
        ("NumberOfInstances", n), ("NumberOfFeatures", width), ("NumberOfMissingValues", missing),
        ("NumberOfInstancesWithMissingValues", incomplete), ("NumberOfNumericFeatures", F.lit(numeric)),
        ("NumberOfSymbolicFeatures", F.lit(nominal)), ("NumberOfBinaryFeatures", F.lit(binary)),
        ("PercentageOfMissingValues", F.try_divide(100.0 * missing, n * width)),
        ("PercentageOfInstancesWithMissingValues", F.try_divide(100.0 * incomplete, n)),
        ("PercentageOfNumericFeatures", F.lit(100.0 * numeric / len(features))),
        ("PercentageOfSymbolicFeatures", F.lit(100.0 * nominal / len(features))),
        ("PercentageOfBinaryFeatures", F.lit(100.0 * binary / len(features))),
        ("Dimensionality", F.try_divide(width, n)),
    ])


def column_moments(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(i, m0, m1, m2, m3): mean, deviation, skewness and kurtosis of each column, in one pass over the table.

    A few columns are aggregated side by side. Many are turned into rows (column, value) as they are read, which are
    aggregated before anything is exchanged; so the plan does not grow with the columns.
    """
    def four(column: Column) -> list[Column]:
        return [f(column) for f in (F.avg, F.stddev_pop, F.skewness, F.kurtosis)]

    if len(names) <= COLUMNS_PER_PASS:
        one = df.agg(*[c.cast("double").alias(f"{i}#{k}") for i, n in enumerate(names) for k, c in enumerate(four(F.col(n)))])
        return one.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), *[F.col(f"`{i}#{k}`").alias(f"m{k}") for k in range(4)]) for i in range(len(names))])).alias("m")).select("m.*")
    # Columns that follow each other make one array, so no expression has thousands of terms.
    # They are named in one text, since a call for each would take longer than the pass.
    quoted = ["double(`" + n.replace("`", "``") + "`)" for n in names]
    parts = [f"array({', '.join(quoted[i : i + COLUMNS_PER_PASS])})" for i in range(0, len(names), COLUMNS_PER_PASS)]
    long = df.select(F.expr(f"posexplode(array({', '.join(parts)})) AS (part, values)")).select("part", F.posexplode("values").alias("k", "x")).filter("x IS NOT NULL")
    found = long.groupBy("part", "k").agg(*[c.alias(f"m{k}") for k, c in enumerate(four(F.col("x")))])
    return found.select((F.col("part") * COLUMNS_PER_PASS + F.col("k")).alias("i"), *[f"m{k}" for k in range(4)])


def moments(df: DataFrame, features: Sequence[Feature]) -> DataFrame:
    """Means over numeric columns of mean, deviation, skewness and kurtosis."""
    names = [f.name for f in features if f.data_type == "numeric" and not f.is_target]
    if not names:
        return df.sparkSession.createDataFrame([], "name string, value double")
    one = column_moments(df, names).agg(*[F.avg(F.nanvl(f"m{i}", F.lit(None).cast("double"))).alias(f"m{i}") for i in range(4)])
    return _long(one, [(f"Mean{what}OfNumericAtts", F.col(f"m{i}"))
                       for i, what in enumerate(("Means", "StdDev", "Skewness", "Kurtosis"))])


def _bits(n: str) -> Column:
    """Entropy of counts: log2 of the total less the mean log2 of the counts."""
    total = F.sum(n)
    return F.log2(total) - F.sum(F.col(n) * F.log2(n)) / total


def classes(df: DataFrame, target: Feature) -> DataFrame:
    """Class sizes over the declared domain, so a class without rows counts 0."""
    counts = df.filter(F.col(target.name).isNotNull()).groupBy(target.name).agg(F.count(F.lit(1)).alias("n"))
    domain = len(target.nominal_values or ())
    one = counts.agg(F.count(F.lit(1)).alias("seen"), F.sum("n").alias("total"), F.max("n").alias("most"),
                     F.min("n").alias("least"), _bits("n").alias("h"))
    smallest = F.when(F.col("seen") < domain, F.lit(0)).otherwise(F.col("least"))
    share = F.try_divide(F.col("most").cast("double"), F.col("total"))
    rows = [
        ("NumberOfClasses", F.lit(domain)), ("MajorityClassSize", F.coalesce("most", F.lit(0))),
        ("MinorityClassSize", smallest), ("DefaultAccuracy", share), ("MajorityClassPercentage", 100.0 * share),
        ("MinorityClassPercentage", F.try_divide(100.0 * smallest, F.col("total"))), ("ClassEntropy", F.col("h")),
    ]
    return _long(one, rows)


def attribute_information(df: DataFrame, features: Sequence[Feature], target: Feature) -> DataFrame:
    """(attribute, entropy, mutual_information) of the nominal inputs against the class.

    One pass counts (attribute, value, class); all the rest works on those counts. Only rows
    with both value and class are counted.
    """
    names = [f.name for f in features if f.data_type == "nominal" and f.name != target.name]
    long = df.filter(F.col(target.name).isNotNull()).select(
        F.col(target.name).alias("y"),
        F.explode(F.array(*[F.struct(F.lit(n).alias("attribute"), F.col(n).alias("x")) for n in names])).alias("c"),
    ).select("c.attribute", "c.x", "y").filter("x IS NOT NULL")
    joint = long.groupBy("attribute", "x", "y").agg(F.count(F.lit(1)).alias("n"))

    def entropy(part: DataFrame, name: str) -> DataFrame:
        return part.groupBy("attribute").agg(_bits("n").alias(name))

    def margin(column: str) -> DataFrame:
        return joint.groupBy("attribute", column).agg(F.sum("n").alias("n"))

    both = entropy(joint, "hxy").join(entropy(margin("x"), "hx"), "attribute").join(entropy(margin("y"), "hy"), "attribute")
    return both.select("attribute", F.col("hx").alias("entropy"),
                       F.greatest(F.col("hx") + F.col("hy") - F.col("hxy"), F.lit(0.0)).alias("mutual_information"))


def nominal(df: DataFrame, features: Sequence[Feature], target: Feature) -> DataFrame:
    """Domain sizes, attribute entropy, mutual information and what follows from them."""
    sizes = [len(f.nominal_values or ()) for f in features if f.data_type == "nominal" and f.name != target.name]
    if not sizes:
        return df.sparkSession.createDataFrame([], "name string, value double")
    mean = sum(sizes) / len(sizes)
    spread = (sum((s - mean) ** 2 for s in sizes) / len(sizes)) ** 0.5
    info = attribute_information(df, features, target).agg(F.avg("entropy").alias("h"), F.avg("mutual_information").alias("mi"))
    class_bits = df.filter(F.col(target.name).isNotNull()).groupBy(target.name).agg(F.count(F.lit(1)).alias("n")).agg(_bits("n").alias("hy"))
    one = info.join(F.broadcast(class_bits))  # one row each
    return _long(one, [
        ("MeanNominalAttDistinctValues", F.lit(mean)), ("MinNominalAttDistinctValues", F.lit(min(sizes))),
        ("MaxNominalAttDistinctValues", F.lit(max(sizes))), ("StdvNominalAttDistinctValues", F.lit(spread)),
        ("MeanAttributeEntropy", F.col("h")), ("MeanMutualInformation", F.col("mi")),
        ("EquivalentNumberOfAtts", F.try_divide(F.col("hy"), F.col("mi"))),
        ("MeanNoiseToSignalRatio", F.try_divide(F.col("h") - F.col("mi"), F.col("mi"))),
    ])


def all_qualities(df: DataFrame, features: Sequence[Feature]) -> DataFrame:
    """(name, value) of every quality; those of the class need a nominal target."""
    out = simple(df, features).unionByName(moments(df, features))
    target = next((f for f in features if f.is_target and f.data_type == "nominal"), None)
    if target is not None:
        out = out.unionByName(classes(df, target)).unionByName(nominal(df, features, target))
    return out
