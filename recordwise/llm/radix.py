"""A distributed LSD radix sort: the place of every row in one total order.

The order is that of whole-number keys, compared one after the other. From the last key's lowest bits to the
first key's highest, each pass is a stable counting sort by one digit: rows lie in blocks of their present
places, the rows of each digit are counted per block, and prefix sums over (digit, block) say where a block's
rows of that digit go; inside, they keep their order. No pass compares keys, no task sees more than a block of
one digit, and after the last pass a row's place is its rank.

Every pass writes its rows and reads them back, so a lost executor repeats at most one pass, and a place
never changes between its two uses. The table of a pass is deleted when the next one is written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordwise.llm.files import dropped, stored

BITS = 11  # of a digit
BLOCK = 1 << 16  # places


def ascending(column: Column) -> Column:
    """A long column as a key whose unsigned digits are in its order."""
    return column.cast("long").bitwiseXOR(F.lit(-(1 << 63)))


def digits(varying: list[int], bits: int = BITS) -> list[tuple[int, int]]:
    """(key, shift) of each pass: the last key first, its low bits first; digits in which no two rows differ are left out."""
    passes = []
    for key in reversed(range(len(varying))):
        rest, shift = varying[key], 0
        while rest:
            lowest = (rest & -rest).bit_length() - 1
            shift, rest = shift + lowest, rest >> lowest
            passes.append((key, shift))
            shift, rest = shift + bits, rest >> bits
    return passes


def counted_pass(rows: DataFrame, key: str, shift: int, bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """One stable counting sort by the digit of ``key`` above ``shift``; ``_place`` becomes the row's new place."""
    digit = F.shiftrightunsigned(key, shift).bitwiseAND(F.lit((1 << bits) - 1))
    rows = rows.withColumn("_digit", digit).withColumn("_block", F.floor(F.col("_place") / block))
    counts = rows.groupBy("_digit", "_block").agg(F.count("*").alias("_n"))
    # one row per digit, at most 2**bits of them
    totals = counts.groupBy("_digit").agg(F.sum("_n").alias("_total"))
    smaller = totals.select("_digit", (F.sum("_total").over(Window.orderBy("_digit")) - F.col("_total")).alias("_smaller"))
    earlier = F.sum("_n").over(Window.partitionBy("_digit").orderBy("_block")) - F.col("_n")
    begins = counts.withColumn("_earlier", earlier).join(F.broadcast(smaller), "_digit")
    begins = begins.select("_digit", "_block", (F.col("_smaller") + F.col("_earlier")).alias("_begin"))
    inside = F.row_number().over(Window.partitionBy("_digit", "_block").orderBy("_place")) - 1
    moved = rows.withColumn("_inside", inside).join(begins, ["_digit", "_block"])
    return moved.withColumn("_place", F.col("_begin") + F.col("_inside")).drop("_digit", "_block", "_inside", "_begin")


def placed(rows: DataFrame) -> DataFrame:
    """``rows`` of a stored table with ``_place``: its place in the files, in the order of their names."""
    spark = rows.sparkSession
    rows = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    sizes = sorted((r[0], r[1]) for r in rows.groupBy("_file").count().collect())  # one row per file
    begins, total = [], 0
    for name, n in sizes:
        begins.append((name, total))
        total += n
    begins = spark.createDataFrame(begins, "_file string, _begin long")
    return rows.join(F.broadcast(begins), "_file").withColumn("_place", F.col("_begin") + F.col("_row")).drop("_file", "_row", "_begin")


def with_place(rows: DataFrame, keys: list[Column], name: str, bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """``rows`` with the column ``name``: their place (0, 1, 2...) in the ascending order of ``keys``.

    Rows with equal keys have neighbouring places in no stated order. NULL comes before all numbers. An empty
    table stays empty. ``rows`` must not hold columns whose names begin with an underscore.
    """
    held = []
    for number, key in enumerate(keys):
        held += [key.isNotNull().cast("long").alias(f"_key{2 * number}"), ascending(F.coalesce(key, F.lit(0))).alias(f"_key{2 * number + 1}")]
    table = stored(rows.select("*", *held), "radix")
    names = [f"_key{i}" for i in range(len(held))]
    spread = table.agg(*(F.bit_or(k).alias(f"or{k}") for k in names), *(F.bit_and(k).alias(f"and{k}") for k in names)).first()
    if spread[f"or{names[0]}"] is None:
        return rows.withColumn(name, F.lit(0).cast("long"))
    varying = [(spread[f"or{k}"] ^ spread[f"and{k}"]) & ((1 << 64) - 1) for k in names]
    current, old = placed(table), table
    for key, shift in digits(varying, bits):
        current = stored(counted_pass(current, names[key], shift, bits, block), "radix")
        dropped(old)
        old = current
    return current.withColumnRenamed("_place", name).drop(*names)
