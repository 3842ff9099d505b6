"""Sharding along a Hilbert curve: quantise metadata, sort by curve index, cut runs of equal row counts.

Only built-in expressions. The order is (curve cell, salt, id, text checksum). Rows are ranked within (cell, salt)
groups, and a group's first rank comes from sums over group counts, so a cell with a third of all rows is ranked in
2**salt_bits parts and no window sees the whole table.

Defined cases: a null text counts no bytes and the checksum of the empty text; a null metadata value takes level 0;
equal rows take neighbouring slots; an empty table gives no rows. Columns that the operator adds replace input columns
of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanforge.llm.shared import crc_of_id


def curve_table(dims: int) -> list[tuple[int, int]]:
    """By state * 2**dims + cell: (next state, digit). A state is the entry corner and the axis of the current cube;
    corner e and axis d are state e * dims + d. Follows from the Gray code: the cell's bits are taken relative to the
    corner, rotated by the axis, and their rank in the Gray code is the digit."""
    size, mask = 1 << dims, (1 << dims) - 1
    right = lambda x, k: ((x >> k % dims) | (x << (dims - k % dims))) & mask
    left = lambda x, k: right(x, dims - k % dims)
    trailing = lambda x: (~x & (x + 1)).bit_length() - 1
    out = []
    for state in range(size * dims):
        corner, axis = divmod(state, dims)
        for cell in range(size):
            gray, digit = right(cell ^ corner, axis + 1), 0
            while gray:
                digit, gray = digit ^ gray, gray >> 1
            enter = 0 if digit == 0 else (even := 2 * ((digit - 1) // 2)) ^ (even >> 1)
            turn = 0 if digit == 0 else trailing(digit - 1 if digit % 2 == 0 else digit) % dims
            out.append(((corner ^ left(enter, axis + 1)) * dims + (axis + turn + 1) % dims, digit))
    return out


def hilbert_index(levels: list[Column], bits: int) -> Column:
    """Curve index of integer levels in [0, 2**bits), most significant bits first."""
    dims = len(levels)
    table = curve_table(dims)
    array = lambda k: F.array(*[F.lit(x[k]) for x in table])
    step = F.lit(0)
    for axis, level in enumerate(levels):
        step = step.bitwiseOR(F.shiftleft(level, axis)) if axis else level
    cells = F.array(*[sum((F.shiftright(level, b).bitwiseAND(F.lit(1)) * (1 << axis) for axis, level in enumerate(levels)), F.lit(0)) for b in range(bits - 1, -1, -1)])

    def move(acc: Column, cell: Column) -> Column:
        at = acc["s"] * (1 << dims) + cell
        return F.struct(F.get(array(0), at).alias("s"), (acc["h"] * (1 << dims) + F.get(array(1), at)).alias("h"))

    return F.aggregate(cells, F.struct(F.lit(0).alias("s"), F.lit(0).cast("long").alias("h")), move, lambda acc: acc["h"])


def log_level(value: Column, bits: int) -> Column:
    """Level by powers of two of a count; null and negative: 0."""
    return F.coalesce(F.least(F.lit((1 << bits) - 1), F.length(F.bin(F.greatest(value, F.lit(0)))) - 1), F.lit(0)).cast("int")


def name_level(value: Column, bits: int) -> Column:
    """Level by checksum of a name; null: 0."""
    return F.coalesce(F.pmod(F.crc32(value), F.lit(1 << bits)), F.lit(0)).cast("int")


def hilbert_shards(docs: DataFrame, levels: list[Column], bits: int = 4, shards: int = 16, salt_bits: int = 6, id_column: str = "doc_id") -> DataFrame:
    """docs with size, text_crc32, curve (the index), shard and slot; shard counts differ by one at most."""
    salt = F.pmod(crc_of_id(id_column), F.lit(1 << salt_bits)).cast("int")
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.withColumns({"size": (F.octet_length(text) + 1).cast("long"), "text_crc32": F.crc32(text), "curve": hilbert_index(levels, bits), "_salt": salt})
    groups = docs.select(hilbert_index(levels, bits).alias("curve"), salt.alias("_salt")).groupBy("curve", "_salt").agg(F.count("*").alias("_n"))
    cells = groups.groupBy("curve").agg(F.sum("_n").alias("_cell_n"))
    cells = cells.withColumns({"_cell_first": F.sum("_cell_n").over(Window.orderBy("curve")) - F.col("_cell_n"), "_total": F.sum("_cell_n").over(Window.partitionBy())}).drop("_cell_n")
    within = F.sum("_n").over(Window.partitionBy("curve").orderBy("_salt")) - F.col("_n")
    firsts = groups.withColumn("_within", within).join(cells, "curve").select("curve", "_salt", "_total", (F.col("_cell_first") + F.col("_within")).alias("_first"))
    order = Window.partitionBy("curve", "_salt").orderBy(id_column, "text_crc32", "size")
    ranked = base.withColumn("_row", F.row_number().over(order)).join(firsts, ["curve", "_salt"])
    ranked = ranked.withColumn("_rank", F.col("_first") + F.col("_row") - 1)
    shard = F.expr(f"_rank * {shards} div _total")
    return ranked.withColumn("shard", shard.cast("int")).withColumn("slot", F.col("_rank") - F.expr(f"(shard * _total + {shards - 1}) div {shards}")).drop("_salt", "_row", "_first", "_total", "_rank")


def document_levels(bits: int = 4) -> list[Column]:
    return [name_level(F.col("lang"), bits), name_level(F.col("source"), bits), log_level(F.col("n_chars"), bits)]


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder a shard, rows in slot order, so that Parquet's min and max prune files in every quantised dimension."""
    sharded.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op4_hilbert_shards(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    slim = ["doc_id", "size", "text_crc32"]
    out = hilbert_shards(docs, document_levels())
    return out.select(*slim, F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), F.col("curve").alias("curve_index"))
