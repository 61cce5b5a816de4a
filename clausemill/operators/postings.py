"""Postings of terms with block maxima: ranked search that reads only the blocks that can hold one of the best.

Units lie in blocks of BLOCK that follow each other in the order of volume and ord. A term's postings hold, for each unit,
how often the term occurs and the columns that searches filter by; for each block a summary holds the most occurrences, the
greatest weight and the first unit. The files of both are sorted by term and block, so a search reads the pages of its terms,
and of these the blocks it asks for. Units are dealt by ranges once, and postings are not moved from where they are made. A
search takes blocks by the best rank that they can hold, and stops when the k-th unit found comes before anything that is left.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clausemill.sources.files import scratch_path, written

BLOCK = 4096
#: Units whose postings one task sorts.
TASK_UNITS = 1 << 17
#: Blocks that a search reads at first; then always twice as many.
FIRST_BLOCKS = 4
_WORD = r"\w+"
_POSTINGS = """block long, volume string, ord long, unit_label string, unit_type string, applies_state string, section_code string,
  applies_to_class string, weight int, term string, tf int"""
_SUMMARIES = "term string, block long, tf int, weight int, first struct<volume: string, ord: long>"
_FOUND = pa.schema([("volume", pa.string()), ("ord", pa.int64()), ("unit_label", pa.string()), ("rank", pa.int32()), ("weight", pa.int32())])
_UNIT = ["volume", "ord", "unit_label", "unit_type", "applies_state", "section_code", "applies_to_class", "weight"]


@dataclass
class PostingsIndex:
    path: str

    def postings(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(_POSTINGS).parquet(f"{self.path}/postings")

    def summaries(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(_SUMMARIES).parquet(f"{self.path}/summaries")


def unit_weight():
    """Of a requirement 2, of a provision or method 1, else 0."""
    return F.when(F.col("unit_type") == "PERFORMANCE_REQUIREMENT", 2).when(F.col("unit_type").isin("DTS_PROVISION", "VERIFICATION_METHOD"), 1).otherwise(0)


def build_postings(units: DataFrame, path: str | None = None) -> PostingsIndex:
    """The index of all ``units`` (volume, ord, unit_label, unit_type, applies_state, section_code, text and, if there,
    applies_to_class), written once. Terms are runs of letters, digits and underscores, in any case; a null text has none.
    (volume, ord) names a unit."""
    spark = units.sparkSession
    path = path or scratch_path(spark)
    if "applies_to_class" not in units.columns:
        units = units.withColumn("applies_to_class", F.lit(""))
    whole = written(units.withColumn("weight", unit_weight()).select(*_UNIT, "text"))
    parts = max(-(-whole.count() // TASK_UNITS), spark.sparkContext.defaultParallelism)
    ordered = whole.repartitionByRange(parts, "volume", "ord").sortWithinPartitions("volume", "ord")
    # A block never crosses a partition; its number follows the order of units.
    blocks = ordered.withColumn("block", F.shiftright(F.monotonically_increasing_id(), (BLOCK - 1).bit_length())).where("text is not null")
    counted = blocks.withColumn("words", F.array_sort(F.regexp_extract_all(F.lower("text"), F.lit(_WORD), F.lit(0)))).drop("text").where("size(words) > 0")
    # A unit's terms are counted where it lies: the last place of each in its sorted words.
    last = counted.withColumn("ends", F.expr("filter(sequence(1, size(words)), i -> i = size(words) or words[i - 1] <> words[i])"))
    terms = last.select("block", *_UNIT, F.explode(F.expr("transform(ends, (e, k) -> struct(words[e - 1] as term, cast(e - if(k = 0, 0, ends[k - 1]) as int) as tf))")).alias("t"))
    rows = terms.select("block", *_UNIT, "t.term", "t.tf")
    # Postings stay in the task that made them, which sorts its own.
    rows.sortWithinPartitions("term", "block", "volume", "ord").write.parquet(f"{path}/postings")
    index = PostingsIndex(path)
    first = F.min(F.struct("volume", "ord")).alias("first")
    sums = index.postings(spark).groupBy("term", "block").agg(F.max("tf").alias("tf"), F.max("weight").alias("weight"), first)
    sums.repartitionByRange("term", "block").sortWithinPartitions("term", "block").write.parquet(f"{path}/summaries")
    return index


def _of_terms(table: DataFrame, terms: list[str]) -> DataFrame:
    """Rows of the terms; files are sorted by them, so that other pages are not read."""
    return table.where(F.col("term").isin(terms))


def search(spark: SparkSession, index: PostingsIndex, terms: list[str], state: str, types: list[str], k: int = 5, section: str | None = None, building_class: str | None = None) -> DataFrame:
    """R-7: the k best units for a state and of some types, and if given of a section and with a class in applies_to_class:
    (volume, ord, unit_label, rank, weight). The rank, ours, is how often the terms occur; then weight, volume and ord.
    Terms are single words; a term in no text adds nothing, and without terms nothing is found."""
    found, _ = search_blocks(spark, index, terms, state, types, k, section, building_class)
    # k rows: as Arrow data they are a local relation, without a job of their own.
    columns = list(zip(*found)) or [()] * len(_FOUND)
    return spark.createDataFrame(pa.table([pa.array(c, f.type) for c, f in zip(columns, _FOUND)], schema=_FOUND))


def search_blocks(spark: SparkSession, index: PostingsIndex, terms: list[str], state: str, types: list[str], k: int, section: str | None, building_class: str | None) -> tuple[list[tuple], int]:
    """The k best, and how many blocks were read."""
    terms = sorted({t.lower() for t in terms})
    if not terms:
        return [], 0
    best_of = F.struct(-F.sum("tf"), -F.max("weight"), F.min("first.volume"), F.min("first.ord"))
    bounds = _of_terms(index.summaries(spark), terms).groupBy("block").agg(best_of.alias("bound"))
    postings = _of_terms(index.postings(spark), terms).where(F.col("applies_state").isin("", state) & F.col("unit_type").isin(types))
    if section is not None:
        postings = postings.where(F.col("section_code") == section)
    if building_class is not None:
        postings = postings.where(F.contains("applies_to_class", F.lit(building_class)))
    order = [F.desc("rank"), F.desc("weight"), "volume", "ord"]
    best: list[tuple] = []
    last, read, take = None, 0, FIRST_BLOCKS
    while True:
        # Blocks after those read, by what they can hold at best; only one batch comes to the driver.
        left = bounds if last is None else bounds.where(F.struct("bound", "block") > F.struct(_like(last[0]), F.lit(last[1]).cast("long")))
        batch = [(tuple(r["bound"]), r["block"]) for r in left.orderBy("bound", "block").limit(take + 1).collect()]
        now, ahead = batch[:take], batch[take:]
        if now:
            rows = postings.where(F.col("block").isin([b for _, b in now])).groupBy("volume", "ord", "unit_label", "weight").agg(F.sum("tf").cast("int").alias("rank"))
            some = rows.orderBy(*order).limit(k).select("volume", "ord", "unit_label", "rank", "weight").collect()
            best = sorted([*best, *map(tuple, some)], key=lambda r: (-r[3], -r[4], r[0], r[1]))[:k]
            read += len(now)
        if not ahead or (len(best) == k and (-best[-1][3], -best[-1][4], best[-1][0], best[-1][1]) < ahead[0][0]):
            return best, read
        last, take = now[-1], take * 2


def _like(bound: tuple):
    rank, weight, volume, ord_ = bound
    return F.struct(F.lit(rank).cast("long"), F.lit(weight).cast("int"), F.lit(volume), F.lit(ord_).cast("long"))
